"""Golden values (export tests of the reference and our own pinned decisions)."""

from tessera.functions import keys as K
from tessera.functions.color import deterministic_color, rgba_from_hex
from tessera.operators import cells as C
from tessera.operators import layers as L
from tessera.operators import raster as R


def _split(spark, s):
    return [r["item"] for r in L.split_request(spark, s).orderBy("pos").collect()]


def test_split_request(spark):
    assert _split(spark, "a,b,c") == ["a", "b", "c"]
    assert _split(spark, "a b c") == ["a", "b", "c"]
    assert _split(spark, "a, b,c") == ["a", "b", "c"]
    assert _split(spark, "a") == ["a"]
    assert _split(spark, "") == []
    assert _split(spark, "x Cathepsin B,y") == ["x", "Cathepsin B", "y"]


def test_resolve_requested_layers(spark):
    cat = spark.createDataFrame([("a",), ("b",), ("Cathepsin B",)], "name string")
    kept, bad = L.resolve_requested_layers(spark, "a, zz Cathepsin B", cat)
    assert [r["name"] for r in kept.orderBy("pos").collect()] == ["a", "Cathepsin B"]
    assert [r["name"] for r in bad.collect()] == ["zz"]
    kept, bad = L.resolve_requested_layers(spark, "", cat)
    assert sorted(r["name"] for r in kept.collect()) == ["Cathepsin B", "a", "b"]


def test_batch_layers(spark):
    items = spark.createDataFrame([(0, "item1"), (1, "item2"), (2, "item3")], "seq int, name string")
    got = {r["batch"]: r["items"] for r in L.batch_layers(items, 2).collect()}
    assert got == {0: ["item1", "item2"], 1: ["item3"]}
    got = {r["batch"]: r["items"] for r in L.batch_layers(items, 2, labels="labels_data").collect()}
    assert got == {0: ["labels_data", "item1", "item2"], 1: ["labels_data", "item3"]}


def _grid_df(spark, grid):
    rows = [(r, c, int(v)) for r, line in enumerate(grid) for c, v in enumerate(line)]
    return spark.createDataFrame(rows, "row int, col int, val long")


def _to_grid(rows, h, w, default=0):
    g = [[default] * w for _ in range(h)]
    for r in rows:
        g[r["row"]][r["col"]] = r["val"]
    return g


def test_label_boundaries_golden(spark):
    x = [[1, 1, 2], [1, 1, 1], [1, 1, 1]]
    got = _to_grid(R.label_boundaries(_grid_df(spark, x), 3, 3).collect(), 3, 3)
    assert got == [[0, 1, 1], [0, 1, 1], [0, 0, 0]]
    scaled = _to_grid(R.label_boundaries(_grid_df(spark, x), 3, 3, scaled=True).collect(), 3, 3)
    assert scaled == [[100, 10000, 10000], [100, 10000, 10000], [100, 100, 100]]


def test_deterministic_color(spark):
    df = spark.createDataFrame([("T cell",), ("",), (None,)], "t string")
    got = [r["c"] for r in df.select(deterministic_color("t").alias("c")).collect()]
    assert got == ["#FC7E99", "", ""]
    rgba = df.limit(1).select(rgba_from_hex(deterministic_color("t")).alias("x")).first()["x"]
    assert rgba == "rgba(252,126,153,0.3)"


def test_parse_acquisition_name(spark):
    df = spark.createDataFrame([("dir/20241205_S3_C902_P99_N99_F00017.TIF",)], "path string")
    r = K.parse_acquisition_name(df).first()
    assert (r["fov"], r["cycle"], r["pool"], r["spot"], r["slide"], r["zslice"]) == (17, 902, 99, 99, 3, None)
    assert r["timestamp"] is None


def test_cell_uid(spark):
    df = spark.createDataFrame([("c_1_12_345",)], "cell_ID string")
    uid = K.cell_uid(df).first()["UID"]
    assert uid == 345 * 345 + 12 == 119037
    back = K.unpair_key(spark.createDataFrame([(uid,)], "z long"), "z").first()
    assert (back["fov"], back["CellId"]) == (12, 345)


def test_cluster_label_median(spark):
    df = spark.createDataFrame([(float(v), 0.0, "A", 1) for v in (1, 2, 4, 9)],
                               "UMAP_1 double, UMAP_2 double, cell_type string, fov int")
    r = C.cluster_labels(df).first()
    assert r["median_1"] == 3.0 and r["n"] == 4 and r["label"] == "A (100.0%)"


def test_segmentation_dir(spark):
    df = spark.createDataFrame([("Segmentation_abc-123_002",), ("Segmentation_abc",), ("other_7",)], "dir string")
    got = [(r["uuid"], r["version"]) for r in K.parse_segmentation_dir(df).collect()]
    assert got == [("abc-123", 2), ("abc", 0), ("other", 7)]


def test_short_run_name(spark):
    df = spark.createDataFrame([("s3://b/x/Liver_A_06_04_2026_12_30_21_218/",), ("22426_06_04_2026",), ("plain",)],
                               "p string")
    got = [r["s"] for r in df.select(K.short_run_name("p").alias("s")).collect()]
    assert got == ["Liver_A", "22426", "plain"]
    got = [r["s"] for r in df.select(K.strip_run_suffix("p").alias("s")).collect()]
    assert got[1] == ""


def test_parse_barcode(spark):
    df = spark.createDataFrame([("bbGGbb",), ("RRx",)], "colorCode string")
    got = [(r["color"], r["spot"], r["id"]) for r in K.parse_barcode(df).collect()]
    assert got == [("GG", 3, "N03_GG"), ("RR", 1, "N01_RR")]
