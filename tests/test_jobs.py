"""X2 slide processing over a miniature bucket tree."""

import gzip
import os

import numpy as np
import pytest

from tessera.functions.keys import OUTPUT_ROOT, pair_key
from tessera.operators import blocks as BL
from tessera.plans import jobs
from tessera.plans.jobs import committed, slide_processing_job

SUFFIX = "__complete_code_cell_target_call_coord.csv"
HEADER = "fov,CellId,x,y,z,target,CellComp\n"


def _touch(path, text="x", gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)


def _slide(root, exp, run, slide, scan, versions, calls=True, locations=True, meta=None):
    base = f"{root}/{exp}/{run}/DecodedFiles/{slide}/{scan}"
    for name, fovs in versions.items():
        for f in fovs:
            _touch(f"{base}/CellStatsDir/{name}/FOV{f:03d}/CellLabels_F{f:03d}.TIF")
    if locations:
        _touch(f"{base}/RunSummary/x_FOV_Locations.csv", "FOV,X_mm,Y_mm,Z_um\n1,0,0,1\n2,0.5,0,1\n")
    if calls:
        _touch(f"{base}/AnalysisResults/abc/FOV001/R{SUFFIX}", HEADER + f"1,1,0.5,0.5,1,{run}{slide},Nuclear\n")
        # another column order
        _touch(f"{base}/AnalysisResults/abc/FOV002/R{SUFFIX}", "target,CellComp,z,y,x,CellId,fov\n" + f"{run}{slide},Nuclear,1,0.25,1.5,0,2\n")
        _touch(f"{base}/AnalysisResults/abc/R{SUFFIX}", HEADER + "9,9,9,9,9,Wrong,Nuclear\n")
    if meta:
        _touch(f"{root}/{exp}/{run}/flatFiles/{slide}/{slide}_metadata_file.csv.gz", meta, gz=True)
    return base


def _tree(root, exp):
    typing = "RNA_RNA_Cell.Typing.InSituType.X_clusters"
    base = _slide(root, exp, "RunA", "Slide1", "Scan1", {"Segmentation_uu1_001": [1, 2, 3, 4], "Segmentation_uu2_002": [1, 2], "Segmentation_uu3_003": [1, 2, 3, 4]},
                  meta=f"fov,cell_ID,cell_id,cellSegmentationSetId,{typing}\n1,1,c_1_1_1, uu2 ,T\n1,2,c_1_1_2,uu1,\n1,3,c_1_1_3,uu9,B\n")
    _touch(f"{base}/CellStatsDir/FOV005/CellLabels_F005.TIF")
    # the same slide name in another run; its id matches no folder: highest manifest version
    other = _slide(root, exp, "RunB", "Slide1", "Scan7", {"Segmentation_uu1_001": [1, 2], "Segmentation_uu5_002": [1, 2]},
                   meta=f"cell_id,{typing},cellSegmentationSetId,cell_ID,fov\nc_1_1_1,Z,gone,1,1\nc_1_1_2,Z,uu5,2,1\n")
    _touch(f"{other}/CellStatsDir/Segmentation_uu5_002/manifest.json", '{"Version": "7"}')
    _touch(f"{other}/CellStatsDir/Segmentation_uu1_001/manifest.json", '{"Version": "3"}')
    _slide(root, exp, "RunA", "Slide3", "Scan3", {"Segmentation_zz_001": [1]}, calls=False, meta="fov,cell_ID,cell_id,cellSegmentationSetId\n1,1,c,zz\n")
    _slide(root, exp, "RunA", "Slide4", "Scan4", {"Segmentation_zz_001": [1]}, locations=False)
    # processed already elsewhere; Logs folders are not slides
    _slide(root, exp, "RunA", "Slide2", "Scan2", {"Segmentation_zz_001": [1]})
    _touch(f"{root}/{OUTPUT_ROOT}/{exp}/RunA/Slide2/images/done")
    _touch(f"{root}/{exp}/RunA/DecodedFiles/Logs/Scan9/log.txt")


def test_slide_processing_job(spark, scratch):
    root, exp, out, log = f"{scratch}/_bucket", "St/Exp", f"{scratch}/out", f"{scratch}/runlog"
    _tree(root, exp)
    base = f"{exp}/RunA/DecodedFiles/Slide1/Scan1"
    tiles = spark.createDataFrame([(base, "Segmentation_uu2_002", 1, 0, 0, 4), (base, "Segmentation_uu2_002", 2, 1, 1, 5), (base, "Segmentation_uu3_003", 1, 0, 1, 9)],
                                  "slide_base_path string, dir string, fov int, row int, col int, val long")
    res = slide_processing_job(spark, root, exp, out, log, tiles=tiles, fov_size=(2, 2), um_per_px=250.0, resources=(4, 16))
    assert sorted((r["run"], r["slide"]) for r in res["slides"].collect()) == [("RunA", "Slide1"), ("RunA", "Slide3"), ("RunA", "Slide4"), ("RunB", "Slide1")]
    sel = {(r["slide_base_path"].split("/")[2], r["dir"], r["rank"]) for r in res["selected"].collect() if "/Slide1/" in r["slide_base_path"]}
    # RunA: primary v2 covers FOV 1, 2; older v1 adds 3, 4; newer v3 is never used. RunB: fallback.
    assert sel == {("RunA", "Segmentation_uu2_002", 0), ("RunA", "Segmentation_uu1_001", 1), ("RunB", "Segmentation_uu5_002", 0)}
    label = {r["fov"]: r["dir"] for r in res["label_tiles"].collect() if r["slide_base_path"] == base}
    assert label == {1: "Segmentation_uu2_002", 2: "Segmentation_uu2_002", 3: "Segmentation_uu1_001", 4: "Segmentation_uu1_001", 5: "CellStatsDir"}
    rows = {(r["run"], r["slide_name"]): r for r in spark.read.parquet(log).collect()}
    assert {k: (r["status"], r["failed_step"]) for k, r in rows.items()} == {
        ("RunA", "Slide1"): ("success", ""), ("RunB", "Slide1"): ("success", ""),
        ("RunA", "Slide3"): ("failed", "read_targets"), ("RunA", "Slide4"): ("failed", "stitch")}
    one = rows["RunA", "Slide1"].asDict()
    assert len(one) == 17 and one["vcpus"] == 4 and one["fov_count"] == 5 and one["duration_total_s"].isdigit()
    t = spark.read.parquet(f"{out}/targets").collect()
    assert sorted((r["run"], r["slide"], r["fov"], r["CellId"], r["x"], r["y"], r["target"]) for r in t) == [
        ("RunA", "Slide1", 1, 1, 0.5, 0.5, "RunASlide1"), ("RunA", "Slide1", 2, 0, 1.5, 0.25, "RunASlide1"),
        ("RunB", "Slide1", 1, 1, 0.5, 0.5, "RunBSlide1"), ("RunB", "Slide1", 2, 0, 1.5, 0.25, "RunBSlide1")]
    m = spark.read.option("header", True).csv(f"{out}/metadata").collect()
    assert sorted((r["run"], r["cell_ID"], r["cell_type"] or "") for r in m) == [("RunA", "c_1_1_1", "T"), ("RunA", "c_1_1_2", ""), ("RunB", "c_1_1_2", "Z")]
    stats = {r["run"]: (r["rows_read"], r["rows_written"], r["n_types"]) for r in res["metadata_stats"].where("slide = 'Slide1'").collect()}
    assert stats["RunA"] == (3, 2, 1)
    g = {(r["run"], r["slide"]): len(r["fov_offsets"]) for r in spark.read.parquet(f"{out}/geometry").collect()}
    assert g == {("RunA", "Slide1"): 2, ("RunB", "Slide1"): 2}
    from pyspark.sql import functions as F
    want = {r[0] for r in spark.createDataFrame([(1, 4), (2, 5)], "f int, c int").select(pair_key(F.col("f"), F.col("c"))).collect()}
    px = spark.read.parquet(f"{out}/labels").where("run = 'RunA'").select(F.explode("px.val").alias("v"))
    assert {r["v"] for r in px.collect()} == want
    status = lambda: sorted((r["run"], r["slide"], r["status"]) for r in spark.read.parquet(f"{out}/status").collect())
    before = status()
    assert len(before) == 4
    # nothing to do: nothing is written, read or logged
    again = slide_processing_job(spark, root, exp, out, log, fov_size=(2, 2), um_per_px=250.0)
    assert again["slides"].count() == 0 and spark.read.parquet(log).count() == 4 and status() == before
    # a later slide does not erase the earlier ones
    _slide(root, exp, "RunC", "Slide1", "Scan8", {"Segmentation_uu8_001": [1]}, meta="fov,cell_ID,cell_id,cellSegmentationSetId\n1,1,c_1_1_1,uu8\n")
    third = slide_processing_job(spark, root, exp, out, log, fov_size=(2, 2), um_per_px=250.0)
    assert [(r["run"], r["slide"]) for r in third["slides"].collect()] == [("RunC", "Slide1")]
    assert sorted({r["run"] for r in spark.read.parquet(f"{out}/targets").collect()}) == ["RunA", "RunB", "RunC"]
    assert len(status()) == 5 and spark.read.parquet(log).count() == 5


ONE = "fov,cell_ID,cell_id,cellSegmentationSetId\n1,1,c_1,zz\n"


def _three(root, exp):
    """Three slides of which the second can be spoilt."""
    return [_slide(root, exp, run, slide, "Scan1", {"Segmentation_zz_001": [1, 2]}, meta=ONE)
            for run, slide in (("RunA", "Slide1"), ("RunB", "Slide2"), ("RunB", "Slide3"))]


def _results(spark, out):
    status = {(r["run"], r["slide"]): (r["status"], r["failed_step"]) for r in spark.read.parquet(f"{out}/status").collect()}
    return status, {t: {(r["run"], r["slide"]) for r in committed(spark, out, t).select("run", "slide").distinct().collect()}
                    for t in ("targets", "metadata", "geometry")}


SPOIL = {
    "value": (lambda base: _touch(f"{base}/AnalysisResults/abc/FOV001/R{SUFFIX}", HEADER + "1,1,oops,0.5,1,g,Nuclear\n"), "read_targets"),
    "column": (lambda base: _touch(f"{base}/AnalysisResults/abc/FOV001/R{SUFFIX}", "fov,CellId,y,z,target,CellComp\n1,1,0.5,1,g,Nuclear\n"), "read_targets"),
    "location": (lambda base: _touch(f"{base}/RunSummary/x_FOV_Locations.csv", "FOV,X_mm,Y_mm,Z_um\n1,0,zero,1\n"), "stitch"),
    "broken file": (lambda base: _touch(base.split("/RunB/")[0] + "/RunB/flatFiles/Slide2/Slide2_metadata_file.csv.gz", "no gzip"), "download"),
}


@pytest.mark.parametrize("what", SPOIL)
def test_a_spoilt_slide_fails_alone(spark, scratch, what):
    root, exp, out, log = f"{scratch}/_bucket", "St/Exp", f"{scratch}/out", f"{scratch}/runlog"
    spoil, step = SPOIL[what]
    spoil(_three(root, exp)[1])
    slide_processing_job(spark, root, exp, out, log, fov_size=(2, 2), um_per_px=250.0)
    fine = {("RunA", "Slide1"), ("RunB", "Slide3")}
    status, tables = _results(spark, out)
    assert status == {**dict.fromkeys(fine, ("success", "")), ("RunB", "Slide2"): ("failed", step)}
    assert tables == dict.fromkeys(tables, fine)
    assert sorted((r["slide_name"], r["status"], r["failed_step"]) for r in spark.read.parquet(log).collect()) == [
        ("Slide1", "success", ""), ("Slide2", "failed", step), ("Slide3", "success", "")]


def test_a_killed_run_is_taken_up_again(spark, scratch, monkeypatch):
    root, exp, out = f"{scratch}/_bucket", "St/Exp", f"{scratch}/out"
    _three(root, exp)

    def killed(*a, **k):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(jobs.S, "write_cell_metadata", killed)
        with pytest.raises(KeyboardInterrupt):
            slide_processing_job(spark, root, exp, out, fov_size=(2, 2), um_per_px=250.0)
    assert os.path.exists(f"{out}/targets") and not os.path.exists(f"{out}/status")
    again = slide_processing_job(spark, root, exp, out, fov_size=(2, 2), um_per_px=250.0)
    assert again["slides"].count() == 3
    status, tables = _results(spark, out)
    assert set(status.values()) == {("success", "")} and all(len(v) == 3 for v in tables.values())
    # the data of the killed attempt is there but does not count
    assert spark.read.parquet(f"{out}/targets").count() == 12 and committed(spark, out, "targets").count() == 6


def test_morphology_images(spark, scratch):
    """F9, R1 and R6 in blocks and A9, for two slides whose mosaics differ."""
    root, exp, out = f"{scratch}/_bucket", "St/Exp", f"{scratch}/out"
    n, rng, rows, want = 600, np.random.default_rng(5), [], {}
    for base in _three(root, exp)[:2]:
        rel, whole = base.split("/_bucket/")[1], np.zeros((n, n + 100), int)
        for fov, x0 in ((1, 100), (2, 0)):  # pasted in FOV order: the second overwrites
            image = rng.integers(1, 5000, (n, n)).astype("<u2")
            name = f"CellStatsDir/Morphology2D/20240101_X_C902_P99_N99_F{fov:03d}.TIF"
            _touch(f"{base}/{name}")
            rows.append((rel, f"{rel}/{name}", "DNA", n, n, *BL.pack(image)))
            whole[:, x0:x0 + n] = image
        _touch(f"{base}/CellStatsDir/Morphology2D/20240101_X_C902_P99_N99_F001_Z003.TIF")
        rows.append((rel, f"{rel}/CellStatsDir/Morphology2D/20240101_X_C902_P99_N99_F001_Z003.TIF", "DNA", n, n, *BL.pack(np.ones((n, n), int))))
        _touch(f"{base}/RunSummary/x_FOV_Locations.csv", "FOV,X_mm,Y_mm,Z_um\n1,0,0,1\n2,0.1,0,1\n")
        want[rel.split("/")[2]] = whole
    images = spark.createDataFrame(rows, "slide_base_path string, path string, channel string, height int, width int, depth int, pixels binary")
    slide_processing_job(spark, root, exp, out, fov_size=(n, n), um_per_px=1.0, images=images, block=256)
    got = committed(spark, out, "images").collect()
    assert {r["run"] for r in got} == {"RunA", "RunB"} and {r["level"] for r in got} == {0}
    for run, whole in want.items():
        mine = np.zeros_like(whole)
        for r in got:
            if r["run"] == run and r["slide"] in ("Slide1", "Slide2"):
                mine[r["by"] * 256:r["by"] * 256 + r["bh"], r["bx"] * 256:r["bx"] * 256 + r["bw"]] = BL.unpack(r["pixels"], r["depth"], r["bh"], r["bw"])
        assert (mine == whole).all()
        w = committed(spark, out, "windows").where(f"run = '{run}'").first()
        assert (w["min"], w["max"]) == (whole[whole > 0].min(), whole.max())
        assert [w["start"], w["end"]] == [int(np.floor(q)) for q in np.quantile(whole[whole > 0], [0.001, 0.999])]


def test_steps_do_not_list_label_folders_again(spark, scratch, monkeypatch):
    """After the first listing, steps read the folders of the files they need."""
    root, exp, out = f"{scratch}/_bucket", "St/Exp", f"{scratch}/out"
    _three(root, exp)
    read, listed = [], []
    by_name, inventory = jobs.RD._csv_by_name, jobs.I.file_inventory
    monkeypatch.setattr(jobs.RD, "_csv_by_name", lambda s, r, *a: read.extend([r] if isinstance(r, str) else r) or by_name(s, r, *a))
    for module in (jobs.RD, jobs.I):
        monkeypatch.setattr(module, "file_inventory", lambda s, r, *a: listed.append(r) or inventory(s, r, *a))
    slide_processing_job(spark, root, exp, out, fov_size=(2, 2), um_per_px=250.0)
    assert listed.count(root) == 1 and {r.rsplit("/", 1)[1] for r in read} == {"flatFiles", "RunSummary", "AnalysisResults"}
    assert len(_results(spark, out)[0]) == 3


def test_a_bucket_named_by_its_scheme(spark, scratch):
    root, exp, out = f"{scratch}/_bucket", "St/Exp", f"{scratch}/out"
    _slide(root, exp, "RunA", "Slide1", "Scan1", {"Segmentation_zz_001": [1, 2]}, meta=ONE)
    slide_processing_job(spark, f"file://{root}", exp, out, fov_size=(2, 2), um_per_px=250.0)
    assert _results(spark, out)[0] == {("RunA", "Slide1"): ("success", "")}


def test_paths_are_matched_a_file_and_not_a_line(spark, scratch, monkeypatch):
    """Patterns on a long path cost more than reading the line; a file's columns may have
    the names of the slide's."""
    root, exp, out = f"{scratch}/_bucket", "St/Exp", f"{scratch}/out"
    base = _slide(root, exp, "RunA", "Slide1", "Scan1", {"Segmentation_zz_001": [1, 2]}, meta=ONE)
    _touch(f"{base}/AnalysisResults/abc/FOV003/R{SUFFIX}", "slide," + HEADER + "S,3,1,0.5,0.5,1,g,Nuclear\n")
    _touch(f"{base}/RunSummary/x_FOV_Locations.csv", "Slide,FOV,X_mm,Y_mm,Z_um\n7,1,0,0,1\n7,2,0.5,0,1\n")
    written, write = [], jobs.S.write_targets
    monkeypatch.setattr(jobs.S, "write_targets", lambda df, *a, **k: written.append(df) or write(df, *a, **k))
    slide_processing_job(spark, root, exp, out, fov_size=(2, 2), um_per_px=250.0)
    assert _results(spark, out)[0] == {("RunA", "Slide1"): ("success", "")}
    assert sorted(r["fov"] for r in committed(spark, out, "targets").collect()) == [1, 2, 3]
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert not any(w in plan.lower() for w in ("rlike", "regexp_extract")), plan


def test_a_listing_is_saved_by_some_tasks(spark, scratch):
    """Neither a task nor a file of the saved table for every few listed files."""
    from tessera.sources import inventory as I
    for k in range(100):
        _touch(f"{scratch}/b/FOV{k:03d}/CellLabels_F{k:03d}.TIF")
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        inv = I.file_inventory(spark, f"{scratch}/b")
        assert inv.count() == 100 and inv.rdd.getNumPartitions() <= I.some_tasks(spark) < 100
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)


@pytest.mark.parametrize("mounted", [True, False])
def test_label_files_of_the_queries(spark, scratch, monkeypatch, mounted):
    from tessera.plans import q_jobs
    if not mounted:  # the way to other stores
        monkeypatch.setattr(q_jobs, "mounted", lambda spark: False)
    names = [f"{'file://' if k % 2 else ''}{scratch}/b/FOV{k:03d}/CellLabels_F{k:03d}.TIF" for k in range(70)]
    q_jobs._touch(spark.createDataFrame([(n,) for n in names], "path string"))
    assert {os.path.getsize(n.removeprefix("file://")) for n in names} == {1}
