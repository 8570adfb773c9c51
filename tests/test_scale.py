"""Operators whose cost must not grow with one key, one column or the number of files."""

import contextlib
import io

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera import util
from tessera.operators import cells as C
from tessera.operators.quantiles import exact_quantiles
from tessera.sources import readers as RD


GENES = 4100  # 20,000 pass as well; wide scans are slow to plan


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_values_with_a_common_beginning_spread_over_tasks(spark, monkeypatch):
    values = spark.range(20_000).select(F.concat(F.lit("c_1_"), F.col("id").cast("string")).alias("v"))
    made = []
    monkeypatch.setattr(util, "saved_table", lambda df, save=util.saved_table: made.append(save(df)) or made[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little data would go to one task
    try:
        out = util.dense_index(values, "v", "code")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = {r.v: r.code for r in out.collect()}
    assert got == {v: k for k, v in enumerate(sorted(f"c_1_{k}" for k in range(20_000)))}
    parts = [r["count"] for r in made[0].groupBy(F.shiftright("_pos", 33)).count().collect()]
    assert len(parts) == 4 and max(parts) < 10_000


def test_dictionary_of_numbers_and_nulls(spark):
    out = util.dense_index(spark.createDataFrame([(5,), (None,), (-7,), (1 << 40,)], "v long"), "v", "code")
    assert {r.v: r.code for r in out.collect()} == {None: 0, -7: 1, 5: 2, 1 << 40: 3}
    assert util.dense_index(spark.createDataFrame([], "v string"), "v", "code").count() == 0


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_quantiles_are_exact_for_floats_of_any_size(spark, accuracy):
    rng = np.random.default_rng(2)
    groups = {"wide": rng.normal(size=3001) * 10.0 ** rng.integers(-200, 200, 3001), "close": 1000 + rng.random(2500) * 1e-9, "one": np.array([4.5]),
              "two": np.array([1.0, 2.0]), "tied": np.repeat([1.0, 2.0, 2.5], [700, 900, 3]), "none": np.array([]), None: rng.random(77)}
    rows = [(g, float(x), None if k % 3 == 0 else float(-x)) for g, v in groups.items() for k, x in enumerate(v)] + [("none", None, None)] * 3
    df = spark.createDataFrame(rows, "g string, a double, b double")
    probs = [0.0, 0.001, 0.25, 0.5, 0.999, 1.0]
    got = {r.g: r for r in exact_quantiles(df, ["g"], {"qa": F.col("a"), "qb": F.col("b")}, probs, {"n": F.count(F.lit(1))}, accuracy).collect()}
    assert set(got) == set(groups)
    for g in groups:
        for name, c in (("qa", 1), ("qb", 2)):
            v = np.array([r[c] for r in rows if r[0] == g and r[c] is not None])
            want = [None] * len(probs) if not len(v) else np.quantile(v, probs)
            assert all(x is None if y is None else abs(x - y) <= 1e-12 * max(1, abs(y)) for x, y in zip(got[g][name], want)), (g, name)
        assert got[g].n == sum(r[0] == g for r in rows)


def test_both_medians_take_two_scans(spark, scratch):
    spark.range(100).selectExpr("'t' AS cell_type", "CAST(id AS DOUBLE) AS UMAP_1", "CAST(id AS DOUBLE) AS UMAP_2").write.parquet(f"{scratch}/u")
    tree = _plan(C.cluster_labels(spark.read.parquet(f"{scratch}/u"))).split("\n\n")[0]
    assert tree.count("Scan parquet") == 2


def test_dotplot_of_thousands_of_genes(spark, scratch):
    n, genes = 60, [f"g{k}" for k in range(GENES)]
    ids = np.arange(n)
    count = lambda k: ((ids * (k % 7) + k) % 5 - 1).astype(np.int32)
    table = pa.table({"cell_type": pa.array([str(i % 3) for i in ids]), **{g: pa.array(count(k)) for k, g in enumerate(genes)}})
    pq.write_table(table, f"{scratch}/wide.parquet")
    got = {(r.cell_type, r.gene): r for r in C.dotplot_stats_wide(spark.read.parquet(f"{scratch}/wide.parquet"), genes).collect()}
    assert len(got) == 3 * GENES
    for k in range(GENES):
        v = count(k)
        for t in range(3):
            r = got[str(t), genes[k]]
            assert abs(r.pct_expressed - (v[ids % 3 == t] > 0).mean()) < 1e-12 and abs(r.mean_expression - v[ids % 3 == t].mean()) < 1e-12


def test_dotplot_counts_only_values(spark):
    df = spark.createDataFrame([("a", "s", 1, None), ("a", "s", 0, None), ("a", "s", None, 2), (None, "s", 5, 5)], "cell_type string, slide string, g1 int, g2 long")
    got = {(r.cell_type, r.gene): (r.pct_expressed, r.mean_expression) for r in C.dotplot_stats_wide(df, ["g1", "g2"], ["slide"]).collect()}
    assert got == {("a", "g1"): (0.5, 0.5), ("a", "g2"): (1.0, 2.0), (None, "g1"): (1.0, 5.0), (None, "g2"): (1.0, 5.0)}


def test_categorical_columns_of_a_wide_table(spark):
    df = spark.range(500).selectExpr("CAST(id AS STRING) AS s", "id", "id % 29 AS few", "IF(id % 30 = 29, NULL, id % 30) AS with_null", "id % 30 AS thirty",
                                     "CAST(id % 2 AS DOUBLE) * -0.0 AS zero", "CAST(NULL AS INT) AS nothing", *[f"id % {k + 2} AS c{k}" for k in range(60)])
    got = {r.column: r.categorical for r in C.categorical_columns(df.repartition(5)).collect()}
    want = {"s": True, "id": False, "few": True, "with_null": False, "thirty": False, "zero": True, "nothing": True, **{f"c{k}": k + 2 < 30 for k in range(60)}}
    assert got == want
    assert "Expand" not in _plan(C.categorical_columns(df))
    assert {r.categorical for r in C.categorical_columns(df.where("false")).collect()} == {True}


def test_indexed_csv_counts_over_files_without_a_sort(spark, scratch):
    spark.range(1000).selectExpr("CONCAT('r', id) AS name", "id * 2 AS v").repartitionByRange(4, "v").sortWithinPartitions("v").write.option("header", True).csv(f"{scratch}/c")
    df = RD.read_indexed_csv(spark, f"{scratch}/c")
    rows = sorted((r.idx, r.name) for r in df.collect())
    assert [i for i, _ in rows] == list(range(1000))
    assert [n for _, n in rows] == [f"r{k}" for k in range(1000)]
    assert "RangePartitioning" not in _plan(df) and "Checkpoint" not in _plan(df)


@pytest.mark.parametrize("n", [2, 12])
def test_csv_layouts_cost_no_job_a_file(spark, scratch, n):
    """The jobs a reader starts do not grow with the number of files."""
    for k in range(n):
        columns = ["a", "b", "c"] if k % 2 else ["c", "a"]
        with contextlib.suppress(FileExistsError):
            __import__("os").makedirs(f"{scratch}/t/FOV{k}")
        with open(f"{scratch}/t/FOV{k}/x.csv", "w") as f:
            f.write(",".join(columns) + "\n" + "".join(",".join(f'"{c}{k},{i}"' for c in columns) + "\n" for i in range(3)) + "\n")
    sc, group = spark.sparkContext, f"csv-{scratch}"
    sc.setJobGroup(group, "read")
    try:
        df = RD.read_csv_by_name(spark, f"{scratch}/t", RD.named(f"{scratch}/t", r"FOV[0-9]+/x\.csv"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup(group)) <= 4
    got = sorted((r.a, r.b, r.c) for r in df.collect())
    assert got == sorted((f"a{k},{i}", f"b{k},{i}" if k % 2 else None, f"c{k},{i}") for k in range(n) for i in range(3))
    with pytest.raises(FileNotFoundError):
        RD.read_csv_by_name(spark, f"{scratch}/t", RD.named(f"{scratch}/t", r"none\.csv"))
