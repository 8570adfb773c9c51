"""Physical-plan properties that matter at scale (checked on the formatted plan)."""

import contextlib
import io

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _jobs_before_action(spark, fn) -> int:
    """Spark jobs a query starts while it is only being built."""
    sc = spark.sparkContext
    group = f"plan-{id(fn)}"
    sc.setJobGroup(group, "plan")
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_global_coordinates_prunes_the_calls(spark):
    p = _plan(E.queries()["global_coordinates"](spark, SF))
    assert "LeftOuter" in p
    # the call table is read with a pruned schema (6 of 11 lineitem columns)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," \
           "l_extendedprice:double,l_linestatus:string>" in p


def test_target_counts_aggregate_before_the_join(spark):
    from tessera.operators.transcripts import target_counts_for_cells
    cells = spark.range(100).selectExpr("id AS UID")
    calls = spark.range(1000).selectExpr("CAST(id % 3 AS INT) AS fov", "CAST(id % 5 AS INT) AS CellId", "'t' AS target")
    p = _plan(target_counts_for_cells(cells, calls)).split("\n\n")[0]
    assert p.count("HashAggregate") >= 6          # calls, cells, result: partial and final each
    assert "Checkpoint" not in p


def test_no_job_runs_while_planning(spark):
    from tessera.operators import cells as C
    from tessera.operators import transcripts as T
    from tessera.operators import versions as V
    calls = spark.range(50).selectExpr("CAST(id % 3 AS INT) AS fov", "CAST(id % 5 AS INT) AS CellId", "'t' AS target", "1 AS slide")
    uids = spark.range(9).selectExpr("id AS UID", "1 AS slide")
    seg = spark.createDataFrame([("s", "Segmentation_a_001", 1), ("s", "Segmentation_b_002", 2)], "slide string, dir string, fov int")
    prim = spark.createDataFrame([("s", "Segmentation_b_002")], "slide string, primary_dir string")
    umap = spark.range(9).selectExpr("'k' AS slide", "'t' AS cell_type", "CAST(id AS DOUBLE) AS UMAP_1", "CAST(id AS DOUBLE) AS UMAP_2")
    assert _jobs_before_action(spark, lambda: T.target_counts_for_cells(uids, calls, keys=["slide"])) == 0
    assert _jobs_before_action(spark, lambda: V.select_segmentations(seg, prim, ["slide"])) == 0
    assert _jobs_before_action(spark, lambda: C.cluster_labels(umap, ["slide"])) == 0


def test_raster_aggregations_are_partial(spark):
    for name in ("transcript_raster", "stitch_mosaic", "label_boundaries"):
        p = _plan(E.queries()[name](spark, SF))
        tree = p.split("\n\n")[0].splitlines()[1:]
        ops = [ln.strip(" +-:").split(" (")[0] for ln in tree]
        ops = [o for o in ops if o not in ("AdaptiveSparkPlan", "Project", "Filter")][:3]
        # the pixel-key aggregation is final <- shuffle <- partial (map-side combine)
        assert ops == ["HashAggregate", "Exchange", "HashAggregate"], (name, ops)


def test_no_cartesian_products(spark):
    for name, fn in E.queries().items():
        if name in E.LLM_QUERIES:
            continue   # these have tests of their own
        if name.startswith(("read_", "write_", "slide_metadata", "metadata_stats", "pack_", "file_inventory",
                            "assemble_counts", "read_expression")):
            continue   # these write fixture files first; covered by the oracle run
        p = _plan(fn(spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
