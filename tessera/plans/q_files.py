"""Registered queries for readers, sinks and the metadata job.

Each query first writes files derived from the input tables in the instrument's
layouts (Spark writes them into the session's checkpoint folder), then reads
them back through the reader under test; the oracle computes the same result
from the input tables directly.
"""

from __future__ import annotations

import os
import re
import uuid
from itertools import groupby

from pyspark import TaskContext
from pyspark.sql import functions as F

from ..operators import runlog as RL
from ..session import ensure_checkpoint_dir
from ..sources import inventory as I
from ..sources import readers as RD
from ..sources import sinks as S
from . import jobs as J
from .bindings import GENES, RUN_STEPS, Bindings, with_ctes
from .q_raster import _GEO
from .registry import query

TYPE_COL = "RNA_RNA_Cell.Typing.InSituType.m{i}_clusters"
RUNS = ["run_a", "run_b", "run_c"]
SLIDE = "S1"


def _scratch(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/fixtures/{uuid.uuid4().hex}"


def write_folders(df, col: str):
    """Writer of one file in a folder for every value of ``col``. What files cost is the
    folders, so they are dealt to several tasks a core whatever their bytes, and each task
    puts its own in place: moved at the end they would wait for each other."""
    n = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n, col).write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(col)


def mounted(spark) -> bool:
    """Whether the shared folder is one that every machine sees as a folder of its own."""
    at = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"


def own_path(path: str) -> str:
    """A path of a mounted folder, without its scheme."""
    return re.sub("^file:/*(?=/)", "", path)


PARENTS = 256  # folders among which the folders of write_json_folders are dealt


def write_json_folders(df, col: str, root: str) -> None:
    """``df`` as JSON lines, one file in a folder for every value of ``col``, as
    ``write_folders`` does, but below ``PARENTS`` folders. Spark's writer sends the name of every
    folder to the driver, so tasks write the files by themselves where they can."""
    spark = df.sparkSession
    df = df.withColumn("part", F.pmod(F.xxhash64(col), F.lit(PARENTS)))
    if not mounted(spark):
        n = 4 * spark.sparkContext.defaultParallelism
        return df.repartition(n, col).write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("part", col).json(root)
    line = F.to_json(F.struct(*[c for c in df.columns if c not in ("part", col)]))
    value = F.coalesce(F.col(col).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    folder = F.concat(F.lit(f"{own_path(root)}/part="), "part", F.lit(f"/{col}="), value)
    lines = df.select(folder.alias("folder"), line.alias("line"))
    lines.repartition(I.some_tasks(spark), "folder").sortWithinPartitions("folder").foreachPartition(_write_mounted)


def _write_mounted(rows) -> None:
    """Lines, in the order of their folders, to one file a folder."""
    name = f"part-{TaskContext.get().partitionId():05d}.json"
    for folder, own in groupby(rows, key=lambda r: r[0]):
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
            f.writelines(f"{r[1]}\n" for r in own)


def _csv_line(*cols):
    """One CSV line; fields quoted (so '' stays an empty string, not NULL)."""
    q = [F.concat(F.lit('"'), F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), '"', '""'), F.lit('"'))
         for c in cols]
    return F.concat_ws(",", *q)


def _write_lines(spark, body, header: str, path: str, compression: str | None = None):
    """Header + body lines (``line``, ``o``) as one text file, in ``o`` order."""
    h = spark.range(1).select(F.lit(header).alias("line"), F.lit(-1).cast("long").alias("o"))
    w = h.unionByName(body.select("line", F.col("o").cast("long"))).orderBy("o").coalesce(1).select("line").write
    if compression:
        w = w.option("compression", compression)
    w.mode("overwrite").text(path)


def _metadata_tree(spark, d):
    """<root>/<run>/flatFiles/S1/S1_metadata_file.csv.gz, one per source."""
    b = Bindings(spark, d)
    root = _scratch(spark)
    m = b.cell_meta
    for i, run in enumerate(RUNS):
        part = m.where(F.col("source_idx") == i)
        body = part.select(_csv_line(F.col("fov"), F.col("cell_ID"), F.col("cell_name"), F.col("seg_id"),
                                     F.col("cell_type")).alias("line"), F.col("row_idx").alias("o"))
        header = ",".join(["fov", "cell_ID", "cell_id", "cellSegmentationSetId", TYPE_COL.format(i=i)])
        _write_lines(spark, body, header, f"{root}/{run}/flatFiles/{SLIDE}/{SLIDE}_metadata_file.csv.gz", "gzip")
    return root


_RUN_SQL = "CASE source_idx WHEN 0 THEN 'run_a' WHEN 1 THEN 'run_b' ELSE 'run_c' END"


@query("read_cell_metadata", with_ctes(f"""
SELECT {_RUN_SQL} AS run, source_idx, fov, CAST(cell_ID AS INTEGER) AS cell_ID, cell_name,
       seg_id AS cellSegmentationSetId, cell_type FROM cell_meta""", "cell_meta"))
def q_read_cell_metadata(spark, d):
    m = RD.read_cell_metadata(spark, _metadata_tree(spark, d), SLIDE)
    # Empty CSV fields read as NULL; both mean "unannotated" (the oracle keeps '').
    return m.select("run", "source_idx", "fov", "cell_ID", "cell_name", "cellSegmentationSetId",
                    F.coalesce("cell_type", F.lit("")).alias("cell_type"))


_X1_SQL = """
m AS (SELECT * FROM cell_meta WHERE trim(seg_id) IN ('seg1', 'seg2')),
firsts AS (SELECT trim(seg_id) AS id, min(source_idx) AS first FROM m GROUP BY 1),
cutv AS (SELECT CASE WHEN count(*) < 2 THEN 1073741824 ELSE max(first) END AS cut FROM firsts),
kept AS (SELECT m.* FROM m, cutv WHERE m.source_idx <= cutv.cut),
seen AS (SELECT c.* FROM cell_meta c, cutv WHERE c.source_idx <= cutv.cut)"""


@query("slide_metadata_job", with_ctes("""
SELECT cell_name AS cell_ID, cell_type,
       CASE WHEN cell_type = '' THEN '' ELSE '#' || upper(substr(md5(cell_type), 1, 6)) END AS hex_color
FROM kept""", "cell_meta", extra=_X1_SQL))
def q_slide_metadata_job(spark, d):
    rows, _ = J.slide_metadata_job(spark, _metadata_tree(spark, d), SLIDE, "seg1, seg2")
    return rows.select("cell_ID", "cell_type", "hex_color")


@query("metadata_stats", with_ctes("""
SELECT (SELECT count(*) FROM seen) AS rows_read, (SELECT count(*) FROM kept) AS rows_written,
       (SELECT count(*) FROM seen) - (SELECT count(*) FROM kept) AS rows_filtered,
       (SELECT count(DISTINCT cell_type) FROM kept WHERE cell_type <> '') AS n_types,
       (SELECT array_to_string(list_sort(list(DISTINCT trim(seg_id))), ',') FROM seen) AS seg_ids_seen""",
                                   "cell_meta", extra=_X1_SQL))
def q_metadata_stats(spark, d):
    _, stats = J.slide_metadata_job(spark, _metadata_tree(spark, d), SLIDE, "seg1, seg2")
    return stats.withColumn("seg_ids_seen", F.array_join("seg_ids_seen", ","))


@query("slide_metadata_first_source", with_ctes("""
SELECT cell_name AS cell_ID, cell_type,
       CASE WHEN cell_type = '' THEN '' ELSE '#' || upper(substr(md5(cell_type), 1, 6)) END AS hex_color
FROM cell_meta WHERE source_idx = 0""", "cell_meta"))
def q_slide_metadata_first_source(spark, d):
    rows, _ = J.slide_metadata_job(spark, _metadata_tree(spark, d), SLIDE, None)
    return rows.select("cell_ID", "cell_type", "hex_color")


@query("write_cell_metadata", with_ctes("""
SELECT cell_name AS cell_ID, cell_type,
       CASE WHEN cell_type = '' THEN '' ELSE '#' || upper(substr(md5(cell_type), 1, 6)) END AS hex_color
FROM kept""", "cell_meta", extra=_X1_SQL))
def q_write_cell_metadata(spark, d):
    root = _metadata_tree(spark, d)
    out = f"{root}/out_metadata"
    J.slide_metadata_job(spark, root, SLIDE, "seg1, seg2", out_path=out)
    back = spark.read.option("header", True).csv(f"{out}/slide={SLIDE}")
    return back.select("cell_ID", F.coalesce("cell_type", F.lit("")).alias("cell_type"),
                       F.coalesce("hex_color", F.lit("")).alias("hex_color"))


# ---------------------------------------------------------------- S3 / K2
_TC_SQL = "SELECT fov, CellId, x, y, z, target, CellComp FROM target_calls"


@query("read_target_calls", with_ctes(_TC_SQL, "target_calls"))
def q_read_target_calls(spark, d):
    root = _scratch(spark)
    t = Bindings(spark, d).target_calls
    # Layout 3 (files in the slide folder itself) plus a decoy elsewhere that must be ignored.
    t.write.option("header", True).csv(f"{root}/slide__complete_code_cell_target_call_coord.csv")
    return RD.read_target_calls(spark, root)


@query("write_read_targets", with_ctes(_TC_SQL, "target_calls"))
def q_write_read_targets(spark, d):
    path = f"{_scratch(spark)}/targets"
    S.write_targets(Bindings(spark, d).target_calls, path, ["fov"])
    back = spark.read.parquet(path)
    return back.select("fov", "CellId", "x", "y", "z", "target", "CellComp")


# ---------------------------------------------------------------- S4 / K5
@query("read_fov_offsets", with_ctes("""
SELECT X_mm, Y_mm, Z_um / 1000.0 AS Z_mm, -2.0 AS ZOffset_mm, 0 AS ROI, FOV FROM fovs""", "fovs"))
def q_read_fov_offsets(spark, d):
    root = _scratch(spark)
    f = Bindings(spark, d).fovs
    f.select("X_mm", "Y_mm", "Z_um", "FOV").orderBy("FOV").write.option("header", True) \
     .csv(f"{root}/RunSummary/S1_FOV_Locations.csv")
    o = RD.read_fov_offsets(spark, f"{root}/RunSummary")
    return o.select("X_mm", "Y_mm", F.round("Z_mm", 6).alias("Z_mm"), "ZOffset_mm", "ROI", "FOV")


@query("read_fov_offsets_legacy", with_ctes("""
SELECT 1 AS Slide, X_mm, Y_mm, Z_um AS Z_mm, -2.0 AS ZOffset_mm, 0 AS ROI, FOV, FOV AS "Order" FROM fovs""", "fovs"))
def q_read_fov_offsets_legacy(spark, d):
    root = _scratch(spark)
    f = Bindings(spark, d).fovs
    f.select(F.lit(1), "X_mm", "Y_mm", "Z_um", F.lit(-2.0), F.lit(0), "FOV", "FOV").write \
     .option("header", False).csv(f"{root}/RunSummary/latest.fovs.csv")
    o = RD.read_fov_offsets(spark, f"{root}/RunSummary")
    return o.drop("ord")


@query("write_slide_geometry", with_ctes("""
SELECT 'S1' AS slide, 8 AS fov_height, 8 AS fov_width, 0.1681 AS scale_um, 'v1' AS version,
       FOV, X_mm, Y_mm FROM fovs""", "fovs"))
def q_write_slide_geometry(spark, d):
    f = Bindings(spark, d).fovs.withColumn("slide", F.lit("S1"))
    path = f"{_scratch(spark)}/geometry"
    S.write_slide_geometry(f, path, 8, 8, 0.1681, "v1")
    g = spark.read.parquet(path)
    return g.select("slide", "fov_height", "fov_width", "scale_um", "version",
                    F.explode("fov_offsets").alias("o")).select(
        "slide", "fov_height", "fov_width", "scale_um", "version", "o.FOV", "o.X_mm", "o.Y_mm")


# ---------------------------------------------------------------- S5 / W2
@query("read_manifests", with_ctes("SELECT dir, Version FROM manifests", "manifests"))
def q_read_manifests(spark, d):
    root = _scratch(spark)
    m = Bindings(spark, d).manifests
    # One folder per segmentation version (the reader takes the folder name from the path).
    write_json_folders(m.select("dir", "Version"), "dir", f"{root}/staging")
    df = RD.read_manifests(spark, f"{root}/staging/*/*", multi_line=False)
    return df.select("dir", "Version")


# ---------------------------------------------------------------- S7 / J12
@query("read_mtx", with_ctes("""
SELECT c_custkey AS cell_idx, CAST(g.i AS BIGINT) AS gene_idx, CAST(e.count AS INTEGER) AS count
FROM expr_long e JOIN customer ON e.cell_ID = c_custkey
JOIN (SELECT * FROM (VALUES ('1-URGENT', 0), ('2-HIGH', 1), ('3-MEDIUM', 2), ('4-NOT SPECIFIED', 3), ('5-LOW', 4)) v(gene, i)) g
  ON e.gene = g.gene WHERE e.count <> 0""", "expr_long"))
def q_read_mtx(spark, d):
    path = f"{_scratch(spark)}/counts.mtx"
    long = Bindings(spark, d).expr_long.where(F.col("count") != 0)
    gi = F.array_position(F.array(*[F.lit(g) for g in GENES]), F.col("gene"))
    body = long.select(F.concat_ws(" ", (F.col("cell_ID") + 1).cast("string"), gi.cast("string"),
                                   F.col("count").cast("string")).alias("line"),
                       (F.col("cell_ID") * 10 + gi).alias("o"))
    n_cells = Bindings(spark, d).t("customer").count()
    nnz = long.count()
    size = spark.range(1).select(F.lit(f"{n_cells} {len(GENES)} {nnz}").alias("line"), F.lit(-1).cast("long").alias("o"))
    _write_lines(spark, size.unionByName(body), "%%MatrixMarket matrix coordinate integer general", path)
    return RD.read_mtx(spark, path)


# ---------------------------------------------------------------- S8
@query("read_dictionary", with_ctes("SELECT ProbeID, DisplayName FROM dictionary", "dictionary"))
def q_read_dictionary(spark, d):
    path = f"{_scratch(spark)}/plex.tsv"
    Bindings(spark, d).dictionary.select("ProbeID", "DisplayName").write.option("header", True) \
        .option("sep", "\t").csv(path)
    return RD.read_dictionary(spark, path, "plex").select("ProbeID", "DisplayName")


# ---------------------------------------------------------------- K3
@query("pack_mosaic_blocks", with_ctes("SELECT channel, row, col, val FROM mosaic WHERE val <> 0",
                                       "fovs", "pixels", "label_pixels", extra=_GEO))
def q_pack_mosaic_blocks(spark, d):
    from .q_raster import _mosaic
    path = f"{_scratch(spark)}/mosaic"
    S.write_mosaic(_mosaic(Bindings(spark, d)), path, block=16)
    back = spark.read.parquet(path)
    return S.unpack_blocks(back.select("channel", "by", "bx", "px"), 16).select(
        F.col("channel").cast("int").alias("channel"), "row", "col", "val")


# ---------------------------------------------------------------- K4
@query("write_run_log", with_ctes("""
SELECT run, CASE WHEN count(DISTINCT step) FILTER (WHERE step IN ('signup', 'view', 'click', 'purchase', 'error')) = 5
                 THEN 'success' ELSE 'failed' END AS status,
       CASE WHEN count(DISTINCT step) FILTER (WHERE step IN ('signup', 'view', 'click', 'purchase', 'error')) = 5
            THEN '' ELSE arg_max(step, start) END AS failed_step
FROM run_steps GROUP BY run""", "run_steps"))
def q_write_run_log(spark, d):
    path = f"{_scratch(spark)}/runlog"
    dur = RL.run_durations(Bindings(spark, d).run_steps, RUN_STEPS)
    failed = dur.select("run", F.lit("failed").alias("status"), F.lit("stitch").alias("failed_step"),
                        F.lit(1).alias("attempt"))
    ok = dur.select("run", "status", "failed_step", F.lit(2).alias("attempt"))
    S.write_run_log(failed, path)
    S.write_run_log(ok, path)
    return RL.latest_status(spark.read.parquet(path), ["run"], ts="attempt")
