"""Registered queries of the slide processing job (X2): its committed tables and status.

The input tables are first written as a bucket tree of four slides in two runs: the
transcript calls dealt over three of them (with differing column orders; the fourth has
none and must fail alone), the metadata sources as the slides' metadata files, FOV
locations and label files for every FOV. The job runs once for a table folder; every
query reads what it committed.
"""

from __future__ import annotations

import os
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import inventory as I
from ..sources import readers as RD
from ..sources import sinks as S
from . import jobs as J
from .bindings import Bindings, with_ctes
from .q_files import _scratch, mounted, own_path
from .q_raster import _GEO, PPM, H, W
from .registry import query

EXPERIMENT = "St/Exp"
SLIDES = [("RunA", "S0"), ("RunA", "S1"), ("RunB", "S0"), ("RunB", "S9")]  # the last has no calls
SEGMENTATION = "Segmentation_seg1_001"
_DONE: dict = {}


def _touch(files: DataFrame) -> None:
    """Files of one byte (listings skip empty ones) at the paths of column ``path``: only the
    names of images matter here. Tasks make them by themselves in a folder that all machines
    mount; in any other store the driver does, where each waits for the store a few times,
    so many are made at once."""
    spark = files.sparkSession
    if mounted(spark):
        files.repartition(I.some_tasks(spark)).foreachPartition(_touch_mounted)
        return
    path, hadoop = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()

    def touch(row) -> None:
        name = path(row["path"])
        out = name.getFileSystem(hadoop).create(name)
        out.write(1)
        out.close()

    with ThreadPool(16) as pool:
        for _ in pool.imap_unordered(touch, files.toLocalIterator(), chunksize=64):
            pass


def _touch_mounted(rows) -> None:
    for row in rows:
        name = own_path(row["path"])
        os.makedirs(os.path.dirname(name), exist_ok=True)
        with open(name, "wb") as f:
            f.write(b"\x01")


def _base(run: str, slide: str) -> str:
    return f"{EXPERIMENT}/{run}/DecodedFiles/{slide}/Scan1"


def _bucket(spark, b: Bindings) -> str:
    root = _scratch(spark)
    name = lambda base: F.format_string(f"{base}/CellStatsDir/{SEGMENTATION}/FOV%03d/CellLabels_F%03d.TIF", "FOV", "FOV")
    _touch(b.fovs.select("FOV").where("FOV IS NOT NULL").distinct()
           .select(F.explode(F.array(*[name(f"{root}/{_base(*s)}") for s in SLIDES])).alias("path")))
    calls = ["fov", "CellId", "x", "y", "z", "target", "CellComp"]
    for k, (run, slide) in enumerate(SLIDES):
        base = f"{root}/{_base(run, slide)}"
        b.fovs.select("X_mm", "Y_mm", "Z_um", "FOV", "ord").coalesce(1).sortWithinPartitions("ord").drop("ord").write.option("header", True) \
         .csv(f"{base}/RunSummary/x_{RD.FOV_LOCATIONS_SUFFIX}")
        if k == 3:
            continue
        order = calls if k != 1 else calls[::-1]
        b.target_calls.where(F.col("z") % 3 == k).select(*order).write.option("header", True) \
         .csv(f"{base}/AnalysisResults/abc/{slide}{RD.TARGET_FILE_SUFFIX}")
        meta = b.cell_meta.where(F.col("source_idx") == k).select(
            "fov", "cell_ID", F.col("cell_name").alias("cell_id_"), F.col("seg_id").alias("cellSegmentationSetId"), F.col("cell_type").alias("kind"))
        names = ["fov", "cell_ID", "cell_id", "cellSegmentationSetId", f"RNA_RNA_Cell.Typing.InSituType.m{k}_clusters"]
        lines = meta.select(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in meta.columns]).alias("value"))
        head = spark.range(1).select(F.lit(",".join(names)).alias("value"))
        head.union(lines).coalesce(1).write.option("compression", "gzip").text(f"{root}/{EXPERIMENT}/{run}/flatFiles/{slide}/{slide}_metadata_file.csv.gz")
    return root


def _job(spark, d: str) -> str:
    """Folder of the job's output for the tables of ``d`` (one run a session)."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _DONE:
        b = Bindings(spark, d)
        root, out = _bucket(spark, b), _scratch(spark)
        tiles = b.label_pixels.withColumn("slide_base_path", F.explode(F.array(*[F.lit(_base(*s)) for s in SLIDES]))).withColumn("dir", F.lit(SEGMENTATION))
        J.slide_processing_job(spark, root, EXPERIMENT, out, tiles=tiles, fov_size=(H, W), um_per_px=1000 / PPM)
        _DONE[at] = out
    return _DONE[at]


_SLIDES = ("VALUES " + ", ".join(f"({k}, '{run}', '{slide}')" for k, (run, slide) in enumerate(SLIDES[:3])))
_MADE = f"made AS (SELECT * FROM ({_SLIDES}) m(k, run, slide))"

query("slide_processing_targets", with_ctes(
    "SELECT run, slide, fov, CellId, x, y, z, target, CellComp FROM target_calls JOIN made ON z % 3 = k", "target_calls", extra=_MADE))(
    lambda spark, d: J.committed(spark, _job(spark, d), "targets").select("run", "slide", "fov", "CellId", "x", "y", "z", "target", "CellComp"))

query("slide_processing_metadata", with_ctes("""
SELECT run, slide, cell_name AS cell_ID, cell_type, CASE WHEN cell_type = '' THEN '' ELSE '#' || upper(substr(md5(cell_type), 1, 6)) END AS hex_color
FROM cell_meta JOIN made ON source_idx = k WHERE seg_id = 'seg1'""", "cell_meta", extra=_MADE))(
    lambda spark, d: J.committed(spark, _job(spark, d), "metadata").select(
        "run", "slide", "cell_ID", *[F.coalesce(c, F.lit("")).alias(c) for c in ("cell_type", "hex_color")]))

query("slide_processing_labels", with_ctes(
    "SELECT run, slide, row, col, val FROM labels, made WHERE val <> 0", "fovs", "pixels", "label_pixels", extra=_GEO + ",\n" + _MADE))(
    lambda spark, d: S.unpack_blocks(J.committed(spark, _job(spark, d), "labels").select("run", "slide", "by", "bx", "px")))

query("slide_processing_geometry", with_ctes(f"""
SELECT run, slide, {H} AS fov_height, {W} AS fov_width, FOV, X_mm, Y_mm FROM f1, made""", "fovs", extra=_GEO.split("ext AS")[0].rstrip(", \n") + ",\n" + _MADE))(
    lambda spark, d: J.committed(spark, _job(spark, d), "geometry").select("run", "slide", "fov_height", "fov_width", F.explode("fov_offsets").alias("o"))
    .select("run", "slide", "fov_height", "fov_width", "o.*"))

query("slide_processing_status", with_ctes("""
SELECT run, slide, CASE WHEN run IS NOT NULL AND slide = 'S9' THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN slide = 'S9' THEN 'read_targets' ELSE '' END AS failed_step
FROM (SELECT run, slide FROM made UNION ALL SELECT 'RunB', 'S9') WHERE (SELECT count(*) FROM cell_meta) > 0""", "cell_meta", extra=_MADE))(
    lambda spark, d: spark.read.parquet(f"{_job(spark, d)}/status").select("run", "slide", "status", "failed_step"))
