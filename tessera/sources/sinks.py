"""Sinks: K1 write_cell_metadata, K2 write_targets, K3 write_mosaic,
K4 write_run_log, K5 write_slide_geometry.

All writes go through Spark's file committer (atomic job commit, ``_SUCCESS``
marker), so a lost executor only re-runs its tasks and a failed job leaves no
half-written table behind.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import first_location
from ..util import saved_table

# ---------------------------------------------------------------------------
# Fixed values.
METADATA_COLUMNS = ["cell_ID", "cell_type", "hex_color"]
FOV_GROUP = 256  # FOVs of a folder of the transcript table
MOSAIC_BLOCK = 1024  # block edge of the packed mosaic table (1M pixels per row group at most)
# ---------------------------------------------------------------------------


def _replacing(df: DataFrame):
    """Writer that replaces the partitions it writes and leaves all others: a run
    over one slide does not erase the slides of earlier runs."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")


# K1 -------------------------------------------------------------------------
def write_cell_metadata(df: DataFrame, path: str, partition_by: list[str] = ("slide",)) -> None:
    """``cell_ID, cell_type, hex_color`` CSV with header, one folder per slide."""
    parts = [c for c in partition_by if c in df.columns]
    (_replacing(df.select(*parts, *METADATA_COLUMNS)).option("header", True)
       .partitionBy(*parts).csv(path))


# K2 -------------------------------------------------------------------------
def write_targets(df: DataFrame, path: str, partition_by: list[str] = ("slide", "fov"), replace: bool = True) -> None:
    """Transcript table as parquet, one folder a slide and ``FOV_GROUP`` FOVs (column
    ``fov_group``; a folder a FOV would cost more than its rows), sorted by FOV and target
    inside each file (min/max skipping for FOV and gene filters). Range partitioning on
    (slide, fov, target) splits a heavy FOV over several tasks / files.

    The FOVs that ``df`` has are replaced, all others stay: rows of other FOVs in the same
    folders are written again. ``replace=False`` adds rows to a table that has none of them."""
    parts = [c for c in partition_by if c in df.columns]
    folders = list(parts)
    if "fov" in parts and dict(df.dtypes)["fov"] in ("tinyint", "smallint", "int", "bigint"):
        df = df.withColumn("fov_group", F.floor(F.col("fov") / FOV_GROUP).cast("long"))
        folders[parts.index("fov")] = "fov_group"
        if replace:
            df = _with_other_fovs(df, path, folders, parts)
    ranged = df.repartitionByRange(*folders, *parts, "target").sortWithinPartitions(*folders, *parts, "target")
    (_replacing(ranged) if replace else ranged.write.mode("append")).partitionBy(*folders).parquet(path)


def _with_other_fovs(df: DataFrame, path: str, folders: list[str], parts: list[str]) -> DataFrame:
    """``df`` and the rows of the table at ``path`` that share a folder but no FOV with it."""
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return df
    df = saved_table(df)
    old = spark.read.schema(df.schema).parquet(path)

    def same(names: list[str]):
        new = df.select(*[F.col(n).alias(f"_{n}") for n in names]).distinct()
        return new, reduce(and_, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names])

    kept = old.join(*same(folders), "left_semi").join(*same([*folders, "fov"]), "left_anti")
    return df.unionByName(kept)


# K3 -------------------------------------------------------------------------
def pack_blocks(pixels: DataFrame, block: int = MOSAIC_BLOCK, keys: list[str] = ("channel", "level")) -> DataFrame:
    """Long pixels -> blocks (keys, by, bx, rows, cols, vals arrays), all-zero
    blocks dropped (the chunk store skips empty chunks). Blocks are bounded by
    block^2 pixels; pick ``block`` so a block stays well under 2 GB."""
    keys = [k for k in keys if k in pixels.columns]
    p = pixels.where(F.col("val") != 0).select(
        *keys, F.floor(F.col("row") / block).alias("by"), F.floor(F.col("col") / block).alias("bx"),
        (F.col("row") % block).cast("int").alias("r"), (F.col("col") % block).cast("int").alias("c"), "val")
    return p.groupBy(*keys, "by", "bx").agg(
        F.sort_array(F.collect_list(F.struct("r", "c", "val"))).alias("px"))


def write_mosaic(pixels: DataFrame, path: str, block: int = MOSAIC_BLOCK, keys: list[str] = ()) -> None:
    b = pack_blocks(pixels, block, [*keys, "channel", "level"])
    parts = [c for c in (*keys, "channel", "level") if c in b.columns]
    _replacing(b).partitionBy(*parts).parquet(path)


def write_blocks(blocks: DataFrame, path: str, partition_by: list[str]) -> None:
    """Packed blocks (:mod:`tessera.operators.blocks`) as parquet, one folder a channel and
    level, rows in block order; blocks without pixels are left out."""
    rows = blocks.where("depth > 0").repartitionByRange(*partition_by, "by", "bx").sortWithinPartitions(*partition_by, "by", "bx")
    _replacing(rows).partitionBy(*partition_by).parquet(path)


def write_windows(windows: DataFrame, path: str, keys: list[str]) -> None:
    """Contrast windows, one row a channel of a slide."""
    _replacing(windows).partitionBy(*keys).parquet(path)


def unpack_blocks(blocks: DataFrame, block: int = MOSAIC_BLOCK) -> DataFrame:
    keys = [c for c in blocks.columns if c not in ("by", "bx", "px")]
    e = blocks.select(*keys, "by", "bx", F.explode("px").alias("p"))
    return e.select(*keys, (F.col("by") * block + F.col("p.r")).alias("row"),
                    (F.col("bx") * block + F.col("p.c")).alias("col"), F.col("p.val").alias("val"))


# K4 -------------------------------------------------------------------------
def write_run_log(df: DataFrame, path: str) -> None:
    """Append run-log rows (one per processed slide and attempt)."""
    df.write.mode("append").parquet(path)


def write_status(df: DataFrame, path: str, keys: list[str] = ("slide",)) -> None:
    """One status row per slide, replacing the slide's earlier one."""
    _replacing(df).partitionBy(*keys).parquet(path)


# K5 -------------------------------------------------------------------------
def write_slide_geometry(fovs: DataFrame, path: str, height: int, width: int, um_per_px: float,
                         version: str, keys: list[str] = ("slide",)) -> DataFrame:
    """One row per slide: FOV height / width, scale, version and the FOV
    offsets as an array of structs (read back and broadcast by raster steps)."""
    keys = [k for k in keys if k in fovs.columns]
    f = first_location(fovs, keys)
    g = f.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("ord", "FOV", "X_mm", "Y_mm"))).alias("o"))
    out = g.select(*keys, F.lit(int(height)).alias("fov_height"), F.lit(int(width)).alias("fov_width"),
                   F.lit(float(um_per_px)).alias("scale_um"), F.lit(version).alias("version"),
                   F.transform("o", lambda s: F.struct(s["FOV"].alias("FOV"), s["X_mm"].alias("X_mm"),
                                                       s["Y_mm"].alias("Y_mm"))).alias("fov_offsets"))
    w = _replacing(out)
    (w.partitionBy(*keys) if keys else w).parquet(path)
    return out
