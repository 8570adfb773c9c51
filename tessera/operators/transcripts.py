"""Transcript (target call) operators.

F3 drop_control_probes, F6 filter_gene, A6 gene_list, J2 global_coordinates,
J3 target_counts_for_cells, J13 ordinal_encode, A13 transcript_raster,
A14 spread_raster, R12 transcripts_for_display.

The call table is the one large table of a slide (~100 MB CSV per FOV), so every
operator here joins it with small tables and aggregates with partial (map-side)
aggregation before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import first_location, global_xy, with_extent
from ..functions.keys import unpair_key
from ..util import dense_index
from .blocks import spread_blocks
from .layers import digest_group

# ---------------------------------------------------------------------------
# Prefixes of control probes (not genes).
CONTROL_PREFIXES = ("NegPrb", "FalseCode", "SystemControl")
# ---------------------------------------------------------------------------


def is_control(col: str = "target"):
    c = F.col(col)
    return c.startswith(CONTROL_PREFIXES[0]) | c.startswith(CONTROL_PREFIXES[1]) | c.startswith(CONTROL_PREFIXES[2])


def drop_control_probes(df: DataFrame, col: str = "target") -> DataFrame:
    """three StringStartsWith predicates, pushed into the parquet scan."""
    return df.where(~F.col(col).startswith(CONTROL_PREFIXES[0])
                    & ~F.col(col).startswith(CONTROL_PREFIXES[1])
                    & ~F.col(col).startswith(CONTROL_PREFIXES[2]))


def gene_list(targets: DataFrame, col: str = "target") -> DataFrame:
    """Sorted distinct non-control targets."""
    return drop_control_probes(targets.select(col), col).distinct().orderBy(col)


def global_coordinates(targets: DataFrame, fovs: DataFrame, height: int, width: int,
                       px_per_mm: float, keys: list[str] = ()) -> DataFrame:
    """Left join FOV offsets onto every call and derive ``global_x/global_y``.

    The FOV side has one row per FOV, with the slide frame from a window over the FOV
    table; adaptive execution broadcasts it when its bytes turn out small, and then the
    call table is only scanned and projected.
    """
    keys = list(keys)
    f = with_extent(first_location(fovs, keys), height, width, px_per_mm, keys)
    f = f.select(*keys, F.col("FOV").alias("fov"), "X_mm", "Y_mm", "minX", "maxX", "minY", "maxY")
    j = targets.join(f, keys + ["fov"], "left")
    gx, gy = global_xy(F.col("x"), F.col("y"), height, width, px_per_mm)
    return (j.withColumn("global_x", gx).withColumn("global_y", gy)
             .drop("minX", "maxX", "minY", "maxY"))


def filter_gene(targets_global: DataFrame, gene: str) -> DataFrame:
    """all calls of one target, as global (y, x)."""
    return targets_global.where(F.col("target") == gene).select(
        F.col("global_y").alias("y"), F.col("global_x").alias("x"))


def target_counts_for_cells(cells: DataFrame, targets: DataFrame, uid_col: str = "UID",
                            keys: list[str] = ()) -> DataFrame:
    """Frequency of each target among calls that fall in the given cells, per
    ``keys`` (slide, run) when both frames carry them.

    ``cells`` holds cell UIDs (pair(fov, cell)); they are unpaired to
    (fov, CellId). Duplicate UIDs count twice, as in a plain inner join.

    One lazy plan: calls are pre-aggregated to (keys, fov, CellId, target) counts
    before anything is shuffled, which bounds the hot "no cell" key (CellId 0) to
    one row per target and task; cells are reduced to their multiplicity; adaptive
    execution broadcasts or splits the join by its measured size.
    """
    keys = list(keys)
    # Keys are made non-nullable (NULL UIDs never match anyway): otherwise the
    # optimizer infers IS NOT NULL over the whole unpair expression and pushes
    # it into the UID producer, which bloats generated code.
    c = unpair_key(cells.select(*keys, uid_col).where(F.col(uid_col).isNotNull()), uid_col).select(
        *keys, F.coalesce(F.col("fov").cast("int"), F.lit(-1)).alias("fov"),
        F.coalesce(F.col("CellId").cast("int"), F.lit(-1)).alias("CellId"))
    c = c.groupBy(*keys, "fov", "CellId").agg(F.count(F.lit(1)).alias("m"))
    pre = targets.groupBy(*keys, "fov", "CellId", "target").agg(F.count(F.lit(1)).alias("n"))
    j = pre.join(c, keys + ["fov", "CellId"])
    out = j.groupBy(*keys, "target").agg(F.sum(F.col("n") * F.col("m")).alias("count"))
    return out.orderBy(*keys, F.desc("count"), "target")


def ordinal_encode(df: DataFrame, col: str, out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Replace strings by 0-based codes in alphabetical order.

    Returns (encoded frame, dictionary). The dictionary is the distinct values, sorted
    once in range partitions that are numbered on from each other
    (:func:`tessera.util.dense_index`), so no single task sees all of them.
    """
    out = out or f"{col}_code"
    d = df.select(col).where(F.col(col).isNotNull()).distinct()
    d = dense_index(d, col, out)
    return df.join(d, col, "left"), d


def transcript_raster(targets: DataFrame, height: int, width: int, mode: str = "all",
                      genes: list[str] | None = None, groups: int | None = None,
                      seed: int = 0, keys: list[str] = ()) -> DataFrame:
    """Points per pixel of each FOV canvas (keys, fov, row, col, val).

    Points outside [0, W] x [0, H] are dropped; the upper edge belongs to the
    last pixel. Modes: ``all`` -> count; ``genes`` -> 1-based index of the last
    listed gene with a point there; ``random`` -> group 1..n per call, from a
    digest of the seed and the call's values (the same on every run), highest wins. Counts are not wrapped to 8 bits.
    """
    H, W, pixel = int(height), int(width), [*keys, "fov", "row", "col"]
    t = targets.where((F.col("x") >= 0) & (F.col("x") <= W) & (F.col("y") >= 0) & (F.col("y") <= H))
    t = (t.withColumn("row", F.least(F.floor("y"), F.lit(H - 1)).cast("int"))
          .withColumn("col", F.least(F.floor("x"), F.lit(W - 1)).cast("int")))
    if mode == "all":
        return t.groupBy(*pixel).agg(F.count(F.lit(1)).alias("val"))
    if mode == "genes":
        gl = F.array(*[F.lit(g) for g in genes])
        t = t.where(F.col("target").isin(list(genes))).withColumn(
            "gi", F.array_position(gl, F.col("target")).cast("int"))
        return t.groupBy(*pixel).agg(F.max("gi").cast("long").alias("val"))
    if mode == "random":
        values = [F.col(c) for c in [*keys, "fov", "CellId", "x", "y", "z", "target"]]
        t = t.withColumn("gi", digest_group(groups, seed, *values))
        return t.groupBy(*pixel).agg(F.max("gi").alias("val"))
    raise ValueError(mode)


def spread_raster(raster: DataFrame, r: int, height: int, width: int, how: str = "sum",
                  keys: list[str] = ()) -> DataFrame:
    """Dilate every point by a disk of radius r (sum of counts, or max of an index),
    clipped to the FOV canvas, block by block (:func:`tessera.operators.blocks.spread_blocks`):
    a point is sent to its block and the blocks within r, whatever the size of the disk."""
    return spread_blocks(raster, r, height, width, how, keys)


def transcripts_for_display(targets_global: DataFrame, fovs: list[int] | None = None,
                            color: str | None = None, gray_no_cell: bool | None = None) -> DataFrame:
    """Drop controls, optionally keep some FOVs, attach a colour index.

    Colour index = 1-based rank of the gene among the displayed genes (sorted);
    with a fixed ``color`` every point gets index 0. ``gray_no_cell`` (default:
    on when a colour is given) marks calls outside cells (CellId 0) as -1.
    """
    if gray_no_cell is None:
        gray_no_cell = color is not None
    t = drop_control_probes(targets_global)
    if fovs is not None:
        t = t.where(F.col("fov").isin(list(fovs)))
    if color is None:
        t, _ = ordinal_encode(t, "target", "color_idx")
        t = t.withColumn("color_idx", F.col("color_idx") + 1)
    else:
        t = t.withColumn("color_idx", F.lit(0))
    if gray_no_cell:
        t = t.withColumn("color_idx", F.when(F.col("CellId") == 0, F.lit(-1)).otherwise(F.col("color_idx")))
    return t.select(F.col("global_y").alias("y"), F.col("global_x").alias("x"),
                    "CellId", F.col("target").alias("Gene"), "color_idx")
