"""Slide coordinate system: FOV placement in mosaic pixels and mm.

Instrument "dash" <=> FOV height != width. With ppm = pixels per mm and H, W the
FOV size in pixels (all rounding is round-half-even = ``bround``):

    quantity          dash                          non-dash
    top origin px     max(X)*ppm + H                min(Y)*ppm - H
    left origin px    min(Y)*ppm                    max(X)*ppm
    canvas height     bround(top - min(X)*ppm)      bround(max(Y)*ppm - top)
    canvas width      bround(max(Y)*ppm + W - left) bround(left + W - min(X)*ppm)
    FOV row origin    bround(top - (X*ppm + H))     bround((Y*ppm - H) - top)
    FOV col origin    bround(Y*ppm - left)          bround(left - X*ppm)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Default micrometres per pixel by instrument generation.
BETA_UM_PER_PX = 0.1203
ALPHA_UM_PER_PX = 0.1681
DASH_UM_PER_PX = 0.18
# ---------------------------------------------------------------------------


def scales(um_per_px: float, scale: float = 1.0) -> dict:
    """um/px rounded to 4 places after the user scale; mm/px and px/mm from it."""
    um = round(um_per_px / scale, 4)
    mm = um / 1000
    return {"um_per_px": um, "mm_per_px": mm, "px_per_mm": 1 / mm}


def is_dash(height: int, width: int) -> bool:
    return (height / width) != 1


def first_location(fovs: DataFrame, keys: list[str] = (), order: str = "ord") -> DataFrame:
    """One location per FOV: duplicated FOV rows keep the first listed one."""
    keys = list(keys)
    cols = [c for c in fovs.columns if c not in keys + ["FOV", order]]
    o = F.col(order)
    return fovs.groupBy(*keys, "FOV").agg(
        *[F.min_by(c, o).alias(c) for c in cols], F.min(o).alias(order))


def with_extent(fovs: DataFrame, height: int, width: int, px_per_mm: float,
                keys: list[str] = ()) -> DataFrame:
    """Add the slide frame (top, left, canvas size, top-left mm) to every FOV row.

    The FOV table is a small dimension (one row per FOV of each slide); the
    extent is a window aggregate over it, partitioned by slide keys.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    ppm = F.lit(float(px_per_mm))
    H, W = F.lit(int(height)), F.lit(int(width))
    minX, maxX = F.min("X_mm").over(w), F.max("X_mm").over(w)
    minY, maxY = F.min("Y_mm").over(w), F.max("Y_mm").over(w)
    df = (fovs.withColumn("minX", minX).withColumn("maxX", maxX)
              .withColumn("minY", minY).withColumn("maxY", maxY))
    if is_dash(height, width):
        top = F.col("maxX") * ppm + H
        left = F.col("minY") * ppm
        df = df.withColumn("top_px", top).withColumn("left_px", left)
        df = (df.withColumn("canvas_h", F.bround(F.col("top_px") - F.col("minX") * ppm).cast("long"))
                .withColumn("canvas_w", F.bround(F.col("maxY") * ppm + W - F.col("left_px")).cast("long"))
                .withColumn("y0", F.bround(F.col("top_px") - (F.col("X_mm") * ppm + H)).cast("long"))
                .withColumn("x0", F.bround(F.col("Y_mm") * ppm - F.col("left_px")).cast("long"))
                .withColumn("top_mm", -F.col("maxX")).withColumn("left_mm", F.col("minY")))
    else:
        top = F.col("minY") * ppm - H
        left = F.col("maxX") * ppm
        df = df.withColumn("top_px", top).withColumn("left_px", left)
        df = (df.withColumn("canvas_h", F.bround(F.col("maxY") * ppm - F.col("top_px")).cast("long"))
                .withColumn("canvas_w", F.bround(F.col("left_px") + W - F.col("minX") * ppm).cast("long"))
                .withColumn("y0", F.bround((F.col("Y_mm") * ppm - H) - F.col("top_px")).cast("long"))
                .withColumn("x0", F.bround(F.col("left_px") - F.col("X_mm") * ppm).cast("long"))
                .withColumn("top_mm", F.col("minY")).withColumn("left_mm", -F.col("maxX")))
    return df


def slide_extent(fovs: DataFrame, height: int, width: int, px_per_mm: float,
                 keys: list[str] = ()) -> DataFrame:
    """One row per slide with canvas size and origin."""
    keys = list(keys)
    ppm = float(px_per_mm)
    g = fovs.groupBy(*keys).agg(F.min("X_mm").alias("minX"), F.max("X_mm").alias("maxX"),
                                F.min("Y_mm").alias("minY"), F.max("Y_mm").alias("maxY"))
    H, W, p = F.lit(int(height)), F.lit(int(width)), F.lit(ppm)
    if is_dash(height, width):
        top = F.col("maxX") * p + H
        left = F.col("minY") * p
        h = F.bround(top - F.col("minX") * p)
        w = F.bround(F.col("maxY") * p + W - left)
        tl = [(-F.col("maxX")).alias("top_mm"), F.col("minY").alias("left_mm")]
    else:
        top = F.col("minY") * p - H
        left = F.col("maxX") * p
        h = F.bround(F.col("maxY") * p - top)
        w = F.bround(left + W - F.col("minX") * p)
        tl = [F.col("minY").alias("top_mm"), (-F.col("maxX")).alias("left_mm")]
    return g.select(*keys, top.alias("top_px"), left.alias("left_px"),
                    h.cast("long").alias("height"), w.cast("long").alias("width"), *tl)


def global_xy(x: Column, y: Column, height: int, width: int, px_per_mm: float) -> tuple[Column, Column]:
    """Transcript position in slide pixels (needs the ``with_extent`` columns)."""
    p = F.lit(float(px_per_mm))
    if is_dash(height, width):
        gx = (x + F.col("Y_mm") * p) - F.col("minY") * p
        gy = (y - F.col("X_mm") * p) + F.col("maxX") * p
    else:
        gx = (x - F.col("X_mm") * p) + F.col("maxX") * p
        gy = (y + F.col("Y_mm") * p) - F.col("minY") * p
    return gx, gy
