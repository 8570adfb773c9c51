"""Colour columns: P7 deterministic_color, P8 palette_color, P9 rgba_from_hex,
P18 assign_category_color."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..util import dense_index


# ---------------------------------------------------------------------------
# Fixed values.
# 20-colour categorical palette used for cluster plots (index = rank of the
# sorted type name, modulo 20).
PALETTE = [
    "#E64B35", "#4DBBD5", "#00A087", "#3C5488", "#F39B7F",
    "#8491B4", "#91D1C2", "#DC9400", "#7E6148", "#B09C85",
    "#E7298A", "#66A61E", "#E6AB02", "#A6761D", "#1B9E77",
    "#D95F02", "#7570B3", "#E7298A", "#A6CEE3", "#1F78B4",
]
HISTOGRAM_DEFAULT_COLOR = "#4C72B0"
LEGEND_DEFAULT_COLOR = "#808080"
TRANSPARENT = "#00000000"
LINK_ALPHA = 0.3
# ---------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P7 -------------------------------------------------------------------------
def deterministic_color(c: Column | str) -> Column:
    """Stable colour per name: ``#`` + first six hex digits of md5, upper case.
    NULL or empty names give ``''``. (Same result in Spark and DuckDB.)"""
    c = _c(c)
    return F.when(c.isNull() | (c == ""), F.lit("")).otherwise(
        F.concat(F.lit("#"), F.upper(F.substring(F.md5(c), 1, 6))))


# P8 -------------------------------------------------------------------------
def palette_color(df: DataFrame, col: str, palette: list[str] = PALETTE,
                  out: str = "color", dictionary: DataFrame | None = None) -> DataFrame:
    """colour = palette[rank(sorted distinct value) mod len(palette)].

    The value dictionary (distinct values, optionally shared across slides via
    ``dictionary``) is numbered without a global window and joined back.
    """
    values = (dictionary if dictionary is not None else df).select(col).where(F.col(col).isNotNull()).distinct()
    pal = F.array(*[F.lit(p) for p in palette])
    d = (dense_index(values, col, "_i").withColumn(out, F.element_at(pal, (F.col("_i") % len(palette) + 1).cast("int")))
         .drop("_i"))
    return df.join(d, col, "left")


# P9 -------------------------------------------------------------------------
def rgba_from_hex(c: Column | str, alpha: float = LINK_ALPHA) -> Column:
    """``#RRGGBB`` -> ``rgba(r,g,b,alpha)``."""
    h = F.regexp_replace(_c(c), "^#", "")
    comp = [F.conv(F.substring(h, i, 2), 16, 10) for i in (1, 3, 5)]
    return F.concat(F.lit("rgba("), comp[0], F.lit(","), comp[1], F.lit(","), comp[2],
                    F.lit(f",{alpha})"))


# P18 ------------------------------------------------------------------------
def assign_category_color(df: DataFrame, col: str, supplied: DataFrame | None = None,
                          category_colors: DataFrame | None = None,
                          hex_col: str | None = "hex_color", order_col: str | None = None,
                          out: str = "color") -> DataFrame:
    """Colour per category value with precedence
    supplied map -> category colour table -> first ``hex_color`` per value ->
    generated (P7); NULL value or no colour -> transparent.

    ``supplied`` / ``category_colors`` are (value, color) tables; joins are
    null-safe, with one row per category on the right.
    """
    cand = []
    base = df
    if supplied is not None:
        s = supplied.toDF(col, "_c_sup")
        base = base.join(s, col, "left")
        cand.append(F.col("_c_sup"))
    if category_colors is not None:
        t = category_colors.toDF(col, "_c_cat")
        base = base.join(t, col, "left")
        cand.append(F.col("_c_cat"))
    if hex_col and hex_col in df.columns:
        order = F.col(order_col) if order_col else F.monotonically_increasing_id()
        first = (df.where(F.col(hex_col).isNotNull() & (F.col(hex_col) != ""))
                   .groupBy(col).agg(F.min_by(hex_col, order).alias("_c_first")))
        base = base.join(first, col, "left")
        cand.append(F.col("_c_first"))
    gen = F.when(deterministic_color(col) == "", None).otherwise(deterministic_color(col))
    cand.append(gen)
    res = F.when(F.col(col).isNull(), F.lit(TRANSPARENT)).otherwise(F.coalesce(*cand, F.lit(TRANSPARENT)))
    return base.withColumn(out, res).drop("_c_sup", "_c_cat", "_c_first")
