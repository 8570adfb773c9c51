"""Operators over several slides at once: slides share FOV and cell numbers, so every
join and group must carry the slide key."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import pair_key
from ..operators import cells as C
from ..operators import transcripts as T
from .bindings import Bindings, with_ctes
from .registry import query

SLIDES = 3
_CALLS = f"""
calls AS (SELECT 'S' || CAST(z % {SLIDES} AS VARCHAR) AS slide, z % {SLIDES} AS s, * FROM target_calls),
pts AS (SELECT slide, fov, CAST(least(floor(y), 511) AS INTEGER) AS row, CAST(least(floor(x), 511) AS INTEGER) AS col
        FROM calls WHERE x BETWEEN 0 AND 512 AND y BETWEEN 0 AND 512),
cells AS (SELECT DISTINCT slide, fov, CellId FROM calls WHERE (fov + CellId + s) % 4 = 0)"""


def _calls(b: Bindings):
    s = F.col("z") % SLIDES
    return b.target_calls.withColumn("slide", F.concat(F.lit("S"), s.cast("string"))).withColumn("s", s)


def _cells(b: Bindings):
    c = _calls(b).where((F.col("fov") + F.col("CellId") + F.col("s")) % 4 == 0).select("slide", "fov", "CellId").distinct()
    return c.select("slide", pair_key("fov", "CellId").alias("UID"))


query("transcript_raster_by_slide", with_ctes(
    "SELECT slide, fov, row, col, count(*) AS val FROM pts GROUP BY ALL", "target_calls", extra=_CALLS))(
    lambda spark, d: T.transcript_raster(_calls(Bindings(spark, d)), 512, 512, keys=["slide"]))

query("spread_raster_by_slide", with_ctes("""
SELECT slide, fov, row + o.dy AS row, col + o.dx AS col, CAST(count(*) AS BIGINT) AS val
FROM pts, (VALUES (0, 0), (0, 1), (0, -1), (1, 0), (-1, 0)) o(dy, dx)
WHERE row + o.dy BETWEEN 0 AND 511 AND col + o.dx BETWEEN 0 AND 511 GROUP BY ALL""", "target_calls", extra=_CALLS))(
    lambda spark, d: T.spread_raster(T.transcript_raster(_calls(Bindings(spark, d)), 512, 512, keys=["slide"]),
                                     1, 512, 512, keys=["slide"]))

query("target_counts_by_slide", with_ctes("""
SELECT slide, target, count(*) AS count FROM calls JOIN cells USING (slide, fov, CellId) GROUP BY ALL""",
                                          "target_calls", extra=_CALLS))(
    lambda spark, d: T.target_counts_for_cells(_cells(Bindings(spark, d)), _calls(Bindings(spark, d)), keys=["slide"]))

query("flag_cells_by_slide", with_ctes("""
SELECT a.slide, a.fov, a.CellId, c.slide IS NOT NULL AS marked
FROM (SELECT DISTINCT slide, fov, CellId FROM calls) a LEFT JOIN cells c ON a.slide = c.slide AND a.fov = c.fov AND a.CellId = c.CellId""",
                                       "target_calls", extra=_CALLS))(
    lambda spark, d: C.flag_cells(
        _calls(Bindings(spark, d)).select("slide", "fov", "CellId").distinct().withColumn("UID", pair_key("fov", "CellId")),
        _cells(Bindings(spark, d)).withColumn("layer", F.lit("marked")), ["marked"], keys=["slide"]).drop("UID"))
