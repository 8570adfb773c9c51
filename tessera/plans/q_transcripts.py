"""Registered transcript queries (driver-table bindings + SQL oracles)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geometry import ALPHA_UM_PER_PX, scales
from ..functions.keys import key_label_pixels
from ..operators import transcripts as T
from ..util import rnd
from .bindings import Bindings, with_ctes
from .registry import query

FOV_H = FOV_W = 512                      # transcript canvas per FOV (pixels)
PPM = scales(ALPHA_UM_PER_PX)["px_per_mm"]
P = repr(PPM)

# ---------------------------------------------------------------- F3
query("drop_control_probes", with_ctes("""
SELECT fov, CellId, x, y, z, target, CellComp FROM target_calls
WHERE NOT starts_with(target, 'NegPrb') AND NOT starts_with(target, 'FalseCode')
  AND NOT starts_with(target, 'SystemControl')""", "target_calls"))(
    lambda spark, d: T.drop_control_probes(Bindings(spark, d).target_calls))

# ---------------------------------------------------------------- A6
query("gene_list", with_ctes("""
SELECT DISTINCT target FROM target_calls
WHERE NOT starts_with(target, 'NegPrb') AND NOT starts_with(target, 'FalseCode')
  AND NOT starts_with(target, 'SystemControl')""", "target_calls"))(
    lambda spark, d: T.gene_list(Bindings(spark, d).target_calls))

# ---------------------------------------------------------------- J2
_FOV1 = """
f1 AS (SELECT FOV, arg_min(X_mm, ord) AS X_mm, arg_min(Y_mm, ord) AS Y_mm FROM fovs GROUP BY FOV),
ext AS (SELECT min(X_mm) AS minX, max(X_mm) AS maxX, min(Y_mm) AS minY, max(Y_mm) AS maxY FROM f1)"""

_J2_BODY = f"""
SELECT t.fov, t.CellId, t.x, t.y, t.z, t.target, t.CellComp, f.X_mm, f.Y_mm,
       round((t.x - f.X_mm * {P}) + ext.maxX * {P}, 6) AS global_x,
       round((t.y + f.Y_mm * {P}) - ext.minY * {P}, 6) AS global_y
FROM target_calls t LEFT JOIN f1 f ON t.fov = f.FOV, ext"""


@query("global_coordinates", with_ctes(_J2_BODY, "fovs", "target_calls", extra=_FOV1))
def q_global_coordinates(spark, d):
    b = Bindings(spark, d)
    g = T.global_coordinates(b.target_calls, b.fovs, FOV_H, FOV_W, PPM)
    return g.withColumn("global_x", rnd("global_x")).withColumn("global_y", rnd("global_y"))


# ---------------------------------------------------------------- F6
@query("filter_gene", with_ctes(f"""
SELECT round((t.y + f.Y_mm * {P}) - ext.minY * {P}, 6) AS y,
       round((t.x - f.X_mm * {P}) + ext.maxX * {P}, 6) AS x
FROM target_calls t LEFT JOIN f1 f ON t.fov = f.FOV, ext
WHERE t.target = 'red widget'""", "fovs", "target_calls", extra=_FOV1))
def q_filter_gene(spark, d):
    b = Bindings(spark, d)
    g = T.global_coordinates(b.target_calls, b.fovs, FOV_H, FOV_W, PPM)
    return T.filter_gene(g, "red widget").select(rnd("y").alias("y"), rnd("x").alias("x"))


# ---------------------------------------------------------------- J3
# Cells = every non-background label of the label raster, keyed by P6.
_CELLS_SQL = """
cells AS (
  SELECT DISTINCT CASE WHEN fov >= val THEN CAST(fov AS BIGINT) * fov + fov + val
                       ELSE val * val + fov END AS UID
  FROM label_pixels WHERE val <> 0)"""


def _label_cells(b: Bindings):
    k = key_label_pixels(b.label_pixels.where(F.col("val") != 0))
    return k.select(F.col("val").alias("UID")).distinct()


@query("target_counts_for_cells", with_ctes("""
SELECT t.target, count(*) AS count
FROM target_calls t JOIN cells c
  ON t.fov = CAST(CASE WHEN c.UID - floor(sqrt(c.UID))^2 < floor(sqrt(c.UID))
                       THEN c.UID - floor(sqrt(c.UID))^2 ELSE floor(sqrt(c.UID)) END AS INTEGER)
 AND t.CellId = CAST(CASE WHEN c.UID - floor(sqrt(c.UID))^2 < floor(sqrt(c.UID))
                          THEN floor(sqrt(c.UID))
                          ELSE c.UID - floor(sqrt(c.UID))^2 - floor(sqrt(c.UID)) END AS INTEGER)
GROUP BY t.target""", "target_calls", "label_pixels", extra=_CELLS_SQL))
def q_target_counts_for_cells(spark, d):
    b = Bindings(spark, d)
    return T.target_counts_for_cells(_label_cells(b), b.target_calls)


# ---------------------------------------------------------------- J13
@query("ordinal_encode", with_ctes("""
SELECT t.fov, t.CellId, t.target, d.target_code, c.CellComp_code
FROM target_calls t
JOIN (SELECT target, CAST(row_number() OVER (ORDER BY target) - 1 AS INTEGER) AS target_code
      FROM (SELECT DISTINCT target FROM target_calls)) d ON t.target = d.target
JOIN (SELECT CellComp, CAST(row_number() OVER (ORDER BY CellComp) - 1 AS INTEGER) AS CellComp_code
      FROM (SELECT DISTINCT CellComp FROM target_calls)) c ON t.CellComp = c.CellComp""", "target_calls"))
def q_ordinal_encode(spark, d):
    t = Bindings(spark, d).target_calls.select("fov", "CellId", "target", "CellComp")
    t, _ = T.ordinal_encode(t, "target")
    t, _ = T.ordinal_encode(t, "CellComp")
    return t.select("fov", "CellId", "target", "target_code", "CellComp_code")


# ---------------------------------------------------------------- A13 (all / genes)
_RASTER_PTS = f"""
pts AS (
  SELECT fov, target, CAST(least(floor(y), {FOV_H - 1}) AS INTEGER) AS row,
         CAST(least(floor(x), {FOV_W - 1}) AS INTEGER) AS col
  FROM target_calls WHERE x >= 0 AND x <= {FOV_W} AND y >= 0 AND y <= {FOV_H})"""

query("transcript_raster", with_ctes("""
SELECT fov, row, col, count(*) AS val FROM pts GROUP BY 1, 2, 3""", "target_calls", extra=_RASTER_PTS))(
    lambda spark, d: T.transcript_raster(Bindings(spark, d).target_calls, FOV_H, FOV_W))

_GENES = ["red widget", "small ring", "blue gear"]
query("transcript_raster_genes", with_ctes("""
SELECT fov, row, col, CAST(max(list_position(['red widget', 'small ring', 'blue gear'], target)) AS BIGINT) AS val
FROM pts WHERE target IN ('red widget', 'small ring', 'blue gear') GROUP BY 1, 2, 3""",
                                           "target_calls", extra=_RASTER_PTS))(
    lambda spark, d: T.transcript_raster(Bindings(spark, d).target_calls, FOV_H, FOV_W, "genes", _GENES))


# ---------------------------------------------------------------- A14
def _disk_sql(r):
    return ", ".join(f"({dy}, {dx})" for dy in range(-r, r + 1) for dx in range(-r, r + 1) if dy * dy + dx * dx <= r * r)


query("spread_raster", with_ctes(f"""
SELECT fov, row + o.dy AS row, col + o.dx AS col, CAST(sum(val) AS BIGINT) AS val
FROM (SELECT fov, row, col, count(*) AS val FROM pts GROUP BY 1, 2, 3) r,
     (VALUES {_disk_sql(2)}) o(dy, dx)
WHERE row + o.dy >= 0 AND row + o.dy < {FOV_H} AND col + o.dx >= 0 AND col + o.dx < {FOV_W}
GROUP BY 1, 2, 3""", "target_calls", extra=_RASTER_PTS))(
    lambda spark, d: T.spread_raster(T.transcript_raster(Bindings(spark, d).target_calls, FOV_H, FOV_W),
                                     2, FOV_H, FOV_W))


# ---------------------------------------------------------------- R12
@query("transcripts_for_display", with_ctes(f"""
SELECT round((t.y + f.Y_mm * {P}) - ext.minY * {P}, 6) AS y,
       round((t.x - f.X_mm * {P}) + ext.maxX * {P}, 6) AS x,
       t.CellId, t.target AS Gene,
       CAST(CASE WHEN t.CellId = 0 THEN -1 ELSE 0 END AS INTEGER) AS color_idx
FROM target_calls t LEFT JOIN f1 f ON t.fov = f.FOV, ext
WHERE NOT starts_with(t.target, 'NegPrb') AND NOT starts_with(t.target, 'FalseCode')
  AND NOT starts_with(t.target, 'SystemControl') AND t.fov IN (1, 2, 3, 4, 5)""",
                                           "fovs", "target_calls", extra=_FOV1))
def q_transcripts_for_display(spark, d):
    b = Bindings(spark, d)
    g = T.global_coordinates(b.target_calls, b.fovs, FOV_H, FOV_W, PPM)
    r = T.transcripts_for_display(g, fovs=[1, 2, 3, 4, 5], color="#00FF00")
    return r.withColumn("y", rnd("y")).withColumn("x", rnd("x")).withColumn("color_idx", F.col("color_idx").cast("int"))


@query("transcripts_by_gene_color", with_ctes(f"""
SELECT round((t.y + f.Y_mm * {P}) - ext.minY * {P}, 6) AS y,
       round((t.x - f.X_mm * {P}) + ext.maxX * {P}, 6) AS x,
       t.CellId, t.target AS Gene, CAST(g.idx AS INTEGER) AS color_idx
FROM target_calls t LEFT JOIN f1 f ON t.fov = f.FOV, ext,
     (SELECT target, row_number() OVER (ORDER BY target) AS idx FROM (
        SELECT DISTINCT target FROM target_calls
        WHERE NOT starts_with(target, 'NegPrb') AND NOT starts_with(target, 'FalseCode')
          AND NOT starts_with(target, 'SystemControl'))) g
WHERE t.target = g.target""", "fovs", "target_calls", extra=_FOV1))
def q_transcripts_by_gene_color(spark, d):
    b = Bindings(spark, d)
    g = T.global_coordinates(b.target_calls, b.fovs, FOV_H, FOV_W, PPM)
    r = T.transcripts_for_display(g)
    return r.withColumn("y", rnd("y")).withColumn("x", rnd("x")).withColumn("color_idx", F.col("color_idx").cast("int"))


# A14 with the genes mode: the last listed gene within the disk wins (max index).
query("spread_raster_genes", with_ctes(f"""
SELECT fov, row + o.dy AS row, col + o.dx AS col, CAST(max(val) AS BIGINT) AS val
FROM (SELECT fov, row, col, CAST(max(list_position(['red widget', 'small ring', 'blue gear'], target)) AS BIGINT) AS val
      FROM pts WHERE target IN ('red widget', 'small ring', 'blue gear') GROUP BY 1, 2, 3) r,
     (VALUES {_disk_sql(3)}) o(dy, dx)
WHERE row + o.dy >= 0 AND row + o.dy < {FOV_H} AND col + o.dx >= 0 AND col + o.dx < {FOV_W}
GROUP BY 1, 2, 3""", "target_calls", extra=_RASTER_PTS))(
    lambda spark, d: T.spread_raster(
        T.transcript_raster(Bindings(spark, d).target_calls, FOV_H, FOV_W, "genes", _GENES), 3, FOV_H, FOV_W, how="max"))
