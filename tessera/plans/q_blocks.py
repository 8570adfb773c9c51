"""Registered queries of the block form (R1, R2, R6, R9, R10, J9), for one slide and for
three that share FOV numbers but lack different FOVs, so canvases and overlaps differ."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import key_label_pixels
from ..operators import blocks as BL
from ..operators import raster as R
from .bindings import Bindings, with_ctes
from .q_raster import _GEO, H, MMPP, P, PPM, W, _ctx, _shapes, _shapes_sql
from .registry import ORACLES, query

BLOCK = 16
SLIDES = 3


def _labels(b: Bindings):
    return key_label_pixels(b.label_pixels).withColumn("channel", F.lit("labels"))


def _mosaic(b: Bindings):
    return BL.stitch_blocks(BL.pack_tiles(b.pixels, H, W), _ctx(b), BLOCK)


def _label_blocks(b: Bindings):
    return BL.stitch_blocks(BL.pack_tiles(_labels(b), H, W), _ctx(b), BLOCK)


def _channels(blocks):
    return BL.blocks_to_long(blocks, BLOCK).withColumn("channel", F.col("channel").cast("int"))


def _nonzero(name):
    return f"SELECT * FROM ({ORACLES[name]}) WHERE val <> 0"


query("stitch_blocks", _nonzero("stitch_mosaic"))(lambda spark, d: _channels(_mosaic(Bindings(spark, d))))

query("pyramid_blocks", _nonzero("build_pyramid"))(
    lambda spark, d: _channels(BL.pyramid_blocks(_mosaic(Bindings(spark, d)), BLOCK, min_size=4)))

query("label_boundaries_blocks", ORACLES["label_boundaries"])(
    lambda spark, d: BL.blocks_to_long(BL.boundaries_blocks(_label_blocks(Bindings(spark, d)), BLOCK), BLOCK)
    .select("row", "col", F.col("val").cast("int").alias("val")))

query("label_contour_blocks", ORACLES["label_contour"])(
    lambda spark, d: BL.blocks_to_long(BL.contour_blocks(_label_blocks(Bindings(spark, d)), 2, BLOCK), BLOCK).select("row", "col", "val"))


@query("cells_in_shapes_blocks", ORACLES["cells_in_shapes"])
def q_cells_in_shapes_blocks(spark, d):
    b = Bindings(spark, d)
    size = _canvas(_ctx(b))
    return BL.cells_in_shapes_blocks(_shapes(spark), _label_blocks(b), MMPP, (0.0, 0.0), *size, BLOCK)


def _canvas(origins):
    row = origins.agg(F.max("canvas_h").alias("h"), F.max("canvas_w").alias("w")).first()
    return int(row["h"]), int(row["w"])


# ---------------------------------------------------------------- several slides
_BY_SLIDE = _GEO + f""",
sl AS (SELECT unnest(range({SLIDES})) AS s),
sf1 AS (SELECT 'S' || s AS slide, f1.* FROM f1, sl WHERE FOV % {SLIDES} <> s),
sext AS (SELECT slide, min(X_mm) AS minX, max(X_mm) AS maxX, min(Y_mm) AS minY, max(Y_mm) AS maxY FROM sf1 GROUP BY slide),
sgeo AS (SELECT slide, FOV AS fov, paste_order,
                CAST(round_even((Y_mm * {P} - {H}) - (minY * {P} - {H}), 0) AS BIGINT) AS y0,
                CAST(round_even(maxX * {P} - X_mm * {P}, 0) AS BIGINT) AS x0,
                CAST(round_even(maxY * {P} - (minY * {P} - {H}), 0) AS BIGINT) AS canvas_h,
                CAST(round_even(maxX * {P} + {W} - minX * {P}, 0) AS BIGINT) AS canvas_w
         FROM sf1 JOIN sext USING (slide)),
scanvas AS (SELECT slide, max(canvas_h) AS h, max(canvas_w) AS w FROM sgeo GROUP BY slide),
spix AS (SELECT 'S' || s AS slide, fov, channel, row, col, val * (s + 1) AS val FROM pixels, sl),
smosaic AS (SELECT slide, p.channel, p.row + g.y0 AS row, p.col + g.x0 AS col, arg_max(p.val, g.paste_order) AS val
            FROM spix p JOIN sgeo g USING (slide, fov)
            WHERE p.row + g.y0 >= 0 AND p.row + g.y0 < g.canvas_h AND p.col + g.x0 >= 0 AND p.col + g.x0 < g.canvas_w
            GROUP BY 1, 2, 3, 4),
skeyed AS (SELECT 'S' || s AS slide, fov, row, col, CASE WHEN val = 0 THEN 0 ELSE val + s END AS val FROM keyed, sl),
slabels AS (SELECT slide, p.row + g.y0 AS row, p.col + g.x0 AS col, arg_max(p.val, g.paste_order) AS val
            FROM skeyed p JOIN sgeo g USING (slide, fov)
            WHERE p.row + g.y0 >= 0 AND p.row + g.y0 < g.canvas_h AND p.col + g.x0 >= 0 AND p.col + g.x0 < g.canvas_w
            GROUP BY 1, 2, 3),
srows AS (SELECT slide, w, unnest(range(h)) AS row FROM scanvas),
sgrid AS (SELECT slide, row, unnest(range(w)) AS col FROM srows),
sdense AS (SELECT g.slide, g.row, g.col, coalesce(l.val, 0) AS val
           FROM sgrid g LEFT JOIN slabels l ON l.slide = g.slide AND l.row = g.row AND l.col = g.col)"""


def _sql(body: str, *more: str) -> str:
    return with_ctes(body, "fovs", "pixels", "label_pixels", extra=",\n".join([_BY_SLIDE, *more]))


def _with_slides(df):
    return df.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SLIDES - 1)))).withColumn("slide", F.concat(F.lit("S"), F.col("s").cast("string")))


def _slide_origins(b: Bindings):
    return R.fov_origins(_with_slides(b.fovs).where(F.col("FOV") % SLIDES != F.col("s")), H, W, PPM, keys=["slide"])


def _slide_tiles(pixels):
    return BL.pack_tiles(pixels, H, W, keys=["slide", "fov", "channel"])


def _slide_mosaic(b: Bindings):
    pixels = _with_slides(b.pixels).withColumn("val", F.col("val") * (F.col("s") + 1))
    return BL.stitch_blocks(_slide_tiles(pixels), _slide_origins(b), BLOCK, keys=["slide"])


def _slide_labels(b: Bindings):
    labels = _with_slides(_labels(b)).withColumn("val", F.when(F.col("val") == 0, 0).otherwise(F.col("val") + F.col("s")))
    return BL.stitch_blocks(_slide_tiles(labels), _slide_origins(b), BLOCK, keys=["slide"])


query("stitch_blocks_by_slide", _sql("SELECT slide, channel, row, col, val FROM smosaic WHERE val <> 0"))(
    lambda spark, d: _channels(_slide_mosaic(Bindings(spark, d))))

_STEP = "(1 << least(level, CAST(floor(log2({0})) AS INTEGER)))"
query("pyramid_blocks_by_slide", _sql(f"""
SELECT slide, channel, level, CAST((row + 1) // {_STEP.format('h')} - 1 AS BIGINT) AS row, CAST((col + 1) // {_STEP.format('w')} - 1 AS BIGINT) AS col, val
FROM smosaic JOIN (SELECT slide, h, w, CAST(unnest(range(0, greatest(1, CAST(floor(log2(greatest(h, w) / 4)) AS INTEGER)))) AS INTEGER) AS level
                   FROM scanvas) USING (slide)
WHERE val <> 0 AND (row + 1) % {_STEP.format('h')} = 0 AND (col + 1) % {_STEP.format('w')} = 0
  AND (row + 1) // {_STEP.format('h')} - 1 < greatest(1, h >> level) AND (col + 1) // {_STEP.format('w')} - 1 < greatest(1, w >> level)"""))(
    lambda spark, d: _channels(BL.pyramid_blocks(_slide_mosaic(Bindings(spark, d)), BLOCK, min_size=4)))

query("label_boundaries_blocks_by_slide", _sql("""
SELECT a.slide, a.row, a.col, 1 AS val FROM sdense a JOIN sdense n
  ON n.slide = a.slide AND n.row BETWEEN a.row - 1 AND a.row + 1 AND n.col BETWEEN a.col - 1 AND a.col + 1
GROUP BY a.slide, a.row, a.col HAVING bool_or(n.val <> a.val)"""))(
    lambda spark, d: BL.blocks_to_long(BL.boundaries_blocks(_slide_labels(Bindings(spark, d)), BLOCK), BLOCK)
    .select("slide", "row", "col", F.col("val").cast("int").alias("val")))

query("label_contour_blocks_by_slide", _sql("""
SELECT a.slide, a.row, a.col, a.val FROM sdense a JOIN sdense n ON n.slide = a.slide AND abs(n.row - a.row) + abs(n.col - a.col) <= 3
GROUP BY a.slide, a.row, a.col, a.val
HAVING a.val <> 0 AND max(CASE WHEN abs(n.row - a.row) + abs(n.col - a.col) <= 1 THEN n.val END) <> min(n.val)"""))(
    lambda spark, d: BL.blocks_to_long(BL.contour_blocks(_slide_labels(Bindings(spark, d)), 3, BLOCK), BLOCK).select("slide", "row", "col", "val"))


@query("cells_in_shapes_blocks_by_slide", _sql("""
SELECT DISTINCT l.slide, s.shape_id, l.val AS UID FROM slabels l JOIN shapes s ON s.kind = 'rectangle'
WHERE l.val <> 0 AND l.row >= trunc(s.vertices[1].y) AND l.row < trunc(s.vertices[3].y)
  AND l.col >= trunc(s.vertices[1].x) AND l.col < trunc(s.vertices[2].x)
UNION
SELECT DISTINCT l.slide, s.shape_id, l.val AS UID
FROM slabels l JOIN (SELECT shape_id, trunc(vertices[1].y) + (trunc(vertices[4].y) - trunc(vertices[1].y)) / 2 AS ey, (trunc(vertices[4].y) - trunc(vertices[1].y)) / 2 AS er,
                            trunc(vertices[1].x) + (trunc(vertices[2].x) - trunc(vertices[1].x)) / 2 AS ex, (trunc(vertices[2].x) - trunc(vertices[1].x)) / 2 AS ec
                     FROM shapes WHERE kind = 'ellipse') s ON pow((l.row - s.ey) / s.er, 2) + pow((l.col - s.ex) / s.ec, 2) < 1
WHERE l.val <> 0""", _shapes_sql()))
def q_cells_in_shapes_blocks_by_slide(spark, d):
    b = Bindings(spark, d)
    origins = _slide_origins(b)
    shapes = _with_slides(_shapes(spark).where("kind IN ('rectangle', 'ellipse')"))
    return BL.cells_in_shapes_blocks(shapes, _slide_labels(b), MMPP, (0.0, 0.0), *_canvas(origins), BLOCK, keys=["slide"])


# ---------------------------------------------------------------- X6, long form by slide
_INSIDE = """
inside AS (
  SELECT DISTINCT l.slide, 'shape_' || s.shape_id AS layer, l.val AS UID FROM slabels l JOIN shapes s ON s.kind = 'rectangle'
  WHERE l.val <> 0 AND l.row >= trunc(s.vertices[1].y) AND l.row < trunc(s.vertices[3].y)
    AND l.col >= trunc(s.vertices[1].x) AND l.col < trunc(s.vertices[2].x)
  UNION
  SELECT DISTINCT l.slide, 'points_' || p.layer, l.val FROM slabels l
  JOIN (SELECT 'S' || l_linenumber % 3 AS slide, CASE WHEN l_linenumber % 2 = 0 THEN 'a' ELSE 'b' END AS layer,
               l_orderkey % 70 AS row, l_partkey % 70 AS col FROM lineitem) p ON p.slide = l.slide AND p.row = l.row AND p.col = l.col
  WHERE l.val <> 0)"""


@query("roi_flags_by_slide", _sql("""
SELECT m.slide, m.UID, bool_or(coalesce(i.layer = 'shape_1', false)) AS shape_1, bool_or(coalesce(i.layer = 'points_a', false)) AS points_a,
       bool_or(coalesce(i.layer = 'points_b', false)) AS points_b
FROM (SELECT DISTINCT slide, val AS UID FROM slabels WHERE val <> 0) m LEFT JOIN inside i ON i.slide = m.slide AND i.UID = m.UID
GROUP BY m.slide, m.UID""", _shapes_sql(), _INSIDE))
def q_roi_flags_by_slide(spark, d):
    from . import jobs as J
    b = Bindings(spark, d)
    origins = _slide_origins(b)
    labels = _with_slides(_labels(b)).withColumn("val", F.when(F.col("val") == 0, 0).otherwise(F.col("val") + F.col("s")))
    labels = R.stitch_mosaic(labels, origins, keys=["slide"]).select("slide", "row", "col", "val")
    li = b.t("lineitem")
    points = li.select(F.concat(F.lit("S"), (F.col("l_linenumber") % 3).cast("string")).alias("slide"),
                       F.when(F.col("l_linenumber") % 2 == 0, "a").otherwise("b").alias("layer"),
                       (F.col("l_orderkey") % 70 + 0.5).cast("double").alias("y"), (F.col("l_partkey") % 70 + 0.5).cast("double").alias("x"))
    meta = labels.where("val <> 0").select("slide", F.col("val").alias("UID")).distinct()
    calls = b.target_calls.withColumn("slide", F.lit("S0"))
    shapes = _with_slides(_shapes(spark).where("kind = 'rectangle'"))
    return J.roi_annotation_job(shapes, labels, meta, calls, MMPP, (0.0, 0.0), *_canvas(origins), points=points, keys=["slide"])[0]
