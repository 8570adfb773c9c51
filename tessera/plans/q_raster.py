"""Registered raster queries: FOV tiles (embeddings as 8 x 8 tiles) placed on a
slide canvas by the FOV table (0.5 mm pitch at 12 px/mm = 6 px, so neighbouring
8 px tiles overlap by 2 px and the overwrite rule matters)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import slide_extent
from ..functions.keys import parse_barcode
from ..operators import cells as C
from ..operators import raster as R
from ..operators import transcripts as TR
from ..util import rnd
from .bindings import FOV_PITCH_PX_PER_MM, FOV_TILE, Bindings, with_ctes
from .registry import query

H = W = FOV_TILE
PPM = FOV_PITCH_PX_PER_MM
MMPP = 1 / PPM


def D(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


P = D(PPM)

_GEO = f"""
f1 AS (SELECT FOV, arg_min(X_mm, ord) AS X_mm, arg_min(Y_mm, ord) AS Y_mm, max(ord) AS paste_order
       FROM fovs GROUP BY FOV),
ext AS (SELECT min(X_mm) AS minX, max(X_mm) AS maxX, min(Y_mm) AS minY, max(Y_mm) AS maxY FROM f1),
geo AS (SELECT FOV AS fov, paste_order,
               CAST(round_even((Y_mm * {P} - {H}) - (minY * {P} - {H}), 0) AS BIGINT) AS y0,
               CAST(round_even(maxX * {P} - X_mm * {P}, 0) AS BIGINT) AS x0,
               CAST(round_even(maxY * {P} - (minY * {P} - {H}), 0) AS BIGINT) AS canvas_h,
               CAST(round_even(maxX * {P} + {W} - minX * {P}, 0) AS BIGINT) AS canvas_w
        FROM f1, ext),
canvas AS (SELECT max(canvas_h) AS h, max(canvas_w) AS w FROM geo),
mosaic AS (SELECT p.channel, p.row + g.y0 AS row, p.col + g.x0 AS col, arg_max(p.val, g.paste_order) AS val
           FROM pixels p JOIN geo g ON p.fov = g.fov
           WHERE p.row + g.y0 >= 0 AND p.row + g.y0 < g.canvas_h AND p.col + g.x0 >= 0 AND p.col + g.x0 < g.canvas_w
           GROUP BY 1, 2, 3),
keyed AS (SELECT fov, row, col,
                 CASE WHEN val = 0 THEN CAST(0 AS BIGINT)
                      WHEN fov >= val THEN CAST(fov AS BIGINT) * fov + fov + val ELSE val * val + fov END AS val
          FROM label_pixels),
labels AS (SELECT p.row + g.y0 AS row, p.col + g.x0 AS col, arg_max(p.val, g.paste_order) AS val
           FROM keyed p JOIN geo g ON p.fov = g.fov
           WHERE p.row + g.y0 >= 0 AND p.row + g.y0 < g.canvas_h AND p.col + g.x0 >= 0 AND p.col + g.x0 < g.canvas_w
           GROUP BY 1, 2),
dense AS (SELECT r.row, c.col, coalesce(l.val, 0) AS val
          FROM canvas, range(0, (SELECT h FROM canvas)) r(row), range(0, (SELECT w FROM canvas)) c(col)
          LEFT JOIN labels l ON l.row = r.row AND l.col = c.col)"""


def _ctx(b: Bindings):
    origins = R.fov_origins(b.fovs, H, W, PPM)
    return origins


def _canvas(b: Bindings):
    e = slide_extent(b.fovs, H, W, PPM).first()
    return int(e["height"]), int(e["width"])


def _mosaic(b: Bindings):
    return R.stitch_mosaic(b.pixels, _ctx(b))


def _labels(b: Bindings):
    return R.stitch_labels(b.label_pixels, _ctx(b)).select("row", "col", "val")


def _ras(body: str, *extra_names):
    return with_ctes(body, "fovs", "pixels", "label_pixels", *extra_names, extra=_GEO)


# ---------------------------------------------------------------- A8
@query("slide_extent", with_ctes(f"""
SELECT minY * {P} - {H} AS top_px, maxX * {P} AS left_px,
       CAST(round_even(maxY * {P} - (minY * {P} - {H}), 0) AS BIGINT) AS height,
       CAST(round_even(maxX * {P} + {W} - minX * {P}, 0) AS BIGINT) AS width,
       minY AS top_mm, -maxX AS left_mm
FROM (SELECT min(X_mm) AS minX, max(X_mm) AS maxX, min(Y_mm) AS minY, max(Y_mm) AS maxY FROM fovs)""", "fovs"))
def q_slide_extent(spark, d):
    return slide_extent(Bindings(spark, d).fovs, H, W, PPM)


query("fov_origins", _ras("SELECT fov, y0, x0, paste_order, canvas_h, canvas_w FROM geo"))(
    lambda spark, d: _ctx(Bindings(spark, d)))

# ---------------------------------------------------------------- R1 / R2
query("stitch_mosaic", _ras("SELECT channel, row, col, val FROM mosaic"))(
    lambda spark, d: _mosaic(Bindings(spark, d)))

query("stitch_labels", _ras("SELECT 'labels' AS channel, row, col, val FROM labels"))(
    lambda spark, d: R.stitch_labels(Bindings(spark, d).label_pixels, _ctx(Bindings(spark, d))))


# ---------------------------------------------------------------- R6
@query("build_pyramid", _ras("""
SELECT channel, level, CAST((row + 1) // (1 << least(level, CAST(floor(log2(h)) AS INTEGER))) - 1 AS BIGINT) AS row,
       CAST((col + 1) // (1 << least(level, CAST(floor(log2(w)) AS INTEGER))) - 1 AS BIGINT) AS col, val
FROM mosaic, canvas,
     (SELECT CAST(unnest(range(0, (SELECT greatest(1, CAST(floor(log2(greatest(h, w) / 4)) AS INTEGER)) FROM canvas)))
              AS INTEGER) AS level) lv
WHERE (row + 1) % (1 << least(level, CAST(floor(log2(h)) AS INTEGER))) = 0
  AND (col + 1) % (1 << least(level, CAST(floor(log2(w)) AS INTEGER))) = 0
  AND (row + 1) // (1 << least(level, CAST(floor(log2(h)) AS INTEGER))) - 1 < greatest(1, h >> level)
  AND (col + 1) // (1 << least(level, CAST(floor(log2(w)) AS INTEGER))) - 1 < greatest(1, w >> level)"""))
def q_build_pyramid(spark, d):
    b = Bindings(spark, d)
    h, w = _canvas(b)
    return R.build_pyramid(_mosaic(b), h, w, min_size=4)


# ---------------------------------------------------------------- R9 / R10
query("label_boundaries", _ras("""
SELECT a.row, a.col, 1 AS val FROM dense a JOIN dense n
  ON n.row BETWEEN a.row - 1 AND a.row + 1 AND n.col BETWEEN a.col - 1 AND a.col + 1
GROUP BY a.row, a.col HAVING bool_or(n.val <> a.val)"""))(
    lambda spark, d: R.label_boundaries(_labels(Bindings(spark, d)), *_canvas(Bindings(spark, d))))

query("label_contour", _ras("""
SELECT a.row, a.col, a.val FROM dense a JOIN dense n
  ON abs(n.row - a.row) + abs(n.col - a.col) <= 2
GROUP BY a.row, a.col, a.val
HAVING a.val <> 0
   AND max(CASE WHEN abs(n.row - a.row) + abs(n.col - a.col) <= 1 THEN n.val END) <> min(n.val)"""))(
    lambda spark, d: R.label_contour(_labels(Bindings(spark, d)), 2, *_canvas(Bindings(spark, d))))

# ---------------------------------------------------------------- A9 / P19 / P20
query("contrast_window", _ras("""
SELECT channel, min, max,
       CASE WHEN s = e AND e <> 0 THEN 0 ELSE s END AS start,
       CASE WHEN s = e AND e = 0 THEN 1000 ELSE e END AS "end"
FROM (SELECT channel, CAST(min(val) AS BIGINT) AS min, CAST(max(val) AS BIGINT) AS max,
             CAST(floor(quantile_cont(CASE WHEN val <> 0 THEN val END, 0.001)) AS BIGINT) AS s,
             CAST(floor(quantile_cont(CASE WHEN val <> 0 THEN val END, 0.999)) AS BIGINT) AS e
      FROM mosaic GROUP BY channel)"""))(
    lambda spark, d: R.contrast_window(_mosaic(Bindings(spark, d))))

query("threshold_pixels", _ras("SELECT channel, row, col, CAST(val > 150 AS INTEGER) AS val FROM mosaic"))(
    lambda spark, d: R.threshold_pixels(_mosaic(Bindings(spark, d)), 150))


def _arith(op):
    def fn(spark, d):
        m = _mosaic(Bindings(spark, d))
        a = m.where(F.col("channel") == 0).drop("channel")
        b = m.where(F.col("channel") == 1).drop("channel")
        return R.pixel_arithmetic(a, b, op).withColumn("val", rnd("val"))
    return fn


_ARITH_SQL = """
SELECT coalesce(a.row, b.row) AS row, coalesce(a.col, b.col) AS col,
       round({expr}, 6) AS val
FROM (SELECT row, col, val FROM mosaic WHERE channel = 0) a
FULL OUTER JOIN (SELECT row, col, val FROM mosaic WHERE channel = 1) b ON a.row = b.row AND a.col = b.col"""
query("pixel_add", _ras(_ARITH_SQL.format(expr="CAST(coalesce(a.val, 0) AS DOUBLE) + CAST(coalesce(b.val, 0) AS DOUBLE)")))(
    _arith("add"))
query("pixel_divide", _ras(_ARITH_SQL.format(
    expr="CAST(coalesce(a.val, 0) AS DOUBLE) / nullif(CAST(coalesce(b.val, 0) AS DOUBLE), 0.0)")))(_arith("divide"))


# ---------------------------------------------------------------- R7
@query("fov_grid", _ras("""
SELECT row, col, 1 AS val FROM (
  SELECT r.row, c.col,
         arg_max(CASE WHEN r.row - g.y0 < 2 OR r.row - g.y0 >= 6 OR c.col - g.x0 < 2 OR c.col - g.x0 >= 6
                      THEN 1 ELSE 0 END, g.paste_order) AS v
  FROM canvas, range(0, (SELECT h FROM canvas)) r(row), range(0, (SELECT w FROM canvas)) c(col), geo g
  WHERE r.row >= g.y0 AND r.row < g.y0 + 8 AND c.col >= g.x0 AND c.col < g.x0 + 8
  GROUP BY 1, 2) WHERE v = 1"""))
def q_fov_grid(spark, d):
    return R.fov_grid(_ctx(Bindings(spark, d)), H, W, 2).withColumn("val", F.col("val").cast("int"))


# ---------------------------------------------------------------- R11
_RECT = f"""
SELECT FOV, corner, round(y, 6) AS y, round(x, 6) AS x FROM (
  SELECT FOV, unnest([1, 2, 3, 4]) AS corner,
         unnest([Y_mm - minY, (Y_mm + {D(H * MMPP)}) - minY, (Y_mm + {D(H * MMPP)}) - minY, Y_mm - minY]) AS y,
         unnest([-X_mm - -maxX, -X_mm - -maxX, (-X_mm + {D(W * MMPP)}) - -maxX, (-X_mm + {D(W * MMPP)}) - -maxX]) AS x
  FROM f1, ext)"""
query("fov_rectangles", _ras(_RECT))(
    lambda spark, d: R.fov_rectangles(Bindings(spark, d).fovs, H, W, MMPP)[0]
    .select("FOV", "corner", rnd("y").alias("y"), rnd("x").alias("x")))

# ---------------------------------------------------------------- R8
_TR_SQL = """
tgeo AS (SELECT FOV AS fov, paste_order,
                CAST(round_even((Y_mm * 1024.0 - 512) - (minY * 1024.0 - 512), 0) AS BIGINT) AS y0,
                CAST(round_even(maxX * 1024.0 - X_mm * 1024.0, 0) AS BIGINT) AS x0,
                CAST(round_even(maxY * 1024.0 - (minY * 1024.0 - 512), 0) AS BIGINT) AS canvas_h,
                CAST(round_even(maxX * 1024.0 + 512 - minX * 1024.0, 0) AS BIGINT) AS canvas_w
         FROM f1, ext),
traster AS (SELECT fov, CAST(least(floor(y), 511) AS INTEGER) AS row, CAST(least(floor(x), 511) AS INTEGER) AS col,
                   count(*) AS val
            FROM target_calls WHERE x >= 0 AND x <= 512 AND y >= 0 AND y <= 512 GROUP BY 1, 2, 3)"""


@query("transcript_mosaic", with_ctes("""
SELECT 'targets' AS channel, t.row + g.y0 AS row, t.col + g.x0 AS col, arg_max(t.val, g.paste_order) AS val
FROM traster t JOIN tgeo g ON t.fov = g.fov
WHERE t.row + g.y0 < g.canvas_h AND t.col + g.x0 < g.canvas_w GROUP BY 1, 2, 3""",
                                      "fovs", "pixels", "label_pixels", "target_calls", extra=_GEO + "," + _TR_SQL))
def q_transcript_mosaic(spark, d):
    b = Bindings(spark, d)
    ras = TR.transcript_raster(b.target_calls, 512, 512)
    return R.transcript_mosaic(ras, R.fov_origins(b.fovs, 512, 512, 1024.0))


# ---------------------------------------------------------------- J8
def _points(b: Bindings):
    li = b.t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return li.select("l_orderkey", "l_linenumber",
                     ((F.col("l_orderkey") % 70) - 4 + 0.5).cast("double").alias("y"),
                     ((F.col("l_partkey") % 70) - 4 + 0.5).cast("double").alias("x"))


query("cells_at_points", with_ctes(f"""
SELECT p.l_orderkey, p.l_linenumber, p.y, p.x, p.row, p.col, l.val AS UID
FROM (SELECT l_orderkey, l_linenumber, y, x,
             CAST(trunc((y * {D(MMPP)} - 0.0) * {P}) AS BIGINT) AS row,
             CAST(trunc((x * {D(MMPP)} - 0.0) * {P}) AS BIGINT) AS col
      FROM (SELECT l_orderkey, l_linenumber, CAST(l_orderkey % 70 - 4 + 0.5 AS DOUBLE) AS y,
                   CAST(l_partkey % 70 - 4 + 0.5 AS DOUBLE) AS x FROM lineitem)) p
JOIN labels l ON p.row = l.row AND p.col = l.col WHERE l.val <> 0""",
                                   "fovs", "pixels", "label_pixels", extra=_GEO))(
    lambda spark, d: R.cells_at_points(_points(Bindings(spark, d)), _labels(Bindings(spark, d)), MMPP, (0.0, 0.0)))


# ---------------------------------------------------------------- J9 / J10 / J11
# Fixed test shapes in layer coordinates (identity transform: 12 px/mm, origin 0).
SHAPES = [
    (1, "rectangle", [(2.5, 3.5), (2.5, 30.5), (20.5, 30.5), (20.5, 3.5)]),
    (2, "polygon", [(25.5, 5.5), (25.5, 40.5), (45.5, 40.5), (35.5, 22.5), (45.5, 5.5)]),
    (3, "ellipse", [(40.5, 30.5), (40.5, 55.5), (58.5, 55.5), (58.5, 30.5)]),
    (4, "line", [(1.5, 1.5), (60.5, 60.5)]),
]
_SHAPE_SCHEMA = T.StructType([
    T.StructField("shape_id", T.IntegerType()), T.StructField("kind", T.StringType()),
    T.StructField("vertices", T.ArrayType(T.StructType([T.StructField("y", T.DoubleType()),
                                                        T.StructField("x", T.DoubleType())])))])


def _shapes(spark):
    return spark.createDataFrame([(i, k, [{"y": y, "x": x} for y, x in v]) for i, k, v in SHAPES], _SHAPE_SCHEMA)


def _shapes_sql():
    rows = []
    for i, k, v in SHAPES:
        verts = ", ".join(f"{{'y': {y}::DOUBLE, 'x': {x}::DOUBLE}}" for y, x in v)
        rows.append(f"({i}, '{k}', [{verts}])")
    return "shapes AS (SELECT * FROM (VALUES " + ", ".join(rows) + ") s(shape_id, kind, vertices))"


_IN_SHAPE = f"""
{_shapes_sql()},
sp AS (SELECT shape_id, kind,
              list_transform(vertices, lambda v: {{'y': CAST(CAST(trunc((v.y * {D(MMPP)} - 0.0) * {P}) AS BIGINT) AS DOUBLE),
                                               'x': CAST(CAST(trunc((v.x * {D(MMPP)} - 0.0) * {P}) AS BIGINT) AS DOUBLE)}}) AS pv
       FROM shapes WHERE kind IN ('polygon', 'rectangle', 'ellipse')),
sb AS (SELECT *, CAST(greatest(list_min(list_transform(pv, lambda v: v.y)), 0.0) AS BIGINT) AS ymin,
              CAST(least(list_max(list_transform(pv, lambda v: v.y)), (SELECT h FROM canvas) - 1) AS BIGINT) AS ymax,
              CAST(greatest(list_min(list_transform(pv, lambda v: v.x)), 0.0) AS BIGINT) AS xmin,
              CAST(least(list_max(list_transform(pv, lambda v: v.x)), (SELECT w FROM canvas) - 1) AS BIGINT) AS xmax,
              (pv[-1].y - pv[1].y) / 2 AS er, (pv[2].x - pv[1].x) / 2 AS ec,
              pv[1].y + (pv[-1].y - pv[1].y) / 2 AS ey, pv[1].x + (pv[2].x - pv[1].x) / 2 AS ex
       FROM sp),
cand AS (SELECT s.shape_id, s.kind, s.pv, s.er, s.ec, s.ey, s.ex, CAST(l.row AS DOUBLE) AS r, CAST(l.col AS DOUBLE) AS c,
                l.val AS UID
         FROM labels l JOIN sb s ON l.row BETWEEN s.ymin AND s.ymax AND l.col BETWEEN s.xmin AND s.xmax
         WHERE l.val <> 0),
inside AS (SELECT DISTINCT shape_id, UID FROM cand
  WHERE CASE WHEN kind = 'ellipse'
             THEN coalesce(((r - ey) / nullif(er, 0.0)) ^ 2 + ((c - ex) / nullif(ec, 0.0)) ^ 2 < 1, false)
             ELSE list_sum(list_transform(range(len(pv)), lambda i:
                    CASE WHEN ((pv[i + 1].y > r) <> (pv[CASE WHEN i = 0 THEN len(pv) ELSE i END].y > r))
                          AND c < (pv[CASE WHEN i = 0 THEN len(pv) ELSE i END].x - pv[i + 1].x) * (r - pv[i + 1].y)
                                  / nullif(pv[CASE WHEN i = 0 THEN len(pv) ELSE i END].y - pv[i + 1].y, 0.0) + pv[i + 1].x
                         THEN 1 ELSE 0 END)) % 2 = 1 END)"""


def _cells_in_shapes(b: Bindings):
    h, w = _canvas(b)
    return R.cells_in_shapes(_shapes(b.spark), _labels(b), MMPP, (0.0, 0.0), h, w, bucket=16)


query("cells_in_shapes", with_ctes("SELECT shape_id, UID FROM inside", "fovs", "pixels", "label_pixels", extra=_GEO + "," + _IN_SHAPE))(
    lambda spark, d: _cells_in_shapes(Bindings(spark, d)))

_LAYERS = ["shape_1", "shape_2", "shape_3"]


@query("flag_cells", with_ctes("""
SELECT m.UID, coalesce(bool_or(i.shape_id = 1), false) AS shape_1, coalesce(bool_or(i.shape_id = 2), false) AS shape_2,
       coalesce(bool_or(i.shape_id = 3), false) AS shape_3
FROM (SELECT DISTINCT val AS UID FROM labels WHERE val <> 0) m LEFT JOIN inside i ON m.UID = i.UID
GROUP BY m.UID""", "fovs", "pixels", "label_pixels", extra=_GEO + "," + _IN_SHAPE))
def q_flag_cells(spark, d):
    b = Bindings(spark, d)
    meta = _labels(b).where(F.col("val") != 0).select(F.col("val").alias("UID")).distinct()
    by_layer = _cells_in_shapes(b).select("UID", F.concat(F.lit("shape_"), F.col("shape_id").cast("string")).alias("layer"))
    return C.flag_cells(meta, by_layer, _LAYERS)


@query("target_counts_in_shapes", with_ctes("""
SELECT t.target, count(*) AS count
FROM target_calls t JOIN inside i
  ON t.fov = CAST(CASE WHEN i.UID - floor(sqrt(i.UID))^2 < floor(sqrt(i.UID))
                       THEN i.UID - floor(sqrt(i.UID))^2 ELSE floor(sqrt(i.UID)) END AS INTEGER)
 AND t.CellId = CAST(CASE WHEN i.UID - floor(sqrt(i.UID))^2 < floor(sqrt(i.UID))
                          THEN floor(sqrt(i.UID)) ELSE i.UID - floor(sqrt(i.UID))^2 - floor(sqrt(i.UID)) END AS INTEGER)
WHERE NOT starts_with(t.target, 'NegPrb') AND NOT starts_with(t.target, 'FalseCode')
  AND NOT starts_with(t.target, 'SystemControl')
GROUP BY t.target""", "fovs", "pixels", "label_pixels", "target_calls", extra=_GEO + "," + _IN_SHAPE))
def q_target_counts_in_shapes(spark, d):
    """Cells inside drawn shapes -> transcripts per gene in those cells."""
    b = Bindings(spark, d)
    cells = _cells_in_shapes(b).select("UID")
    return TR.target_counts_for_cells(cells, TR.drop_control_probes(b.target_calls))


query("color_labels", _ras("""
SELECT l.row, l.col, CAST(CASE WHEN l.val = 0 THEN 0 ELSE coalesce(c.color_idx, 99) END AS INTEGER) AS color_idx
FROM labels l LEFT JOIN (SELECT DISTINCT val AS UID, CAST(val % 7 + 1 AS INTEGER) AS color_idx
                         FROM labels WHERE val <> 0 AND val % 3 = 0) c ON l.val = c.UID"""))(
    lambda spark, d: R.color_labels(
        _labels(Bindings(spark, d)),
        _labels(Bindings(spark, d)).where((F.col("val") != 0) & (F.col("val") % 3 == 0))
        .select(F.col("val").alias("UID"), (F.col("val") % 7 + 1).cast("int").alias("color_idx")).distinct(), 99))

# ---------------------------------------------------------------- O6
query("stack_channels", _ras("""
SELECT 'ch' || CAST(channel AS VARCHAR) AS channel, row, col, val,
       CAST(CASE channel WHEN 2 THEN 0 WHEN 0 THEN 1 WHEN 1 THEN 2 END AS INTEGER) AS channel_idx,
       channel <> 1 AS active
FROM mosaic"""))(
    lambda spark, d: R.stack_channels(
        _mosaic(Bindings(spark, d)).withColumn("channel", F.concat(F.lit("ch"), F.col("channel").cast("string"))),
        ["ch1", "ch0", "ch2"], ome=True, active=["ch0", "ch2"]))


query("stack_channels_boundary", _ras("""
SELECT channel, row, col, val, channel_idx, active FROM (
  SELECT 'ch' || CAST(channel AS VARCHAR) AS channel, row, col, val, CAST(1 - channel AS INTEGER) AS channel_idx, true AS active
  FROM mosaic WHERE channel < 2)
UNION ALL
SELECT 'boundaries', a.row, a.col, 1, 2, true FROM dense a JOIN dense n
  ON n.row BETWEEN a.row - 1 AND a.row + 1 AND n.col BETWEEN a.col - 1 AND a.col + 1
GROUP BY a.row, a.col HAVING bool_or(n.val <> a.val)"""))(
    lambda spark, d: R.stack_channels(
        _mosaic(Bindings(spark, d)).withColumn("channel", F.concat(F.lit("ch"), F.col("channel").cast("string"))),
        ["ch0", "ch1"], ome=True, boundary=R.label_boundaries(_labels(Bindings(spark, d)), *_canvas(Bindings(spark, d)))))


# ---------------------------------------------------------------- R3
@query("stitch_proteins", _ras("""
SELECT m.channel, m.row, m.col, m.val,
       CASE WHEN m.channel LIKE '%CPRO%' THEN coalesce(d.name, m.channel) ELSE m.channel END AS layer
FROM (SELECT 'CPRO' || CAST(channel * 2 AS VARCHAR) AS channel, row, col, val FROM mosaic) m
LEFT JOIN (SELECT ProbeID, arg_max(DisplayName, ord) AS name FROM dictionary GROUP BY 1) d ON m.channel = d.ProbeID""",
                                       "dictionary"))
def q_stitch_proteins(spark, d):
    b = Bindings(spark, d)
    tiles = b.pixels.withColumn("channel", F.concat(F.lit("CPRO"), (F.col("channel") * 2).cast("string")))
    return R.stitch_proteins(tiles, _ctx(b), b.dictionary)


# ---------------------------------------------------------------- P13 / R4
def _barcodes(b: Bindings):
    p = b.t("part").select("p_partkey", "p_type", "p_brand")
    code = F.concat(F.repeat(F.lit("b"), (F.col("p_partkey") % 4).cast("int")),
                    F.element_at(F.array(*[F.lit(x) for x in R.ENCODED_PAGES]), (F.col("p_partkey") % 4 + 1).cast("int")),
                    F.lit("bb"))
    return p.select("p_partkey", code.alias("colorCode"), F.concat_ws("/", "p_type", "p_brand").alias("Protein"))


_BARCODE_SQL = """
bc AS (SELECT p_partkey, repeat('b', CAST(p_partkey % 4 AS INTEGER))
                         || (['BB', 'GG', 'YY', 'RR'])[CAST(p_partkey % 4 + 1 AS INTEGER)] || 'bb' AS colorCode,
              p_type || '/' || p_brand AS Protein FROM part),
bcp AS (SELECT *, regexp_extract(colorCode, '([A-Z]{2})', 1) AS color,
               CAST(instr(colorCode, regexp_extract(colorCode, '([A-Z]{2})', 1)) AS INTEGER) AS spot FROM bc),
bci AS (SELECT *, printf('N%02d_%s', spot, color) AS id FROM bcp)"""

query("parse_barcode", with_ctes("SELECT p_partkey, colorCode, Protein, color, spot, id FROM bci", extra=_BARCODE_SQL))(
    lambda spark, d: parse_barcode(_barcodes(Bindings(spark, d))))


@query("stitch_encoded", with_ctes("""
SELECT m.channel, m.row, m.col, m.val, m.channel || '_' || coalesce(replace(b.Protein, '/', '_'), 'None') AS layer
FROM (SELECT printf('N%02d_%s', channel + 1, (['BB', 'GG', 'YY', 'RR'])[channel + 1]) AS channel, row, col, val
      FROM mosaic) m
LEFT JOIN (SELECT id, arg_min(Protein, p_partkey) AS Protein FROM bci GROUP BY id) b ON m.channel = b.id""",
                                      "fovs", "pixels", "label_pixels", extra=_GEO + "," + _BARCODE_SQL))
def q_stitch_encoded(spark, d):
    b = Bindings(spark, d)
    tiles = b.pixels.withColumn("spot", F.col("channel") + 1).withColumn("page", F.col("channel"))
    bc = parse_barcode(_barcodes(b)).groupBy("id").agg(F.min_by("Protein", "p_partkey").alias("Protein"))
    return R.stitch_encoded(tiles, _ctx(b), bc)


# ---------------------------------------------------------------- R5
@query("stitch_composite", _ras("""
SELECT CAST(p.channel AS INTEGER) AS band, p.row + g.y0 AS row, p.col + g.x0 AS col, arg_max(p.val, g.paste_order) AS val
FROM pixels p JOIN geo g ON p.fov = g.fov
WHERE p.fov IN (SELECT CAST(floor(page_id * 3 / 5) + 1 AS INTEGER) FROM pages GROUP BY 1 HAVING count(*) = 1)
  AND p.row + g.y0 < g.canvas_h AND p.col + g.x0 < g.canvas_w
GROUP BY 1, 2, 3"""))
def q_stitch_composite(spark, d):
    b = Bindings(spark, d)
    files = b.t("pages").select((F.floor(F.col("page_id") * 3 / 5) + 1).cast("int").alias("fov"), F.col("url").alias("path"))
    tiles = b.pixels.withColumnRenamed("channel", "band")
    return R.stitch_composite(tiles, files, _ctx(b))
