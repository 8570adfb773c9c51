"""Images as tables: tiles, mosaics, pyramids, neighbourhoods, shapes.

Long pixel form: (keys..., channel, row, col, val). Missing pixels are 0
(background / uncovered canvas), so every operator writes sparse output.

R1 stitch_mosaic, R2 stitch_labels, R3 stitch_proteins, R4 stitch_encoded,
R5 stitch_composite, R6 build_pyramid, R7 fov_grid, R8 transcript_mosaic,
R9 label_boundaries, R10 label_contour, R11 fov_rectangles, A9 contrast_window,
J8 cells_at_points, J9 cells_in_shapes, J10 (via cells.flag_cells),
J11 color_labels, O6 stack_channels, P19 threshold_pixels, P20 pixel_arithmetic.

Neighbourhood operators (R9, R10, A14) never self-join the pixel table: each
pixel sends its value to the neighbour positions (explode of a literal offset
list) and one aggregation per target pixel combines them, with partial
aggregation before the shuffle. Missing neighbours are detected by comparing the
number of values received with the number of in-canvas offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import first_location, with_extent
from ..functions.keys import key_label_pixels
from .quantiles import exact_quantiles
from .shapes import cover, inside_test

# ---------------------------------------------------------------------------
# Fixed values.
PYRAMID_MIN_SIZE = 256             # levels = floor(log2(max(H, W) / 256))
WINDOW_PERCENTILES = (0.001, 0.999)
EMPTY_WINDOW_END = 1000
BOUNDARY_SCALED = (100, 10000)     # (inside, boundary) when written for display
ENCODED_PAGES = ("BB", "GG", "YY", "RR")
# ---------------------------------------------------------------------------


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


# --------------------------------------------------------------------- origins
def fov_origins(fovs: DataFrame, height: int, width: int, px_per_mm: float,
                keys: list[str] = (), order: str = "ord") -> DataFrame:
    """(keys, fov, y0, x0, paste_order, canvas_h, canvas_w) per FOV.

    Duplicated FOV rows keep their first location; the FOV is pasted at the
    position of its last listing (the reference loops over every row)."""
    keys = list(keys)
    last = fovs.groupBy(*keys, "FOV").agg(F.max(order).alias("paste_order"))
    loc = with_extent(first_location(fovs, keys, order), height, width, px_per_mm, keys)
    return (loc.join(last, keys + ["FOV"])
               .select(*keys, F.col("FOV").alias("fov"), "y0", "x0", "paste_order", "canvas_h", "canvas_w"))


# --------------------------------------------------------------------- R1
def stitch_mosaic(tiles: DataFrame, origins: DataFrame, keys: list[str] = (),
                  channel_cols: list[str] = ("channel",), overlap: bool | None = None,
                  tile_height: int | None = None, tile_width: int | None = None) -> DataFrame:
    """Paste FOV tiles at their origins; later tiles (paste order) overwrite the
    whole rectangle, zeros included; FOVs without a location are skipped;
    pixels outside the canvas are dropped.

    Overlap: the winner per canvas pixel is ``max_by(val, paste_order)``, a
    partial aggregate. When tiles do not overlap — given as ``overlap=False``
    or, with the tile size, found by :func:`tiles_overlap` on the small FOV
    table — the aggregation (a shuffle of every pixel) is skipped and the stitch
    is a broadcast join plus a projection.
    """
    keys, ch = list(keys), list(channel_cols)
    if overlap is None and tile_height and tile_width:
        overlap = tiles_overlap(origins, tile_height, tile_width, keys)
    o = origins.select(*keys, "fov", "y0", "x0", "paste_order", "canvas_h", "canvas_w")
    j = tiles.join(o, keys + ["fov"])
    j = j.select(*keys, *ch, (F.col("row") + F.col("y0")).alias("row"), (F.col("col") + F.col("x0")).alias("col"),
                 "val", "paste_order", "canvas_h", "canvas_w")
    j = j.where((F.col("row") >= 0) & (F.col("row") < F.col("canvas_h"))
                & (F.col("col") >= 0) & (F.col("col") < F.col("canvas_w")))
    if overlap is False:
        return j.select(*keys, *ch, "row", "col", "val")
    return j.groupBy(*keys, *ch, "row", "col").agg(F.max_by("val", "paste_order").alias("val"))


def tiles_overlap(origins: DataFrame, height: int, width: int, keys: list[str] = ()) -> bool:
    """Do any two FOV rectangles overlap? Origins are bucketed on an H x W grid;
    two rectangles can only overlap when their buckets are neighbours, so the
    check joins each origin with the 4 forward neighbour buckets only (no
    all-pairs comparison). One small job on the FOV table."""
    keys = list(keys)
    o = origins.select(*keys, "fov", "y0", "x0",
                       F.floor(F.col("y0") / height).alias("by"), F.floor(F.col("x0") / width).alias("bx"))
    offs = F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx"))
                     for a, b in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    probe = o.select(*keys, F.col("fov").alias("f2"), F.col("y0").alias("y2"), F.col("x0").alias("x2"),
                     F.explode(offs).alias("d")).select(
        *keys, "f2", "y2", "x2", (F.floor(F.col("y2") / height) + F.col("d.dy")).alias("by"),
        (F.floor(F.col("x2") / width) + F.col("d.dx")).alias("bx"))
    pairs = o.join(probe, keys + ["by", "bx"]).where(F.col("fov") != F.col("f2"))
    hit = pairs.where((F.abs(F.col("y0") - F.col("y2")) < height) & (F.abs(F.col("x0") - F.col("x2")) < width))
    return hit.limit(1).count() > 0


# --------------------------------------------------------------------- R2
def stitch_labels(label_tiles: DataFrame, origins: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Key every label (0 stays background) by its FOV, then stitch."""
    k = key_label_pixels(label_tiles).withColumn("channel", F.lit("labels"))
    return stitch_mosaic(k, origins, keys)


# --------------------------------------------------------------------- R3
def stitch_proteins(tiles: DataFrame, origins: DataFrame, dictionary: DataFrame | None = None,
                    keys: list[str] = (), tag: str | None = None) -> DataFrame:
    """One mosaic per protein probe (``channel`` = probe id) in one job; the
    channel is then renamed to its display name (P14)."""
    from .cells import probe_label
    m = stitch_mosaic(tiles, origins, keys)
    if dictionary is None:
        return m
    return probe_label(m, dictionary, col="channel", out="layer", tag=tag)


# --------------------------------------------------------------------- R4
def stitch_encoded(tiles: DataFrame, origins: DataFrame, barcodes: DataFrame | None = None,
                   keys: list[str] = (), tag: str | None = None) -> DataFrame:
    """Tiles carry (spot, page) with page 0..3 = BB, GG, YY, RR; the layer is
    ``N##_CC`` + ``_<Protein>`` (``/`` -> ``_``) or ``_None`` via the barcode
    table (P13 ``id``), + optional tag."""
    pages = F.array(*[F.lit(p) for p in ENCODED_PAGES])
    t = tiles.withColumn("channel", F.format_string("N%02d_%s", F.col("spot"),
                                                       F.element_at(pages, F.col("page") + 1)))
    m = stitch_mosaic(t, origins, keys)
    if barcodes is not None:
        b = barcodes.select(F.col("id").alias("channel"), F.regexp_replace("Protein", "/", "_").alias("_p"))
        m = m.join(b, "channel", "left").withColumn(
            "layer", F.concat(F.col("channel"), F.lit("_"), F.coalesce("_p", F.lit("None")))).drop("_p")
    else:
        m = m.withColumn("layer", F.col("channel"))
    if tag:
        m = m.withColumn("layer", F.concat(F.col("layer"), F.lit(f"_{tag}")))
    return m


# --------------------------------------------------------------------- R5
def stitch_composite(tiles: DataFrame, files: DataFrame, origins: DataFrame, keys: list[str] = ()) -> DataFrame:
    """3-band mosaic (band as channel); a FOV is used only if exactly one
    composite file matched it (``files`` = (keys, fov, path))."""
    keys = list(keys)
    one = files.groupBy(*keys, "fov").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 1).drop("n")
    t = tiles.join(one, keys + ["fov"], "left_semi")
    return stitch_mosaic(t, origins, keys, channel_cols=["band"])


# --------------------------------------------------------------------- R6
def pyramid_levels(height: Column, width: Column, min_size: int = PYRAMID_MIN_SIZE) -> Column:
    """Number of levels: floor(log2(max(H, W) / min_size)), at least 1."""
    return F.greatest(F.lit(1), F.floor(F.log2(F.greatest(height, width) / F.lit(min_size))).cast("int"))


def build_pyramid(mosaic: DataFrame, height, width, keys: list[str] = (),
                  channel_cols: list[str] = ("channel",), min_size: int = PYRAMID_MIN_SIZE) -> DataFrame:
    """Nearest-neighbour halving pyramid, all levels in one pass.

    Level k has size n_k = max(1, n // 2^k) per axis and samples the odd
    (bottom-right) source pixel, source = min(2r + 1, n_{k-1} - 1). Composed to
    level 0 this keeps pixel R iff (R + 1) is a multiple of 2^m with
    m = min(k, floor(log2 n)) and r = (R + 1) / 2^m - 1 < n_k. Each pixel is
    exploded over its levels (a literal-bounded sequence), never joined.
    """
    keys, ch = list(keys), list(channel_cols)
    H, W = _lit(height).cast("long"), _lit(width).cast("long")
    L = pyramid_levels(H, W, min_size)
    e = mosaic.select(*keys, *ch, "row", "col", "val", F.explode(F.sequence(F.lit(0), L - 1)).alias("level"))
    k = F.col("level")

    def axis(idx: str, n: Column):
        m = F.least(k, F.floor(F.log2(n.cast("double"))).cast("int"))
        p = F.pow(F.lit(2.0), m).cast("long")
        nk = F.greatest(F.lit(1).cast("long"), F.floor(n / F.pow(F.lit(2.0), k)).cast("long"))
        r = F.floor((F.col(idx) + 1) / p).cast("long") - 1
        ok = (((F.col(idx) + 1) % p) == 0) & (r < nk)
        return r, ok

    r, okr = axis("row", H)
    c, okc = axis("col", W)
    return e.where(okr & okc).select(*keys, *ch, "level", r.alias("row"), c.alias("col"), "val")


# --------------------------------------------------------------------- R7
def fov_grid(origins: DataFrame, height: int, width: int, border: int, keys: list[str] = ()) -> DataFrame:
    """FOV outlines: 1 on a border of ``border`` px of each FOV, 0 inside, pasted
    with the overwrite rule of R1. Only border pixels are generated (four
    strips per FOV); each is resolved against the last FOV covering it through
    a grid-bucket equi-join on the small FOV table."""
    keys = list(keys)
    H, W, b = int(height), int(width), int(border)
    o = origins.select(*keys, "fov", "y0", "x0", "paste_order", "canvas_h", "canvas_w")
    if b <= 0 or 2 * b >= min(H, W):
        strips = [(0, H, 0, W)]
    else:
        strips = [(0, b, 0, W), (H - b, H, 0, W), (b, H - b, 0, b), (b, H - b, W - b, W)]
    parts = []
    for r0, r1, c0, c1 in strips:
        parts.append(o.select(*keys, "fov", "y0", "x0", "canvas_h", "canvas_w",
                              F.explode(F.sequence(F.lit(r0), F.lit(r1 - 1))).alias("r"))
                     .select("*", F.explode(F.sequence(F.lit(c0), F.lit(c1 - 1))).alias("c")))
    cand = parts[0]
    for p in parts[1:]:
        cand = cand.unionByName(p)
    cand = cand.select(*keys, (F.col("y0") + F.col("r")).alias("row"), (F.col("x0") + F.col("c")).alias("col"),
                       "canvas_h", "canvas_w")
    cand = cand.where((F.col("row") >= 0) & (F.col("row") < F.col("canvas_h"))
                      & (F.col("col") >= 0) & (F.col("col") < F.col("canvas_w"))).select(*keys, "row", "col").distinct()
    # Rectangles exploded to the (at most four) H x W grid buckets they touch.
    rect = o.select(*keys, "fov", "y0", "x0", "paste_order",
                    F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(c).alias("c"))
                                        for a in (0, 1) for c in (0, 1)])).alias("d"))
    rect = rect.select(*keys, "fov", "y0", "x0", "paste_order",
                       (F.floor(F.col("y0") / H) + F.col("d.a")).alias("by"),
                       (F.floor(F.col("x0") / W) + F.col("d.c")).alias("bx")).distinct()
    c2 = cand.withColumn("by", F.floor(F.col("row") / H)).withColumn("bx", F.floor(F.col("col") / W))
    j = c2.join(rect, keys + ["by", "bx"])
    j = j.where((F.col("row") >= F.col("y0")) & (F.col("row") < F.col("y0") + H)
                & (F.col("col") >= F.col("x0")) & (F.col("col") < F.col("x0") + W))
    rr, cc = F.col("row") - F.col("y0"), F.col("col") - F.col("x0")
    on_border = ((rr < b) | (rr >= H - b) | (cc < b) | (cc >= W - b)) if 0 < b and 2 * b < min(H, W) else F.lit(True)
    j = j.withColumn("v", on_border.cast("int"))
    g = j.groupBy(*keys, "row", "col").agg(F.max_by("v", "paste_order").alias("val"))
    return g.where(F.col("val") == 1)


# --------------------------------------------------------------------- R8
def transcript_mosaic(raster: DataFrame, origins: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Per-FOV transcript rasters (A13/A14) stitched as layer ``targets``."""
    return stitch_mosaic(raster.withColumn("channel", F.lit("targets")), origins, keys)


# --------------------------------------------------------------------- neighbourhoods
def _in_canvas_count(offsets, row: Column, col: Column, height: Column, width: Column) -> Column:
    terms = [((row + dy >= 0) & (row + dy < height) & (col + dx >= 0) & (col + dx < width)).cast("int")
             for dy, dx in offsets]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def _send(pixels: DataFrame, offsets, keys: list[str], height: Column, width: Column) -> DataFrame:
    """Every pixel sends its value to itself (own) and to each offset position
    inside the canvas: rows (keys, row, col, val, own)."""
    offs = F.array(F.struct(F.lit(0).alias("dy"), F.lit(0).alias("dx"), F.lit(True).alias("own")),
                   *[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(False).alias("own"))
                     for dy, dx in offsets])
    e = pixels.select(*keys, "row", "col", "val", F.explode(offs).alias("o"))
    e = e.select(*keys, (F.col("row") - F.col("o.dy")).alias("row"), (F.col("col") - F.col("o.dx")).alias("col"),
                 "val", F.col("o.own").alias("own"))
    return e.where((F.col("row") >= 0) & (F.col("row") < height) & (F.col("col") >= 0) & (F.col("col") < width))


def _neigh_stats(pixels: DataFrame, offsets, keys, height, width) -> DataFrame:
    """Per pixel: own value (0 if absent) and min / max over the offset
    neighbourhood, missing positions counting as 0."""
    H, W = _lit(height), _lit(width)
    s = _send(pixels, offsets, keys, H, W)
    g = s.groupBy(*keys, "row", "col").agg(
        F.max(F.when(F.col("own"), F.col("val"))).alias("own_val"),
        F.min(F.when(~F.col("own"), F.col("val"))).alias("nmin"),
        F.max(F.when(~F.col("own"), F.col("val"))).alias("nmax"),
        F.sum((~F.col("own")).cast("int")).alias("nrecv"))
    # A neighbour at +offset sends with -offset; expected = in-canvas positions.
    exp = _in_canvas_count([(dy, dx) for dy, dx in offsets], F.col("row"), F.col("col"), H, W)
    missing = F.col("nrecv") < exp
    zero = F.lit(0).cast("long")
    g = g.withColumn("own_val", F.coalesce(F.col("own_val").cast("long"), zero))
    g = g.withColumn("nmin", F.when(missing, F.least(F.coalesce(F.col("nmin").cast("long"), zero), zero))
                     .otherwise(F.col("nmin").cast("long")))
    g = g.withColumn("nmax", F.when(missing, F.greatest(F.coalesce(F.col("nmax").cast("long"), zero), zero))
                     .otherwise(F.col("nmax").cast("long")))
    return g


EIGHT = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy, dx) != (0, 0)]
CROSS = [(-1, 0), (1, 0), (0, -1), (0, 1)]


def diamond(k: int):
    return [(dy, dx) for dy in range(-k, k + 1) for dx in range(-k, k + 1)
            if 0 < abs(dy) + abs(dx) <= k]


# --------------------------------------------------------------------- R9
def label_boundaries(labels: DataFrame, height, width, keys: list[str] = (), scaled: bool = False) -> DataFrame:
    """1 where a pixel differs from any of its 8 neighbours (edges replicated,
    so out-of-canvas neighbours never differ); sparse output (boundary pixels),
    or with ``scaled`` every touched pixel as 100 / 10000."""
    keys = list(keys)
    g = _neigh_stats(labels, EIGHT, keys, height, width)
    b = ((F.col("nmin") != F.col("own_val")) | (F.col("nmax") != F.col("own_val")))
    out = g.select(*keys, "row", "col", b.cast("int").alias("val"))
    if scaled:
        return out.withColumn("val", F.when(F.col("val") == 1, BOUNDARY_SCALED[1]).otherwise(BOUNDARY_SCALED[0]))
    return out.where(F.col("val") == 1)


# --------------------------------------------------------------------- R10
def label_contour(labels: DataFrame, k: int, height, width, keys: list[str] = ()) -> DataFrame:
    """Keep a label only where grey dilation over the 1-px cross differs from
    grey erosion over the k-iterated cross (a diamond of radius k >= 1).

    One send + one aggregation: the diamond contains the cross, so each sent
    value is tagged with whether its offset is in the cross."""
    keys = list(keys)
    H, W = _lit(height), _lit(width)
    dia = diamond(max(1, k))
    offs = F.array(F.struct(F.lit(0).alias("dy"), F.lit(0).alias("dx"), F.lit(True).alias("own"),
                            F.lit(True).alias("cross")),
                   *[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(False).alias("own"),
                              F.lit(abs(dy) + abs(dx) == 1).alias("cross")) for dy, dx in dia])
    e = labels.select(*keys, "row", "col", "val", F.explode(offs).alias("o"))
    e = e.select(*keys, (F.col("row") - F.col("o.dy")).alias("row"), (F.col("col") - F.col("o.dx")).alias("col"),
                 "val", F.col("o.own").alias("own"), F.col("o.cross").alias("cross"))
    e = e.where((F.col("row") >= 0) & (F.col("row") < H) & (F.col("col") >= 0) & (F.col("col") < W))
    g = e.groupBy(*keys, "row", "col").agg(
        F.max(F.when(F.col("own"), F.col("val"))).alias("own_val"),
        F.max(F.when(F.col("cross"), F.col("val"))).alias("cmax"),
        F.sum((F.col("cross") & ~F.col("own")).cast("int")).alias("ncross"),
        F.min("val").alias("dmin"),
        F.sum((~F.col("own")).cast("int")).alias("ndia"))
    zero = F.lit(0).cast("long")
    own = F.coalesce(F.col("own_val").cast("long"), zero)
    cross_missing = F.col("ncross") < _in_canvas_count(CROSS, F.col("row"), F.col("col"), H, W)
    dia_missing = (F.col("ndia") < _in_canvas_count(dia, F.col("row"), F.col("col"), H, W)) | F.col("own_val").isNull()
    dil = F.when(cross_missing | F.col("own_val").isNull(), F.greatest(F.col("cmax").cast("long"), zero)) \
           .otherwise(F.col("cmax").cast("long"))
    ero = F.when(dia_missing, F.least(F.col("dmin").cast("long"), zero)).otherwise(F.col("dmin").cast("long"))
    return g.where((dil != ero) & (own != 0)).select(*keys, "row", "col", own.alias("val"))


# --------------------------------------------------------------------- R11
def fov_rectangles(fovs: DataFrame, height: int, width: int, mm_per_px: float, keys: list[str] = ()):
    """Corners (y, x) in mm relative to the slide's top-left, one row per corner,
    and per FOV centre / size in world mm."""
    keys = list(keys)
    dash = (height / width) != 1
    ppm = 1 / mm_per_px
    f = with_extent(first_location(fovs, keys), height, width, ppm, keys)
    if dash:
        oy, ox = -F.col("X_mm"), F.col("Y_mm")
        tly, tlx = -F.col("maxX"), F.col("minY")
    else:
        oy, ox = F.col("Y_mm"), -F.col("X_mm")
        tly, tlx = F.col("minY"), -F.col("maxX")
    fh, fw = F.lit(height * mm_per_px), F.lit(width * mm_per_px)
    corners = F.array(
        F.struct(F.lit(1).alias("corner"), (oy - tly).alias("y"), (ox - tlx).alias("x")),
        F.struct(F.lit(2).alias("corner"), ((oy + fh) - tly).alias("y"), (ox - tlx).alias("x")),
        F.struct(F.lit(3).alias("corner"), ((oy + fh) - tly).alias("y"), ((ox + fw) - tlx).alias("x")),
        F.struct(F.lit(4).alias("corner"), (oy - tly).alias("y"), ((ox + fw) - tlx).alias("x")))
    rects = f.select(*keys, "FOV", F.explode(corners).alias("c")).select(*keys, "FOV", "c.*")
    centres = f.select(*keys, "FOV",
                       ((oy - tly) + tly + fh / 2).alias("center_y"),
                       ((ox - tlx) + tlx + fw / 2).alias("center_x"),
                       fh.alias("size_y"), fw.alias("size_x"))
    return rects, centres


# --------------------------------------------------------------------- A9
def contrast_window(pixels: DataFrame, keys: list[str] = ("channel",), exact: bool = True,
                    accuracy: int = 100_000) -> DataFrame:
    """min, max over all pixels; 0.1 / 99.9 percentiles over non-zero pixels,
    truncated to int; degenerate window: end 0 -> end 1000, else start 0.

    Exact percentiles take two scans and bounded memory, whatever the pixels' type
    (:func:`tessera.operators.quantiles.exact_quantiles`)."""
    keys = list(keys)
    nz = F.when(F.col("val") != 0, F.col("val"))
    ends = {"min": F.min("val"), "max": F.max("val")}
    if exact:
        g = exact_quantiles(pixels, keys, {"p": nz}, list(WINDOW_PERCENTILES), ends)
    else:
        g = pixels.groupBy(*keys).agg(F.percentile_approx(nz, list(WINDOW_PERCENTILES), accuracy).alias("p"), *[c.alias(n) for n, c in ends.items()])
    start = F.floor(F.col("p")[0]).cast("long")
    end = F.floor(F.col("p")[1]).cast("long")
    g = g.select(*keys, F.col("min").cast("long").alias("min"), F.col("max").cast("long").alias("max"),
                 start.alias("start"), end.alias("end"))
    same = F.col("start") == F.col("end")
    return (g.withColumn("start2", F.when(same & (F.col("end") != 0), F.lit(0)).otherwise(F.col("start")))
             .withColumn("end", F.when(same & (F.col("end") == 0), F.lit(EMPTY_WINDOW_END)).otherwise(F.col("end")))
             .drop("start").withColumnRenamed("start2", "start"))


# --------------------------------------------------------------------- J8
def cells_at_points(points: DataFrame, labels: DataFrame, mm_per_px: float, top_left_mm,
                    keys: list[str] = ()) -> DataFrame:
    """Label under each point: layer coords -> mosaic pixel (truncate), equi-join
    on (row, col), drop background. Duplicates are kept."""
    keys = list(keys)
    ppm = 1 / mm_per_px
    tly, tlx = top_left_mm
    p = points.select(*keys, *[c for c in points.columns if c not in keys],
                      ((F.col("y") * F.lit(mm_per_px) - _lit(tly)) * F.lit(ppm)).cast("long").alias("row"),
                      ((F.col("x") * F.lit(mm_per_px) - _lit(tlx)) * F.lit(ppm)).cast("long").alias("col"))
    lab = labels.select(*keys, "row", "col", F.col("val").alias("UID")).where(F.col("UID") != 0)
    return p.join(lab, keys + ["row", "col"])


# --------------------------------------------------------------------- J9
SHAPE_BUCKET = 256  # grid cell edge in pixels of the shape join


def cells_in_shapes(shapes: DataFrame, labels: DataFrame, mm_per_px: float, top_left_mm,
                    height, width, bucket: int = SHAPE_BUCKET, keys: list[str] = ()) -> DataFrame:
    """Distinct non-zero labels with a pixel inside a polygon / rectangle
    (even-odd rule on the pixel index) or ellipse (((r-r0)/a)^2 + ((c-c0)/b)^2 < 1).

    Range join as an equi-join: every label pixel looks up its grid cell (of its own
    slide, with ``keys`` on both frames) among the cells that shapes cover
    (:func:`tessera.operators.shapes.cover`). Cells inside a shape need no test; cells
    on its outline carry the few edges in them, so no vertex list is joined.
    Returns (keys, shape_id, UID)."""
    keys = list(keys)
    cells = cover(shapes, mm_per_px, top_left_mm, height, width, bucket, keys)
    lab = labels.where(F.col("val") != 0).select(
        *keys, "row", "col", F.col("val").alias("UID"),
        F.floor(F.col("row") / bucket).alias("by"), F.floor(F.col("col") / bucket).alias("bx"))
    j = lab.join(cells, [*keys, "by", "bx"]).where(inside_test(F.col("row"), F.col("col")))
    return j.select(*keys, "shape_id", "UID").distinct()


# --------------------------------------------------------------------- J11
def color_labels(labels: DataFrame, colors: DataFrame, default_idx: int, keys: list[str] = ()) -> DataFrame:
    """Colour index per label pixel: mapped labels -> their index, unmapped ->
    ``default_idx``, background 0 -> index 0 (the added background entry).
    ``colors`` = (UID, color_idx), one row per annotated cell. Background pixels, most
    of an image, get negative join keys spread by position, so they match nothing and
    never meet in one task."""
    keys = list(keys)
    c = colors.select(F.col("UID").cast("long").alias("_k"), "color_idx").where("_k > 0")
    spread = -1 - F.pmod(F.xxhash64("row", "col"), F.lit(1 << 20))
    j = labels.withColumn("_k", F.when(F.col("val") == 0, spread).otherwise(F.col("val").cast("long"))).join(c, "_k", "left")
    idx = F.when(F.col("val") == 0, F.lit(0)).otherwise(F.coalesce("color_idx", F.lit(default_idx)))
    return j.select(*keys, "row", "col", idx.cast("int").alias("color_idx"))


# --------------------------------------------------------------------- O6
def stack_channels(pixels: DataFrame, channels: list[str], ome: bool = False,
                   boundary: DataFrame | None = None, active: list[str] | None = None) -> DataFrame:
    """Stack the layers of one level on a channel axis: long form with
    ``channel_idx`` (request order; reversed for OME, boundary layer appended
    last) and an ``active`` flag."""
    order = list(reversed(channels)) if ome else list(channels)
    d = pixels.where(F.col("channel").isin(order))
    if ome and boundary is not None:
        d = d.unionByName(boundary.withColumn("channel", F.lit("boundaries")), allowMissingColumns=True)
        order = order + ["boundaries"]
    arr = F.array(*[F.lit(c) for c in order])
    d = d.withColumn("channel_idx", (F.array_position(arr, F.col("channel")) - 1).cast("int"))
    act = set(active) if active is not None else set(order)
    return d.withColumn("active", F.col("channel").isin(list(act)))


# --------------------------------------------------------------------- P19 / P20
def threshold_pixels(pixels: DataFrame, t) -> DataFrame:
    return pixels.withColumn("val", (F.col("val") > F.lit(t)).cast("int"))


def pixel_arithmetic(a: DataFrame, b: DataFrame, op: str, keys: list[str] = ()) -> DataFrame:
    """Pixelwise a (op) b for equal-shaped images (missing pixel = 0); divide
    gives NULL where numpy would give inf/nan."""
    keys = list(keys)
    x = a.select(*keys, "row", "col", F.col("val").alias("a"))
    y = b.select(*keys, "row", "col", F.col("val").alias("b"))
    j = x.join(y, keys + ["row", "col"], "full")
    av, bv = F.coalesce("a", F.lit(0)).cast("double"), F.coalesce("b", F.lit(0)).cast("double")
    res = {"add": av + bv, "subtract": av - bv, "multiply": av * bv,
           "divide": F.try_divide(av, F.nullif(bv, F.lit(0.0)))}[op]
    return j.select(*keys, "row", "col", res.alias("val"))
