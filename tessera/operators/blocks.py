"""Dense (block) form of the raster operators: R1, R6, R9, R10, J9 and A14.

The long pixel form is exact and pure Catalyst but carries one row per pixel. Here an
image is a table of packed rectangles: bytes of the narrowest integer that holds the
rectangle's values (0 bytes where all are zero), so a 16-bit pixel costs two bytes in a
shuffle and numpy reads it in place. Spark routes the rectangles; slide keys and the
canvas size travel with each of them, so one job does all slides.

* piece: (keys, channel, fov, top, left, ph, pw, depth, pixels), a part of a tile of at
  most ``PIECE`` x ``PIECE`` pixels. Tiles are cut before anything gathers them:
  :func:`pack_tiles` from long pixels, :func:`cut_tiles` from images held as bytes.
* block: (keys, channel, by, bx, bh, bw, canvas_h, canvas_w, depth, pixels), a part of a
  mosaic. :func:`stitch_blocks` sends every piece to the blocks it covers and pastes in
  paste order; a group is one block and the few pieces over it.
* pyramid: level 0 is the blocks themselves; a block sends its sampled pixels of each
  higher level (a third of its size in all) to the block of that level.
* halos: a block sends each block within reach the strip that lies in its halo.

Missing pixels and absent blocks are 0; results equal the long form.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

PIECE = 512
BLOCK = 1024
SPREAD_BLOCK = 256
SPARSE_RADIUS = 64
OUT_BYTES = 16 << 20
OUT_ROWS = 65_536
ROW_BYTES = 1024  # of the Python objects of a row that waits to be written
_DTYPES = {1: "u1", 2: "<u2", 4: "<u4", 8: "<i8"}

PIECE_FIELDS = "top int, left int, ph int, pw int, depth int, pixels binary"
BLOCK_FIELDS = "by long, bx long, bh int, bw int, canvas_h long, canvas_w long, depth int, pixels binary"


# --------------------------------------------------------------------- packed pixels
def pack(a: np.ndarray) -> tuple[int, bytes]:
    """(bytes a pixel, row-major bytes) in the narrowest width; all zero packs to nothing."""
    if not a.size or not a.any():
        return 0, b""
    if a.dtype.kind == "b":
        return 1, a.astype("u1").tobytes()
    high, low = int(a.max()), int(a.min())
    depth = 8 if low < 0 else next(d for d in (1, 2, 4, 8) if high < 1 << 8 * d or d == 8)
    return depth, np.ascontiguousarray(a, dtype=_DTYPES[depth]).tobytes()


def unpack(pixels: bytes, depth: int, h: int, w: int) -> np.ndarray:
    return np.zeros((h, w), "u1") if depth == 0 else np.frombuffer(pixels, _DTYPES[depth]).reshape(h, w)


# --------------------------------------------------------------------- rows in, rows out
def _schema(df: DataFrame, keys: list[str], fields: str) -> StructType:
    plain = StructType.fromDDL(fields)
    return StructType([df.schema[k] for k in keys] + plain.fields)


def _records(rows: Iterator[tuple], schema: StructType) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size."""
    arrow = to_arrow_schema(schema)
    held, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    for row in rows:
        held.append(row)
        size += ROW_BYTES + (len(row[-1]) if isinstance(row[-1], bytes) else 8)
        if size >= OUT_BYTES or len(held) >= OUT_ROWS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _pixel_records(chunks: Iterator[tuple], schema: StructType) -> Iterator[pa.RecordBatch]:
    """(key values, arrays of one length...) as Arrow batches of bounded size, keys repeated."""
    arrow = to_arrow_schema(schema)
    held, size = [], 0

    def batch():
        own = np.repeat(np.arange(len(held)), [len(c[1]) for c in held])
        n_keys = len(held[0][0])
        columns = [pa.array([c[0][k] for c in held], arrow[k].type).take(pa.array(own)) for k in range(n_keys)]
        columns += [pa.array(np.concatenate([c[k] for c in held])).cast(arrow[n_keys + k - 1].type) for k in range(1, len(held[0]))]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    for chunk in chunks:
        if not len(chunk[1]):
            continue
        held.append(chunk)
        size += ROW_BYTES // 8 + len(chunk[1])  # a chunk waits as Python objects, however short it is
        if size >= 8 * OUT_ROWS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _each_row(df: DataFrame, schema: StructType, fn: Callable[[dict], Iterator[tuple]], write=_records) -> DataFrame:
    """``fn`` on every row; binary columns arrive as buffers, not copied."""
    def run(batches):
        def rows():
            for b in batches:
                columns = [c if pa.types.is_binary(c.type) else c.to_pylist() for c in b.columns]
                names = b.schema.names
                for k in range(b.num_rows):
                    yield from fn({n: c[k].as_buffer() if isinstance(c, pa.Array) else c[k] for n, c in zip(names, columns)})
        yield from write(rows(), schema)
    return df.mapInArrow(run, schema)


def _each_group(df: DataFrame, keys: list[str], schema: StructType, fn, order: list[str] = (), write=_records) -> DataFrame:
    """``fn(key values, batches)`` on the rows of every key, in ``order``: one shuffle by the
    key, then each partition is read in key order, holding one group at a time."""
    def run(batches):
        def changes(b):
            out = np.zeros(b.num_rows, bool)
            for k in keys:
                code = b.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                out[1:] |= code[1:] != code[:-1]
            return np.flatnonzero(out)

        def rows():
            key, held = None, []
            for b in batches:
                if not b.num_rows:
                    continue
                edges = [0, *changes(b).tolist(), b.num_rows]
                starts = b.select(keys).take(pa.array(edges[:-1])).to_pylist()
                for low, high, start in zip(edges[:-1], edges[1:], starts):
                    value = tuple(start.values())
                    if held and value != key:
                        yield from fn(key, held)
                        held = []
                    key = value
                    held.append(b.slice(low, high - low))
            if held:
                yield from fn(key, held)
        yield from write(rows(), schema)
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _values(parts: list[pa.RecordBatch], *names: str) -> list[np.ndarray]:
    return [np.concatenate([p.column(n).to_numpy(zero_copy_only=False) for p in parts]) for n in names]


def _rectangles(parts: list[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """(named values..., pixels as an array of ph x pw) of every row."""
    for p in parts:
        columns = [p.column(n).to_pylist() for n in (*names, "ph", "pw", "depth")]
        pixels = p.column("pixels")
        for k in range(p.num_rows):
            *own, h, w, depth = [c[k] for c in columns]
            yield (*own, unpack(pixels[k].as_buffer(), depth, h, w))


# --------------------------------------------------------------------- tiles to pieces
def _pieces(h: int, w: int, size: int):
    for top in range(0, h, size):
        for left in range(0, w, size):
            yield top, left, min(size, h - top), min(size, w - left)


def pack_tiles(pixels: DataFrame, height: int, width: int, keys=("fov", "channel"), piece: int = PIECE) -> DataFrame:
    """Long tile pixels (keys, row, col, val) -> pieces of every tile, zero where no pixel is
    given. Pixels go straight to their piece, so a group holds at most ``piece``^2 of them;
    each tile adds one mark a piece, so pieces without pixels are there too."""
    keys, n = list(keys), int(piece)
    own = pixels.where((F.col("row") >= 0) & (F.col("row") < height) & (F.col("col") >= 0) & (F.col("col") < width)).select(
        *keys, (F.floor(F.col("row") / n) * n).cast("int").alias("top"), (F.floor(F.col("col") / n) * n).cast("int").alias("left"),
        (F.col("row") % n * n + F.col("col") % n).cast("int").alias("at"), F.col("val").cast("long").alias("v"))
    corners = F.array(*[F.struct(F.lit(t).alias("top"), F.lit(x).alias("left")) for t, x, _, _ in _pieces(height, width, n)])
    marks = pixels.select(*keys).distinct().withColumn("c", F.explode(corners)).select(
        *keys, "c.top", "c.left", F.lit(-1).alias("at"), F.lit(0).cast("long").alias("v"))
    schema = _schema(pixels, keys, PIECE_FIELDS)

    def fill(key, parts):
        *own, top, left = key
        h, w = min(n, height - top), min(n, width - left)
        at, v = _values(parts, "at", "v")
        image = np.zeros((h, w), np.int64)
        at, v = at[at >= 0], v[at >= 0]
        image[at // n, at % n] = v
        yield (*own, top, left, h, w, *pack(image))

    return _each_group(own.unionByName(marks), [*keys, "top", "left"], schema, fill)


def cut_tiles(tiles: DataFrame, keys=("fov", "channel"), piece: int = PIECE) -> DataFrame:
    """Images held as bytes (keys, height, width, depth, pixels) -> pieces, without a shuffle."""
    keys, n = list(keys), int(piece)

    def cut(row):
        image = unpack(row["pixels"], row["depth"], row["height"], row["width"])
        for top, left, h, w in _pieces(row["height"], row["width"], n):
            yield (*[row[k] for k in keys], top, left, h, w, *pack(image[top:top + h, left:left + w]))

    return _each_row(tiles.select(*keys, "height", "width", "depth", "pixels"), _schema(tiles, keys, PIECE_FIELDS), cut)


# --------------------------------------------------------------------- R1
def stitch_blocks(pieces: DataFrame, origins: DataFrame, block: int = BLOCK, keys: list[str] = ()) -> DataFrame:
    """``pieces`` placed by ``origins`` = (keys, fov, y0, x0, paste_order, canvas_h,
    canvas_w); later tiles overwrite whole, zeros included. Pieces are clipped and cut at
    block edges where they are; what is shuffled is each pixel once, packed."""
    keys, B = list(keys), int(block)
    o = origins.select(*keys, "fov", "y0", "x0", "paste_order", "canvas_h", "canvas_w")
    placed = pieces.withColumn("channel", F.col("channel").cast("string")).join(o, [*keys, "fov"])
    by = [*keys, "channel", "by", "bx"]

    def cut(row):
        image = unpack(row["pixels"], row["depth"], row["ph"], row["pw"])
        y, x = row["y0"] + row["top"], row["x0"] + row["left"]
        r0, r1 = max(0, y), min(y + row["ph"], row["canvas_h"])
        c0, c1 = max(0, x), min(x + row["pw"], row["canvas_w"])
        if r0 >= r1 or c0 >= c1:
            return
        own = [row[k] for k in keys]
        for ty in range(r0 // B, (r1 - 1) // B + 1):
            a, b = max(r0, ty * B), min(r1, (ty + 1) * B)
            for tx in range(c0 // B, (c1 - 1) // B + 1):
                c, d = max(c0, tx * B), min(c1, (tx + 1) * B)
                yield (*own, row["channel"], ty, tx, row["paste_order"], row["canvas_h"], row["canvas_w"], a - ty * B, c - tx * B,
                       b - a, d - c, *pack(image[a - y:b - y, c - x:d - x]))

    cuts = _each_row(placed, _schema(placed, [*keys, "channel"], "by long, bx long, paste_order long, canvas_h long, canvas_w long, "
                                     "oy int, ox int, ph int, pw int, depth int, pixels binary"), cut)

    def paste(key, parts):
        *own, ty, tx = key
        H, W = parts[0].column("canvas_h")[0].as_py(), parts[0].column("canvas_w")[0].as_py()
        out = np.zeros((min(B, H - ty * B), min(B, W - tx * B)), np.int64)
        for oy, ox, image in _rectangles(parts, "oy", "ox"):
            out[oy:oy + image.shape[0], ox:ox + image.shape[1]] = image
        yield (*own, ty, tx, *out.shape, H, W, *pack(out))

    return _each_group(cuts, by, _schema(placed, [*keys, "channel"], BLOCK_FIELDS), paste, ["paste_order"])


def block_keys(blocks: DataFrame) -> list[str]:
    """The columns before ``by``: slide keys, channel, and level where there is one."""
    return blocks.columns[:blocks.columns.index("by")]


def blocks_to_long(blocks: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks -> long pixels (keys, channel, row, col, val) that are not 0."""
    B, keys = int(block), block_keys(blocks)

    def pixels(row):
        if row["depth"]:
            image = unpack(row["pixels"], row["depth"], row["bh"], row["bw"])
            r, c = np.nonzero(image)
            yield [row[k] for k in keys], row["by"] * B + r, row["bx"] * B + c, image[r, c].astype(np.int64)

    return _each_row(blocks, _schema(blocks, keys, "row long, col long, val long"), pixels, _pixel_records)


# --------------------------------------------------------------------- R6
def pyramid_blocks(blocks: DataFrame, block: int = BLOCK, min_size: int = 256) -> DataFrame:
    """R6 for every canvas of the table: blocks with a ``level`` (after the other keys).
    Levels and sampling as in :func:`tessera.operators.raster.build_pyramid`."""
    B, keys = int(block), block_keys(blocks)

    def emit(row):
        if not row["depth"]:
            return
        H, W = row["canvas_h"], row["canvas_w"]
        image = unpack(row["pixels"], row["depth"], row["bh"], row["bw"])
        for k in range(1, int(math.floor(math.log2(max(H, W) / min_size)))):
            part = []
            for n, at, size in ((H, row["by"] * B, row["bh"]), (W, row["bx"] * B, row["bw"])):
                step = 1 << min(k, n.bit_length() - 1)
                first = -(at + 1) % step  # the first pixel at or after ``at`` that a step ends on
                low = (at + first + 1) // step - 1
                count = min(len(range(first, size, step)), max(1, n >> k) - low)
                part.append((first, step, low, count))
            (fy, sy, ly, ny), (fx, sx, lx, nx) = part
            if ny <= 0 or nx <= 0:
                continue
            sub = image[fy::sy, fx::sx][:ny, :nx]
            for ty in range(ly // B, (ly + ny - 1) // B + 1):
                a, b = max(ly, ty * B), min(ly + ny, (ty + 1) * B)
                for tx in range(lx // B, (lx + nx - 1) // B + 1):
                    c, d = max(lx, tx * B), min(lx + nx, (tx + 1) * B)
                    yield (*[row[x] for x in keys], k, ty, tx, H, W, a - ty * B, c - tx * B, b - a, d - c,
                           *pack(sub[a - ly:b - ly, c - lx:d - lx]))

    subs = _each_row(blocks, _schema(blocks, keys, "level int, by long, bx long, canvas_h long, canvas_w long, oy int, ox int, "
                                     "ph int, pw int, depth int, pixels binary"), emit)

    def assemble(key, parts):
        *own, level, ty, tx = key
        H, W = parts[0].column("canvas_h")[0].as_py(), parts[0].column("canvas_w")[0].as_py()
        out = np.zeros((min(B, max(1, H >> level) - ty * B), min(B, max(1, W >> level) - tx * B)), np.int64)
        for oy, ox, image in _rectangles(parts, "oy", "ox"):
            out[oy:oy + image.shape[0], ox:ox + image.shape[1]] = image
        yield (*own, level, ty, tx, *out.shape, H, W, *pack(out))

    upper = _each_group(subs, [*keys, "level", "by", "bx"], _schema(blocks, keys, "level int, " + BLOCK_FIELDS), assemble)
    rest = [c for c in blocks.columns if c not in keys]
    return blocks.select(*keys, F.lit(0).alias("level"), *rest).union(upper)


# --------------------------------------------------------------------- halos
def _with_halo(blocks: DataFrame, k: int, block: int, fn: Callable[[np.ndarray, int, int], np.ndarray]) -> DataFrame:
    """Give every block a halo of ``k`` pixels and apply ``fn(padded, bh, bw)``. A block sends
    each block within ``k`` pixels the part of its own pixels that lies in that block's
    halo: strips and corners for the 8 neighbours, further rings when ``k`` exceeds the
    block edge. Groups exist for every block that has pixels or lies near one; halo parts
    beyond the canvas replicate its edge, by true distance from it. Results that are all 0
    are left out."""
    B, k, keys = int(block), int(k), block_keys(blocks)
    reach = -(-k // B)  # how many blocks away a halo can end
    ring = [(dy, dx) for dy in range(-reach, reach + 1) for dx in range(-reach, reach + 1) if (dy, dx) != (0, 0)]

    def emit(row):
        if not row["depth"]:
            return
        by, bx, bh, bw, H, W = [row[c] for c in ("by", "bx", "bh", "bw", "canvas_h", "canvas_w")]
        own = [row[x] for x in keys]
        yield (*own, by, bx, H, W, 0, 0, bh, bw, row["depth"], row["pixels"].to_pybytes())
        image = unpack(row["pixels"], row["depth"], bh, bw)
        for dy, dx in ring:
            ty, tx = by + dy, bx + dx
            if ty < 0 or tx < 0 or ty * B >= H or tx * B >= W:
                continue
            # rows / columns of this block inside the target's halo, in block coordinates
            r0, r1 = max(0, ty * B - k - by * B), min(bh, min(H, (ty + 1) * B) + k - by * B)
            c0, c1 = max(0, tx * B - k - bx * B), min(bw, min(W, (tx + 1) * B) + k - bx * B)
            if r0 < r1 and c0 < c1:
                depth, strip = pack(image[r0:r1, c0:c1])
                # a strip of zeros is sent too: its block may have no row of its own
                yield (*own, ty, tx, H, W, by * B + r0 - ty * B, bx * B + c0 - tx * B, r1 - r0, c1 - c0, depth, strip)

    parts = _each_row(blocks, _schema(blocks, keys, "by long, bx long, canvas_h long, canvas_w long, oy int, ox int, "
                                      "ph int, pw int, depth int, pixels binary"), emit)

    def compute(key, parts):
        *own, by, bx = key
        H, W = parts[0].column("canvas_h")[0].as_py(), parts[0].column("canvas_w")[0].as_py()
        bh, bw = min(B, H - by * B), min(B, W - bx * B)
        images = [r for r in _rectangles(parts, "oy", "ox") if r[2].any()]
        if not images:
            return
        pad = np.zeros((bh + 2 * k, bw + 2 * k), np.result_type(*[a.dtype for _, _, a in images]))
        for oy, ox, a in images:
            pad[k + oy:k + oy + a.shape[0], k + ox:k + ox + a.shape[1]] = a
        # parts of the halo beyond the canvas, by distance
        top, left = max(0, k - by * B), max(0, k - bx * B)
        bottom, right = max(0, by * B + bh + k - H), max(0, bx * B + bw + k - W)
        inner = pad[top:pad.shape[0] - bottom, left:pad.shape[1] - right]
        depth, pixels = pack(fn(np.pad(inner, ((top, bottom), (left, right)), mode="edge"), bh, bw))
        if depth:
            yield (*own, by, bx, bh, bw, H, W, depth, pixels)

    return _each_group(parts, [*keys, "by", "bx"], _schema(blocks, keys, BLOCK_FIELDS), compute)


def boundaries_blocks(blocks: DataFrame, block: int = BLOCK) -> DataFrame:
    """1 where any of the 8 neighbours differs (canvas edges replicated)."""
    def fn(pad, bh, bw):
        centre = pad[1:1 + bh, 1:1 + bw]
        out = np.zeros(centre.shape, bool)
        for dy in (0, 1, 2):
            for dx in (0, 1, 2):
                out |= pad[dy:dy + bh, dx:dx + bw] != centre
        return out
    return _with_halo(blocks, 1, block, fn)


def _cross(a: np.ndarray, best) -> np.ndarray:
    """``best`` of every inner pixel and its 4 neighbours."""
    out = best(a[1:-1, 1:-1], a[:-2, 1:-1])
    for other in (a[2:, 1:-1], a[1:-1, :-2], a[1:-1, 2:]):
        out = best(out, other)
    return out


def contour_blocks(blocks: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """Keep a label where grey dilation over the 1-px cross differs from grey erosion
    over the radius-k diamond: the cross taken k times."""
    k = max(1, int(k))

    def fn(pad, bh, bw):
        near = _cross(pad[k - 1:k + bh + 1, k - 1:k + bw + 1], np.maximum)
        least = pad
        for _ in range(k):
            least = _cross(least, np.minimum)
        return np.where(near != least, pad[k:k + bh, k:k + bw], 0)
    return _with_halo(blocks, k, block, fn)


# --------------------------------------------------------------------- A14
def _run_best(a: np.ndarray, widths: list[int], how: str) -> dict[int, np.ndarray]:
    """For each half-width, the sum or maximum over the row window around every pixel that
    has one within ``a``; columns keep their place (edges beyond the window are cut)."""
    out, r, n = {}, max(widths), a.shape[1]
    if how == "sum":
        total = np.concatenate([np.zeros((a.shape[0], 1), a.dtype), np.cumsum(a, axis=1)], axis=1)
        return {w: total[:, r + w + 1:n - r + w + 1] - total[:, r - w:n - r - w] for w in set(widths)}
    best = a[:, r:n - r]
    for w in range(r + 1):
        if w:
            best = np.maximum(best, np.maximum(a[:, r - w:n - r - w], a[:, r + w:n - r + w]))
        if w in widths:
            out[w] = best
    return out


def disk(a: np.ndarray, r: int, how: str) -> np.ndarray:
    """Sum or maximum over a disk of radius r around every pixel of ``a`` without its
    outermost r: one row window a line of the disk, windows by running sums or by
    widening step by step, so the work per pixel grows with r, not with its square."""
    widths = [math.isqrt(r * r - dy * dy) for dy in range(-r, r + 1)]
    rows = _run_best(a, widths, how)
    h = a.shape[0] - 2 * r
    out = rows[widths[0]][:h].copy()
    for dy in range(1, 2 * r + 1):
        line = rows[widths[dy]][dy:dy + h]
        out = out + line if how == "sum" else np.maximum(out, line)
    return out


def spread_blocks(raster: DataFrame, r: int, height: int, width: int, how: str = "sum", keys: list[str] = (),
                  block: int = SPREAD_BLOCK) -> DataFrame:
    """A14 over sparse FOV rasters (keys, fov, row, col, val): every point goes to its block
    and to the blocks in whose halo of r pixels it lies (most points to one), and each
    block dilates what it got. Returns the covered pixels, clipped to the canvas."""
    r, B, own = int(r), int(block), [*keys, "fov"]
    if r == 0:
        agg = F.sum("val") if how == "sum" else F.max("val")
        return raster.groupBy(*own, "row", "col").agg(agg.cast("long").alias("val"))
    inside = raster.where((F.col("row") >= -r) & (F.col("row") < height + r) & (F.col("col") >= -r) & (F.col("col") < width + r))
    places = {}
    for name, size in (("row", height), ("col", width)):
        low = F.greatest(F.floor((F.col(name) - r) / B), F.lit(0))
        places[name] = F.sequence(low, F.least(F.floor((F.col(name) + r) / B), F.lit((size - 1) // B)))
    sent = inside.select(*own, "row", "col", F.col("val").cast("long").alias("val"), F.explode(places["row"]).alias("by"))
    sent = sent.select("*", F.explode(places["col"]).alias("bx"))

    near = np.arange(-min(r, SPARSE_RADIUS), min(r, SPARSE_RADIUS) + 1)
    dy, dx = np.nonzero(near[:, None] ** 2 + near ** 2 <= r * r)
    dy, dx = near[dy], near[dx]

    def dilate(key, parts):
        *mine, by, bx = key
        bh, bw = min(B, height - by * B), min(B, width - bx * B)
        row, col, val = _values(parts, "row", "col", "val")
        if r <= SPARSE_RADIUS and len(row) * len(dy) < bh * bw:  # few points: their disks one by one
            y, x = (row - by * B)[:, None] + dy, (col - bx * B)[:, None] + dx
            on = (y >= 0) & (y < bh) & (x >= 0) & (x < bw)
            spot, place = np.unique((y * bw + x)[on], return_inverse=True)
            out = np.full(len(spot), 0 if how == "sum" else np.iinfo(np.int64).min)
            (np.add if how == "sum" else np.maximum).at(out, place, np.broadcast_to(val[:, None], y.shape)[on])
            yield mine, by * B + spot // bw, bx * B + spot % bw, out
            return
        a = np.full((bh + 2 * r, bw + 2 * r), 0 if how == "sum" else np.iinfo(np.int64).min)
        seen = np.zeros(a.shape, np.int32)
        at = (row - by * B + r, col - bx * B + r)
        (np.add if how == "sum" else np.maximum).at(a, at, val)
        np.add.at(seen, at, 1)
        y, x = np.nonzero(disk(seen, r, "sum"))
        yield mine, by * B + y, bx * B + x, disk(a, r, how)[y, x]

    return _each_group(sent, [*own, "by", "bx"], _schema(raster, own, "row int, col int, val long"), dilate, write=_pixel_records)


# --------------------------------------------------------------------- J9
def cells_in_shapes_blocks(shapes: DataFrame, label_blocks: DataFrame, mm_per_px: float, top_left_mm, height, width,
                           block: int = BLOCK, keys: list[str] = ()) -> DataFrame:
    """The cover of every shape by blocks (:func:`tessera.operators.shapes.cover`) meets the
    label blocks in an equi-join; blocks inside a shape give all their labels, blocks on
    its outline test their pixels against the edges that pass through them. Returns
    distinct (keys, shape_id, UID)."""
    from .shapes import cover, inside_mask
    B, keys = int(block), list(keys)
    c = cover(shapes, mm_per_px, top_left_mm, height, width, B, keys)
    j = label_blocks.select(*keys, "by", "bx", "bh", "bw", "depth", "pixels").where("depth > 0").join(c, [*keys, "by", "bx"])

    def labels(row):
        image = unpack(row["pixels"], row["depth"], row["bh"], row["bw"])
        found = np.unique(image if row["inside"] else image[inside_mask(row, row["by"] * B, row["bx"] * B, *image.shape)]).astype(np.int64)
        yield [*[row[k] for k in keys], row["shape_id"]], found[found != 0]

    return _each_row(j, _schema(j, [*keys, "shape_id"], "UID long"), labels, _pixel_records).distinct()
