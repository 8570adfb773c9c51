"""Block form against the long form at the edges: thin last blocks, halos as large as a
block and larger, pyramid steps larger than a block, dense tiles."""

import time

import numpy as np
import pytest

from tessera.operators import blocks as BL
from tessera.operators import raster as R
from tessera.operators import shapes
from tessera.util import saved_table


def _image(h, w, seed, fill=None):
    rng = np.random.default_rng(seed)
    return np.full((h, w), fill, np.int64) if fill else rng.integers(0, 4, (h, w)) * (rng.random((h, w)) < 0.7)


def _long(spark, a):
    rows = [("labels", int(r), int(c), int(a[r, c])) for r in range(a.shape[0]) for c in range(a.shape[1]) if a[r, c]]
    return spark.createDataFrame(rows, "channel string, row int, col int, val long")


def _blocks(spark, a, B, channel="labels"):
    rows = []
    for by in range(-(-a.shape[0] // B)):
        for bx in range(-(-a.shape[1] // B)):
            p = a[by * B:(by + 1) * B, bx * B:(bx + 1) * B]
            rows.append((channel, by, bx, *p.shape, *a.shape, *BL.pack(p)))
    return spark.createDataFrame(rows, "channel string, " + BL.BLOCK_FIELDS)


def _pixels(df):
    return {(r["row"], r["col"], r["val"]) for r in df.select("row", "col", "val").collect() if r["val"]}


@pytest.mark.parametrize("size,k", [((7, 7), 2), ((8, 8), 3), ((9, 9), 2), ((9, 17), 8), ((10, 9), 11), ((17, 17), 2)])
def test_contour_blocks_equal_long_form(spark, size, k):
    for fill in (None, 17):
        a = _image(*size, seed=k, fill=fill)
        want = _pixels(R.label_contour(_long(spark, a), k, *size))
        got = _pixels(BL.blocks_to_long(BL.contour_blocks(_blocks(spark, a, 8), k, block=8), 8))
        assert got == want, (size, k, fill)


@pytest.mark.parametrize("size", [(7, 9), (8, 8), (9, 17)])
def test_boundary_blocks_equal_long_form(spark, size):
    a = _image(*size, seed=1)
    long = R.label_boundaries(_long(spark, a), *size).select("row", "col", "val")
    assert {p[:2] for p in _pixels(BL.blocks_to_long(BL.boundaries_blocks(_blocks(spark, a, 8), block=8), 8))} == {p[:2] for p in _pixels(long)}


def test_pyramid_blocks_keep_every_level(spark):
    h, w, B = 70, 130, 4
    a = _image(h, w, seed=3)
    want = R.build_pyramid(_long(spark, a), h, w, min_size=2).where("val <> 0")
    got = BL.blocks_to_long(BL.pyramid_blocks(_blocks(spark, a, B), block=B, min_size=2), B)
    count = lambda df: {r["level"]: r["count"] for r in df.groupBy("level").count().collect()}
    cells = lambda df: {(r["level"], r["row"], r["col"], r["val"]) for r in df.collect()}
    assert count(got) == count(want) and max(count(want)) >= 4
    assert cells(got.select("level", "row", "col", "val")) == cells(want.select("level", "row", "col", "val"))


def test_packing_a_large_tile_is_linear(spark):
    px = spark.range(512 * 512).selectExpr("1 AS fov", "0 AS channel", "CAST(id / 512 AS INT) AS row", "CAST(id % 512 AS INT) AS col", "id + 1 AS val")
    start = time.time()
    rows = BL.pack_tiles(px, 512, 512, piece=200).collect()
    assert time.time() - start < 60
    assert sorted((r.top, r.left, r.ph, r.pw) for r in rows) == [(t, x, min(200, 512 - t), min(200, 512 - x)) for t in (0, 200, 400) for x in (0, 200, 400)]
    whole = np.zeros((512, 512), np.int64)
    for r in rows:
        whole[r.top:r.top + r.ph, r.left:r.left + r.pw] = BL.unpack(r.pixels, r.depth, r.ph, r.pw)
    assert (whole == np.arange(1, 512 * 512 + 1).reshape(512, 512)).all()


def test_a_real_size_tile_stays_small(spark):
    """A 4256 x 4256 tile of 16-bit pixels: cut, stitched and halved in blocks of 1024."""
    n = 4256
    image = (np.arange(n * n, dtype=np.uint32) % 60_001).astype("<u2").reshape(n, n)
    tiles = spark.createDataFrame([(f, "c", n, n, *BL.pack(image)) for f in (1, 2)], "fov int, channel string, height int, width int, depth int, pixels binary")
    pieces = BL.cut_tiles(tiles)
    origins = spark.createDataFrame([(1, 0, 0, 1, n, 2 * n - 100), (2, 0, n - 100, 2, n, 2 * n - 100)],
                                    "fov int, y0 long, x0 long, paste_order long, canvas_h long, canvas_w long")
    blocks = saved_table(BL.stitch_blocks(pieces, origins))
    assert blocks.agg({"depth": "max"}).first()[0] == 2
    want = np.concatenate([image[:, :n - 100], image], axis=1)
    sizes = blocks.selectExpr("max(octet_length(pixels)) AS most", "sum(octet_length(pixels)) AS bytes", "count(*) AS n").first()
    assert (sizes.most, sizes.bytes, sizes.n) == (2 * 1024 * 1024, 2 * want.size, 5 * 9)
    top = BL.pyramid_blocks(blocks).where("level = 4").collect()
    small = np.zeros((n >> 4, want.shape[1] >> 4), np.int64)
    for r in top:
        small[r.by * 1024:r.by * 1024 + r.bh, r.bx * 1024:r.bx * 1024 + r.bw] = BL.unpack(r.pixels, r.depth, r.bh, r.bw)
    assert (small == want[15::16, 15::16][:n >> 4, :want.shape[1] >> 4]).all()
    for r in blocks.where("(by + bx) % 5 = 0").collect():
        assert (BL.unpack(r.pixels, r.depth, r.bh, r.bw) == want[r.by * 1024:r.by * 1024 + r.bh, r.bx * 1024:r.bx * 1024 + r.bw]).all()


@pytest.mark.parametrize("value,depth", [(0, 0), (1, 1), (255, 1), (256, 2), (65_535, 2), (65_536, 4), (2**32, 8), (-1, 8)])
def test_pixels_pack_to_the_narrowest_width(value, depth):
    a = np.zeros((3, 5), np.int64)
    a[1, 2] = value
    got = BL.pack(a)
    assert got[0] == depth and len(got[1]) == depth * 15
    assert (BL.unpack(got[1], depth, 3, 5) == a).all()


def _spread_long(raster, r, h, w, how):
    """The disk as one row a pixel of it."""
    offs = [(dy, dx) for dy in range(-r, r + 1) for dx in range(-r, r + 1) if dy * dy + dx * dx <= r * r]
    out = {}
    for fov, row, col, val in raster:
        for dy, dx in offs:
            k = (fov, row + dy, col + dx)
            if 0 <= k[1] < h and 0 <= k[2] < w:
                out[k] = out.get(k, 0) + val if how == "sum" else max(out.get(k, val), val)
    return out


@pytest.mark.parametrize("r", range(9))
def test_spread_equals_the_disk_by_pixels(spark, r):
    h, w = 45, 61
    rng = np.random.default_rng(r)
    raster = [(int(f), int(y), int(x), int(v)) for f, y, x, v in zip(rng.integers(1, 3, 90), rng.integers(0, h, 90), rng.integers(0, w, 90), rng.integers(-3, 9, 90))]
    raster = list({p[:3]: p for p in raster + [(1, 0, 0, 5), (1, h - 1, w - 1, -7), (2, 15, 16, 0)]}.values())
    df = spark.createDataFrame(raster, "fov int, row int, col int, val long")
    for how in ("sum", "max"):
        got = {(p.fov, p.row, p.col): p.val for p in BL.spread_blocks(df, r, h, w, how, block=16).collect()}
        assert got == _spread_long(raster, r, h, w, how), how


def test_spread_sends_points_not_disks(spark):
    """What is shuffled does not depend on the radius, but for points near a block's edge."""
    points = spark.range(4000).selectExpr("1 AS fov", "CAST(id * 37 % 2048 AS INT) AS row", "CAST(id * 101 % 2048 AS INT) AS col", "1L AS val")
    for r in (1, 8):
        plan = BL.spread_blocks(points, r, 2048, 2048)._jdf.queryExecution().optimizedPlan()
        assert "Generate" in plan.toString()
        rows = points.selectExpr(f"size(sequence(greatest((row - {r}) div 256, 0), least((row + {r}) div 256, 7))) * size(sequence(greatest((col - {r}) div 256, 0), least((col + {r}) div 256, 7))) AS n")
        assert rows.agg({"n": "sum"}).first()[0] < 4000 * 1.2


def test_blocks_of_slides_stay_apart(spark):
    a, b = _image(20, 30, 1), _image(33, 17, 2)
    both = _blocks(spark, a, 8).selectExpr("'A' AS slide", "*").union(_blocks(spark, b, 8).selectExpr("'B' AS slide", "*"))
    for op in (lambda t: BL.boundaries_blocks(t, 8), lambda t: BL.contour_blocks(t, 2, 8), lambda t: BL.pyramid_blocks(t, 8, min_size=4)):
        got = BL.blocks_to_long(op(both), 8)
        for name, image in (("A", a), ("B", b)):
            one = BL.blocks_to_long(op(_blocks(spark, image, 8)), 8)
            mine = got.where(f"slide = '{name}'").drop("slide")
            assert mine.exceptAll(one).count() == 0 == one.exceptAll(mine).count()


def _polygon_brute(v, box):
    ymin, ymax, xmin, xmax = box
    r, c = np.mgrid[ymin:ymax + 1, xmin:xmax + 1].astype(float)
    n = np.zeros(r.shape, int)
    for (y1, x1), (y2, x2) in zip(v, np.roll(v, 1, axis=0)):
        if y1 != y2:
            n += ((y1 > r) != (y2 > r)) & (c < (x2 - x1) * (r - y1) / (y2 - y1) + x1)
    return {(int(a) + ymin, int(b) + xmin) for a, b in zip(*np.nonzero(n % 2))}


@pytest.mark.parametrize("seed", range(12))
def test_polygon_cover_equals_the_even_odd_rule(seed):
    rng = np.random.default_rng(seed)
    v = rng.integers(-20, 220, (int(rng.integers(3, 40)), 2)).astype(float)  # crossing itself, partly off the canvas
    box = tuple(int(x) for x in (max(v[:, 0].min(), 0), min(v[:, 0].max(), 180), max(v[:, 1].min(), 0), min(v[:, 1].max(), 150)))
    got, tested = [], 0
    for by, bx, inside, edges, flips in shapes.polygon_cells(np.hstack([v, np.roll(v, 1, axis=0)]), box, 16):
        cell = {"kind": "polygon", "edges": [dict(zip(("y1", "x1", "y2", "x2"), e)) for e in edges], "flips": sorted(flips),
                "ymin": box[0], "ymax": box[1], "xmin": box[2], "xmax": box[3]}
        mask = np.ones((16, 16), bool) if inside else shapes.inside_mask(cell, by * 16, bx * 16, 16, 16)
        got += [(by * 16 + int(y), bx * 16 + int(x)) for y, x in zip(*np.nonzero(mask))]
        tested += not inside
    assert len(got) == len(set(got)) and set(got) == _polygon_brute(v, box)


def test_a_shape_over_the_whole_slide_touches_vertices_on_its_outline_only():
    n, grid = 40_000, 256
    angle = np.linspace(0, 2 * np.pi, 3000, endpoint=False)
    v = np.floor(np.stack([n / 2 + n * 0.49 * np.sin(angle), n / 2 + n * 0.49 * np.cos(angle)], 1))
    cells = list(shapes.polygon_cells(np.hstack([v, np.roll(v, 1, axis=0)]), (int(v[:, 0].min()), int(v[:, 0].max()), int(v[:, 1].min()), int(v[:, 1].max())), grid))
    inside = sum(c[2] for c in cells)
    edges = sum(len(c[3]) for c in cells)
    outline = 8 * n / grid
    assert inside > 15_000 and len(cells) - inside < outline and edges < 3000 + 4 * outline
    assert max(len(c[3]) + len(c[4]) for c in cells) < 40


@pytest.mark.parametrize("how", ["sum", "max"])
def test_spread_of_few_points_makes_no_whole_blocks(spark, monkeypatch, how):
    raster = {(1, 0, 0): 3, (1, 0, 1): 5, (1, 40, 63): 2, (2, 31, 32): 7, (2, 63, 63): 1}
    df = spark.createDataFrame([(*k, v) for k, v in raster.items()], "fov int, row int, col int, val long")
    for r in (1, 3):
        want = {}
        for (f, y, x), v in raster.items():
            for dy in range(-r, r + 1):
                for dx in range(-r, r + 1):
                    at = (f, y + dy, x + dx)
                    if dy * dy + dx * dx <= r * r and 0 <= at[1] < 64 and 0 <= at[2] < 64:
                        want[at] = (want.get(at, 0) + v) if how == "sum" else max(want.get(at, v), v)
        got = BL.spread_blocks(df, r, 64, 64, how, block=32).collect()
        assert {(p.fov, p.row, p.col): p.val for p in got} == want
    calls = []
    monkeypatch.setattr(BL, "disk", lambda *a: calls.append(a))
    schema = BL._schema(df, ["fov"], "row int, col int, val long")
    monkeypatch.setattr(BL, "_each_group", lambda d, keys, s, fn, **k: fn)
    import pyarrow as pa
    fn = BL.spread_blocks(df, 1, 64, 64, how, block=32)
    part = pa.RecordBatch.from_pydict({"row": [0, 0], "col": [0, 1], "val": [3, 5]})
    assert sum(len(c[1]) for c in fn((1, 0, 0), [part])) == 5 and not calls and len(schema) == 4


def test_waiting_chunks_are_bounded():
    """Short and empty chunks are written in time too: they wait as Python objects."""
    from pyspark.sql.types import StructType
    schema, waiting = StructType.fromDDL("k long, v long"), [0]

    def chunks():
        for k in range(100_000):
            waiting[0] += 1
            yield [k], np.arange(k % 2)

    most = rows = 0
    for batch in BL._pixel_records(chunks(), schema):
        most, rows, waiting[0] = max(most, waiting[0]), rows + batch.num_rows, 0
    assert rows == 50_000 and most <= 10_000
