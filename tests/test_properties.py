"""Set-based operators against plain loops / numpy on random cases.

Many random cases run in ONE Spark job each: the case id is a grouping key,
which is also how the operators handle many slides at once.
"""

import random

import numpy as np
from pyspark.sql import functions as F

from tessera.functions import keys as K
from tessera.operators import raster as R
from tessera.operators import versions as V


# ----------------------------------------------------------------- pairing
def test_pair_round_trip(spark):
    vals = [(x, y) for x in range(0, 200, 7) for y in range(0, 200, 3)]
    vals += [(65535, 65535), (1, 65536), (2**31 - 1, 12), (3, 2**31 - 1), (2**26, 2**26 + 5)]
    df = spark.createDataFrame(vals, "x long, y long").withColumn("z", K.pair_key("x", "y"))
    back = K.unpair_key(df, "z", "x2", "y2")
    bad = back.where((F.col("x") != F.col("x2")) | (F.col("y") != F.col("y2"))).count()
    assert bad == 0
    z = {(r["x"], r["y"]): r["z"] for r in df.collect()}
    assert z[(65535, 65535)] < 2**32 <= z[(1, 65536)]


# ----------------------------------------------------------------- W1
def _w1_loop(dirs: dict, primary: str):
    ver = lambda d: int(d.rsplit("_", 1)[1]) if d.rsplit("_", 1)[-1].isdigit() else 0
    all_fovs = dirs[sorted(dirs, key=lambda d: (ver(d), d))[0]]
    if dirs[primary] >= all_fovs:
        return [primary]
    selected, covered = [primary], set(dirs[primary])
    older = sorted([d for d in dirs if ver(d) < ver(primary)], key=lambda d: (-ver(d), d))
    for d in older:
        if covered >= all_fovs:
            break
        new = dirs[d] - covered
        if new:
            selected.append(d)
            covered |= new
    return selected


def test_select_segmentations_matches_loop(spark):
    rng = random.Random(5)
    rows, prims, expect = [], [], {}
    for case in range(150):
        n = rng.randint(1, 5)
        dirs = {}
        for v in range(n):
            d = f"Segmentation_u{rng.randint(0, 2)}_{v:03d}"
            dirs[d] = {f for f in range(1, 13) if rng.random() < (0.9 if v == 0 else 0.5)} or {1}
        primary = rng.choice(sorted(dirs))
        expect[case] = sorted(_w1_loop(dirs, primary))
        rows += [(case, d, f) for d, fs in dirs.items() for f in fs]
        prims.append((case, primary))
    seg = spark.createDataFrame(rows, "case int, dir string, fov int")
    prim = spark.createDataFrame(prims, "case int, primary_dir string")
    sel, _ = V.select_segmentations(seg, prim, ["case"])
    got = {}
    for r in sel.collect():
        got.setdefault(r["case"], []).append(r["dir"])
    assert {k: sorted(v) for k, v in got.items()} == expect


# ----------------------------------------------------------------- W3
def test_merge_metadata_sources_matches_loop(spark):
    rng = random.Random(9)
    rows, expect = [], {}
    for case in range(120):
        sources = [[f"id{rng.randint(0, 4)}" for _ in range(rng.randint(0, 6))] for _ in range(rng.randint(1, 4))]
        requested = {f"id{rng.randint(0, 4)}" for _ in range(rng.randint(1, 3))}
        out, found = [], set()
        for s_idx, src in enumerate(sources):
            m = [(s_idx, i) for i, sid in enumerate(src) if sid in requested]
            if m:
                out += m
                found |= requested & set(src)
                if found >= requested:
                    break
        expect[(case, ",".join(sorted(requested)))] = sorted(out)
        rows += [(case, s_idx, i, sid) for s_idx, src in enumerate(sources) for i, sid in enumerate(src)]
    df = spark.createDataFrame(rows, "case int, source_idx int, i int, seg string")
    got = {}
    # one requested set per case: run the operator per distinct request with the case as key
    by_req = {}
    for (case, req) in expect:
        by_req.setdefault(req, []).append(case)
    for req, cases in by_req.items():
        sub = df.where(F.col("case").isin(cases))
        for r in V.merge_metadata_sources(sub, req, seg_col="seg", keys=["case"]).collect():
            got.setdefault((r["case"], req), []).append((r["source_idx"], r["i"]))
    assert {k: sorted(v) for k, v in got.items() if v} == {k: v for k, v in expect.items() if v}


# ----------------------------------------------------------------- R1 / R6 / R9 / R10 vs numpy
def test_stitch_pyramid_boundaries_vs_numpy(spark):
    canvas, tile = 21, 6
    rng = np.random.default_rng(11)
    origins, tiles = [], []
    order = rng.permutation(14)
    for f in range(14):
        y0, x0 = int(rng.integers(0, canvas - 3)), int(rng.integers(0, canvas - 3))
        origins.append((f, y0, x0, int(order[f]), canvas, canvas))
        tiles.append(rng.integers(0, 4, size=(tile, tile)))
    im = np.zeros((canvas, canvas), dtype=np.int64)
    for f in sorted(range(14), key=lambda i: origins[i][3]):
        _, y0, x0, _, _, _ = origins[f]
        h = min(tile, canvas - y0)
        w = min(tile, canvas - x0)
        im[y0:y0 + h, x0:x0 + w] = tiles[f][:h, :w]
    o = spark.createDataFrame(origins, "fov int, y0 long, x0 long, paste_order long, canvas_h long, canvas_w long")
    t = spark.createDataFrame([(f, "c", r, c, int(tiles[f][r, c])) for f in range(14) for r in range(tile)
                               for c in range(tile)], "fov int, channel string, row int, col int, val long")
    m = R.stitch_mosaic(t, o)
    got = np.zeros_like(im)
    for r in m.collect():
        got[r["row"], r["col"]] = r["val"]
    assert (got == im).all()

    # pyramid: odd (bottom-right) sample, sizes max(1, n // 2)
    pyr = R.build_pyramid(m, canvas, canvas, min_size=2).collect()
    levels = max(1, int(np.floor(np.log2(canvas / 2))))
    ref = im
    for lv in range(levels):
        g = np.zeros_like(ref)
        for r in pyr:
            if r["level"] == lv:
                g[r["row"], r["col"]] = r["val"]
        assert (g == ref).all(), lv
        n0, n1 = ref.shape
        rows = [min(2 * i + 1, n0 - 1) for i in range(max(1, n0 // 2))]
        cols = [min(2 * j + 1, n1 - 1) for j in range(max(1, n1 // 2))]
        ref = ref[np.ix_(rows, cols)]

    # boundaries: any of 8 neighbours differs (edge replicated)
    pad = np.pad(im, 1, mode="edge")
    expect = np.zeros_like(im)
    for dy in (-1, 0, 1):
        for dx in (-1, 0, 1):
            expect |= (pad[1 + dy:1 + dy + canvas, 1 + dx:1 + dx + canvas] != im)
    b = np.zeros_like(im)
    for r in R.label_boundaries(m.drop("channel"), canvas, canvas).collect():
        b[r["row"], r["col"]] = r["val"]
    assert (b == expect).all()

    # contour k=2: dilation over the cross != erosion over the radius-2 diamond
    pad2 = np.pad(im, 2, mode="reflect")
    dil = im.copy()
    for dy, dx in ((-1, 0), (1, 0), (0, -1), (0, 1)):
        dil = np.maximum(dil, pad2[2 + dy:2 + dy + canvas, 2 + dx:2 + dx + canvas])
    ero = im.copy()
    for dy in range(-2, 3):
        for dx in range(-2, 3):
            if abs(dy) + abs(dx) <= 2:
                ero = np.minimum(ero, pad2[2 + dy:2 + dy + canvas, 2 + dx:2 + dx + canvas])
    expect_c = np.where(dil != ero, im, 0)
    cgot = np.zeros_like(im)
    for r in R.label_contour(m.drop("channel"), 2, canvas, canvas).collect():
        cgot[r["row"], r["col"]] = r["val"]
    assert (cgot == expect_c).all()


# ----------------------------------------------------------------- J9 vs brute force
def _pnpoly(r, c, verts):
    inside = False
    n = len(verts)
    for i in range(n):
        y1, x1 = verts[i]
        y2, x2 = verts[i - 1]
        if (y1 > r) != (y2 > r) and c < (x2 - x1) * (r - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def test_cells_in_shapes_vs_brute_force(spark):
    rng = np.random.default_rng(2)
    H = W = 40
    lab = rng.integers(0, 30, size=(H, W))
    shapes = [(1, "polygon", [(3.5, 3.5), (3.5, 30.5), (25.5, 30.5), (15.5, 15.5), (25.5, 3.5)]),
              (2, "rectangle", [(30.5, 2.5), (30.5, 12.5), (38.5, 12.5), (38.5, 2.5)]),
              (3, "ellipse", [(20.5, 20.5), (20.5, 36.5), (34.5, 36.5), (34.5, 20.5)]),
              (4, "path", [(0.5, 0.5), (39.5, 39.5)])]
    sdf = spark.createDataFrame([(i, k, [{"y": y, "x": x} for y, x in v]) for i, k, v in shapes],
                                "shape_id int, kind string, vertices array<struct<y:double,x:double>>")
    ldf = spark.createDataFrame([(r, c, int(lab[r, c])) for r in range(H) for c in range(W)],
                                "row int, col int, val long")
    got = {(r["shape_id"], r["UID"]) for r in R.cells_in_shapes(sdf, ldf, 1.0, (0.0, 0.0), H, W, bucket=8).collect()}
    from tessera.operators import blocks as BL
    bl = spark.createDataFrame([("labels", by, bx, 16 if by < 2 else H - 32, 16 if bx < 2 else W - 32, H, W,
                                 *BL.pack(lab[by * 16:(by + 1) * 16, bx * 16:(bx + 1) * 16]))
                                for by in range(3) for bx in range(3)], "channel string, " + BL.BLOCK_FIELDS)
    got_b = {(r["shape_id"], r["UID"]) for r in
             BL.cells_in_shapes_blocks(sdf, bl, 1.0, (0.0, 0.0), H, W, 16).collect()}
    assert got_b == got
    expect = set()
    for sid, kind, v in shapes:
        if kind not in ("polygon", "rectangle", "ellipse"):
            continue
        pv = [(float(int(y)), float(int(x))) for y, x in v]
        ys, xs = [p[0] for p in pv], [p[1] for p in pv]
        for r in range(max(int(min(ys)), 0), min(int(max(ys)), H - 1) + 1):
            for c in range(max(int(min(xs)), 0), min(int(max(xs)), W - 1) + 1):
                if kind == "ellipse":
                    er, ec = (pv[-1][0] - pv[0][0]) / 2, (pv[1][1] - pv[0][1]) / 2
                    ok = ((r - (pv[0][0] + er)) / er) ** 2 + ((c - (pv[0][1] + ec)) / ec) ** 2 < 1
                else:
                    ok = _pnpoly(r, c, pv)
                if ok and lab[r, c] != 0:
                    expect.add((sid, int(lab[r, c])))
    assert got == expect


# ----------------------------------------------------------------- block form == long form
def test_block_form_matches_long_form(spark):
    from tessera.operators import blocks as BL
    rng = np.random.default_rng(4)
    canvas, tile, n = 37, 9, 10
    origins = [(f, int(rng.integers(-2, canvas - 4)), int(rng.integers(0, canvas - 4)), int(o), canvas, canvas)
               for f, o in zip(range(n), rng.permutation(n))]
    o = spark.createDataFrame(origins, "fov int, y0 long, x0 long, paste_order long, canvas_h long, canvas_w long")
    t = spark.createDataFrame([(f, "c", r, c, int(rng.integers(0, 5))) for f in range(n) for r in range(tile)
                               for c in range(tile)], "fov int, channel string, row int, col int, val long")
    long_m = R.stitch_mosaic(t, o).where(F.col("val") != 0).select("channel", "row", "col", "val")
    blocks = BL.stitch_blocks(BL.pack_tiles(t, tile, tile, piece=4), o, block=8)
    got = BL.blocks_to_long(blocks, 8).select("channel", "row", "col", "val")
    assert got.exceptAll(long_m).count() == 0 and long_m.exceptAll(got).count() == 0
    lp = R.build_pyramid(R.stitch_mosaic(t, o), canvas, canvas, min_size=2).where(F.col("val") != 0)
    bp = BL.blocks_to_long(BL.pyramid_blocks(blocks, 8, min_size=2), 8)
    cols = ["channel", "level", "row", "col", "val"]
    assert bp.select(cols).exceptAll(lp.select(cols)).count() == 0
    assert lp.select(cols).exceptAll(bp.select(cols)).count() == 0


# ----------------------------------------------------------------- J3
def test_target_counts_equal_a_loop(spark):
    import collections
    from tessera.operators import transcripts as T
    from tessera.plans.bindings import Bindings
    b = Bindings(spark, "/root/testdata/sf0.001")
    cells = b.label_pixels.where(F.col("val") != 0).select("fov", "val").distinct()
    pairs = [tuple(r) for r in cells.collect()]
    uids = cells.select(K.pair_key("fov", "val").alias("UID"))
    calls = collections.Counter((r["fov"], r["CellId"], r["target"]) for r in b.target_calls.collect())
    want = collections.Counter()
    for (fov, cell, target), n in calls.items():
        want[target] += n * pairs.count((fov, cell))
    got = {r["target"]: r["count"] for r in T.target_counts_for_cells(uids, b.target_calls).collect()}
    assert got == {k: v for k, v in want.items() if v} and got
    # a cell listed twice counts twice
    twice = {r["target"]: r["count"] for r in T.target_counts_for_cells(uids.union(uids), b.target_calls).collect()}
    assert twice == {k: 2 * v for k, v in got.items()}


def test_tiles_overlap(spark):
    o = spark.createDataFrame([(1, 0, 0), (2, 0, 8), (3, 8, 0)], "fov int, y0 long, x0 long")
    assert not R.tiles_overlap(o, 8, 8)
    o2 = spark.createDataFrame([(1, 0, 0), (2, 0, 7)], "fov int, y0 long, x0 long")
    assert R.tiles_overlap(o2, 8, 8)


# ----------------------------------------------------------------- bounded exact median
def test_exact_median_bounded(spark):
    from tessera.operators.quantiles import exact_quantiles
    rng = np.random.default_rng(8)
    rows = [("big", float(v)) for v in rng.normal(size=20001)] + [("even", float(v)) for v in rng.normal(size=4000)]
    rows += [("small", 1.0), ("small", 2.0), ("small", 4.0), ("small", 9.0), ("one", 5.0)]
    rows += [("tied", 3.0)] * 5000 + [("mixed", 1.0)] * 500 + [("mixed", 2.0)] * 500 + [("mixed", float(v)) for v in rng.normal(size=999)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["m"][0] for r in exact_quantiles(df, ["g"], {"m": F.col("v")}, [0.5], accuracy=10_000).collect()}
    for g in ("big", "even", "small", "one", "tied", "mixed"):
        vals = np.array([v for k, v in rows if k == g])
        assert abs(got[g] - float(np.median(vals))) < 1e-12, g


def test_stitch_without_overlap_skips_aggregation(spark):
    o = spark.createDataFrame([(1, 0, 0, 1, 8, 8), (2, 0, 4, 2, 8, 8)],
                              "fov int, y0 long, x0 long, paste_order long, canvas_h long, canvas_w long")
    t = spark.createDataFrame([(f, "c", r, c, f * 10 + r) for f in (1, 2) for r in range(4) for c in range(4)],
                              "fov int, channel string, row int, col int, val long")
    import contextlib
    import io
    m = R.stitch_mosaic(t, o, tile_height=4, tile_width=4)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        m.explain()
    assert "Aggregate" not in buf.getvalue()
    agg = R.stitch_mosaic(t, o)
    assert sorted(tuple(r) for r in m.collect()) == sorted(tuple(r) for r in agg.collect())


def test_boundaries_block_form_matches_long_form(spark):
    from tessera.operators import blocks as BL
    rng = np.random.default_rng(21)
    H, W, B = 27, 22, 8
    # sparse labels: some 3x3 cells, large empty background, one region missing entirely
    px = {}
    for _ in range(25):
        r, c, v = int(rng.integers(0, H - 2)), int(rng.integers(0, W - 2)), int(rng.integers(1, 6))
        for dr in range(3):
            for dc in range(3):
                px[(r + dr, c + dc)] = v
    rows = [("labels", r, c, v) for (r, c), v in px.items() if not (r < 8 and c >= 16)]
    long = spark.createDataFrame(rows, "channel string, row long, col long, val long")
    ref = R.label_boundaries(long.drop("channel"), H, W).select("row", "col")
    # block table of the same image
    img = np.zeros((H, W), dtype=np.int64)
    for _, r, c, v in rows:
        img[r, c] = v
    blocks = []
    for by in range((H + B - 1) // B):
        for bx in range((W + B - 1) // B):
            a = img[by * B:(by + 1) * B, bx * B:(bx + 1) * B]
            if a.any():
                blocks.append(("labels", by, bx, *a.shape, H, W, *BL.pack(a)))
    bdf = spark.createDataFrame(blocks, "channel string, " + BL.BLOCK_FIELDS)
    got = BL.blocks_to_long(BL.boundaries_blocks(bdf, B), B).select("row", "col")
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_contour_block_form_matches_long_form(spark):
    from tessera.operators import blocks as BL
    rng = np.random.default_rng(5)
    H, W, B = 23, 30, 8
    img = np.zeros((H, W), dtype=np.int64)
    for _ in range(30):
        r, c, v = int(rng.integers(0, H - 3)), int(rng.integers(0, W - 3)), int(rng.integers(1, 7))
        img[r:r + 4, c:c + 4] = v
    img[0:8, 8:16] = 0   # an uncovered block inside the canvas
    rows = [(int(r), int(c), int(img[r, c])) for r in range(H) for c in range(W) if img[r, c] != 0]
    long = spark.createDataFrame(rows, "row long, col long, val long")
    blocks = []
    for by in range((H + B - 1) // B):
        for bx in range((W + B - 1) // B):
            a = img[by * B:(by + 1) * B, bx * B:(bx + 1) * B]
            if a.any():
                blocks.append(("labels", by, bx, *a.shape, H, W, *BL.pack(a)))
    bdf = spark.createDataFrame(blocks, "channel string, " + BL.BLOCK_FIELDS)
    for k in (1, 2, 3):
        ref = R.label_contour(long, k, H, W).select("row", "col", "val")
        got = BL.blocks_to_long(BL.contour_blocks(bdf, k, B), B).select("row", "col", "val")
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0, k
    ref = R.label_boundaries(long, H, W).select("row", "col")
    got = BL.blocks_to_long(BL.boundaries_blocks(bdf, B), B).select("row", "col")
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


# ----------------------------------------------------------------- many slides in one job
def test_multi_slide_equals_per_slide(spark):
    from tessera.operators import transcripts as T
    fovs = spark.createDataFrame(
        [(s, f, float(f % 3) * 0.5 + (0.25 if s == "B" else 0.0), float(f // 3) * 0.5, f) for s in ("A", "B")
         for f in range(1, 7)], "slide string, FOV int, X_mm double, Y_mm double, ord long")
    calls = spark.createDataFrame([(s, f, float(i), float(2 * i), "g") for s in ("A", "B") for f in range(1, 7)
                                   for i in range(3)], "slide string, fov int, x double, y double, target string")
    both = T.global_coordinates(calls, fovs, 8, 8, 12.0, keys=["slide"])
    for s in ("A", "B"):
        one = T.global_coordinates(calls.where(F.col("slide") == s).drop("slide"),
                                   fovs.where(F.col("slide") == s).drop("slide"), 8, 8, 12.0)
        a = both.where(F.col("slide") == s).drop("slide").select(sorted(one.columns))
        assert a.exceptAll(one.select(sorted(one.columns))).count() == 0
        assert one.select(sorted(one.columns)).exceptAll(a).count() == 0
    o2 = R.fov_origins(fovs, 8, 8, 12.0, keys=["slide"])
    tiles = spark.createDataFrame([(s, f, "c", r, c, f * 100 + r * 8 + c) for s in ("A", "B") for f in range(1, 7)
                                   for r in range(8) for c in range(8)],
                                  "slide string, fov int, channel string, row int, col int, val long")
    m2 = R.stitch_mosaic(tiles, o2, keys=["slide"])
    for s in ("A", "B"):
        o1 = R.fov_origins(fovs.where(F.col("slide") == s).drop("slide"), 8, 8, 12.0)
        m1 = R.stitch_mosaic(tiles.where(F.col("slide") == s).drop("slide"), o1)
        a = m2.where(F.col("slide") == s).drop("slide")
        assert a.exceptAll(m1).count() == 0 and m1.exceptAll(a).count() == 0
