"""Shapes over a raster (J9): which grid cells a drawn shape covers, and how.

:func:`cover` splits a shape's bounding box like a quadtree. A cell that no edge passes
through is wholly inside or outside; the others split down to the grid. Inside cells
carry no geometry; a cell on the outline carries the edges that pass through it and, for
the edges right of it, the rows at which they change the even-odd count. So a pixel is
tested only in the cells of the outline, and only against what lies in its own cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CELL = ("by long, bx long, inside boolean, kind string, edges array<struct<y1:double,x1:double,y2:double,x2:double>>, flips array<long>, "
        "ymin long, ymax long, xmin long, xmax long, er double, ec double, ey double, ex double")


def pixel_shapes(shapes: DataFrame, mm_per_px: float, top_left_mm, height, width) -> DataFrame:
    """Shapes with integer pixel vertices ``pv`` (truncated), their box clipped to the canvas
    and ellipse radii and centre from the box vertices; kinds other than polygon /
    rectangle / ellipse are dropped."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    ppm, (tly, tlx) = 1 / mm_per_px, top_left_mm
    s = shapes.where(F.col("kind").isin("polygon", "rectangle", "ellipse")).withColumn("pv", F.transform("vertices", lambda v: F.struct(
        ((v["y"] * F.lit(mm_per_px) - lit(tly)) * F.lit(ppm)).cast("long").cast("double").alias("y"),
        ((v["x"] * F.lit(mm_per_px) - lit(tlx)) * F.lit(ppm)).cast("long").cast("double").alias("x"))))
    ys, xs = F.transform("pv", lambda v: v["y"]), F.transform("pv", lambda v: v["x"])
    s = (s.withColumn("ymin", F.greatest(F.array_min(ys), F.lit(0.0)).cast("long"))
          .withColumn("ymax", F.least(F.array_max(ys), lit(height) - 1).cast("long"))
          .withColumn("xmin", F.greatest(F.array_min(xs), F.lit(0.0)).cast("long"))
          .withColumn("xmax", F.least(F.array_max(xs), lit(width) - 1).cast("long")))
    return (s.withColumn("er", (F.element_at("pv", -1)["y"] - F.element_at("pv", 1)["y"]) / 2)
             .withColumn("ec", (F.element_at("pv", 2)["x"] - F.element_at("pv", 1)["x"]) / 2)
             .withColumn("ey", F.element_at("pv", 1)["y"] + F.col("er"))
             .withColumn("ex", F.element_at("pv", 1)["x"] + F.col("ec")))


def crossing(edges: np.ndarray, row) -> np.ndarray:
    """Where each edge (y1, x1, y2, x2) crosses a row it spans."""
    y1, x1, y2, x2 = edges.T
    return (x2 - x1) * (row - y1) / (y2 - y1) + x1


def _clip_flips(flips: set[int], first: int, last: int) -> set[int]:
    """The same even-odd count on the rows first..last: earlier changes count at ``first``."""
    out = {t for t in flips if first < t <= last}
    return out | {first} if sum(t <= first for t in flips) % 2 else out


def polygon_cells(edges: np.ndarray, box: tuple[int, int, int, int], grid: int) -> Iterator[tuple]:
    """(by, bx, inside, edges, flips) of every grid cell with a pixel of the polygon: pixels
    (r, c) of the box (ymin, ymax, xmin, xmax) right of which an odd number of edges
    crosses row r. Only cells that an edge passes through, or whose rows differ, split."""
    ymin, ymax, xmin, xmax = box
    edges = edges[edges[:, 0] != edges[:, 2]]
    todo = [(ymin // grid, ymax // grid, xmin // grid, xmax // grid, edges, set())]
    while todo:
        by0, by1, bx0, bx1, edges, flips = todo.pop()
        r0, r1 = max(by0 * grid, ymin), min((by1 + 1) * grid - 1, ymax)
        c0, c1 = max(bx0 * grid, xmin), min((bx1 + 1) * grid - 1, xmax)
        low, high = np.minimum(edges[:, 0], edges[:, 2]), np.maximum(edges[:, 0], edges[:, 2])
        spans = (low <= r1) & (high > r0)  # an edge counts on rows low <= r < high
        edges, low, high = edges[spans], low[spans], high[spans]
        a, b = crossing(edges, np.maximum(low, r0)), crossing(edges, np.minimum(high - 1, r1))
        right, left = np.minimum(a, b) > c1, np.maximum(a, b) <= c0
        flips = set(flips)
        for x, y in zip(low[right], high[right]):
            flips ^= {int(x)}
            flips ^= {int(y)}
        flips, near = _clip_flips(flips, r0, r1), edges[~right & ~left]
        if not len(near) and not flips:
            continue
        one = by0 == by1 and bx0 == bx1
        if not len(near) and flips == {r0}:
            for by in range(by0, by1 + 1):
                for bx in range(bx0, bx1 + 1):
                    whole = by * grid >= ymin and (by + 1) * grid - 1 <= ymax and bx * grid >= xmin and (bx + 1) * grid - 1 <= xmax
                    yield by, bx, whole, near, flips  # cells the box cuts keep the test of the box
        elif one:
            yield by0, bx0, False, near, flips
        else:
            my, mx = (by0 + by1) // 2, (bx0 + bx1) // 2
            for y0, y1 in ((by0, my), (my + 1, by1)):
                for x0, x1 in ((bx0, mx), (mx + 1, bx1)):
                    if y0 <= y1 and x0 <= x1:
                        todo.append((y0, y1, x0, x1, near, flips))


def ellipse_cells(er: float, ec: float, ey: float, ex: float, box: tuple[int, int, int, int], grid: int) -> Iterator[tuple]:
    """As :func:`polygon_cells` for pixels with ((r - ey) / er)^2 + ((c - ex) / ec)^2 < 1."""
    ymin, ymax, xmin, xmax = box
    if not er or not ec:
        return
    at = lambda r, c: ((r - ey) / er) ** 2 + ((c - ex) / ec) ** 2
    todo = [(ymin // grid, ymax // grid, xmin // grid, xmax // grid)]
    none = np.zeros((0, 4))
    while todo:
        by0, by1, bx0, bx1 = todo.pop()
        r0, r1, c0, c1 = by0 * grid, (by1 + 1) * grid - 1, bx0 * grid, (bx1 + 1) * grid - 1
        if at(min(max(ey, r0), r1), min(max(ex, c0), c1)) >= 1:
            continue
        boxed = r0 >= ymin and r1 <= ymax and c0 >= xmin and c1 <= xmax
        if boxed and max(at(r, c) for r in (r0, r1) for c in (c0, c1)) < 1:
            yield from ((by, bx, True, none, ()) for by in range(by0, by1 + 1) for bx in range(bx0, bx1 + 1))
        elif by0 == by1 and bx0 == bx1:
            yield by0, bx0, False, none, ()
        else:
            my, mx = (by0 + by1) // 2, (bx0 + bx1) // 2
            todo += [(y0, y1, x0, x1) for y0, y1 in ((by0, my), (my + 1, by1)) for x0, x1 in ((bx0, mx), (mx + 1, bx1)) if y0 <= y1 and x0 <= x1]


def cover(shapes: DataFrame, mm_per_px: float, top_left_mm, height, width, grid: int, keys: list[str] = ()) -> DataFrame:
    """(keys, shape_id, cell) of every grid cell that a shape may cover; the fields of a cell
    are ``CELL``. A shape is one row, as it was drawn; its cells are as many as it covers."""
    keys = list(keys)
    s = pixel_shapes(shapes, mm_per_px, top_left_mm, height, width)
    s = s.where((F.col("ymax") >= F.col("ymin")) & (F.col("xmax") >= F.col("xmin")))
    s = s.select(*keys, "shape_id", "kind", "pv", "ymin", "ymax", "xmin", "xmax", "er", "ec", "ey", "ex")
    schema = StructType([s.schema[k] for k in [*keys, "shape_id"]] + StructType.fromDDL(CELL).fields)
    arrow, names = to_arrow_schema(schema), ("y1", "x1", "y2", "x2")

    def split(batches):
        for batch in batches:
            for row in batch.to_pylist():
                box = tuple(row[c] for c in ("ymin", "ymax", "xmin", "xmax"))
                radii = tuple(row[c] for c in ("er", "ec", "ey", "ex"))
                if row["kind"] == "ellipse":
                    cells = ellipse_cells(*radii, box, grid)
                else:
                    v = np.array([(p["y"], p["x"]) for p in row["pv"]], float)
                    cells = polygon_cells(np.hstack([v, np.roll(v, 1, axis=0)]), box, grid)
                own, held = [row[k] for k in [*keys, "shape_id"]], []
                for by, bx, inside, edges, flips in cells:
                    edges = [] if inside else [dict(zip(names, e)) for e in edges.tolist()]
                    held.append((*own, by, bx, inside, row["kind"], edges, [] if inside else sorted(flips), *box, *radii))
                    if len(held) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    return s.mapInArrow(split, schema)


def inside_test(row: Column, col: Column) -> Column:
    """Whether a pixel that met a cell of :func:`cover` is inside the shape."""
    r, c = row.cast("double"), col.cast("double")
    boxed = row.between(F.col("ymin"), F.col("ymax")) & col.between(F.col("xmin"), F.col("xmax"))

    def crosses(e):
        at = (e["x2"] - e["x1"]) * (r - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        return ((e["y1"] > r) != (e["y2"] > r)) & (c < at)

    odd = (F.size(F.filter("flips", lambda t: t <= row)) + F.size(F.filter("edges", crosses))) % 2 == 1
    round_ = F.pow((r - F.col("ey")) / F.col("er"), 2) + F.pow((c - F.col("ex")) / F.col("ec"), 2) < 1
    return F.col("inside") | (boxed & F.when(F.col("kind") == "ellipse", round_).otherwise(odd))


def inside_mask(cell: dict, top: int, left: int, h: int, w: int) -> np.ndarray:
    """:func:`inside_test` for all pixels of a block at (top, left)."""
    r, c = np.arange(top, top + h, dtype=float)[:, None], np.arange(left, left + w, dtype=float)[None, :]
    boxed = (r >= cell["ymin"]) & (r <= cell["ymax"]) & (c >= cell["xmin"]) & (c <= cell["xmax"])
    if cell["kind"] == "ellipse":
        return boxed & (((r - cell["ey"]) / cell["er"]) ** 2 + ((c - cell["ex"]) / cell["ec"]) ** 2 < 1)
    odd = np.repeat(np.searchsorted(np.array(cell["flips"], float), r[:, 0], "right")[:, None], w, axis=1)
    for e in cell["edges"]:
        spans = np.flatnonzero((e["y1"] > r[:, 0]) != (e["y2"] > r[:, 0]))
        at = (e["x2"] - e["x1"]) * (r[spans] - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        odd[spans] += c < at
    return boxed & (odd % 2 == 1)
