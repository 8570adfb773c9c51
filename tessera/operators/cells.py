"""Cell-level analytics.

F1 drop_unannotated, F2 filter_fovs, F4 filter_segmentation, F8 subset_cells,
J1 expression_with_type, J4 match_cells, J5 shared_and_exclusive_slides,
J10 flag_cells, J12 assemble_counts, J14 density_compare, A1 cell_type_counts,
A2 dotplot_stats, A3 type_density, A4 cluster_labels, A5 type_flows,
A7 metadata_stats, O3 shared_types, O4 dotplot_matrix, P14 probe_label,
P15 detect_cell_type_column, P16 column_profile, P17 minmax_scale.

Cell tables are large (one row per cell of every slide); per-type or per-slide
results are tiny. Aggregations therefore run with partial aggregation first and
only the small results are broadcast back.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.color import HISTOGRAM_DEFAULT_COLOR
from ..util import attach, dense_index
from .quantiles import ACCURACY, exact_quantiles

# ---------------------------------------------------------------------------
# Fixed values.
CELL_TYPE_COLUMN_PATTERN = r"^RNA_RNA_Cell\.Typing\.InSituType\..*_clusters$"
MIN_FLOW_FRACTION = 0.005
NEURONAL_TYPES = ["Inhibitory.neuron.A", "Inhibitory.neuron.B", "Inhibitory.neuron.C",
                  "L2.3.neuron", "L4.neuron", "L6.neuron"]
DOT_SIZE_SCALE = 200
CATEGORICAL_MAX_DISTINCT = 30
NUMERIC = ("int", "bigint", "smallint", "tinyint", "double", "float")
# ---------------------------------------------------------------------------


def _c(c):
    return F.col(c) if isinstance(c, str) else c


# F1 -------------------------------------------------------------------------
def drop_unannotated(df: DataFrame, col: str = "cell_type", trim: bool = False) -> DataFrame:
    v = F.trim(F.col(col)) if trim else F.col(col)
    return df.where(F.col(col).isNotNull() & (v != ""))


# F2 -------------------------------------------------------------------------
def fov_set(ranges) -> list[int]:
    """Expand ``[(1, 20), 35, (40, 42)]`` (inclusive ranges or single FOVs)."""
    out: list[int] = []
    for r in ranges:
        if isinstance(r, (tuple, list)):
            out.extend(range(int(r[0]), int(r[1]) + 1))
        else:
            out.append(int(r))
    return sorted(set(out))


def filter_fovs(df: DataFrame, fovs, col: str = "fov") -> DataFrame:
    """Membership in a literal FOV set (an IN list pushes into the parquet scan)."""
    return df.where(F.col(col).isin(fov_set(fovs)))


# F4 -------------------------------------------------------------------------
def filter_segmentation(df: DataFrame, ids: str | None, col: str = "seg_id") -> DataFrame:
    """Keep rows whose stripped segmentation id is in the comma-separated set."""
    if ids is None or ids.strip() == "":
        return df
    wanted = sorted({s.strip() for s in ids.split(",") if s.strip()})
    return df.where(F.trim(F.col(col)).isin(wanted))


# F8 -------------------------------------------------------------------------
def subset_cells(df: DataFrame, col: str, values: DataFrame) -> DataFrame:
    """Cells whose ``col`` is among ``values`` (single-column frame), cast to the
    column type first; the value list is broadcast into a semi join."""
    typ = dict(df.dtypes)[col]
    v = values.select(F.col(values.columns[0]).cast(typ).alias(col)).distinct()
    return df.join(v, col, "left_semi")


# J1 -------------------------------------------------------------------------
def expression_with_type(expr: DataFrame, meta: DataFrame, type_col: str = "cell_type") -> DataFrame:
    """Inner join on (fov, cell_ID); both sides are per-cell and unique per key,
    so a shuffle join on the composite key is balanced."""
    m = meta.select("fov", "cell_ID", F.col(type_col).alias("cell_type"))
    return expr.join(m, ["fov", "cell_ID"])


def expression_long(expr_wide: DataFrame, genes: list[str]) -> DataFrame:
    """Wide (fov, cell_ID, gene...) -> long (fov, cell_ID, gene, count)."""
    keys = [c for c in expr_wide.columns if c not in genes]
    return expr_wide.unpivot(keys, [f"`{g}`" for g in genes], "gene", "count")


# J4 -------------------------------------------------------------------------
def last_per_key(df: DataFrame, key: str, value: str, order: str = "row_idx") -> DataFrame:
    """One row per key; duplicated keys keep the last row (``max_by``)."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def match_cells(a: DataFrame, b: DataFrame, key: str = "cell_name", type_col: str = "cell_type",
                order: str = "row_idx") -> DataFrame:
    """Same cells in two experiments; empty types are legal, NULL becomes ''."""
    la = last_per_key(a.select(key, F.coalesce(F.col(type_col), F.lit("")).alias("type_a"), order),
                      key, "type_a", order)
    lb = last_per_key(b.select(key, F.coalesce(F.col(type_col), F.lit("")).alias("type_b"), order),
                      key, "type_b", order)
    return la.join(lb, key)


# J5 -------------------------------------------------------------------------
def shared_and_exclusive_slides(a: DataFrame, b: DataFrame, col: str = "slide") -> DataFrame:
    """(slide, in_a, in_b, status) with status both / only_a / only_b."""
    da = a.select(col).distinct().withColumn("in_a", F.lit(True))
    db = b.select(col).distinct().withColumn("in_b", F.lit(True))
    j = da.join(db, col, "full").select(col, F.coalesce("in_a", F.lit(False)).alias("in_a"),
                                        F.coalesce("in_b", F.lit(False)).alias("in_b"))
    return j.withColumn("status", F.when(F.col("in_a") & F.col("in_b"), "both")
                        .when(F.col("in_a"), "only_a").otherwise("only_b"))


# A5 -------------------------------------------------------------------------
def type_flows(matched: DataFrame, keys: list[str] = (), fraction: float = MIN_FLOW_FRACTION):
    """Reclassification flows between two experiments.

    Returns (links, nodes, summary):
      links   (keys, type_a, type_b, n) for flows with n >= floor(total * fraction)
      nodes   (keys, side, type, total, node_order) totals from kept flows only,
              ordered by total desc then type
      summary (keys, total, changed, changed_pct) over ALL flows
    """
    keys = list(keys)
    flows = matched.groupBy(*keys, "type_a", "type_b").agg(F.count(F.lit(1)).alias("n"))
    summ = flows.groupBy(*keys).agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("type_a") != F.col("type_b"), F.col("n")).otherwise(0)).alias("changed"))
    # no shared cells -> no summary row (the original divided by zero there)
    summ = summ.where(F.col("total") > 0)
    summ = summ.withColumn("changed_pct", F.round(F.col("changed") * 100.0 / F.col("total"), 6))
    thr = summ.select(*keys, F.floor(F.col("total") * F.lit(fraction)).alias("min_flow"))
    kept = attach(flows, thr, keys)
    kept = kept.where(F.col("n") >= F.col("min_flow")).drop("min_flow")
    na = kept.groupBy(*keys, F.col("type_a").alias("type")).agg(F.sum("n").alias("total")).withColumn("side", F.lit("a"))
    nb = kept.groupBy(*keys, F.col("type_b").alias("type")).agg(F.sum("n").alias("total")).withColumn("side", F.lit("b"))
    from pyspark.sql import Window
    w = Window.partitionBy(*keys, "side").orderBy(F.desc("total"), "type")
    nodes = na.unionByName(nb).withColumn("node_order", F.row_number().over(w))
    return kept, nodes, summ


# A1 -------------------------------------------------------------------------
def cell_type_counts(df: DataFrame, slide_col: str = "slide", type_col: str = "cell_type",
                     color_col: str = "hex_color", order: str = "row_idx") -> DataFrame:
    """Per slide and stripped non-empty type: count, first non-empty colour
    (default #4C72B0), rank by count desc then first appearance."""
    t = F.trim(F.col(type_col))
    d = df.select(slide_col, t.alias("cell_type"),
                  F.when(F.trim(F.col(color_col)) != "", F.trim(F.col(color_col))).alias("_col"),
                  F.col(order).alias("_o")).where(F.col("cell_type").isNotNull() & (F.col("cell_type") != ""))
    g = d.groupBy(slide_col, "cell_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("_col", F.when(F.col("_col").isNotNull(), F.col("_o"))).alias("_c"),
        F.min("_o").alias("_first"))
    from pyspark.sql import Window
    w = Window.partitionBy(slide_col).orderBy(F.desc("n"), "_first")
    return (g.withColumn("color", F.coalesce("_c", F.lit(HISTOGRAM_DEFAULT_COLOR)))
             .withColumn("rank", F.row_number().over(w))
             .drop("_c", "_first"))


# A2 -------------------------------------------------------------------------
def dotplot_stats(df_long: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Per (keys, cell_type, gene): fraction of cells with count > 0 and mean count
    over all cells of the type (long input: one row per cell and gene)."""
    return df_long.groupBy(*keys, "cell_type", "gene").agg(
        F.avg((F.col("count") > 0).cast("double")).alias("pct_expressed"),
        F.avg(F.col("count").cast("double")).alias("mean_expression"))


GENE_CHUNK = 1024  # genes of one array column
HELD_SUMS = 4 << 20  # sums a task holds before it sends them on


def gene_sums(df_wide: DataFrame, genes: list[str], group: list[str]) -> DataFrame:
    """(group, gene, total, positive, present) from the wide matrix: each gene's sum, count of
    values above 0 and count of values. Every task adds its rows up in numpy, so what
    leaves it is one row a group and gene, however many cells there are."""
    chunks = [genes[k:k + GENE_CHUNK] for k in range(0, len(genes), GENE_CHUNK)]
    types = dict(df_wide.dtypes)

    def array(chunk, name):
        """One array column instead of thousands of columns; one SQL text, for there are many."""
        plain = len({types[g] for g in chunk}) == 1 and types[chunk[0]] in NUMERIC
        quoted = ["`" + g.replace("`", "``") + "`" for g in chunk]
        return f"array({', '.join(quoted if plain else [f'CAST({q} AS DOUBLE)' for q in quoted])}) AS {name}"

    rows = df_wide.selectExpr(*[f"`{g}`" for g in group], *[array(c, f"c{k}") for k, c in enumerate(chunks)])
    names = pa.array(genes)

    def add(batches):
        sums: dict = {}
        schema = None
        for b in batches:
            if not b.num_rows:
                continue
            schema = schema or [b.schema.field(g).type for g in group]
            keys = list(zip(*[b.column(g).to_pylist() for g in group]))
            place = {k: i for i, k in enumerate(dict.fromkeys(keys))}
            owner = np.array([place[k] for k in keys])
            order = np.argsort(owner, kind="stable")
            first = np.flatnonzero(np.diff(owner[order], prepend=-1))
            parts = []
            for k, c in enumerate(chunks):
                values = b.column(f"c{k}").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(c))[order].astype(float)
                seen = ~np.isnan(values)
                parts.append([np.add.reduceat(x, first) for x in (np.where(seen, values, 0), (values > 0).astype(np.int64), seen.astype(np.int64))])
            total, positive, present = (np.concatenate([p[n] for p in parts], axis=1) for n in range(3))
            for i, key in enumerate(place):
                had = sums.get(key)
                own = [total[i], positive[i], present[i]]
                sums[key] = own if had is None else [x + y for x, y in zip(had, own)]
            if len(sums) * len(genes) > HELD_SUMS:  # many groups: what is added up so far goes on
                yield from write(sums, schema)
                sums = {}
        yield from write(sums, schema)

    def write(sums, schema):
        for key, own in sums.items():
            columns = [pa.array([v], t).take(pa.array(np.zeros(len(genes), np.int32))) for v, t in zip(key, schema)]
            yield pa.RecordBatch.from_arrays([*columns, names, *map(pa.array, own)], names=[*group, "gene", "total", "positive", "present"])

    fields = ", ".join(f"`{g}` {types[g]}" for g in group) + ", gene string, total double, positive long, present long"
    return rows.mapInArrow(add, fields)


def dotplot_stats_wide(df_wide: DataFrame, genes: list[str], keys: list[str] = ()) -> DataFrame:
    """Same statistics from the wide matrix, for any number of genes: tasks add their rows up
    as arrays (:func:`gene_sums`); the sums, one a task, group and gene, are then added by
    (group, gene)."""
    group = [*keys, "cell_type"]
    each = gene_sums(df_wide, genes, group).groupBy(*group, "gene").agg(
        F.sum("total").alias("t"), F.sum("positive").alias("p"), F.sum("present").alias("n"))
    share = lambda c: F.try_divide(F.col(c).cast("double"), F.col("n").cast("double"))
    return each.select(*group, "gene", share("p").alias("pct_expressed"), share("t").alias("mean_expression"))


# A3 / J14 -------------------------------------------------------------------
def type_density(df: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Cells of each type divided by the number of distinct FOVs of the slide."""
    keys = list(keys)
    n = df.groupBy(*keys, "cell_type").agg(F.count(F.lit(1)).alias("n"))
    f = df.groupBy(*keys).agg(F.countDistinct("fov").alias("n_fovs"))
    j = attach(n, f, keys)
    return j.select(*keys, "cell_type", (F.col("n") / F.col("n_fovs")).alias("density"))


def density_compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Full outer join of two density tables on type; missing -> 0."""
    x = a.select("cell_type", F.col("density").alias("density_a"))
    y = b.select("cell_type", F.col("density").alias("density_b"))
    return x.join(y, "cell_type", "full").select(
        "cell_type", F.coalesce("density_a", F.lit(0.0)).alias("density_a"),
        F.coalesce("density_b", F.lit(0.0)).alias("density_b"))


# A4 -------------------------------------------------------------------------
def cluster_labels(df: DataFrame, keys: list[str] = (), exact: bool = True, accuracy: int = ACCURACY) -> DataFrame:
    """Per type: median UMAP_1/UMAP_2, n, percent of all cells, ``"type (p%)"``.

    ``exact`` gives the exact interpolating medians of both columns in two scans
    (:func:`tessera.operators.quantiles.exact_quantiles`); ``exact=False`` is the one-pass
    sketch (``percentile_approx``).
    """
    keys = list(keys)
    gk = keys + ["cell_type"]
    count = F.count(F.lit(1))
    if exact:
        g = exact_quantiles(df, gk, {"median_1": F.col("UMAP_1"), "median_2": F.col("UMAP_2")}, [0.5], {"n": count}, accuracy)
        g = g.select(*gk, F.col("median_1")[0].alias("median_1"), F.col("median_2")[0].alias("median_2"), "n")
    else:
        g = df.groupBy(*gk).agg(F.percentile_approx("UMAP_1", 0.5, accuracy).alias("median_1"),
                                F.percentile_approx("UMAP_2", 0.5, accuracy).alias("median_2"), count.alias("n"))
    # types of a slide: a handful of rows, so the total is a window over them
    pct = F.col("n") / F.sum("n").over(Window.partitionBy(*keys)) * 100
    return (g.withColumn("pct", pct)
             .withColumn("label", F.concat(F.col("cell_type"), F.lit(" ("),
                                           F.regexp_replace(F.format_number(F.col("pct"), 1), ",", ""), F.lit("%)"))))


# A7 -------------------------------------------------------------------------
def metadata_stats(raw: DataFrame, kept: DataFrame, seg_col: str = "seg_id",
                   type_col: str = "cell_type", keys: list[str] = ()) -> DataFrame:
    """Per ``keys``: rows read (``raw``: the rows of every source that was read), rows
    written (all of ``kept``, typed or not), rows filtered, number of non-empty
    types, segmentation ids seen (sorted set), in one aggregation per frame."""
    keys = list(keys)
    r = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_read"),
                               F.sort_array(F.collect_set(F.trim(F.col(seg_col)))).alias("seg_ids_seen"))
    typed = F.when(F.col(type_col) != "", F.col(type_col))
    k = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_written"), F.count_distinct(typed).alias("n_types"))
    j = r.join(k, keys, "left") if keys else attach(r, k)
    written = F.coalesce("rows_written", F.lit(0))
    return j.select(*keys, "rows_read", written.alias("rows_written"),
                    (F.col("rows_read") - written).alias("rows_filtered"),
                    F.coalesce("n_types", F.lit(0)).alias("n_types"), "seg_ids_seen")


# O3 / O4 --------------------------------------------------------------------
def shared_types(a: DataFrame, b: DataFrame, only: list[str] | None = None) -> DataFrame:
    s = a.select("cell_type").intersect(b.select("cell_type"))
    if only is not None:
        s = s.where(F.col("cell_type").isin(list(only)))
    return s.orderBy("cell_type")


def dotplot_matrix(stats_a: DataFrame, stats_b: DataFrame, label_a: str = "A", label_b: str = "B",
                   only: list[str] | None = None) -> DataFrame:
    """Both slides' stats on their shared types; colour = mean / shared max mean,
    size = pct * 200."""
    st = shared_types(stats_a, stats_b, only)
    u = (stats_a.withColumn("slide", F.lit(label_a))
         .unionByName(stats_b.withColumn("slide", F.lit(label_b))))
    u = u.join(st, "cell_type", "left_semi")
    mx = u.agg(F.max("mean_expression").alias("_vmax"))
    j = attach(u, mx)
    return j.select("slide", "cell_type", "gene", "pct_expressed", "mean_expression",
                    F.when(F.col("_vmax") > 0, F.col("mean_expression") / F.col("_vmax"))
                     .otherwise(F.lit(0.0)).alias("color_value"),
                    (F.col("pct_expressed") * DOT_SIZE_SCALE).alias("dot_size"))


# P14 ------------------------------------------------------------------------
def probe_label(df: DataFrame, dictionary: DataFrame, col: str = "probe", to_name: bool = True,
                out: str = "label", tag: str | None = None) -> DataFrame:
    """ProbeID -> DisplayName (duplicate ids: last wins) or name -> ProbeID
    (duplicate names: first wins). Only ids containing ``CPRO`` are renamed; the
    lookup happens before an optional tag is appended."""
    if to_name:
        d = dictionary.groupBy("ProbeID").agg(F.max_by("DisplayName", "ord").alias("_name"))
        j = df.join(d, df[col] == d["ProbeID"], "left").drop("ProbeID")
        res = F.when(F.col(col).contains("CPRO"), F.coalesce("_name", F.col(col))).otherwise(F.col(col))
    else:
        d = dictionary.groupBy("DisplayName").agg(F.min_by("ProbeID", "ord").alias("_name"))
        j = df.join(d, df[col] == d["DisplayName"], "left").drop("DisplayName")
        res = F.coalesce("_name", F.col(col))
    if tag:
        res = F.concat(res, F.lit(f"_{tag}"))
    return j.withColumn(out, res).drop("_name")


# P15 ------------------------------------------------------------------------
def detect_cell_type_column(columns: list[str], override: str | None = None) -> str | None:
    """First header matching the typing-column pattern (plan-time choice)."""
    if override:
        return override
    for c in columns:
        if re.match(CELL_TYPE_COLUMN_PATTERN, c):
            return c
    return None


def with_cell_type(df: DataFrame, override: str | None = None) -> DataFrame:
    c = detect_cell_type_column(df.columns, override)
    return df.withColumn("cell_type", F.col(f"`{c}`") if c else F.lit(None).cast("string"))


# P16 ------------------------------------------------------------------------
def column_profile(df: DataFrame, columns: list[str] | None = None,
                   max_distinct: int = CATEGORICAL_MAX_DISTINCT) -> DataFrame:
    """(column, n_distinct incl. null, numeric, categorical): exact counts, for a handful of
    columns (each is counted on its own copy of the rows); :func:`categorical_columns`
    answers for all columns of a wide table."""
    columns = columns or df.columns
    types = dict(df.dtypes)
    aggs = []
    for c in columns:
        aggs += [F.count_distinct(F.col(f"`{c}`")).alias(f"d_{c}"),
                 F.max(F.col(f"`{c}`").isNull().cast("int")).alias(f"n_{c}")]
    r = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"),
                     (F.col(f"d_{c}") + F.coalesce(F.col(f"n_{c}"), F.lit(0))).alias("n_distinct"),
                     F.lit(types[c] in NUMERIC or types[c].startswith("decimal")).alias("numeric"))
            for c in columns]
    out = r.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    return out.withColumn("categorical", (~F.col("numeric")) | (F.col("n_distinct") < max_distinct))


def categorical_columns(df: DataFrame, columns: list[str] | None = None, max_distinct: int = CATEGORICAL_MAX_DISTINCT) -> DataFrame:
    """(column, numeric, categorical): not a number, or fewer than ``max_distinct``
    values, null counted as one. For any number of columns in one pass: a task keeps at
    most ``max_distinct`` values of a column and stops looking once it has them, and
    the few kept are merged; no row is repeated for a column."""
    columns, types = columns or df.columns, dict(df.dtypes)
    numbers = [c for c in columns if types[c] in NUMERIC or types[c].startswith("decimal")]

    def seen(batches):
        kept = [set() for _ in numbers]
        for b in batches:
            for k, have in enumerate(kept):
                if len(have) < max_distinct:
                    have.update(repr(v) if v else None if v is None else "0" for v in b.column(k).unique().to_pylist())
        names = [numbers[k] for k, have in enumerate(kept) for _ in list(have)[:max_distinct]]
        values = [v for have in kept for v in list(have)[:max_distinct]]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.string())], names=["column", "value"])

    listed = df.sparkSession.createDataFrame([(k, c, c in numbers) for k, c in enumerate(columns)], "_k int, column string, numeric boolean")
    few = F.col("n").isNull() | (F.col("n") < max_distinct)
    if numbers:
        found = df.select(*[F.col(f"`{c}`") for c in numbers]).mapInArrow(seen, "column string, value string").groupBy("column").agg(
            (F.count_distinct("value") + F.coalesce(F.max(F.col("value").isNull().cast("int")), F.lit(0))).alias("n"))
        listed = listed.join(found, "column", "left")
    else:
        listed = listed.withColumn("n", F.lit(None).cast("long"))
    return listed.select("column", "numeric", (~F.col("numeric") | few).alias("categorical"))


# P17 ------------------------------------------------------------------------
def minmax_scale(df: DataFrame, col: str, out: str | None = None, subset: Column | None = None) -> DataFrame:
    """Scale to [0, 1] with min/max of the whole table, then keep ``subset``;
    a constant column scales to 0."""
    out = out or f"{col}_scaled"
    mm = df.agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
    j = attach(df, mm)
    j = j.withColumn(out, F.when(F.col("_mx") == F.col("_mn"), F.lit(0.0))
                     .otherwise((F.col(col) - F.col("_mn")) / (F.col("_mx") - F.col("_mn"))))
    j = j.drop("_mn", "_mx")
    return j.where(subset) if subset is not None else j


# J10 ------------------------------------------------------------------------
def flag_cells(meta: DataFrame, cells_by_layer: DataFrame, layers: list[str],
               uid_col: str = "UID", keys: list[str] = ()) -> DataFrame:
    """One boolean column per annotation layer: is the cell (of this slide, with
    ``keys``) in that layer."""
    on = [*keys, uid_col]
    p = (cells_by_layer.select(*on, "layer").distinct()
         .groupBy(*on).pivot("layer", list(layers)).agg(F.lit(True)))
    j = meta.join(p, on, "left")
    for l in layers:
        j = j.withColumn(l, F.coalesce(F.col(f"`{l}`"), F.lit(False)))
    return j


# J12 ------------------------------------------------------------------------
def assemble_counts(counts: DataFrame, obs: DataFrame, var: DataFrame,
                    coords: DataFrame | None = None, umap: DataFrame | None = None) -> DataFrame:
    """Positional assembly: COO (cell_idx, gene_idx, count) joined to obs / var by
    their dense 0-based file-order index (``idx``), coords / umap by row number.
    Returns the long table (cell, gene, count, obs/coords/umap columns)."""
    o = obs.withColumnRenamed("idx", "cell_idx")
    v = var.withColumnRenamed("idx", "gene_idx")
    j = counts.join(o, "cell_idx").join(v, "gene_idx")
    if coords is not None:
        j = j.join(coords.withColumnRenamed("idx", "cell_idx"), "cell_idx", "left")
    if umap is not None:
        j = j.join(umap.withColumnRenamed("idx", "cell_idx"), "cell_idx", "left")
    return j


def category_colors(obs: DataFrame, column: str, colors: DataFrame) -> DataFrame:
    """The colours of a categorical obs column, one row per category in category
    order (position, category, color). ``colors`` = (value, color[, ord]); the last
    entry of a value wins. A category without a colour fails the job when the rows
    are produced."""
    d = colors.groupBy("value").agg(F.max_by("color", "ord").alias("color") if "ord" in colors.columns
                                    else F.max("color").alias("color"))
    c = dense_index(obs.select(F.col(column).cast("string").alias("category")).where("category IS NOT NULL").distinct(),
                    "category", "position")
    j = c.join(d, c["category"] == d["value"], "left")
    missing = F.raise_error(F.concat(F.lit(f"no color for {column} "), F.col("category")))
    return j.select("position", "category", F.coalesce(F.col("color"), missing).alias("color"))
