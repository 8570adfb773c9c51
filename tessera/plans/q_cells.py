"""Registered cell-analytics queries (slide A = cell_meta, slide B = cell_meta_b)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.color import deterministic_color, palette_color, rgba_from_hex, PALETTE
from ..operators import cells as C
from ..util import rnd
from .bindings import GENES, Bindings, with_ctes
from .registry import query

SLIDE_B_FOVS = [(1, 12), 20]
_B_FOVS_SQL = "(1,2,3,4,5,6,7,8,9,10,11,12,20)"
_COLOR_SQL = "CASE WHEN {c} IS NULL OR {c} = '' THEN '' ELSE '#' || upper(substr(md5({c}), 1, 6)) END"


def _meta_out(b: Bindings, which: str = "a"):
    m = b.cell_meta if which == "a" else b.cell_meta_b
    return m.withColumn("hex_color", deterministic_color("cell_type"))


# ---------------------------------------------------------------- P7
query("deterministic_color", with_ctes(f"""
SELECT cell_name AS cell_ID, cell_type, {_COLOR_SQL.format(c='cell_type')} AS hex_color FROM cell_meta""",
                                       "cell_meta"))(
    lambda spark, d: _meta_out(Bindings(spark, d)).select(F.col("cell_name").alias("cell_ID"), "cell_type", "hex_color"))

# ---------------------------------------------------------------- P9
query("rgba_from_hex", with_ctes(f"""
SELECT DISTINCT cell_type, 'rgba(' || CAST(CAST(('0x' || substr(c, 2, 2)) AS INTEGER) AS VARCHAR) || ','
       || CAST(CAST(('0x' || substr(c, 4, 2)) AS INTEGER) AS VARCHAR) || ','
       || CAST(CAST(('0x' || substr(c, 6, 2)) AS INTEGER) AS VARCHAR) || ',0.3)' AS rgba
FROM (SELECT cell_type, {_COLOR_SQL.format(c='cell_type')} AS c FROM cell_meta WHERE cell_type <> '')""",
                                 "cell_meta"))(
    lambda spark, d: (_meta_out(Bindings(spark, d)).where(F.col("cell_type") != "")
                      .select("cell_type", rgba_from_hex("hex_color").alias("rgba")).distinct()))


# ---------------------------------------------------------------- A1
_HIST_SQL = f"""
m AS (SELECT 'A' AS slide, cell_type, {_COLOR_SQL.format(c='cell_type')} AS hex_color, row_idx FROM cell_meta
      UNION ALL
      SELECT 'B' AS slide, cell_type, {_COLOR_SQL.format(c='cell_type')} AS hex_color, row_idx FROM cell_meta_b),
d AS (SELECT slide, trim(cell_type) AS cell_type,
             CASE WHEN trim(hex_color) <> '' THEN trim(hex_color) END AS c, row_idx
      FROM m WHERE cell_type IS NOT NULL AND trim(cell_type) <> ''),
g AS (SELECT slide, cell_type, count(*) AS n, arg_min(c, row_idx) FILTER (WHERE c IS NOT NULL) AS c1,
             min(row_idx) AS f FROM d GROUP BY 1, 2)"""


@query("cell_type_counts", with_ctes("""
SELECT slide, cell_type, n, coalesce(c1, '#4C72B0') AS color,
       CAST(row_number() OVER (PARTITION BY slide ORDER BY n DESC, f) AS INTEGER) AS rank
FROM g""", "cell_meta", "cell_meta_b", extra=_HIST_SQL))
def q_cell_type_counts(spark, d):
    b = Bindings(spark, d)
    m = (_meta_out(b, "a").withColumn("slide", F.lit("A"))
         .unionByName(_meta_out(b, "b").withColumn("slide", F.lit("B")), allowMissingColumns=True))
    return C.cell_type_counts(m)


# ---------------------------------------------------------------- J1 / E7 / A2 (X3 chain)
_STATS_SQL = """
typed AS (SELECT e.fov, e.cell_ID, e.gene, e.count, m.cell_type
          FROM expr_long e JOIN cell_meta m ON e.fov = m.fov AND e.cell_ID = m.cell_ID
          WHERE m.cell_type IS NOT NULL AND m.cell_type <> ''),
typed_b AS (SELECT e.fov, e.cell_ID, e.gene, e.count, m.cell_type
          FROM expr_long e JOIN cell_meta_b m ON e.fov = m.fov AND e.cell_ID = m.cell_ID
          WHERE m.cell_type IS NOT NULL AND m.cell_type <> '' AND e.fov IN """ + _B_FOVS_SQL + """),
stats_a AS (SELECT cell_type, gene, avg(CASE WHEN count > 0 THEN 1.0 ELSE 0.0 END::DOUBLE) AS pct_expressed,
                   avg(CAST(count AS DOUBLE)) AS mean_expression FROM typed GROUP BY 1, 2),
stats_b AS (SELECT cell_type, gene, avg(CASE WHEN count > 0 THEN 1.0 ELSE 0.0 END::DOUBLE) AS pct_expressed,
                   avg(CAST(count AS DOUBLE)) AS mean_expression FROM typed_b GROUP BY 1, 2)"""

query("expression_long", with_ctes("SELECT fov, cell_ID, gene, count FROM expr_long", "expr_long"))(
    lambda spark, d: Bindings(spark, d).expr_long)

query("expression_with_type", with_ctes("""
SELECT e.fov, e.cell_ID, e.gene, e.count, m.cell_type
FROM expr_long e JOIN cell_meta m ON e.fov = m.fov AND e.cell_ID = m.cell_ID""", "expr_long", "cell_meta"))(
    lambda spark, d: C.expression_with_type(Bindings(spark, d).expr_long, Bindings(spark, d).cell_meta))


def _typed(b: Bindings, which="a"):
    meta = b.cell_meta if which == "a" else b.cell_meta_b
    e = b.expr_wide if which == "a" else C.filter_fovs(b.expr_wide, SLIDE_B_FOVS)
    return C.drop_unannotated(C.expression_with_type(e, meta))


def _stats(b: Bindings, which="a", wide=True):
    t = _typed(b, which)
    if wide:
        return C.dotplot_stats_wide(t, GENES)
    return C.dotplot_stats(C.expression_long(t, GENES))


def _round_stats(df):
    return df.withColumn("pct_expressed", rnd("pct_expressed")).withColumn("mean_expression", rnd("mean_expression"))


_STATS_BODY = "SELECT cell_type, gene, round(pct_expressed, 6) AS pct_expressed, round(mean_expression, 6) AS mean_expression FROM stats_a"
query("dotplot_stats", with_ctes(_STATS_BODY, "expr_long", "cell_meta", "cell_meta_b", extra=_STATS_SQL))(
    lambda spark, d: _round_stats(_stats(Bindings(spark, d), "a", wide=False)))
query("dotplot_stats_wide", with_ctes(_STATS_BODY, "expr_long", "cell_meta", "cell_meta_b", extra=_STATS_SQL))(
    lambda spark, d: _round_stats(_stats(Bindings(spark, d), "a", wide=True)))

# ---------------------------------------------------------------- O3 / O4
query("shared_types", with_ctes("""
SELECT cell_type FROM stats_a INTERSECT SELECT cell_type FROM stats_b""",
                                "expr_long", "cell_meta", "cell_meta_b", extra=_STATS_SQL))(
    lambda spark, d: C.shared_types(_stats(Bindings(spark, d), "a"), _stats(Bindings(spark, d), "b")))


@query("dotplot_matrix", with_ctes("""
SELECT slide, cell_type, gene, round(pct_expressed, 6) AS pct_expressed, round(mean_expression, 6) AS mean_expression,
       round(CASE WHEN vmax > 0 THEN mean_expression / vmax ELSE 0.0 END, 6) AS color_value,
       round(pct_expressed * 200, 6) AS dot_size
FROM (SELECT 'A' AS slide, * FROM stats_a UNION ALL SELECT 'B' AS slide, * FROM stats_b) u,
     (SELECT max(mean_expression) AS vmax FROM (
        SELECT mean_expression FROM stats_a WHERE cell_type IN (SELECT cell_type FROM stats_b)
        UNION ALL SELECT mean_expression FROM stats_b WHERE cell_type IN (SELECT cell_type FROM stats_a))) mx
WHERE cell_type IN (SELECT cell_type FROM stats_a INTERSECT SELECT cell_type FROM stats_b)""",
                                   "expr_long", "cell_meta", "cell_meta_b", extra=_STATS_SQL))
def q_dotplot_matrix(spark, d):
    b = Bindings(spark, d)
    m = C.dotplot_matrix(_stats(b, "a"), _stats(b, "b"))
    for c in ("pct_expressed", "mean_expression", "color_value", "dot_size"):
        m = m.withColumn(c, rnd(c))
    return m


# ---------------------------------------------------------------- A3 / J14
_DENS_SQL = """
da AS (SELECT cell_type, count(*) / (SELECT count(DISTINCT fov) FROM cell_meta WHERE cell_type <> '') AS density
       FROM cell_meta WHERE cell_type <> '' GROUP BY 1),
db AS (SELECT cell_type, count(*) / (SELECT count(DISTINCT fov) FROM cell_meta_b
                                     WHERE cell_type <> '' AND fov IN """ + _B_FOVS_SQL + """) AS density
       FROM cell_meta_b WHERE cell_type <> '' AND fov IN """ + _B_FOVS_SQL + """ GROUP BY 1)"""

query("type_density", with_ctes("SELECT cell_type, round(density, 6) AS density FROM da",
                                "cell_meta", "cell_meta_b", extra=_DENS_SQL))(
    lambda spark, d: C.type_density(C.drop_unannotated(Bindings(spark, d).cell_meta)).withColumn("density", rnd("density")))


@query("density_compare", with_ctes("""
SELECT coalesce(da.cell_type, db.cell_type) AS cell_type, round(coalesce(da.density, 0.0), 6) AS density_a,
       round(coalesce(db.density, 0.0), 6) AS density_b
FROM da FULL OUTER JOIN db ON da.cell_type = db.cell_type""", "cell_meta", "cell_meta_b", extra=_DENS_SQL))
def q_density_compare(spark, d):
    b = Bindings(spark, d)
    a = C.type_density(C.drop_unannotated(b.cell_meta))
    bb = C.type_density(C.filter_fovs(C.drop_unannotated(b.cell_meta_b), SLIDE_B_FOVS))
    r = C.density_compare(a, bb)
    return r.withColumn("density_a", rnd("density_a")).withColumn("density_b", rnd("density_b"))


# ---------------------------------------------------------------- A4 / P8
@query("cluster_labels", with_ctes("""
SELECT cell_type, round(median(UMAP_1), 6) AS median_1, round(median(UMAP_2), 6) AS median_2, count(*) AS n,
       round(count(*) / (SELECT count(*) FROM umap) * 100, 6) AS pct,
       cell_type || ' (' || printf('%.1f', count(*) / (SELECT count(*) FROM umap) * 100) || '%)' AS label
FROM umap GROUP BY cell_type""", "umap"))
def q_cluster_labels(spark, d):
    r = C.cluster_labels(Bindings(spark, d).umap)
    for c in ("median_1", "median_2", "pct"):
        r = r.withColumn(c, rnd(c))
    return r


_PAL = ", ".join(f"'{p}'" for p in PALETTE)
query("palette_color", with_ctes(f"""
SELECT u.cell_type, u.fov, round(u.UMAP_1, 6) AS UMAP_1, round(u.UMAP_2, 6) AS UMAP_2, p.color
FROM umap u JOIN (SELECT cell_type, ([{_PAL}])[CAST((row_number() OVER (ORDER BY cell_type) - 1) % 20 + 1 AS INTEGER)] AS color
                  FROM (SELECT DISTINCT cell_type FROM umap)) p ON u.cell_type = p.cell_type""", "umap"))(
    lambda spark, d: palette_color(Bindings(spark, d).umap, "cell_type").select(
        "cell_type", "fov", rnd("UMAP_1").alias("UMAP_1"), rnd("UMAP_2").alias("UMAP_2"), "color"))


# ---------------------------------------------------------------- J4 / A5 (X4 chain)
_FLOW_SQL = """
ma AS (SELECT cell_name, arg_max(coalesce(cell_type, ''), row_idx) AS type_a FROM cell_meta GROUP BY 1),
mb AS (SELECT cell_name, arg_max(coalesce(cell_type, ''), row_idx) AS type_b FROM cell_meta_b GROUP BY 1),
matched AS (SELECT ma.cell_name, type_a, type_b FROM ma JOIN mb ON ma.cell_name = mb.cell_name),
flows AS (SELECT type_a, type_b, count(*) AS n FROM matched GROUP BY 1, 2),
thr AS (SELECT floor(sum(n) * 0.005) AS min_flow FROM flows),
kept AS (SELECT type_a, type_b, n FROM flows, thr WHERE n >= min_flow)"""


def _flows(b: Bindings):
    return C.type_flows(C.match_cells(b.cell_meta, b.cell_meta_b))


query("match_cells", with_ctes("SELECT cell_name, type_a, type_b FROM matched", "cell_meta", "cell_meta_b",
                               extra=_FLOW_SQL))(
    lambda spark, d: C.match_cells(Bindings(spark, d).cell_meta, Bindings(spark, d).cell_meta_b))

query("type_flows", with_ctes("SELECT type_a, type_b, n FROM kept", "cell_meta", "cell_meta_b", extra=_FLOW_SQL))(
    lambda spark, d: _flows(Bindings(spark, d))[0])

query("flow_nodes", with_ctes("""
SELECT type, CAST(total AS BIGINT) AS total, side,
       CAST(row_number() OVER (PARTITION BY side ORDER BY total DESC, type) AS INTEGER) AS node_order
FROM (SELECT type_a AS type, sum(n) AS total, 'a' AS side FROM kept GROUP BY 1
      UNION ALL SELECT type_b AS type, sum(n) AS total, 'b' AS side FROM kept GROUP BY 1)""",
                              "cell_meta", "cell_meta_b", extra=_FLOW_SQL))(
    lambda spark, d: _flows(Bindings(spark, d))[1])

query("flow_summary", with_ctes("""
SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(CASE WHEN type_a <> type_b THEN n ELSE 0 END) AS BIGINT) AS changed,
       round(sum(CASE WHEN type_a <> type_b THEN n ELSE 0 END) * 100.0 / sum(n), 6) AS changed_pct
FROM flows""", "cell_meta", "cell_meta_b", extra=_FLOW_SQL))(
    lambda spark, d: _flows(Bindings(spark, d))[2])

# ---------------------------------------------------------------- J5
query("shared_and_exclusive_slides", with_ctes("""
SELECT coalesce(a.slide, b.slide) AS slide, a.slide IS NOT NULL AS in_a, b.slide IS NOT NULL AS in_b,
       CASE WHEN a.slide IS NOT NULL AND b.slide IS NOT NULL THEN 'both'
            WHEN a.slide IS NOT NULL THEN 'only_a' ELSE 'only_b' END AS status
FROM (SELECT DISTINCT slide FROM slides WHERE page_id % 2 = 0) a
FULL OUTER JOIN (SELECT DISTINCT slide FROM slides WHERE page_id % 3 = 0) b ON a.slide = b.slide""", "slides"))(
    lambda spark, d: C.shared_and_exclusive_slides(
        Bindings(spark, d).slides.where(F.col("page_id") % 2 == 0),
        Bindings(spark, d).slides.where(F.col("page_id") % 3 == 0)))

# ---------------------------------------------------------------- F1 / F2 / F4 / F8
query("drop_unannotated", with_ctes("""
SELECT fov, cell_ID, cell_type FROM cell_meta WHERE cell_type IS NOT NULL AND cell_type <> ''""", "cell_meta"))(
    lambda spark, d: C.drop_unannotated(Bindings(spark, d).cell_meta).select("fov", "cell_ID", "cell_type"))

query("filter_fovs", with_ctes(f"""
SELECT fov, cell_ID, cell_type FROM cell_meta_b WHERE fov IN {_B_FOVS_SQL}""", "cell_meta_b"))(
    lambda spark, d: C.filter_fovs(Bindings(spark, d).cell_meta_b, SLIDE_B_FOVS).select("fov", "cell_ID", "cell_type"))

query("filter_segmentation", with_ctes("""
SELECT cell_name, seg_id FROM cell_meta WHERE trim(seg_id) IN ('seg1', 'seg3')""", "cell_meta"))(
    lambda spark, d: C.filter_segmentation(Bindings(spark, d).cell_meta, " seg1, seg3 ").select("cell_name", "seg_id"))


@query("subset_cells", with_ctes("""
SELECT cell_name, cell_type FROM cell_meta
WHERE cell_type IN (SELECT DISTINCT cell_type FROM cell_meta_b WHERE fov = 3 AND cell_type <> 'HOUSEHOLD')""",
                                 "cell_meta", "cell_meta_b"))
def q_subset_cells(spark, d):
    b = Bindings(spark, d)
    values = b.cell_meta_b.where((F.col("fov") == 3) & (F.col("cell_type") != "HOUSEHOLD")).select("cell_type")
    return C.subset_cells(b.cell_meta, "cell_type", values).select("cell_name", "cell_type")


# ---------------------------------------------------------------- P14
query("probe_label", with_ctes("""
SELECT p.probe, CASE WHEN p.probe LIKE '%CPRO%' THEN coalesce(d.name, p.probe) ELSE p.probe END AS label
FROM (SELECT ProbeID AS probe FROM dictionary) p
LEFT JOIN (SELECT ProbeID, arg_max(DisplayName, ord) AS name FROM dictionary GROUP BY 1) d ON p.probe = d.ProbeID""",
                               "dictionary"))(
    lambda spark, d: C.probe_label(Bindings(spark, d).dictionary.select(F.col("ProbeID").alias("probe")),
                                   Bindings(spark, d).dictionary))

query("probe_label_reverse", with_ctes("""
SELECT p.probe, coalesce(d.id, p.probe) AS label
FROM (SELECT DISTINCT DisplayName AS probe FROM dictionary) p
LEFT JOIN (SELECT DisplayName, arg_min(ProbeID, ord) AS id FROM dictionary GROUP BY 1) d ON p.probe = d.DisplayName""",
                                       "dictionary"))(
    lambda spark, d: C.probe_label(Bindings(spark, d).dictionary.select(F.col("DisplayName").alias("probe")).distinct(),
                                   Bindings(spark, d).dictionary, to_name=False))

# ---------------------------------------------------------------- P16
_PROFILE_COLS = [("fov", True), ("cell_ID", True), ("cell_type", False), ("seg_id", False), ("source_idx", True)]
query("column_profile", with_ctes(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) AS n_distinct,
       {str(n).lower()} AS numeric,
       (NOT {str(n).lower()}) OR (count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) < 30) AS categorical
FROM cell_meta""" for c, n in _PROFILE_COLS), "cell_meta"))(
    lambda spark, d: C.column_profile(Bindings(spark, d).cell_meta, [c for c, _ in _PROFILE_COLS]))

query("categorical_columns", with_ctes(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {str(n).lower()} AS numeric,
       (NOT {str(n).lower()}) OR (count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) < 30) AS categorical
FROM cell_meta""" for c, n in _PROFILE_COLS), "cell_meta"))(
    lambda spark, d: C.categorical_columns(Bindings(spark, d).cell_meta, [c for c, _ in _PROFILE_COLS]))

# ---------------------------------------------------------------- P17
query("minmax_scale", with_ctes("""
SELECT fov, cell_type, round(CASE WHEN mx = mn THEN 0.0 ELSE (UMAP_1 - mn) / (mx - mn) END, 6) AS UMAP_1_scaled
FROM umap, (SELECT min(UMAP_1) AS mn, max(UMAP_1) AS mx FROM umap) s WHERE fov <= 10""", "umap"))(
    lambda spark, d: C.minmax_scale(Bindings(spark, d).umap, "UMAP_1", subset=F.col("fov") <= 10)
    .select("fov", "cell_type", rnd("UMAP_1_scaled").alias("UMAP_1_scaled")))


# ---------------------------------------------------------------- J12 category colours
query("category_colors", with_ctes("""
SELECT CAST(row_number() OVER (ORDER BY encode(category)) - 1 AS INTEGER) AS position, category, '#' || upper(substr(md5(category || 'x'), 1, 6)) AS color
FROM (SELECT DISTINCT cell_type AS category FROM cell_meta WHERE cell_type <> '')""", "cell_meta"))(
    lambda spark, d: C.category_colors(
        Bindings(spark, d).cell_meta.where("cell_type <> ''"), "cell_type",
        # every type twice: the last entry wins
        Bindings(spark, d).cell_meta.where("cell_type <> ''").select(F.col("cell_type").alias("value")).distinct()
        .select("value", F.explode(F.array(F.lit(0), F.lit(1))).alias("ord"))
        .withColumn("color", F.when(F.col("ord") == 0, "#000000").otherwise(F.concat(F.lit("#"), F.upper(F.substring(F.md5(F.concat("value", F.lit("x"))), 1, 6)))))))
