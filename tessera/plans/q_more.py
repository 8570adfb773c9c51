"""More registered queries: expression reader, inventory listing, category
colours, positional count assembly, FOV centres and the X3 / X4 / X5 jobs."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions.color import PALETTE, assign_category_color
from ..operators import cells as C
from ..operators import raster as R
from ..sources import inventory as I
from ..sources import readers as RD
from . import jobs as J
from .bindings import GENES, Bindings, with_ctes
from .q_cells import SLIDE_B_FOVS, _B_FOVS_SQL, _STATS_SQL
from .q_files import _scratch, write_folders
from .q_raster import H, MMPP, W, _arith, _ARITH_SQL, _ras
from .registry import query

# ---------------------------------------------------------------- S2
_SUB_GENES = ["2-HIGH", "5-LOW"]


@query("read_expression", with_ctes("""
SELECT fov, CAST(cell_ID AS INTEGER) AS cell_ID, gene, count FROM expr_long WHERE gene IN ('2-HIGH', '5-LOW')""",
                                    "expr_long"))
def q_read_expression(spark, d):
    path = f"{_scratch(spark)}/expr.csv"
    Bindings(spark, d).expr_wide.write.option("header", True).csv(path)
    return RD.read_expression(spark, path, _SUB_GENES, long=True)


# ---------------------------------------------------------------- S6
@query("file_inventory", with_ctes("""
SELECT 'targets/fov=' || fov AS folder, 1 AS files, CAST(sum(strlen(target) + 1) AS BIGINT) AS bytes
FROM target_calls GROUP BY fov UNION ALL SELECT 'lone', 1, 4""", "target_calls"))
def q_file_inventory(spark, d):
    """Folders below the root, files in them and their bytes (a line feed ends each line)."""
    root = _scratch(spark)
    calls = Bindings(spark, d).target_calls.select("fov", F.col("target").alias("value"))
    write_folders(calls, "fov").text(f"{root}/targets")
    spark.range(1).select(F.lit("abc").alias("value")).write.text(f"{root}/lone")
    inv = I.file_inventory(spark, root).withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    rel = I.relative_path("path", re.sub("^file:/*(?=/)", "", root))
    return inv.groupBy(F.regexp_extract(rel, "^(.*)/[^/]*$", 1).alias("folder")).agg(
        F.count(F.lit(1)).cast("int").alias("files"), F.sum("length").alias("bytes"))


# ---------------------------------------------------------------- P18
def _colored(b: Bindings):
    m = b.cell_meta.select("cell_name", "cell_type", "row_idx",
                           F.when(F.col("row_idx") % 7 == 0,
                                  F.concat(F.lit("#"), F.lpad((F.col("row_idx") % 4096).cast("string"), 6, "0")))
                            .alias("hex_color"))
    m = m.withColumn("cell_type", F.when(F.col("row_idx") % 23 == 0, F.lit(None)).otherwise(F.col("cell_type")))
    spark = b.spark
    # user-supplied colour maps (parameters); a local relation keeps the join an equi-join
    supplied = spark.createDataFrame([("BUILDING", "#111111")], "v string, c string")
    cat = spark.createDataFrame([("MACHINERY", "#222222")], "v string, c string")
    return assign_category_color(m, "cell_type", supplied=supplied, category_colors=cat, order_col="row_idx")


query("assign_category_color", with_ctes("""
SELECT m.cell_name, m.cell_type, m.row_idx, m.hex_color,
       CASE WHEN m.cell_type IS NULL THEN '#00000000'
            ELSE coalesce(CASE WHEN m.cell_type = 'BUILDING' THEN '#111111' END,
                          CASE WHEN m.cell_type = 'MACHINERY' THEN '#222222' END, f.c,
                          CASE WHEN m.cell_type <> '' THEN '#' || upper(substr(md5(m.cell_type), 1, 6)) END,
                          '#00000000') END AS color
FROM m LEFT JOIN first f ON m.cell_type = f.cell_type""", "cell_meta", extra="""
m AS (SELECT cell_name, CASE WHEN row_idx % 23 = 0 THEN NULL ELSE cell_type END AS cell_type, row_idx,
             CASE WHEN row_idx % 7 = 0 THEN '#' || lpad(CAST(row_idx % 4096 AS VARCHAR), 6, '0') END AS hex_color
      FROM cell_meta),
first AS (SELECT cell_type, arg_min(hex_color, row_idx) AS c FROM m WHERE hex_color IS NOT NULL AND hex_color <> ''
          GROUP BY 1)"""))(
    lambda spark, d: _colored(Bindings(spark, d)))

# ---------------------------------------------------------------- P20 (subtract / multiply)
query("pixel_subtract", _ras(_ARITH_SQL.format(expr="CAST(coalesce(a.val, 0) AS DOUBLE) - CAST(coalesce(b.val, 0) AS DOUBLE)")))(
    _arith("subtract"))
query("pixel_multiply", _ras(_ARITH_SQL.format(expr="CAST(coalesce(a.val, 0) AS DOUBLE) * CAST(coalesce(b.val, 0) AS DOUBLE)")))(
    _arith("multiply"))


# ---------------------------------------------------------------- J12
@query("assemble_counts", with_ctes("""
SELECT c.c_name AS name, e.gene AS gene_name, CAST(e.count AS INTEGER) AS count, c.c_mktsegment AS segment,
       c.c_acctbal AS acctbal
FROM expr_long e JOIN customer c ON e.cell_ID = c.c_custkey WHERE e.count <> 0""", "expr_long"))
def q_assemble_counts(spark, d):
    from .q_files import q_read_mtx
    b = Bindings(spark, d)
    root = _scratch(spark)
    counts = q_read_mtx(spark, d)     # (cell_idx = c_custkey, gene_idx, count) through a MatrixMarket file
    cust = b.t("customer").orderBy("c_custkey")
    cust.select("c_name", "c_mktsegment").write.option("header", True).csv(f"{root}/obs.csv")
    spark.createDataFrame([(g,) for g in GENES], "gene_name string").coalesce(1).write.option("header", True) \
        .csv(f"{root}/var.csv")
    cust.select(F.col("c_acctbal").cast("string").alias("acctbal")).write.option("header", True).csv(f"{root}/coords.csv")
    obs = RD.read_indexed_csv(spark, f"{root}/obs.csv")
    var = RD.read_indexed_csv(spark, f"{root}/var.csv", index_first_column=False)
    coords = RD.read_indexed_csv(spark, f"{root}/coords.csv", index_first_column=False)
    a = C.assemble_counts(counts, obs, var, coords)
    return a.select("name", "gene_name", "count", F.col("c_mktsegment").alias("segment"),
                    F.col("acctbal").cast("double").alias("acctbal"))


# ---------------------------------------------------------------- R11 centres
query("fov_centers", _ras(f"""
SELECT FOV, round(((Y_mm - minY) + minY) + {H * MMPP!r} / 2, 6) AS center_y,
       round(((-X_mm - -maxX) + -maxX) + {W * MMPP!r} / 2, 6) AS center_x,
       round({H * MMPP!r}, 6) AS size_y, round({W * MMPP!r}, 6) AS size_x
FROM f1, ext"""))(
    lambda spark, d: R.fov_rectangles(Bindings(spark, d).fovs, H, W, MMPP)[1].select(
        "FOV", *[F.round(c, 6).alias(c) for c in ("center_y", "center_x", "size_y", "size_x")]))


# ---------------------------------------------------------------- X3
@query("dotplot_job", with_ctes("""
SELECT slide, cell_type, gene, round(pct_expressed, 6) AS pct_expressed, round(mean_expression, 6) AS mean_expression,
       round(CASE WHEN vmax > 0 THEN mean_expression / vmax ELSE 0.0 END, 6) AS color_value,
       round(pct_expressed * 200, 6) AS dot_size
FROM (SELECT 'A' AS slide, * FROM stats_a UNION ALL SELECT 'B' AS slide, * FROM stats_b) u,
     (SELECT max(mean_expression) AS vmax FROM (
        SELECT mean_expression FROM stats_a WHERE cell_type IN (SELECT cell_type FROM stats_b)
        UNION ALL SELECT mean_expression FROM stats_b WHERE cell_type IN (SELECT cell_type FROM stats_a))) mx
WHERE cell_type IN (SELECT cell_type FROM stats_a INTERSECT SELECT cell_type FROM stats_b)""",
                                "expr_long", "cell_meta", "cell_meta_b", extra=_STATS_SQL))
def q_dotplot_job(spark, d):
    b = Bindings(spark, d)
    m = J.dotplot_job(b.expr_wide, b.cell_meta, b.expr_wide, b.cell_meta_b, GENES, fovs_b=SLIDE_B_FOVS)
    for c in ("pct_expressed", "mean_expression", "color_value", "dot_size"):
        m = m.withColumn(c, F.round(c, 6))
    return m


# ---------------------------------------------------------------- X4
def _slides_ab(b: Bindings):
    a = b.cell_meta.withColumn("slide", F.concat(F.lit("S"), (F.col("fov") % 3).cast("string")))
    bb = b.cell_meta_b.withColumn("slide", F.concat(F.lit("S"), (F.col("fov") % 4).cast("string")))
    return a, bb


_X4_SQL = """
a AS (SELECT 'S' || CAST(fov % 3 AS VARCHAR) AS slide, cell_name, coalesce(cell_type, '') AS t, row_idx FROM cell_meta),
b AS (SELECT 'S' || CAST(fov % 4 AS VARCHAR) AS slide, cell_name, coalesce(cell_type, '') AS t, row_idx FROM cell_meta_b),
both_ AS (SELECT DISTINCT slide FROM a INTERSECT SELECT DISTINCT slide FROM b),
la AS (SELECT slide, cell_name, arg_max(t, row_idx) AS type_a FROM a WHERE slide IN (SELECT slide FROM both_) GROUP BY 1, 2),
lb AS (SELECT slide, cell_name, arg_max(t, row_idx) AS type_b FROM b WHERE slide IN (SELECT slide FROM both_) GROUP BY 1, 2),
flows AS (SELECT la.slide, type_a, type_b, count(*) AS n FROM la JOIN lb ON la.slide = lb.slide AND la.cell_name = lb.cell_name
          GROUP BY 1, 2, 3),
thr AS (SELECT slide, floor(sum(n) * 0.005) AS min_flow FROM flows GROUP BY 1),
kept AS (SELECT f.slide, type_a, type_b, n FROM flows f JOIN thr t ON f.slide = t.slide WHERE n >= min_flow)"""

_HEX = "'#' || upper(substr(md5({c}), 1, 6))"
_RGBA = ("'rgba(' || CAST(CAST(('0x' || substr(h, 2, 2)) AS INTEGER) AS VARCHAR) || ',' || "
         "CAST(CAST(('0x' || substr(h, 4, 2)) AS INTEGER) AS VARCHAR) || ',' || "
         "CAST(CAST(('0x' || substr(h, 6, 2)) AS INTEGER) AS VARCHAR) || ',0.3)'")

query("reclassification_links", with_ctes(f"""
SELECT slide, type_a, type_b, n,
       CASE WHEN h = '' THEN NULL ELSE {_RGBA} END AS color
FROM (SELECT *, CASE WHEN type_a IS NULL OR type_a = '' THEN '' ELSE {_HEX.format(c='type_a')} END AS h FROM kept)""",
                                          "cell_meta", "cell_meta_b", extra=_X4_SQL))(
    lambda spark, d: J.reclassification_job(*_slides_ab(Bindings(spark, d)))[0])

query("reclassification_nodes", with_ctes(f"""
SELECT slide, type, CAST(total AS BIGINT) AS total, side,
       CAST(row_number() OVER (PARTITION BY slide, side ORDER BY total DESC, type) AS INTEGER) AS node_order,
       CASE WHEN type = '' THEN '' ELSE {_HEX.format(c='type')} END AS color
FROM (SELECT slide, type_a AS type, sum(n) AS total, 'a' AS side FROM kept GROUP BY 1, 2
      UNION ALL SELECT slide, type_b AS type, sum(n) AS total, 'b' AS side FROM kept GROUP BY 1, 2)""",
                                          "cell_meta", "cell_meta_b", extra=_X4_SQL))(
    lambda spark, d: J.reclassification_job(*_slides_ab(Bindings(spark, d)))[1])


# ---------------------------------------------------------------- X5
_PAL = ", ".join(f"'{p}'" for p in PALETTE)


@query("cluster_label_job", with_ctes("""
SELECT g.cell_type, round(median_1, 6) AS median_1, round(median_2, 6) AS median_2, n, round(pct, 6) AS pct, label, p.color
FROM (SELECT cell_type, median(UMAP_1) AS median_1, median(UMAP_2) AS median_2, count(*) AS n,
             count(*) / (SELECT count(*) FROM ub) * 100 AS pct,
             cell_type || ' (' || printf('%.1f', count(*) / (SELECT count(*) FROM ub) * 100) || '%)' AS label
      FROM ub GROUP BY cell_type) g JOIN pal p ON g.cell_type = p.cell_type""", "umap", extra=f"""
ua AS (SELECT * FROM umap WHERE cell_type IS NOT NULL AND cell_type <> ''),
ub AS (SELECT * FROM umap WHERE fov IN {_B_FOVS_SQL} AND cell_type IS NOT NULL AND cell_type <> ''),
pal AS (SELECT cell_type, ([{_PAL}])[CAST((row_number() OVER (ORDER BY cell_type) - 1) % 20 + 1 AS INTEGER)] AS color
        FROM (SELECT cell_type FROM ua UNION SELECT cell_type FROM ub))"""))
def q_cluster_label_job(spark, d):
    u = Bindings(spark, d).umap
    _, b = J.cluster_label_job(u, u, fovs_b=SLIDE_B_FOVS)
    for c in ("median_1", "median_2", "pct"):
        b = b.withColumn(c, F.round(c, 6))
    return b
