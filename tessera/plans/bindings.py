"""Bindings of the slide data model to the driver tables.

Each binding is written twice: as a Spark DataFrame (``Bindings``) and as a
DuckDB/ANSI SQL common table expression (``SQL_CTES``) for the oracle check.
Every binding is a projection/aggregation of the input tables, so the work of a
bound query grows with the tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the bindings.
GENES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]  # o_orderpriority
RUN_STEPS = ["signup", "view", "click", "purchase", "error"]            # event_type
PRIMARY_VERSION = 17
FOV_TILE = 8            # embeddings hold 64 floats = one 8 x 8 tile
FOV_PITCH_PX_PER_MM = 12.0  # 0.5 mm FOV spacing -> 6 px: neighbouring 8 px tiles overlap
# ---------------------------------------------------------------------------


class Bindings:
    """Lazily built DataFrames of the slide data model over one table folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # E4 FOV locations -------------------------------------------------------
    @cached_property
    def fovs(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.t("supplier").select(
            (k + 1).cast("int").alias("FOV"),
            (k % 10).cast("double").__mul__(F.lit(0.5)).alias("X_mm"),
            F.floor(k / 10).cast("double").__mul__(F.lit(0.5)).alias("Y_mm"),
            F.col("s_acctbal").alias("Z_um"),
            k.alias("ord"),
        )

    # E9 transcript calls ----------------------------------------------------
    @cached_property
    def target_calls(self) -> DataFrame:
        li = self.t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                       "l_extendedprice", "l_linestatus")
        part = self.t("part").select("p_partkey", "p_name", "p_size")
        j = li.join(part, li.l_partkey == part.p_partkey)
        pk5 = (F.col("p_partkey") % 5).cast("string")
        target = (F.when(F.col("p_size") == 1, F.concat(F.lit("NegPrb"), pk5))
                   .when(F.col("p_size") == 2, F.concat(F.lit("SystemControl"), pk5))
                   .when(F.col("p_size") == 3, F.concat(F.lit("FalseCode"), pk5))
                   .otherwise(F.col("p_name")))
        return j.select(
            (F.col("l_suppkey") + 1).cast("int").alias("fov"),
            (F.col("l_orderkey") % 40).cast("int").alias("CellId"),
            (F.floor("l_extendedprice") % 512).cast("double").alias("x"),
            ((F.col("l_partkey") * 7 + F.col("l_linenumber")) % 512).cast("double").alias("y"),
            F.col("l_linenumber").cast("int").alias("z"),
            target.alias("target"),
            F.col("l_linestatus").alias("CellComp"),
        )

    # E5 cell metadata -------------------------------------------------------
    @cached_property
    def cell_meta(self) -> DataFrame:
        c = self.t("customer")
        fov = (F.col("c_nationkey") + 1).cast("int")
        return c.select(
            fov.alias("fov"),
            F.col("c_custkey").alias("cell_ID"),
            F.concat(F.lit("c_1_"), fov.cast("string"), F.lit("_"), F.col("c_custkey").cast("string")).alias("cell_name"),
            F.when(F.col("c_custkey") % 17 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("cell_type"),
            F.concat(F.lit("seg"), (F.col("c_custkey") % 4).cast("string")).alias("seg_id"),
            (F.floor(F.col("c_custkey") / 100) % 3).cast("int").alias("source_idx"),
            F.col("c_custkey").alias("row_idx"),
        )

    @cached_property
    def cell_meta_b(self) -> DataFrame:
        """Second experiment on the same slide: some cells re-typed, some missing."""
        c = self.t("customer").where(F.col("c_custkey") % 13 != 0)
        fov = (F.col("c_nationkey") + 1).cast("int")
        k = F.col("c_custkey")
        return c.select(
            fov.alias("fov"),
            k.alias("cell_ID"),
            F.concat(F.lit("c_1_"), fov.cast("string"), F.lit("_"), k.cast("string")).alias("cell_name"),
            F.when(k % 5 == 0, F.lit("HOUSEHOLD")).when(k % 251 == 0, F.lit("RARE"))
             .otherwise(F.col("c_mktsegment")).alias("cell_type"),
            k.alias("row_idx"),
        )

    # E7 expression matrix ---------------------------------------------------
    @cached_property
    def expr_wide(self) -> DataFrame:
        """fov, cell_ID, one count column per gene (missing pair -> 0).

        The pivot aggregates on the map side; the pivot values are a fixed list,
        so no extra job is needed to find them."""
        counts = (self.t("orders").groupBy("o_custkey")
                  .pivot("o_orderpriority", GENES).count())
        cells = self.t("customer").select(
            (F.col("c_nationkey") + 1).cast("int").alias("fov"),
            F.col("c_custkey").alias("cell_ID"))
        j = cells.join(counts, cells.cell_ID == counts.o_custkey, "left").drop("o_custkey")
        return j.select("fov", "cell_ID", *[F.coalesce(F.col(f"`{g}`"), F.lit(0)).cast("long").alias(g)
                                            for g in GENES])

    @cached_property
    def expr_long(self) -> DataFrame:
        from ..operators.cells import expression_long
        return expression_long(self.expr_wide, GENES)

    # E14 UMAP ---------------------------------------------------------------
    @cached_property
    def umap(self) -> DataFrame:
        e = self.t("embeddings")
        return e.select(
            F.col("embedding")[0].cast("double").alias("UMAP_1"),
            F.col("embedding")[1].cast("double").alias("UMAP_2"),
            F.concat(F.lit("T"), F.col("label").cast("string")).alias("cell_type"),
            (F.col("vec_id") % 50 + 1).cast("int").alias("fov"),
        )

    # E10 raster tiles (long pixel form) ---------------------------------------
    def _tile_cells(self) -> DataFrame:
        # Every vector is a tile; vectors of the same FOV are repeated exposures of it.
        n = max(1, self.t("supplier").count())
        return self.t("embeddings").select(
            (F.col("vec_id") % n + 1).cast("int").alias("fov"),
            (F.col("label") % 3).cast("int").alias("channel"),
            F.posexplode("embedding").alias("pos", "v"),
        )

    @cached_property
    def pixels(self) -> DataFrame:
        return self._tile_cells().select(
            "fov", "channel",
            F.floor(F.col("pos") / FOV_TILE).cast("int").alias("row"),
            (F.col("pos") % FOV_TILE).cast("int").alias("col"),
            F.floor((F.col("v").cast("double") + 1) * 100).cast("long").alias("val"),
        ).groupBy("fov", "channel", "row", "col").agg(F.max("val").alias("val"))

    @cached_property
    def label_pixels(self) -> DataFrame:
        return self._tile_cells().select(
            "fov",
            F.floor(F.col("pos") / FOV_TILE).cast("int").alias("row"),
            (F.col("pos") % FOV_TILE).cast("int").alias("col"),
            F.when(F.col("v").cast("double") > F.lit(0.1).cast("double"), F.col("pos") % 5 + 1)
             .otherwise(0).cast("long").alias("val"),
        ).groupBy("fov", "row", "col").agg(F.max("val").alias("val"))

    # E3 segmentation folders ---------------------------------------------------
    @cached_property
    def seg(self) -> DataFrame:
        d = self.t("documents").select("doc_id", "source")
        n = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
        fov = (F.floor(F.col("doc_id") / 20) % 40 + 1).cast("int")
        rows = d.select(
            F.concat(F.lit("Segmentation_"), F.col("source"), F.lit("_"),
                     F.lpad(n.cast("string"), 3, "0")).alias("dir"),
            n.alias("N"), fov.alias("fov"))
        return (rows.where((F.col("N") == 0) | ((F.col("fov") + F.col("N")) % 4 < 2))
                    .select("dir", "fov").distinct())

    # segmentation manifests ----------------------------------------------------
    @cached_property
    def manifests(self) -> DataFrame:
        ev = self.t("events").select("event_id", "user_id", "props")
        return ev.select(
            F.concat(F.lit("Segmentation_u"), F.col("user_id").cast("string")).alias("dir"),
            F.get_json_object("props", "$.k").alias("Version"),
            F.col("event_id").alias("row_idx"),
        )

    # run log steps ---------------------------------------------------------------
    @cached_property
    def run_steps(self) -> DataFrame:
        ev = self.t("events")
        return (ev.groupBy(F.col("user_id").alias("run"), F.col("event_type").alias("step"))
                  .agg(F.min("ts").alias("start"), F.max("ts").alias("end")))

    # E2 inventory ------------------------------------------------------------------
    @cached_property
    def inventory(self) -> DataFrame:
        return self.t("pages").select(F.col("url").alias("path"),
                                      F.length("html").cast("long").alias("length"))

    @cached_property
    def slides(self) -> DataFrame:
        p = self.t("pages").select("page_id", "url")
        host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)
        run = F.regexp_extract("url", r"^[a-z]+://[^/]+/([^/?#]+)", 1)
        return p.select(F.col("page_id"), host.alias("slide"), run.alias("run"),
                        F.concat_ws("/", F.lit("out"), run, host).alias("output_prefix"))

    @cached_property
    def outputs(self) -> DataFrame:
        return (self.slides.where(F.col("page_id") % 3 == 0)
                    .select(F.concat(F.col("output_prefix"), F.lit("/images/")).alias("key")))

    # E16 dictionaries / layers -------------------------------------------------------
    @cached_property
    def dictionary(self) -> DataFrame:
        p = self.t("part")
        return p.select(
            F.concat(F.when(F.col("p_partkey") % 2 == 0, F.lit("CPRO")).otherwise(F.lit("X")),
                     F.col("p_partkey").cast("string")).alias("ProbeID"),
            F.col("p_name").alias("DisplayName"),
            F.col("p_partkey").alias("ord"),
        )

    @cached_property
    def channels(self) -> DataFrame:
        return self.t("part").select(F.col("p_type").alias("name")).distinct()

    @cached_property
    def proteins(self) -> DataFrame:
        return self.t("part").select(F.col("p_brand").alias("name")).distinct()


# ---------------------------------------------------------------------------
# The same bindings in SQL (DuckDB dialect, also valid Spark SQL where noted).
SQL_CTES = {
    "fovs": """
fovs AS (
  SELECT CAST(s_suppkey + 1 AS INTEGER) AS FOV,
         CAST(s_suppkey % 10 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS X_mm,
         CAST(floor(s_suppkey / 10) AS DOUBLE) * CAST(0.5 AS DOUBLE) AS Y_mm,
         s_acctbal AS Z_um, s_suppkey AS ord
  FROM supplier)""",
    "target_calls": """
target_calls AS (
  SELECT CAST(l_suppkey + 1 AS INTEGER) AS fov,
         CAST(l_orderkey % 40 AS INTEGER) AS CellId,
         CAST(CAST(floor(l_extendedprice) AS BIGINT) % 512 AS DOUBLE) AS x,
         CAST((l_partkey * 7 + l_linenumber) % 512 AS DOUBLE) AS y,
         CAST(l_linenumber AS INTEGER) AS z,
         CASE WHEN p_size = 1 THEN 'NegPrb' || CAST(p_partkey % 5 AS VARCHAR)
              WHEN p_size = 2 THEN 'SystemControl' || CAST(p_partkey % 5 AS VARCHAR)
              WHEN p_size = 3 THEN 'FalseCode' || CAST(p_partkey % 5 AS VARCHAR)
              ELSE p_name END AS target,
         l_linestatus AS CellComp
  FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "cell_meta": """
cell_meta AS (
  SELECT CAST(c_nationkey + 1 AS INTEGER) AS fov, c_custkey AS cell_ID,
         'c_1_' || CAST(c_nationkey + 1 AS VARCHAR) || '_' || CAST(c_custkey AS VARCHAR) AS cell_name,
         CASE WHEN c_custkey % 17 = 0 THEN '' ELSE c_mktsegment END AS cell_type,
         'seg' || CAST(c_custkey % 4 AS VARCHAR) AS seg_id,
         CAST(CAST(floor(c_custkey / 100) AS BIGINT) % 3 AS INTEGER) AS source_idx,
         c_custkey AS row_idx
  FROM customer)""",
    "cell_meta_b": """
cell_meta_b AS (
  SELECT CAST(c_nationkey + 1 AS INTEGER) AS fov, c_custkey AS cell_ID,
         'c_1_' || CAST(c_nationkey + 1 AS VARCHAR) || '_' || CAST(c_custkey AS VARCHAR) AS cell_name,
         CASE WHEN c_custkey % 5 = 0 THEN 'HOUSEHOLD' WHEN c_custkey % 251 = 0 THEN 'RARE'
              ELSE c_mktsegment END AS cell_type,
         c_custkey AS row_idx
  FROM customer WHERE c_custkey % 13 <> 0)""",
    "expr_long": """
expr_counts AS (
  SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2),
expr_genes AS (
  SELECT * FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) g(gene)),
expr_long AS (
  SELECT CAST(c.c_nationkey + 1 AS INTEGER) AS fov, c.c_custkey AS cell_ID, g.gene AS gene,
         CAST(coalesce(e.n, 0) AS BIGINT) AS count
  FROM customer c CROSS JOIN expr_genes g
  LEFT JOIN expr_counts e ON e.o_custkey = c.c_custkey AND e.o_orderpriority = g.gene)""",
    "umap": """
umap AS (
  SELECT CAST(embedding[1] AS DOUBLE) AS UMAP_1, CAST(embedding[2] AS DOUBLE) AS UMAP_2,
         'T' || CAST(label AS VARCHAR) AS cell_type, CAST(vec_id % 50 + 1 AS INTEGER) AS fov
  FROM embeddings)""",
    "tile_cells": """
tile_cells AS (
  SELECT CAST(vec_id % (SELECT greatest(count(*), 1) FROM supplier) + 1 AS INTEGER) AS fov, CAST(label % 3 AS INTEGER) AS channel,
         CAST(u.i - 1 AS INTEGER) AS pos, CAST(embedding[u.i] AS DOUBLE) AS v
  FROM embeddings, (SELECT unnest(range(1, 65)) AS i) u)""",
    "pixels": """
pixels AS (
  SELECT fov, channel, CAST(floor(pos / 8) AS INTEGER) AS row, CAST(pos % 8 AS INTEGER) AS col,
         max(CAST(floor((v + 1) * 100) AS BIGINT)) AS val
  FROM tile_cells GROUP BY 1, 2, 3, 4)""",
    "label_pixels": """
label_pixels AS (
  SELECT fov, CAST(floor(pos / 8) AS INTEGER) AS row, CAST(pos % 8 AS INTEGER) AS col,
         max(CAST(CASE WHEN v > CAST(0.1 AS DOUBLE) THEN pos % 5 + 1 ELSE 0 END AS BIGINT)) AS val
  FROM tile_cells GROUP BY 1, 2, 3)""",
    "seg": """
seg AS (
  SELECT DISTINCT dir, fov FROM (
    SELECT 'Segmentation_' || source || '_' || lpad(CAST(N AS VARCHAR), 3, '0') AS dir, N, fov
    FROM (SELECT source, CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) AS N,
                 CAST(CAST(floor(doc_id / 20) AS BIGINT) % 40 + 1 AS INTEGER) AS fov
          FROM documents) d0) d1
  WHERE N = 0 OR (fov + N) % 4 < 2)""",
    "manifests": """
manifests AS (
  SELECT 'Segmentation_u' || CAST(user_id AS VARCHAR) AS dir,
         json_extract_string(props, '$.k') AS Version, event_id AS row_idx
  FROM events)""",
    "run_steps": """
run_steps AS (
  SELECT user_id AS run, event_type AS step, min(ts) AS start, max(ts) AS "end"
  FROM events GROUP BY 1, 2)""",
    "inventory": """
inventory AS (
  SELECT url AS path, CAST(length(html) AS BIGINT) AS length FROM pages)""",
    "slides": """
slides AS (
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS slide,
         regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)', 1) AS run,
         'out/' || regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)', 1) || '/'
                || regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS output_prefix
  FROM pages)""",
    "outputs": """
outputs AS (
  SELECT output_prefix || '/images/' AS key FROM slides WHERE page_id % 3 = 0)""",
    "dictionary": """
dictionary AS (
  SELECT (CASE WHEN p_partkey % 2 = 0 THEN 'CPRO' ELSE 'X' END) || CAST(p_partkey AS VARCHAR) AS ProbeID,
         p_name AS DisplayName, p_partkey AS ord
  FROM part)""",
    "channels": """
channels AS (SELECT DISTINCT p_type AS name FROM part)""",
    "proteins": """
proteins AS (SELECT DISTINCT p_brand AS name FROM part)""",
}

_DEPS = {"pixels": ["tile_cells"], "label_pixels": ["tile_cells"], "outputs": ["slides"]}


def with_ctes(body: str, *names: str, extra: str | None = None) -> str:
    """Prefix ``body`` with the CTEs it uses (dependencies first)."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [SQL_CTES[n].strip() for n in order]
    if extra:
        parts.append(extra.strip())
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
