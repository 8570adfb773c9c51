"""Operator 9: mix sources to target weights by capped water-filling.

Sources share the words of all documents by weight; a source stops at ``max_epochs``
times its own size and what it leaves is shared again by weight until no source is
above its cap. The water level is found by repeated sums over the sources, which
return two scalars a round. A source's target is then met with whole repetitions of
all its documents and one further, partial pass in a seeded order. The order is cut
into ``2**16`` hash ranges: prefix sums over the ranges of a source and running sums
inside a range replace one long window, so a source with a third of all rows is
spread over all tasks.

Only DataFrame functions run here. Reruns agree: the order comes from a digest of the
seed, the id and the size.

Cases: a null text has size 0; null sources form one source, last in order; documents
of size 0 take nothing; repeated rows are documents of their own; an empty table gives
an empty result; other columns are ignored by ``mix_plan`` and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import numbered, saved, set_aside

WORD = r"[^\x20\x09-\x0D]+"
RANGE_DIGITS = 4  # hex digits of the digest that name a range


def source_key(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), c))


def source_ranks(sizes: DataFrame) -> DataFrame:
    """Position of each source in code-point order, null last, without one global
    window: sources are range-partitioned, numbered inside a partition, and shifted by
    the number of sources in the partitions before it."""
    ranged = saved(sizes.repartitionByRange("source_key").withColumn("part", F.spark_partition_id()))
    before = (ranged.groupBy("part").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
              .select("part", F.coalesce("before", F.lit(0)).alias("before")))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("source_key"))
    return ranged.withColumn("inside", inside).join(before, "part").select(
        "source_key", "source_size", (F.col("before") + F.col("inside") - 1).alias("rank"))


def water_level(sources: DataFrame, max_epochs: float) -> float:
    """Words per unit of weight at which capped sources and the rest share all words."""
    total = sources.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    if not total["t"]:
        return 0.0
    level = total["t"] / total["w"]
    while True:
        above = F.col("source_size") * max_epochs < F.col("weight") * F.lit(level)
        row = sources.agg(F.sum(F.when(above, F.col("source_size") * max_epochs)).alias("capped"),
                          F.sum(F.when(~above, F.col("weight"))).alias("w")).first()
        found = (total["t"] - (row["capped"] or 0)) / row["w"] if row["w"] else level
        if found <= level:
            return level
        level = found


def mix_plan(docs: DataFrame, weights=(5, 2, 1), max_epochs: int = 3, seed: int = 17,
             id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """rid, doc_id, size, source_size, target, reps, taken (reps * size) of every row."""
    rows = saved(numbered(docs).select(
        "rid", F.col(id_col).alias("doc_id"), source_key(F.col(source_col).cast("string")).alias("source_key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")))
    rows = rows.withColumn("order", order).withColumn("range", F.substring("order", 1, RANGE_DIGITS))
    sizes = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = saved(source_ranks(sizes).withColumn("weight", weight))
    level = water_level(sources, float(max_epochs))
    cap = F.col("source_size") * F.lit(float(max_epochs))
    sources = sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))
    sources = (sources.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
               .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    in_source = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (rows.groupBy("source_key", "range").agg(F.sum("size").alias("range_size"))
              .withColumn("before_range", F.coalesce(F.sum("range_size").over(in_source), F.lit(0)))
              .join(sources, "source_key").drop("range_size", "rank", "weight"))
    in_range = Window.partitionBy("source_key", "range").orderBy("order", "rid").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("before_range") + F.coalesce(F.col("before_row"), F.lit(0))
    extra = (F.col("rest") > 0) & (before + F.col("size") / 2 <= F.col("rest"))
    return (rows.withColumn("before_row", F.sum("size").over(in_range))
            .join(ranges, ["source_key", "range"])
            .withColumn("reps", F.col("whole") + F.when(extra, 1).otherwise(0))
            .select("rid", "doc_id", "size", "source_size", "target", "reps", (F.col("reps") * F.col("size")).alias("taken")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents with every row repeated as often as the mix takes it (0 to
    ``max_epochs`` times); columns as given."""
    plan = mix_plan(docs, **options).select("rid", "reps").filter("reps > 0")
    rows, _, restored = set_aside(docs)
    copies = rows.join(plan, "rid").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("reps").cast("int"))))
    return restored(copies)


SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
s AS (SELECT k, sum(size)::DOUBLE AS source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY encode(k)) - 1) % 3 + 1)::INT] AS weight FROM d GROUP BY k),
fill AS (
  SELECT sum(source_size) / sum(weight) AS level, 0 AS step FROM s
  UNION ALL
  SELECT (SELECT (sum(source_size) - sum(CASE WHEN 3.0 * source_size < weight * f.level THEN 3.0 * source_size ELSE 0 END))
               / sum(CASE WHEN 3.0 * source_size < weight * f.level THEN 0 ELSE weight END) FROM s), step + 1
  FROM fill f WHERE step < 40),
t AS (SELECT k, source_size, least(3.0 * source_size, weight * (SELECT max(level) FROM fill)) AS target FROM s),
u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
o AS (
  SELECT d.doc_id, d.size, u.source_size, u.target, u.whole, u.target - u.whole * u.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.k ORDER BY md5('17:' || d.doc_id || ':' || d.size) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN u ON u.k = d.k)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN rest > 0 AND before + size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM o
"""
