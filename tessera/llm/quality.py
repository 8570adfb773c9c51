"""Operator 8: quality rules with cross-document line frequency.

Line rule: lines are normalised (lower case, white space collapsed) and hashed; for
each host the distinct documents with a line are counted, where documents of the same
text count once. A line found in more than ``max(min_docs, share * documents of the
host)`` documents is removed; a document left with less than ``min_left`` of its words
(or none) is depleted and rejected. Base rules look at one document alone.

Only DataFrame functions run here. Texts never leave the scan: per-document figures
are array functions in the row, and only line hashes are shuffled. A line that a third
of all documents carry is one key of a partially aggregated count, and its rows meet
the short list of removed lines in a join that adaptive execution splits.

Cases: a null or empty text has no words and fails the base rules; null hosts are one
host; repeated rows are judged row by row and count once for line frequency; an empty
table gives an empty result; other columns are ignored by ``quality`` and kept by
``clean_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import numbered, set_aside

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 5


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a computed array once: the generator keeps the optimiser from copying the
    expression into every lambda that reads the column."""
    return df.withColumn(name, F.explode(F.array(value)))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, SPACE + "+", " ")))


def base_figures(rows: DataFrame) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of ``text``."""
    text = F.col("text")
    rows = (rows.withColumn("word_chars", (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long"))
            .withColumn("n_symbols", F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long")))
    rows = held(rows, "worded", F.filter(lines_of(text), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.withColumn("n_dup_lines", (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long")).drop("worded")
    rows = held(rows, "hashes", F.transform(F.filter(F.split(text, SPACE + "+", -1), lambda w: w != ""), lambda w: F.xxhash64(w))).drop("text")
    rows = rows.withColumn("n_words", F.size("hashes").cast("long"))
    at = lambda i, k: F.get(F.col("hashes"), i + k)
    windows = F.when(F.col("n_words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW),
        lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    rows = held(rows, "windows", windows).drop("hashes")
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    pairs = F.when(repeats, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(none)
    rows = held(rows, "pairs", pairs).drop("windows")
    same = lambda k, d: F.coalesce(F.get(F.col("pairs"), k + d)["h"], F.lit(None).cast("long"))
    twice = F.filter("pairs", lambda x, k: (x["h"].eqNullSafe(F.when(k > 0, same(k, -1)))) | (x["h"].eqNullSafe(same(k, 1))))
    rows = held(rows, "starts", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("pairs")
    step = F.transform("starts", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("starts"), k + 1) - s, F.lit(WINDOW))))
    return rows.withColumn("n_repeat_words", F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)).drop("starts")


def line_rows(rows: DataFrame) -> DataFrame:
    """rid, host, document digest, hash and words of every distinct normalised line."""
    lines = F.explode(F.array_distinct(F.filter(F.transform(lines_of(F.col("text")), normal), lambda x: x != "")))
    return (rows.select("rid", "host", F.xxhash64("text").alias("digest"), lines.alias("line"))
            .select("rid", "host", "digest", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")))


def frequent_lines(rows: DataFrame, min_docs: int, share: float) -> DataFrame:
    """(host, h1, h2) of the lines above the limit."""
    seen = line_rows(rows).groupBy("host", "h1", "h2", "digest").count()
    counts = seen.groupBy("host", "h1", "h2").agg(F.count("*").alias("docs")).filter(F.col("docs") > min_docs)
    hosts = (rows.select("host", F.xxhash64("text").alias("digest")).groupBy("host", "digest").count()
             .groupBy("host").agg(F.count("*").alias("host_docs")))
    return (counts.join(hosts, "host").filter(F.col("docs") > F.col("host_docs") * F.lit(share))
            .select("host", "h1", "h2"))


def _rows(docs: DataFrame, host_col: str, *keep: str) -> DataFrame:
    host = F.col(host_col).cast("string")
    return numbered(docs).select("rid", *keep, F.when(host.isNull(), "1").otherwise(F.concat(F.lit("0"), host)).alias("host"),
                                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def removed_words(rows: DataFrame, min_docs: int, share: float) -> DataFrame:
    """rid, removed: words on lines above the limit (repeats within the text included)."""
    words = F.regexp_count("line", F.lit(WORD))
    each = (rows.select("rid", "host", F.explode(F.filter(F.transform(lines_of(F.col("text")), normal), lambda x: x != "")).alias("line"))
            .select("rid", "host", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), words.alias("words")))
    return (each.join(frequent_lines(rows, min_docs, share), ["host", "h1", "h2"])
            .groupBy("rid").agg(F.sum("words").alias("removed")))


def quality(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", min_docs: int = 20,
            share: float = 0.02, min_left: float = 0.2) -> DataFrame:
    """Base figures and verdict of every row; ``removed_words`` are those on lines
    above the limit."""
    rows = _rows(docs, host_col, id_col)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (left <= 0) | (left < F.lit(min_left) * F.col("n_words"))
    return (base_figures(rows.select("rid", id_col, "text"))
            .join(removed_words(rows, min_docs, share), "rid", "left")
            .withColumn("removed_words", F.coalesce("removed", F.lit(0)).cast("long"))
            .withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)
            .select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words"))


def clean_documents(docs: DataFrame, host_col: str = "source", min_docs: int = 20, share: float = 0.02,
                    min_left: float = 0.2) -> DataFrame:
    """The documents that are not depleted, without the lines above the limit."""
    rows = _rows(docs, host_col)
    lines = F.posexplode(lines_of(F.col("text")))
    h = normal(F.col("line"))
    each = (rows.select("rid", "host", lines.alias("pos", "line"))
            .withColumn("h1", F.xxhash64(h)).withColumn("h2", F.xxhash64(F.lit(1), h))
            .withColumn("words", F.regexp_count("line", F.lit(WORD))))
    gone = frequent_lines(rows, min_docs, share).withColumn("gone", F.lit(True))
    kept = (each.join(gone, ["host", "h1", "h2"], "left").groupBy("rid")
            .agg(F.sum("words").alias("all"), F.sum(F.when(F.col("gone").isNull(), F.col("words")).otherwise(0)).alias("left"),
                 F.array_sort(F.collect_list(F.when(F.col("gone").isNull(), F.struct("pos", "line")))).alias("parts"))
            .filter((F.col("left") > 0) & (F.col("left") >= F.lit(min_left) * F.col("all")))
            .select("rid", F.array_join(F.transform("parts", lambda x: x["line"]), "\n").alias("left_text")))
    out, text, restored = set_aside(docs)
    return restored(out.join(kept, "rid").withColumn(text, F.col("left_text")))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
win AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
g AS (SELECT doc_id, i, array_to_string(words[i:i+4], ' ') AS s FROM win),
dup AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM dup WHERE c > 1) GROUP BY doc_id),
l AS (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
worded AS (SELECT * FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dl AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY doc_id),
nl AS (SELECT doc_id, host, text, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS line FROM worded),
hosts AS (SELECT host, count(DISTINCT text) AS n FROM d GROUP BY host),
freq AS (SELECT nl.host, line FROM nl JOIN hosts h ON h.host = nl.host GROUP BY nl.host, line
         HAVING count(DISTINCT text) > 20 AND count(DISTINCT text) > 0.02 * max(h.n)),
rem AS (SELECT nl.doc_id, sum(len(regexp_extract_all(nl.line, '[^\x20\x09-\x0D]+'))) AS n FROM nl JOIN freq f ON f.host = nl.host AND f.line = nl.line GROUP BY nl.doc_id),
f AS (
  SELECT d.doc_id, len(words) AS n_words, coalesce(list_sum([length(x) for x in words]), 0) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(dl.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
         coalesce(rem.n, 0) AS removed_words
  FROM d JOIN w ON w.doc_id = d.doc_id LEFT JOIN dl ON dl.doc_id = d.doc_id LEFT JOIN cov ON cov.doc_id = d.doc_id LEFT JOIN rem ON rem.doc_id = d.doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, removed_words::BIGINT AS removed_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - removed_words > 0
         AND n_words - removed_words >= 0.2 * n_words AS kept
FROM f
"""
