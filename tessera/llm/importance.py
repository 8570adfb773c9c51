"""Operator 12: target-distribution importance resampling.

Documents are drawn as if from the distribution of a target set (here the benchmark):
features are runs of 1 to ``order`` words, hashed to buckets; a bucket's gain is the
logarithm of its share in the target over its share in the corpus, and a document's
weight the sum of its features' gains, looked up in one array. Adding Gumbel noise that is
fixed by the id and the seed turns the highest scores into a draw without replacement.

The highest scores are found by parallel sorting by regular sampling: every partition
sorts its rows into a run, every ``stride``-th row of each run is a sample, regular
places among the sorted samples are the splitters, segments between splitters are
exchanged, each merges the runs it received, and prefix counts over the segments make
local places exact ranks. The row number is the last part of the sort key, so ties and
rows that repeat are split like any others.

Cases: a null or empty text has no features and weight 0; a null id takes no noise, so
score and rank are null and the row is not among those drawn from; rows that repeat count
and are drawn row by row, ties going to the smaller id; with no documents of ``min_words``
words, none is drawn; empty tables give an empty result, an empty target set gains like one
that holds every bucket equally often; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import numbered, read, saved, set_aside, with_text
from .text import by_bytes, runs, spread, text_buffer

BUCKETS = 10_000
SAMPLES_PER_SEGMENT = 64
SEGMENT_ROWS = 1 << 19
LONG_WORD = 64

#: Bytes of words once A-Z are lower case: digits, a-z, and all of a letter beyond ASCII.
_CLASS = np.zeros(256, bool)
_CLASS[0x30:0x3A] = _CLASS[0x61:0x7B] = _CLASS[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(0xEDB88320), x >> 1)
    return x


_CRC = _crc_table()


def crc32_runs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of the bytes of each run: one byte of all runs at a time, longest
    runs first, so that those still going on are a prefix; very long ones one by one."""
    length = ends - starts
    order = np.argsort(-np.minimum(length, LONG_WORD + 1), kind="stable")
    begin, size = starts[order], length[order]
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    long = int((size > LONG_WORD).sum())
    longest = int(size[long]) if long < len(size) else 0
    stop = np.searchsorted(-size[long:], -np.arange(longest), "left") + long
    for k in range(longest):
        going = slice(long, int(stop[k]))
        state[going] = _CRC[(state[going] ^ buf[begin[going] + k]) & 0xFF] ^ (state[going] >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = ~state
    for k in order[:long]:
        out[k] = zlib.crc32(buf[starts[k]:ends[k]].tobytes())
    return out


def features(column: pa.Array, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, document index) of every feature of the texts, and words per document."""
    buf, offsets = text_buffer(column)
    buf = _LOWER[buf]
    starts, ends, owner = runs(_CLASS[buf], offsets)
    n_words = np.bincount(owner, minlength=len(column))
    length = ends - starts
    place = np.cumsum(length + 1) - length - 1
    line = np.full(int(length.sum()) + len(length), 32, np.uint8)  # the words, each followed by one space
    line[spread(place, length)] = buf[spread(starts, length)]
    found, docs = [], []
    for n in range(1, order + 1):
        first = np.flatnonzero(owner[:len(owner) - n + 1] == owner[n - 1:]) if len(owner) >= n else np.zeros(0, np.int64)
        last = first + n - 1
        found.append(crc32_runs(line, place[first], place[last] + length[last]) % buckets)
        docs.append(owner[first])
    return np.concatenate(found), np.concatenate(docs), n_words


def bucket_counts(docs: DataFrame, order: int, buckets: int) -> np.ndarray:
    """Features per bucket over all texts: one array a task, summed; at most ``buckets`` rows come back."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in by_bytes(batches):
            total += np.bincount(features(batch.column("text"), order, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in with_text(docs).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / corpus share)) of every bucket, shares smoothed by one."""
    buckets, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    top, low = s_all + buckets, t_all + buckets
    return np.array([math.floor(1000 * math.log((float(t) + 1) * top / ((float(s) + 1) * low))) for s, t in zip(corpus, target)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, order: int, id_col: str) -> DataFrame:
    """rid, id, n_words, n_features, weight of every row."""
    buckets = len(gain)

    def weigh(batches):
        for batch in by_bytes(batches):
            bucket, owner, n_words = features(batch.column("text"), order, buckets)
            n = batch.num_rows
            weight = np.bincount(owner, weights=gain[bucket], minlength=n).astype(np.int64)  # whole numbers far below 2**53
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("id"), pa.array(n_words.astype(np.int64)),
                 pa.array(np.bincount(owner, minlength=n).astype(np.int64)), pa.array(weight)],
                names=["rid", "id", "n_words", "n_features", "weight"])

    rows = numbered(with_text(docs, id_col).toDF("id", "text").withColumn("id", F.col("id").cast("long")))
    return rows.mapInArrow(weigh, "rid long, id long, n_words long, n_features long, weight long")


def sort_keys(score: np.ndarray, ident: np.ndarray, rid: np.ndarray) -> np.ndarray:
    """Byte strings that sort as (score descending, id, row number)."""
    parts = np.empty((len(score), 3), ">u8")
    for k, values in enumerate((-score, ident, rid)):
        parts[:, k] = np.ascontiguousarray(values, np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return parts.view("S24").ravel()


def _keys(batch) -> np.ndarray:
    return sort_keys(*[batch.column(c).to_numpy() for c in ("score", "id", "rid")])


def ranked(rows: DataFrame, n: int, keep: int) -> DataFrame:
    """``rows`` (score, id, rid, ...; ``n`` of them) with rank: 1, 2, ... up to ``keep`` by
    descending score, then id; null beyond. Sorted by regular sampling."""
    spark = rows.sparkSession
    segments = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SEGMENT_ROWS))
    stride = max(1, n // (segments * SAMPLES_PER_SEGMENT))
    sorted_runs = saved(rows.sortWithinPartitions(F.col("score").desc(), "id", "rid").withColumn("pos", F.monotonically_increasing_id()))
    place = F.col("pos").bitwiseAND(F.lit((1 << 33) - 1))
    # at most SAMPLES_PER_SEGMENT keys a segment and one a run
    samples = sorted_runs.filter(place % stride == stride // 2).select("score", "id", "rid").toArrow()
    keys = np.sort(_keys(samples.combine_chunks()))
    splitters = np.unique(keys[np.arange(1, segments) * len(keys) // segments]) if len(keys) else keys
    names, types = rows.columns, ", ".join(f"{c} {t}" for c, t in rows.dtypes)

    def assign(batches):
        for batch in batches:
            at = np.searchsorted(splitters, _keys(batch), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(at)], names=[*names, "segment"])

    dealt = sorted_runs.select(*names).mapInArrow(assign, f"{types}, segment int")
    size = np.zeros(len(splitters) + 1, np.int64)
    for row in dealt.groupBy("segment").count().collect():  # one row a segment
        size[row["segment"]] = row["count"]
    before = np.cumsum(size) - size
    reached = int(np.searchsorted(before, keep, "left"))  # later segments hold no rank up to ``keep``

    def merge(key, table):
        table = table.combine_chunks()
        order = np.argsort(_keys(table), kind="stable")  # runs arrive sorted: a merge of them
        rank = before[key[0].as_py()] + 1 + np.arange(len(order))
        return table.take(pa.array(order)).select(names).append_column("rank", pa.array(rank, mask=rank > keep))

    near = dealt.filter(F.col("segment") < reached).groupBy("segment").applyInArrow(merge, f"{types}, rank long")
    return near.union(dealt.filter(F.col("segment") >= reached).drop("segment").withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, order: int = 1, buckets: int = BUCKETS,
             seed: int = 2024, id_col: str = "doc_id") -> DataFrame:
    """rid, id, n_words, n_features, weight, score, rank (null: not drawn) of every row;
    floor(percent * N / 100) of the N rows with ``min_words`` words are drawn."""
    gain = gains(bucket_counts(docs, order, buckets), bucket_counts(target, order, buckets))
    digest = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), 1, 8)
    uniform = (F.conv(digest, 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(uniform)))
    rows = saved(weighed(docs, gain, order, id_col).withColumn("score", F.col("weight") + noise))
    able = F.col("score").isNotNull() & (F.col("n_words") >= min_words)
    n = rows.filter(able).count()
    others = rows.filter(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked(rows.filter(able), n, percent * n // 100).union(others) if n else others


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The documents that are drawn, columns as given."""
    chosen = resample(docs, target, **options).filter("rank IS NOT NULL").select("rid")
    rows, _, restored = set_aside(docs)
    return restored(rows.join(chosen, "rid", "left_semi"))


def op12_importance(spark, sf_dir):
    rows = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return rows.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
dw AS (SELECT rid, unnest(words) AS word FROM d),
v AS (SELECT DISTINCT word FROM (SELECT word FROM dw UNION ALL SELECT word FROM b)),
h AS (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(word) + 1),
        lambda i: ('0x' || substr(hex(encode(word)), 2 * i - 1, 2))::BIGINT)),
        lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))) % 10000 AS bucket FROM v),
dc AS (SELECT bucket, count(*) AS n FROM dw JOIN h USING (word) GROUP BY bucket),
bc AS (SELECT bucket, count(*) AS n FROM b JOIN h USING (word) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((coalesce(bc.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM dc) + 10000)::DOUBLE
        / ((dc.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM bc) + 10000)::DOUBLE)))::BIGINT AS gain FROM dc LEFT JOIN bc USING (bucket)),
w AS (SELECT rid, sum(gain) AS weight FROM dw JOIN h USING (word) JOIN g USING (bucket) GROUP BY rid),
s AS (
  SELECT rid, doc_id, len(words) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM d LEFT JOIN w USING (rid)),
r AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id, rid) AS place, count(*) OVER () AS n FROM s WHERE n_features >= 20 AND score IS NOT NULL)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank FROM s LEFT JOIN r USING (rid)
"""
