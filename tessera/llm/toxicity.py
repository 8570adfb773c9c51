"""Operator 7: toxicity by cumulative-link ordinal regression.

Severity grades 0 .. K-1 are ordered. One weight vector over sparse features (presence
of hashed words and word beginnings) is shared by all thresholds: P(grade <= k) = sigmoid(threshold_k -
w . x). The result is the expected severity, the chance of any toxicity, and a verdict.

Labels say only toxic or not. Toxic labelled rows are split into a mild and a severe
grade at the median number of distinct features typical of toxic rows, so K = 3.

The model is fitted on a bounded sample, at most ``max_labelled`` labelled rows, the
smallest by a digest of their id. Word statistics come from the sample in one
aggregation; the ``n_features`` most telling (by likelihood ratio) are used, and
only their hits are gathered for the fit. The chosen rows' ids are broadcast (bounded
by the parameter), so the texts are not shuffled. Scoring runs over whole texts.

Cases: null and empty texts have no features and score as the thresholds alone say;
labels that are null or name no document are left out, repeated labels count once per
document (toxic wins); repeated documents are scored row by row; without rows of both
classes, severity is 0 and nothing is toxic; an empty table gives an empty result;
other columns are ignored by ``toxicity`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import numbered, saved, with_text
from .text import by_bytes, run_lengths, text_buffer, word_hashes, words

BITS = 22
PREFIXES = (4, 5, 6, 7, 8, 10)  # bytes
LEAST_GAIN = 24.0  # likelihood ratio a feature must reach, about 5 standard deviations


def hashed_words(column) -> tuple[np.ndarray, np.ndarray]:
    """(document index, hashed feature). A word here is a run of
    letters and digits (all bytes from 0x80 count as letters), A-Z lower-cased; its
    features are itself and its beginnings of ``PREFIXES`` bytes."""
    buf, offsets = text_buffer(column)
    letter = (buf >= 128) | ((buf >= 48) & (buf <= 57)) | ((buf >= 65) & (buf <= 90)) | ((buf >= 97) & (buf <= 122))
    buf = np.where(letter, buf, np.uint8(32))
    starts, ends, docs = words(buf, offsets)
    found, owners = [word_hashes(buf, starts, ends)], [docs]
    for n in PREFIXES:
        longer = ends - starts > n
        found.append(word_hashes(buf, starts[longer], starts[longer] + n) ^ np.uint64(n << 60))
        owners.append(docs[longer])
    hashes = (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)
    return np.concatenate(owners), hashes


@dataclass
class Ordinal:
    """Cumulative-link model: weights per hashed word, ordered thresholds."""
    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def grades(self, score: np.ndarray) -> np.ndarray:
        """Chance of each grade, rows x K."""
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))
        edges = np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1)
        return np.diff(edges, axis=1)

    def scores(self, column) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[self.features] = self.weights
        docs, hashes = hashed_words(column)
        hit = table[hashes] != 0
        pairs = np.unique(docs[hit] << BITS | hashes[hit])
        return np.bincount(pairs >> BITS, weights=table[pairs & ((1 << BITS) - 1)], minlength=len(column))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, n_features: int, n_grades: int,
                l2: float = 2e-5, steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by full-batch Adam on the cumulative-link likelihood;
    thresholds stay ordered as a first value and positive steps."""
    n = len(grades)
    share = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / n, 1e-4, 1 - 1e-4)
    start = np.log(share / (1 - share))
    p = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    high, low = np.minimum(grades, n_grades - 2), np.maximum(grades - 1, 0)
    for t in range(1, steps + 1):
        w, cuts = p[:n_features], np.cumsum(np.concatenate([p[n_features:n_features + 1], np.exp(p[n_features + 1:])]))
        score = np.bincount(rows, weights=w[cols], minlength=n)
        up = np.where(grades < n_grades - 1, 1 / (1 + np.exp(-np.clip(cuts[high] - score, -50, 50))), 1.0)
        down = np.where(grades > 0, 1 / (1 + np.exp(-np.clip(cuts[low] - score, -50, 50))), 0.0)
        chance = np.maximum(up - down, 1e-12)
        d_up, d_down = up * (1 - up) / chance, down * (1 - down) / chance
        g_score = (d_up - d_down) / n
        g = np.zeros_like(p)
        g[:n_features] = np.bincount(cols, weights=g_score[rows], minlength=n_features) + l2 * w
        g_cut = (np.bincount(low, weights=np.where(grades > 0, d_down, 0), minlength=n_grades - 1)
                 - np.bincount(high, weights=np.where(grades < n_grades - 1, d_up, 0), minlength=n_grades - 1)) / n
        g[n_features:] = np.cumsum(g_cut[::-1])[::-1]
        g[n_features + 1:] *= np.exp(p[n_features + 1:])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return p[:n_features], np.cumsum(np.concatenate([p[n_features:n_features + 1], np.exp(p[n_features + 1:])]))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, n_features: int = 4096,
        id_col: str = "doc_id", label_col: str = "toxic") -> Ordinal | None:
    picked = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__toxic"))
              .filter("__id IS NOT NULL AND __toxic IS NOT NULL").groupBy("__id").agg(F.max("__toxic").alias("__toxic"))
              .orderBy(F.md5(F.col("__id").cast("string")), "__id").limit(max_labelled))
    # one row an id, by the digest of its text: rows that repeat an id do not widen the sample
    text = F.col("text").cast("string")
    sample = saved(docs.select(F.col(id_col).alias("__id"), F.struct(F.md5(F.coalesce(text, F.lit(""))).alias("digest"), text.alias("text")).alias("row"))
                   .join(F.broadcast(picked), "__id").groupBy("__id", "__toxic").agg(F.min("row").alias("row")).select("__toxic", "row.text"))

    def count(batches):
        for batch in by_bytes(batches):
            toxic = batch.column("__toxic").to_numpy()
            at, hashes = hashed_words(batch.column("text"))
            pairs = np.unique(at << BITS | hashes)
            key = np.sort((pairs & ((1 << BITS) - 1)) << 1 | (toxic[pairs >> BITS] > 0))
            start, n = run_lengths(key)
            key = key[start]
            yield pa.RecordBatch.from_arrays([pa.array(key >> 1), pa.array(np.where(key & 1, 0, n)), pa.array(np.where(key & 1, n, 0))],
                                             names=["word", "clean", "toxic"])

    totals = sample.groupBy((F.col("__toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()
    n = {r["toxic"]: r["n"] for r in totals}
    if not n.get(True) or not n.get(False):
        return None
    share = n[True] / (n[True] + n[False])
    seen = F.col("toxic") + F.col("clean")
    odds = F.log((F.col("toxic") + 0.5) / (n[True] + 1.0)) - F.log((F.col("clean") + 0.5) / (n[False] + 1.0))
    part = lambda c, p: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (seen * p))).otherwise(0.0)
    gain = 2 * (part("toxic", share) + part("clean", 1 - share))
    telling = (sample.mapInArrow(count, "word long, clean long, toxic long").groupBy("word")
               .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
               .select("word", odds.alias("odds"), gain.alias("gain")).filter(F.col("gain") > LEAST_GAIN)
               .orderBy(F.desc("gain"), "word").limit(n_features).collect())
    if not telling:
        return None
    features = np.array([r["word"] for r in telling])
    typical = np.array([r["odds"] > 2 for r in telling])

    def hits(batches):
        place = np.full(1 << BITS, -1, np.int32)
        place[features] = np.arange(len(features))
        for batch in by_bytes(batches):
            at, hashes = hashed_words(batch.column("text"))
            found = place[hashes]
            at, found = at[found >= 0], found[found >= 0]
            pairs = np.unique(at << 32 | found)
            telling = np.bincount(pairs >> 32, weights=typical[pairs & 0xFFFFFFFF], minlength=batch.num_rows).astype(np.float64)
            edges = np.searchsorted(pairs >> 32, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("__toxic"), pa.array(telling), lists], names=["toxic", "telling", "at"])

    got = sample.mapInArrow(hits, "toxic int, telling double, at array<int>").toArrow()
    toxic, hits_of = got["toxic"].to_numpy() > 0, got["telling"].to_numpy()
    severe = hits_of > np.median(hits_of[toxic])
    grades = np.where(toxic, 1 + severe, 0)
    lists = got["at"].combine_chunks()
    rows = np.repeat(np.arange(len(grades)), np.diff(lists.offsets.to_numpy()))
    order = np.lexsort((hits_of, grades))  # the sample's row order must not matter
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    weights, thresholds = fit_ordinal(back[rows], lists.flatten().to_numpy(), grades[order], len(features), 3)
    return Ordinal(features, weights.astype(np.float32), thresholds)


def toxicity(docs: DataFrame, labels: DataFrame, cutoff: float = 0.5, id_col: str = "doc_id", **options) -> DataFrame:
    """doc_id, severity (expected grade), p_toxic, toxic of every row."""
    model = fit(docs, labels, id_col=id_col, **options)
    kind = dict(docs.dtypes)[id_col]
    return with_text(docs, id_col).mapInArrow(scorer(model, cutoff, id_col), f"`{id_col}` {kind}, severity double, p_toxic double, toxic boolean")


def scorer(model: Ordinal | None, cutoff: float, key: str):
    def run(batches):
        for batch in by_bytes(batches):
            if model is None:
                chances = np.eye(1, 3).repeat(batch.num_rows, axis=0)
            else:
                chances = model.grades(model.scores(batch.column("text")))
            any_toxic = 1 - chances[:, 0]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(chances @ np.arange(chances.shape[1])),
                                              pa.array(any_toxic), pa.array(any_toxic >= cutoff)],
                                             names=[key, "severity", "p_toxic", "toxic"])
    return run


def drop_toxic(docs: DataFrame, labels: DataFrame, cutoff: float = 0.5, **options) -> DataFrame:
    """The documents that are not toxic; columns as given."""
    model = fit(docs, labels, **options)
    schema = docs.schema

    def keep(batches):
        score = scorer(model, cutoff, "__n")
        for batch in by_bytes(batches):
            keyed = pa.RecordBatch.from_arrays([batch.column("text"), pa.array(np.arange(batch.num_rows))], names=["text", "__n"])
            verdict = pa.Table.from_batches(list(score([keyed])))["toxic"]
            yield batch.filter(pc.invert(verdict.combine_chunks()))
    return docs.mapInArrow(keep, schema)
