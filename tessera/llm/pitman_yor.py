"""Operator 5: language-model scores from a hierarchical Pitman-Yor model.

Restaurants: a token is seated in the restaurant of its context, the whole word before
it (or the text's start), whose new tables are customers of one parent restaurant
shared by all contexts. The parent's base gives ``UNKNOWN`` of its mass to the one
outcome "a word outside the training vocabulary" and the rest to the vocabulary,
uniformly: probabilities sum to 1 over the vocabulary and that outcome. Discounts come
from the counts of counts of each level.

Cells. A task turns about ``CHUNK_BYTES`` of text into the chunk's distinct cells
(word, context) with training counts and sends each once to the word's bucket, so a
frequent word pair is one entry a chunk. A bucket merges them and keeps, for each
chunk, the places of its cells; words and contexts are numbers from there on.

Training. Gibbs sweeps reseat all customers of a cell given everything else: their
tables are drawn by the Chinese-restaurant rule, customer by customer up to 64 and then
in blocks that double. A word's parent state is in its bucket; a context's totals
(customers, tables) are sums over buckets, kept by hash range of the context: a bucket
sends its tables by context to the ranges and gets the sums back, in the order of its
own contexts, so no hash travels after the first round. Buckets run side by side
against the totals of the sweep before; only the parent's two sums return to the driver.

Scoring. The predictive probability of every cell, averaged over the sweeps after
burn-in, and the word's count go to the chunks that hold the cell and meet their texts,
which are scored whole. Logarithms of single cells travel as 32-bit floats.

Words are told apart by 60-bit hashes (about one collision expected at 10**9 words).

Cases: null and empty texts are one end token; rows without an id count as id '';
repeated rows are documents of their own; without training rows, all probability is
the base's; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import saved, text_bytes
from .text import LOWER, U64, by_bytes, mix, run_lengths, text_buffer, word_hashes, words

CONTEXTS = 16            # contexts the low bits of a key can name, for a Sampler without its own
CHUNK_BYTES = 16 << 20
_WORD = U64(0xFFFFFFFFFFFFFFF0)
_END = mix(np.array([0x5DEECE66D], U64))[0] & _WORD
_START = _WORD           # context of a text's first token; above every word
STRENGTH = 1.0
UNKNOWN = 0.5


def doc_tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """(word hash of every token, document index): each document's words, then its end."""
    buf, offsets = text_buffer(column)
    starts, ends, docs = words(buf, offsets)
    n = len(column)
    at = np.arange(len(docs)) + docs  # one end token after each earlier document
    last = np.cumsum(np.bincount(docs, minlength=n)) + np.arange(n)
    key = np.empty(len(docs) + n, U64)
    key[at] = word_hashes(buf, starts, ends) & _WORD
    key[last] = _END
    return key, np.repeat(np.arange(n), np.diff(np.concatenate([[-1], last])))


def token_cells(columns) -> tuple[np.ndarray, np.ndarray, list, np.ndarray]:
    """(vocabulary, cell number of every token, document index by column, distinct
    cells). A cell is word * (vocabulary + 1) + context, both as places in the sorted
    vocabulary; the text's start comes after it."""
    parts = [doc_tokens(c) for c in columns]
    vocabulary, word = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    context = np.empty(len(word), np.int64)
    context[1:] = word[:-1]
    context[np.concatenate([np.diff(o, prepend=-1) > 0 for _, o in parts])] = len(vocabulary)
    cells, number = np.unique(word * (len(vocabulary) + 1) + context, return_inverse=True)
    return vocabulary, number, [o for _, o in parts], cells


def chunked(batches, *columns):
    """(chunk id, tables of its slices): a partition's rows in order, cut at
    ``CHUNK_BYTES`` of text."""
    part, k, held, size = TaskContext.get().partitionId(), 0, [], 0
    for batch in by_bytes(batches):
        held.append(batch)
        size += len(text_buffer(batch.column("text"))[0])
        if size >= CHUNK_BYTES:
            yield part << 32 | k, held
            k, held, size = k + 1, [], 0
    if held:
        yield part << 32 | k, held


def cells_of(held) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, context, training count) of a chunk's distinct cells, in order."""
    vocabulary, number, owners, cells = token_cells([b.column("text") for b in held])
    train = np.concatenate([~b.column("held_out").to_numpy(zero_copy_only=False)[o] for b, o in zip(held, owners)])
    counts = np.bincount(number[train], minlength=len(cells))
    names = np.append(vocabulary, _START)
    return vocabulary[cells // len(names)], names[cells % len(names)], counts


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so a sorted array falls into them in order."""
    return ((keys >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def seat(customers: np.ndarray, fresh: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables of each dish after its customers sit down: customer i + 1 opens a table
    with odds ``fresh`` to ``i - discount * tables``."""
    tables = np.minimum(customers, 1).astype(np.int64)
    live = np.flatnonzero(customers > 1)
    for i in range(1, 64):
        if not len(live):
            return tables
        t, a = tables[live], fresh[live]
        tables[live] += rng.random(len(live)) < a / (a + i - discount * t)
        live = live[customers[live] > i + 1]
    low = 64
    while len(live):
        n = np.minimum(customers[live], 2 * low) - low
        a = fresh[live]
        chance = np.clip(a / (a + low + n / 2 - discount * tables[live]), 0, 1)
        tables[live] += rng.binomial(n, chance)
        low *= 2
        live = live[customers[live] > low]
    return tables


def unknown_mass(base: dict) -> float:
    return UNKNOWN if base["v"] else 1.0


def known_mass(base: dict) -> float:
    """Base probability of one word of the vocabulary."""
    return (1 - unknown_mass(base)) / max(base["v"], 1)


class Sampler:
    """State of one bucket's cells, sorted by word, and its sweeps. ``keys`` tell words
    apart by their high 60 bits; ``context`` numbers each cell's context among
    ``contexts`` (without it, the low bits of the key do)."""

    def __init__(self, keys, counts, bucket: int, base: dict, context=None, contexts: int = CONTEXTS):
        self.counts, self.bucket, self.base, self.contexts = counts.astype(np.int64), bucket, base, contexts
        self.context = (keys & ~_WORD).astype(np.int64) if context is None else context
        self.first, size = run_lengths(keys & _WORD)
        self.word = np.repeat(np.arange(len(self.first)), size)
        self.resume(np.minimum(self.counts, 1))
        self.parent_tables = np.minimum(self.parent, 1)

    def resume(self, tables, parent_tables=None) -> None:
        self.tables, self.parent_tables = tables, parent_tables
        self.parent = self.by_word(tables)

    def by_word(self, values) -> np.ndarray:
        return np.add.reduceat(values, self.first) if len(self.first) else np.zeros(0, np.int64)

    def by_context(self, values) -> np.ndarray:
        return np.bincount(self.context, weights=values, minlength=self.contexts)

    def parent_chance(self, total) -> np.ndarray:
        b = self.base
        fresh = (STRENGTH + b["d0"] * total["t0"]) * known_mass(b)
        return (self.parent - b["d0"] * self.parent_tables + fresh) / (STRENGTH + total["c0"])

    def sweep(self, number: int, total) -> None:
        b, rng = self.base, np.random.default_rng([b"hpy"[0], number, self.bucket])
        fresh = (STRENGTH + b["d"] * total["t"][self.context]) * self.parent_chance(total)[self.word]
        self.resume(seat(self.counts, fresh, b["d"], rng))
        self.parent_tables = seat(self.parent, np.full(len(self.parent), (STRENGTH + b["d0"] * total["t0"]) * known_mass(b)), b["d0"], rng)

    def chances(self, total, customers) -> np.ndarray:
        """Predictive probability of every cell; a word never trained on is the unknown one."""
        b = self.base
        unknown = (STRENGTH + b["d0"] * total["t0"]) * unknown_mass(b) / (STRENGTH + total["c0"])
        parent = np.where(self.parent > 0, self.parent_chance(total), unknown)[self.word]
        own = self.counts - b["d"] * self.tables
        return (own + (STRENGTH + b["d"] * total["t"][self.context]) * parent) / (STRENGTH + customers[self.context])

    def sums(self) -> dict:
        return {"t": self.by_context(self.tables), "c0": int(self.parent.sum()), "t0": int(self.parent_tables.sum())}


def squeezed(values: np.ndarray) -> bytes:
    """Compressed byte planes, after their length."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def loose(data: bytes, kind) -> np.ndarray:
    planes = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd")
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def packed(values) -> bytes:
    values = np.ascontiguousarray(values)
    if len(values) and int(values.max()) >> 32:
        raise OverflowError("a count of one cell is over 32 bits")
    return squeezed(values.astype(np.uint32))


def unpacked(data) -> np.ndarray:
    return loose(data, np.uint32).astype(np.int64)


def packed_sums(values) -> bytes:
    return squeezed(values.astype(np.int64))


def packed_hashes(values) -> bytes:
    """Hashes in order as differences."""
    return squeezed(np.diff(values, prepend=U64(0)))


def unpacked_hashes(data) -> np.ndarray:
    return np.cumsum(loose(data, U64), dtype=U64)


def one_row(batch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def rows_of(schema: pa.Schema, rows) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


def _schema(text: str) -> pa.Schema:
    kind = {"long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kind[t]) for n, t in (x.split() for x in text.split(", "))])


def tidy(spark) -> None:
    """Let Spark delete the shuffle files of steps whose result is saved: its cleaner
    waits for the driver's garbage collection."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


_FIGURES = ("tokens", "vocabulary", "once", "twice", "words_once", "words_twice", "cells")
_SENT = "bucket long, chunk long, words binary, sizes binary, contexts binary, counts binary"
_BUILT = "bucket long, sizes binary, context binary, counts binary, names binary, chunks binary, lengths binary, asks binary, " + ", ".join(f"{n} long" for n in _FIGURES)
_NAMES = "owner long, bucket long, names binary, customers binary, tables binary"
_OWNED = "owner long, bucket long, place binary, customers binary, tables binary"
_SWEPT = "kind long, bucket long, owner long, a binary, b binary, c0 long, t0 long"
_TOTAL = "bucket long, owner long, tables binary"
_NOTES = "bucket long, round long, owner long, a binary, b binary"
_ANSWERS = "bucket long, chunk long, logs binary, counts binary"
_KINDS = {n: _schema(n) for n in (_SENT, _BUILT, _NAMES, _OWNED, _SWEPT, _TOTAL, _NOTES, _ANSWERS)}


def merged(key, table):
    """One bucket's cells over all chunks: (words' numbers of cells, context number and
    count of each cell, hashes of the contexts) and each chunk's places among them."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    join = lambda c, of: np.concatenate([of(r[c]) for r in rows])
    sent = [unpacked(r["counts"]) for r in rows]
    names, context = np.unique(join("contexts", lambda x: np.frombuffer(x, U64)), return_inverse=True)
    word = np.repeat(np.unique(join("words", unpacked_hashes), return_inverse=True)[1], join("sizes", unpacked))
    cells, place = np.unique(word * len(names) + context, return_inverse=True)
    counts = np.bincount(place, weights=np.concatenate(sent), minlength=len(cells)).astype(np.int64)
    sizes = np.bincount(cells // len(names))
    per_word = np.add.reduceat(counts, np.cumsum(sizes) - sizes)
    lengths = np.array([len(x) for x in sent])
    ends = np.cumsum(lengths)
    asks = np.diff(place, prepend=0)
    asks[(ends - lengths)[1:]] = place[(ends - lengths)[1:]]
    figures = [counts.sum(), (per_word > 0).sum(), (counts == 1).sum(), (counts == 2).sum(), (per_word == 1).sum(), (per_word == 2).sum(), (counts > 0).sum()]
    return rows_of(_KINDS[_BUILT], [{
        "bucket": key[0].as_py(), "sizes": packed(sizes), "context": packed(cells % len(names)), "counts": packed(counts), "names": packed_hashes(names),
        "chunks": np.array([r["chunk"] for r in rows], np.int64).tobytes(), "lengths": packed(lengths), "asks": packed(asks),
        **{n: int(x) for n, x in zip(_FIGURES, figures)}}])


def sampler_of(r, base) -> Sampler:
    sizes, context = unpacked(r["sizes"]), unpacked(r["context"])
    keys = np.repeat(np.arange(len(sizes), dtype=U64) << U64(4), sizes)
    return Sampler(keys, unpacked(r["counts"]), r["bucket"], base, context, int(context.max()) + 1)


def owned(key, table):
    """Totals of a range's contexts: customers and first tables, and the place of each
    bucket's contexts among the range's."""
    rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
    found = [unpacked_hashes(r["names"]) for r in rows]
    names, place = np.unique(np.concatenate(found), return_inverse=True)
    cut = np.cumsum([len(x) for x in found])[:-1]
    total = [np.bincount(place, weights=np.concatenate([unpacked(r[c]) for r in rows]), minlength=len(names)) for c in ("customers", "tables")]
    return rows_of(_KINDS[_OWNED], [{"owner": r["owner"], "bucket": r["bucket"], "place": packed(p), "customers": packed_sums(total[0][p]), "tables": packed_sums(total[1][p])}
                                    for r, p in zip(rows, np.split(place, cut))])


def summed(key, sent, owners):
    """New totals of a range's contexts, to each bucket in the order of its own."""
    tables = {r["bucket"]: unpacked(r["a"]) for r in sent.to_pylist()}
    places = {r["bucket"]: unpacked(r["place"]) for r in owners.to_pylist()}
    total = np.zeros(max((int(p.max()) + 1 for p in places.values()), default=0))
    for b, p in places.items():
        total[p] += tables[b]
    return rows_of(_KINDS[_TOTAL], [{"bucket": b, "owner": key[0].as_py(), "tables": packed_sums(total[p])} for b, p in places.items()])


def scores(docs: DataFrame, sweeps: int = 4, burn_in: int = 2, id_col: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col("text").cast("string").alias("text"),
                       (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 1).alias("held_out"))
    buckets = max(spark.sparkContext.defaultParallelism, text_bytes(rows) // CHUNK_BYTES + 1)

    def send(batches):
        for chunk, held in chunked(batches):
            word, context, counts = cells_of(held)
            first, size = run_lengths(word)
            bucket, n = run_lengths(bucket_of(word[first], buckets))
            for b, k in zip(bucket, n):
                low, high = first[b], first[b + k - 1] + size[b + k - 1]
                yield rows_of(_KINDS[_SENT], [{"bucket": int(bucket_of(word[low:low + 1], buckets)[0]), "chunk": chunk, "words": packed_hashes(word[first[b:b + k]]), "sizes": packed(size[b:b + k]),
                                               "contexts": context[low:high].tobytes(), "counts": packed(counts[low:high])}]).to_batches()[0]

    def send_names(batches):
        for r in (r for batch in batches for r in batch.to_pylist()):
            s, names = sampler_of(r, None), unpacked_hashes(r["names"])
            customers, tables = s.by_context(s.counts), s.by_context(s.tables)
            first, size = run_lengths(bucket_of(names, buckets))
            for a, n in zip(first, size):
                yield rows_of(_KINDS[_NAMES], [{"owner": int(bucket_of(names[a:a + 1], buckets)[0]), "bucket": r["bucket"], "names": packed_hashes(names[a:a + n]),
                                                "customers": packed(customers[a:a + n]), "tables": packed(tables[a:a + n])}]).to_batches()[0]

    built = saved(rows.mapInArrow(send, _SENT).groupBy("bucket").applyInArrow(merged, _BUILT))
    tidy(spark)
    owners = saved(built.select("bucket", "sizes", "context", "counts", "names").mapInArrow(send_names, _NAMES).groupBy("owner").applyInArrow(owned, _OWNED))
    tidy(spark)
    f = built.agg(*[F.sum(n).alias(n) for n in _FIGURES]).first().asDict()
    f = {k: v or 0 for k, v in f.items()}
    discount = lambda one, two: min(max(one / (one + 2 * two), 0.05), 0.95) if one else 0.5
    base = {"v": f["vocabulary"], "n": f["tokens"], "d": discount(f["once"], f["twice"]), "d0": discount(f["words_once"], f["words_twice"])}
    heads = [{"c0": f["cells"], "t0": f["vocabulary"]}]

    # Notes of a bucket: totals of its contexts by round (owner >= 0: a tables, b
    # customers, these in round 0 only) and its own tables after each sweep (owner -1:
    # a of cells, b of words).
    def totals(notes, number):
        rows = sorted((r for r in notes if r["round"] == number and r["owner"] >= 0), key=lambda r: r["owner"])
        return {"t": np.concatenate([loose(r["a"], np.int64) for r in rows]), **heads[number]}

    def resumed(s, notes, number):
        for r in notes:
            if r["round"] == number and r["owner"] < 0:
                s.resume(unpacked(r["a"]), unpacked(r["b"]))

    def swept(number):
        def one(key, cells, notes):
            notes = notes.to_pylist()
            s = sampler_of(cells.to_pylist()[0], base)
            resumed(s, notes, number - 1)
            s.sweep(number, totals(notes, number))
            x, out = s.sums(), []
            at = 0
            for r in sorted((r for r in notes if r["round"] == number and r["owner"] >= 0), key=lambda r: r["owner"]):
                n = len(loose(r["a"], np.int64))
                out.append({"kind": 1, "bucket": s.bucket, "owner": r["owner"], "a": packed(x["t"][at:at + n])})
                at += n
            out.append({"kind": 0, "bucket": s.bucket, "owner": -1, "a": packed(s.tables), "b": packed(s.parent_tables), "c0": x["c0"], "t0": x["t0"]})
            return rows_of(_KINDS[_SWEPT], out)
        return one

    def note(frame, number, a, b):
        return frame.select("bucket", F.lit(number).cast("long").alias("round"), "owner", F.expr(a).cast("binary").alias("a"), F.expr(b).cast("binary").alias("b"))

    sums, own = [note(owners, 0, "tables", "customers")], []
    cells = built.select("bucket", "sizes", "context", "counts")
    places = owners.select("owner", "bucket", "place")
    for k in range(sweeps):
        notes = sums[k].union(own[k - 1]) if k else sums[0]
        out = saved(cells.groupBy("bucket").cogroup(notes.groupBy("bucket")).applyInArrow(swept(k), _SWEPT))
        got = out.filter("kind = 0").agg(F.sum("c0").alias("c0"), F.sum("t0").alias("t0")).first()
        heads.append({"c0": got["c0"] or 0, "t0": got["t0"] or 0})
        tidy(spark)
        back = out.filter("kind = 1").select("owner", "bucket", "a").groupBy("owner").cogroup(places.groupBy("owner"))
        sums.append(note(saved(back.applyInArrow(summed, _TOTAL)), k + 1, "tables", "null"))
        own.append(note(out.filter("kind = 0"), k, "a", "b"))
        tidy(spark)

    def answer(key, state, notes):
        r, notes = state.to_pylist()[0], notes.to_pylist()
        s = sampler_of(r, base)
        customers = np.concatenate([loose(x["b"], np.int64) for x in sorted((x for x in notes if x["round"] == 0 and x["owner"] >= 0), key=lambda x: x["owner"])])
        chance = np.zeros(len(s.counts))
        for number in range(burn_in, sweeps):
            resumed(s, notes, number)
            chance += s.chances(totals(notes, number + 1), customers)
        logs = np.log10(chance / (sweeps - burn_in)).astype(np.float32)
        counts = s.by_word(s.counts)[s.word]
        ends = np.cumsum(unpacked(r["lengths"]))[:-1]
        places = [np.cumsum(x) for x in np.split(unpacked(r["asks"]), ends)]
        return rows_of(_KINDS[_ANSWERS], [{"bucket": s.bucket, "chunk": int(c), "logs": squeezed(logs[p]), "counts": packed(counts[p])}
                                          for c, p in zip(np.frombuffer(r["chunks"], np.int64), places)])

    def with_chunk(batches):
        for chunk, held in chunked(batches):
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(held), pa.int64()), pa.array([one_row(b) for b in held], pa.binary())], names=["chunk", "rows"])

    def score(texts, answers):
        answers = answers.sort_by("bucket")
        logs = np.concatenate([loose(x, np.float32) for x in answers["logs"].to_pylist()]).astype(np.float64)
        counts = np.concatenate([unpacked(x) for x in answers["counts"].to_pylist()])
        slices = [pa.ipc.open_stream(x).read_next_batch() for x in texts["rows"].to_pylist()]
        _, number, owners, _ = token_cells([b.column("text") for b in slices])
        plain = np.log10((counts + 0.5) / (base["n"] + 0.5 * (base["v"] + 1)))
        out, end = [], 0
        for b, owner in zip(slices, owners):
            at = number[end:end + len(owner)]
            n, end = b.num_rows, end + len(owner)
            out.append(pa.table([b.column("doc_id"), b.column("held_out"), pa.array(np.bincount(owner, minlength=n), pa.int64()),
                                 pa.array(np.bincount(owner, weights=counts[at] > 0, minlength=n).astype(np.int64)), pa.array([base["n"]] * n, pa.int64()),
                                 pa.array(np.bincount(owner, weights=plain[at], minlength=n)), pa.array(np.bincount(owner, weights=logs[at], minlength=n))],
                                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(out)

    notes = sums[0]
    for number in range(burn_in, sweeps):
        notes = notes.union(own[number]).union(sums[number + 1])
    asked = built.select("bucket", "sizes", "context", "counts", "chunks", "lengths", "asks")
    answers = asked.groupBy("bucket").cogroup(notes.groupBy("bucket")).applyInArrow(answer, _ANSWERS)
    texts = rows.mapInArrow(with_chunk, "chunk long, rows binary")
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def perplexity(scored: DataFrame) -> DataFrame:
    """held_out, tokens, perplexity of the model and of the base."""
    power = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("tokens"), power("score").alias("perplexity"), power("base_score").alias("base_perplexity"))
