"""Operator 1: exact substring dedup with suffix arrays.

A byte goes when a string of ``length`` (200) bytes that covers it also starts
anywhere else, in the same or another document. Matches are judged on the input.

1. Anchors. Each 200-byte window has a 16-byte gram of least hash (leftmost at a tie).
   Its anchor is that gram with the 92 bytes before it, where the window holds them, or
   else after it, so equal windows have equal anchors; grams alone, of which there are
   only so many, would meet by chance ever more often in larger tables. A passage is the
   text under a maximal run of windows with one anchor: about 250 bytes for 50 windows.
   Windows can only be equal if their passages' anchors are, so passages whose anchor
   occurs once anywhere are dropped, exactly and before any text is shuffled.
   A task sends each anchor's first passage to the anchor's bucket and keeps the
   others (known to repeat) spread, so a frequent anchor costs a bucket one entry a task.
2. Passages with equal bytes become one, with a count; more than one copy settles all
   of its windows. Bytes only move for anchors with several distinct passages.
3. Shards. These passages are dealt to shards by anchor; an anchor with more than
   ``HOT`` distinct passages is spread over several shards. Each shard's suffix array is
   built by Larsson-Sadakane refinement in numpy (groups already sorted are left
   alone) to a depth of 200 bytes, where suffixes of one rank are a class of equal
   windows; suffixes too short to matter at a depth are left out from there on.
4. Merging. Shards of a spread anchor send one 128-bit fingerprint per class, sorted;
   a merging task finds each in the others' by binary search.
5. Marked windows go back to their documents, whose covered bytes are removed.

Memory: one shard's bytes, or the anchors of one slice of text; documents move by row.

Cases: null and empty texts, and texts below 200 bytes, lose nothing; repeated rows
are documents of their own, so both lose what they share; a document may repeat
itself; overlapping repeats count; an empty table gives an empty result; other columns
are ignored by ``repeat_digests`` and kept by ``remove_repeats``, where a character that
a cut splits is dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import numbered, saved, set_aside, text_bytes
from .text import EXACT, U64, by_bytes, mix, run_lengths, spread, text_buffer, word_hashes

GRAM = 16
HOT = 4096               # distinct passages of an anchor that one shard takes
SHARD_BYTES = 2 << 20
BUCKET_BYTES = 24 << 20
HELD = 1 << 20           # passages a task holds before it sends them
_SECOND = mix(EXACT ^ U64(0x5851F42D4C957F2D))


def packed(buf: np.ndarray) -> np.ndarray:
    """Big-endian 8-byte number at every position (zeros beyond the end)."""
    x = np.concatenate([buf, np.zeros(8, np.uint8)]).astype(U64)
    x = x[:-1] << U64(8) | x[1:]
    x = x[:-2] << U64(16) | x[2:]
    return (x[:-4] << U64(32) | x[4:])[:len(buf)]


def passages(buf: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(document index, start, windows, anchor hash) of every passage, all left halves
    first; starts count from the document's first byte."""
    none = np.zeros(0, np.int64)
    n = len(buf) - length + 1
    if n < 1:
        return none, none, none, np.zeros(0, U64)
    eight = packed(buf)
    gram = mix(eight[:len(buf) - GRAM + 1] * U64(0x9E3779B97F4A7C15) + mix(eight[8:len(buf) - GRAM + 9]))
    least = gram & U64(0xFFFFFFFF00000000) | np.arange(len(gram), dtype=U64)
    span, width = 1, length - GRAM + 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    anchor = (least & U64(0xFFFFFFFF)).astype(np.int64)
    size = np.diff(offsets)
    windows = np.maximum(size - length + 1, 0)
    fits = np.zeros(n + 1, np.int8)
    has = windows > 0
    fits[offsets[:-1][has]] += 1
    np.add.at(fits, offsets[:-1][has] + windows[has], -1)
    fits = np.cumsum(fits[:n], dtype=np.int8).astype(bool)
    new = fits.copy()
    new[1:] &= ~fits[:-1] | (anchor[1:] != anchor[:-1])
    new[offsets[:-1][has]] = True
    start = np.flatnonzero(new)
    stop = np.flatnonzero(fits & np.append(new[1:] | ~fits[1:], True)) + 1
    at = anchor[start]
    half = (length - GRAM) // 2
    middle = np.clip(at - half + 1, start, stop)
    left, right = middle > start, middle < stop
    low = np.concatenate([at[left] - half, at[right]])
    high = np.concatenate([at[left] + GRAM, at[right] + length - half])
    known = word_hashes(buf, low, high, EXACT)
    known[np.count_nonzero(left):] ^= U64(1)
    start, stop = np.concatenate([start[left], middle[right]]), np.concatenate([middle[left], stop[right]])
    doc = np.searchsorted(offsets, start, "right") - 1
    return doc, start - offsets[doc], stop - start, known


def suffix_array(text: np.ndarray, depth: int = 0, room: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank of every suffix): sorted by 8 bytes, then by the ranks
    ``h`` further on, doubling ``h``, only within groups that are not yet single.

    With a ``depth`` (8 at least) suffixes are sorted by their first ``depth`` bytes and
    ranks are equal where these are; with ``room`` (bytes from each position to its
    passage's end) only the suffixes that have as many bytes are told apart."""
    n = len(text)
    key = packed(text)
    order = np.argsort(key).astype(np.int32)
    starts, lengths = run_lengths(key[order])
    del key
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(starts, lengths)
    slots = spread(starts[lengths > 1], lengths[lengths > 1]).astype(np.int32)
    h = 8
    while len(slots) and not 0 < depth <= h:
        step = min(h, depth - h) if depth else h
        at = order[slots]
        if room is not None:
            enough = room[at] >= h + step
            at, slots = at[enough], slots[enough]
        key = rank[at].astype(np.int64)
        key <<= 32
        key |= np.where(at < n - step, rank[np.minimum(at, n - 1 - step) + step] + 1, 0)
        by = np.argsort(key)
        order[slots] = at = at[by]
        first, count = run_lengths(key[by])
        del key, by
        rank[at] = np.repeat(slots[first], count)
        slots = slots[spread(first[count > 1], count[count > 1])]
        h += step
    return order, rank


def common_prefixes(text: np.ndarray, order: np.ndarray, rank: np.ndarray, cap: int, lane: int = 512) -> np.ndarray:
    """Common prefix, up to ``cap``, of each suffix in the array with the one before:
    Kasai's walk in text order, where a suffix keeps all but one byte of what its
    neighbour to the left had, in parallel lanes of the text. The operator itself
    reads classes off ranks; this tells how far neighbours agree."""
    n = len(text)
    key = np.concatenate([packed(text), np.zeros(cap + 16, U64)])
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    found = np.zeros(n, np.int64)
    lanes = np.arange(0, n, lane)
    known = np.zeros(len(lanes), np.int64)
    for step in range(lane):
        i = lanes + step
        live = np.flatnonzero(i < n)
        i = i[live]
        j = before[i]
        l = np.maximum(known[live] - 1, 0)
        l[j < 0] = 0
        go = np.flatnonzero((j >= 0) & (l < cap))
        while len(go):
            differ = key[i[go] + l[go]] ^ key[j[go] + l[go]]
            same = differ == 0
            left = go[~same]
            if len(left):
                bits = 63 - np.floor(np.log2((differ[~same] >> U64(8)).astype(np.float64) * 256 + 255.5)).astype(np.int64)
                l[left] += np.where(differ[~same] >> U64(8) == 0, 7, bits // 8)
            go = go[same]
            l[go] += 8
            go = go[l[go] < cap]
        l = np.minimum(l, np.minimum(cap, n - np.maximum(i, j)))
        l[j < 0] = 0
        known[live] = l
        found[i] = l
    return found[order]


def window_classes(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage index, window, class) of every window of distinct passages. Byte 255,
    which UTF-8 never holds, parts them."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    buf = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    room = np.repeat((starts + sizes).astype(np.int32), sizes + 1) - np.arange(len(buf), dtype=np.int32)
    klass = suffix_array(buf, length, room)[1]
    count = sizes - length + 1
    at = spread(starts, count)
    which = np.repeat(np.arange(len(texts)), count)
    return which, at - starts[which], klass[at]


def repeated_anchors(docs: DataFrame, length: int, n_bytes: int) -> DataFrame:
    """rid, start, windows, anchor of the passages whose anchor occurs again."""
    buckets = max(1, int(n_bytes / 50 * 25 // BUCKET_BYTES) + 1)
    columns = ("anchor", "rid", "start", "windows")

    def pack(bucket, settled, rows):
        order = np.argsort(bucket, kind="stable")
        first, count = run_lengths(bucket[order])
        parts = [order[a:a + n] for a, n in zip(first, count)]
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[order[first]].astype(np.int32)), pa.array([settled] * len(parts))]
            + [pa.array([c[p].tobytes() for p in parts], pa.binary()) for c in rows], names=["bucket", "settled", *columns, "twice"])

    def flush(held):
        anchor, rid, start, windows = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(anchor, kind="stable")
        first, count = run_lengths(anchor[order])
        twice = (np.repeat(count, count) > 1).astype(np.uint8)
        rows = [c[order] for c in (anchor, rid, start.astype(np.int32), windows.astype(np.int32))] + [twice]
        lead = np.zeros(len(order), bool)
        lead[first] = True
        yield pack((rows[0][lead] >> U64(32)) % U64(buckets), False, [c[lead] for c in rows])
        if not lead.all():  # these repeat within this task already; any bucket will do
            yield pack(np.arange(np.count_nonzero(~lead)) // 4096 % buckets, True, [c[~lead] for c in rows])

    def send(batches):
        held, n = [], 0
        for batch in by_bytes(batches):
            rids = batch.column("rid").to_numpy()
            doc, start, windows, anchor = passages(*text_buffer(batch.column("text")), length)
            held.append((anchor, rids[doc], start, windows))
            n += len(anchor)
            if n >= HELD:
                yield from flush(held)
                held, n = [], 0
        if n:
            yield from flush(held)

    def meet(key, table):
        kinds = (U64, np.int64, np.int32, np.int32, np.uint8)
        settled = table["settled"].to_numpy()
        out = []
        for kind in (True, False):
            at = np.flatnonzero(settled == kind)
            if not len(at):
                continue
            rows = [np.concatenate([np.frombuffer(table[c][k].as_py(), t) for k in at.tolist()]) for c, t in zip((*columns, "twice"), kinds)]
            if not kind:
                order = np.argsort(rows[0], kind="stable")
                _, count = run_lengths(rows[0][order])
                again = np.empty(len(order), bool)
                again[order] = np.repeat(count, count) > 1
                rows = [c[again | (rows[4] > 0)] for c in rows]
            out.append(rows)
        anchor, rid, start, windows, _ = (np.concatenate(x) for x in zip(*out))
        return pa.table({"rid": pa.array(rid), "start": pa.array(start), "windows": pa.array(windows), "anchor": pa.array(anchor.view(np.int64))})

    sent = docs.mapInArrow(send, "bucket int, settled boolean, anchor binary, rid binary, start binary, windows binary, twice binary")
    return sent.groupBy("bucket").applyInArrow(meet, "rid long, start int, windows int, anchor long")


def cut_passages(docs: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """rid, anchor, digest, passage, windows, copies, starts: a document's distinct
    passages."""
    wanted = found.groupBy("rid").agg(F.collect_list(F.struct("start", "windows", "anchor")).alias("at"))

    def cut(batches):
        for batch in by_bytes(batches, limit=4 << 20):
            buf, offsets = text_buffer(batch.column("text"))
            data = buf.tobytes()
            out = []
            for rid, base, at in zip(batch.column("rid").to_pylist(), offsets.tolist(), batch.column("at").to_pylist()):
                own: dict = {}
                for p in at:
                    text = data[base + p["start"]:base + p["start"] + p["windows"] + length - 1]
                    own.setdefault((p["anchor"], hashlib.blake2b(text, digest_size=16).digest()), (text, []))[1].append(p["start"])
                out += [(rid, a, d, t, len(t) - length + 1, len(s), np.array(s, np.int32).tobytes()) for (a, d), (t, s) in own.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary()))],
                                             names=["rid", "anchor", "digest", "passage", "windows", "copies", "starts"])
    return docs.join(wanted, "rid").mapInArrow(cut, "rid long, anchor long, digest binary, passage binary, windows int, copies int, starts binary")


def mark_windows(cut: DataFrame, distinct: DataFrame, length: int) -> DataFrame:
    """anchor, digest, marked: windows of single passages that occur in another passage
    (packed int32 positions), from shards and their merging. Of each passage in
    ``distinct`` whose anchor has others, the text is taken from one document (``rep``)."""
    several = (distinct.groupBy("anchor").agg(F.count("*").alias("k"), F.sum(F.col("windows") + (length - 1)).alias("b")).filter("k > 1"))
    total = several.agg(F.sum("b").alias("b")).first()["b"] or 0
    rows = (cut.select("rid", "anchor", "digest", "passage")
            .join(distinct.join(several, "anchor").select("anchor", "digest", F.col("rep").alias("rid"), "copies", "k"), ["rid", "anchor", "digest"]))
    shards = max(1, int(total // SHARD_BYTES) + 1)
    parts = F.ceil(F.col("k") / HOT)
    shard = F.when(F.col("k") <= HOT, F.pmod(F.xxhash64("anchor"), F.lit(shards))).otherwise(
        F.pmod(F.xxhash64("anchor", F.pmod(F.xxhash64("digest"), parts)), F.lit(shards)))
    rows = rows.select(shard.cast("int").alias("shard"), "anchor", "digest", "passage", "copies", (F.col("k") > HOT).alias("hot"))
    buckets = shards

    def work(key, table):
        texts = table["passage"].to_pylist()
        anchors, digests = table["anchor"].to_numpy(), table["digest"].to_pylist()
        single = table["copies"].to_numpy() == 1
        hot = table["hot"].to_numpy()
        which, window, klass = window_classes(texts, length)
        size = np.bincount(klass)
        marked = (size[klass] > 1) & single[which]
        first, count = run_lengths(which[marked])
        positions = window[marked].astype(np.int32)
        owner = which[marked][first]
        out = [(int(anchors[w]), digests[w], positions[a:a + n].tobytes(), None, None) for w, a, n in zip(owner, first, count)]
        if hot.any():
            # One window of each class, told by its fingerprint; a class of single
            # windows of single passages can still be marked by another shard.
            at = np.flatnonzero(hot[which])
            _, lead = np.unique(klass[at], return_index=True)
            at = at[lead]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            buf = np.frombuffer(b"".join(texts), np.uint8)
            start = (np.cumsum(sizes) - sizes)[which[at]] + window[at]
            f1, f2 = word_hashes(buf, start, start + length, EXACT), word_hashes(buf, start, start + length, _SECOND)
            open_ = (size[klass[at]] == 1) & single[which[at]]
            order = np.lexsort((f2, f1))
            bucket = (f1[order] >> U64(32)) % U64(buckets)
            by = np.argsort(bucket, kind="stable")
            order, bucket = order[by], bucket[by]
            first, count = run_lengths(bucket)
            for a, n in zip(first, count):
                p = order[a:a + n]
                names = b"".join(digests[w] + int(anchors[w]).to_bytes(8, "little", signed=True) for w in which[at[p]])
                body = b"".join([f1[p].tobytes(), f2[p].tobytes(), window[at[p]].astype(np.int64).tobytes(), open_[p].astype(np.int64).tobytes(), names])
                out.append((None, None, None, int(bucket[a]), body))
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else ((),) * 5, kinds)], names=["anchor", "digest", "marked", "bucket", "run"])

    def merge(key, table):
        runs = []
        for body in table["run"].to_pylist():
            n = len(body) // 56
            f1, f2, window, open_ = np.frombuffer(body, U64, 4 * n).reshape(4, n)
            runs.append((f1, f2, window, open_, np.frombuffer(body, np.dtype([("digest", "V16"), ("anchor", "<i8")]), n, 32 * n)))
        out: dict = {}
        for a, (f1, f2, window, open_, names) in enumerate(runs):
            hit = np.zeros(len(f1), bool)
            for b, (g1, g2, *_) in enumerate(runs):
                if a != b:
                    at = np.searchsorted(g1, f1)
                    end = np.searchsorted(g1, f1, "right")
                    while (alive := at < end).any():
                        hit[alive] |= g2[at[alive]] == f2[alive]
                        at = at + 1
            for k in np.flatnonzero(hit & (open_ == 1)).tolist():
                out.setdefault((int(names["anchor"][k]), names["digest"][k].tobytes()), []).append(int(window[k]))
        return pa.table({"anchor": pa.array([a for a, _ in out], pa.int64()), "digest": pa.array([d for _, d in out], pa.binary()),
                         "marked": pa.array([np.array(w, np.int32).tobytes() for w in out.values()], pa.binary())})

    done = saved(rows.groupBy("shard").applyInArrow(work, "anchor long, digest binary, marked binary, bucket int, run binary"))
    merged = done.filter("run IS NOT NULL").groupBy("bucket").applyInArrow(merge, "anchor long, digest binary, marked binary")
    return done.filter("run IS NULL").select("anchor", "digest", "marked").union(merged)


def repeat_marks(docs: DataFrame, length: int, n_bytes: int) -> DataFrame:
    """rid, marks: for each document with repeats its marked windows, as (starts of a
    passage, windows of it, null where all its windows are marked)."""
    cut = saved(cut_passages(docs, repeated_anchors(docs, length, n_bytes), length))
    distinct = saved(cut.groupBy("anchor", "digest").agg(F.sum("copies").alias("copies"), F.first("windows").alias("windows"), F.min("rid").alias("rep")))
    marked = mark_windows(cut, distinct, length)
    whole = distinct.filter("copies > 1").select("anchor", "digest", F.lit(None).cast("binary").alias("marked"), "windows")
    both = whole.union(marked.select("anchor", "digest", "marked", F.lit(0).alias("windows")))
    return (cut.select("rid", "anchor", "digest", "starts").join(both, ["anchor", "digest"])
            .groupBy("rid").agg(F.collect_list(F.struct("starts", "windows", "marked")).alias("marks")))


def covered(n: int, marks, length: int) -> np.ndarray:
    """Which of a document's ``n`` bytes a marked window covers."""
    edge = np.zeros(n + 1, np.int64)
    for m in marks or ():
        starts = np.frombuffer(m["starts"], np.int32).astype(np.int64)
        if m["marked"] is None:
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + m["windows"] + length - 1, -1)
        else:
            at = (starts[:, None] + np.frombuffer(m["marked"], np.int32)[None, :]).ravel()
            np.add.at(edge, at, 1)
            np.add.at(edge, at + length, -1)
    return np.cumsum(edge[:n]) > 0


def _kept(batch: pa.RecordBatch, length: int, column: str = "text"):
    """(kept bytes, removed bytes, removed runs, bytes) of every row."""
    buf, offsets = text_buffer(batch.column(column))
    for low, high, marks in zip(offsets[:-1], offsets[1:], batch.column("marks").to_pylist()):
        own = buf[low:high]
        if not marks:
            yield own.tobytes(), 0, 0, len(own)
            continue
        gone = covered(len(own), marks, length)
        runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
        yield own[~gone].tobytes(), int(gone.sum()), runs, len(own)


def repeat_digests(docs: DataFrame, length: int = 200, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    rows = numbered(docs).select("rid", F.col(id_col).alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = repeat_marks(rows.select("rid", "text"), length, text_bytes(rows))

    def finish(batches):
        for batch in by_bytes(batches, limit=4 << 20):
            kept = list(_kept(batch, length))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([k[3] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.int64()),
                 pa.array([k[2] for k in kept], pa.int64()), pa.array([hashlib.sha256(k[0]).hexdigest() for k in kept], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    kind = dict(docs.dtypes)[id_col]
    return rows.join(marks, "rid", "left").mapInArrow(finish, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """The documents without their repeated bytes; columns as given."""
    rows, text, restored = set_aside(docs)
    texts = rows.select("rid", F.col(text).cast("string").alias("text"))
    marks = repeat_marks(texts, length, text_bytes(texts))
    names = [c for c in rows.columns if c != "rid"]

    def finish(batches):
        for batch in by_bytes(batches, text, limit=4 << 20):
            null = batch.column(text).is_null().to_pylist()
            kept = [None if z else k[0].decode("utf-8", "ignore") for z, k in zip(null, _kept(batch, length, text))]
            columns = [pa.array(kept, pa.string()) if c == text else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    joined = rows.join(marks, "rid", "left").select(*names, "marks")
    return restored(joined.mapInArrow(finish, joined.drop("marks").schema))
