"""Operator 3: n-gram Jaccard join, size-aware, heavy and light.

A document's set is its distinct five-word shingles. Documents with equal sets are one
class, of which one row goes on. Two classes link at ``100 * common >= 80 * union``.

Candidates. The elements of a set are ordered by hash, and ``d1 + d2`` elements are
foreign to a linked pair (``d1`` of this set's, ``d2`` of the other's), where
``2 * d1 + d2 <= 0.4 * n`` and ``d1 <= 0.2 * n``.
* Small sets (below the boundary) enumerate fixed-size subsets: the pairs of
  neighbours among the first ``floor(0.4 n) + 2`` elements. A foreign element spoils
  at most two of this set's pairs (one if it is the other's), so a linked pair of
  sets has a subset in common.
* Large sets scan inverted lists: of the first ``floor(0.2 n) + 1`` elements, a linked
  pair has one in common, hence stands together in its list.
Sets up to 1.25 times the boundary do both, so no link across it is lost. The boundary
minimises the estimated cost over all documents' sizes: subsets cost two rows for one
list entry, lists cost their length, which grows with the number of large sets.

Subsets and list entries are sorted and joined in hash buckets. A task sends each
signature to its bucket once, with the least class that has it, and the other classes
as edges to that class, so a signature common to a third of all documents costs a
bucket one entry a task. The edges' components bound where links can be: linked
classes always fall into one component (candidate cluster).

A passage that many documents share chains clusters. Clusters of more than ``BLOCK``
classes are therefore formed anew from fixed-size subsets of four neighbours among the
first ``floor(0.8 n) + 4`` elements (a foreign element spoils four or three of them),
for sets of 20 elements and more; smaller ones, and those up to 25, stay where they were.

Verification. Clusters are cut into blocks of about ``BLOCK`` classes of like size;
each pair of blocks that can hold links is one unit of work, in which common elements
of all pairs of sets are counted exactly by products of incidence matrices. A unit
returns link counts per class and a spanning forest of its links; components of all forests are the result.
No pair of documents is ever a row.

Cases: documents without words have an empty set and link with nothing; fewer than five
words are one shingle; null texts count as empty; repeated rows are documents of their
own (with equal sets); null ids take part but are never the least id of a group; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import numbered, saved, set_aside, with_text
from .text import U64, by_bytes, mix, run_lengths, shingle_hashes, text_buffer, word_hashes, words

BUCKET_BYTES = 24 << 20
HELD = 1 << 22           # signatures a task holds before it sends them
BLOCK = 256              # classes in a block
FINE = 20                # sets from this size can use subsets of four
UNIT_BYTES = 16 << 20    # set bytes of the units that share a group
COMMON = 0.01            # assumed share of large sets in an inverted list


def doc_sets(column, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(document index, shingle hash) of all distinct shingles, ordered by both."""
    buf, offsets = text_buffer(column)
    starts, ends, docs = words(buf, offsets)
    hashes, owner = shingle_hashes(word_hashes(buf, starts, ends), docs, len(column), size)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        first = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
        hashes, owner = hashes[first], owner[first]
    return owner, hashes


def set_keys(owner: np.ndarray, hashes: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size, two 64-bit digests) of each document's set."""
    n = np.bincount(owner, minlength=n_docs)
    digests = []
    for salt in (U64(0x1B873593A5A5A5A5), U64(0xCC9E2D51C3C3C3C3)):
        total = np.zeros(len(hashes) + 1, U64)
        np.cumsum(mix(hashes ^ salt), out=total[1:])
        edges = np.concatenate([[0], np.cumsum(n)])
        digests.append(mix((total[edges[1:]] - total[edges[:-1]]) ^ n.astype(U64)).view(np.int64))
    return n, digests[0], digests[1]


def set_table(docs: DataFrame, size: int, id_col: str) -> DataFrame:
    """rid, doc_id, n, h1, h2 of every row."""
    def run(batches):
        for batch in by_bytes(batches):
            owner, hashes = doc_sets(batch.column("text"), size)
            n, h1, h2 = set_keys(owner, hashes, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), pa.array(n), pa.array(h1), pa.array(h2)],
                                             names=["rid", "doc_id", "n", "h1", "h2"])
    kind = dict(docs.dtypes)[id_col]
    rows = numbered(docs).select("rid", F.col(id_col).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"rid long, doc_id {kind}, n long, h1 long, h2 long")


def boundary(sizes: dict[int, int]) -> int:
    """Size from which sets scan inverted lists, by estimated cost over all sets."""
    if not sizes:
        return 1
    n = np.array(sorted(sizes), float)
    count = np.array([sizes[int(k)] for k in n], float)
    cut = np.append(n, n[-1] + 1)
    cost = [(0.4 * n * count)[n < 1.25 * x].sum() + (0.2 * n * count)[n >= x].sum() * (1 + COMMON * count[n >= x].sum()) for x in cut]
    return int(cut[int(np.argmin(cost))])


def signatures(owner: np.ndarray, hashes: np.ndarray, n: np.ndarray, edge: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, document index): subsets of small sets, list entries of large ones."""
    first = np.cumsum(n) - n
    at = np.arange(len(hashes)) - first[owner]
    size = n[owner]
    lists = (size >= edge) & (at <= size // 5)
    out, docs = [mix(hashes[lists] ^ U64(0x94D049BB))], [owner[lists]]
    if len(hashes) > 1:
        pair = (size[:-1] < 1.25 * edge) & (at[:-1] <= 2 * size[:-1] // 5) & (owner[:-1] == owner[1:])
        out.append(mix(mix(hashes[:-1][pair]) + hashes[1:][pair]))
        docs.append(owner[:-1][pair])
    return np.concatenate(out), np.concatenate(docs)


def least_and_edges(sig: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct signatures, least node of each, distinct (node, least) pairs of the rest)."""
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    start, length = run_lengths(sig)
    least = np.repeat(node[start], length)
    other = node != least
    pairs = np.unique(np.stack([node[other], least[other]], axis=1), axis=0) if other.any() else np.zeros((0, 2), np.int64)
    return sig[start], node[start], pairs


def shared_edges(rows: DataFrame, read, buckets: int) -> DataFrame:
    """Edges (a, b) between nodes that share a signature. ``read`` turns Arrow batches
    into (signatures, node of each) arrays."""
    def flush(sig, node):
        sig, node, pairs = least_and_edges(np.concatenate(sig), np.concatenate(node))
        bucket = (sig >> U64(32)) % U64(buckets)
        order = np.argsort(bucket, kind="stable")
        start, length = run_lengths(bucket[order])
        parts = [order[a:a + n] for a, n in zip(start, length)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(bucket[p[0]]) for p in parts], pa.int32()), pa.array([sig[p].tobytes() for p in parts], pa.binary()),
             pa.array([node[p].tobytes() for p in parts], pa.binary())], names=["bucket", "sig", "node"])
        if len(pairs):
            # Edges found here travel as entries without signatures, spread over the buckets.
            where = np.arange(len(pairs)) * buckets // len(pairs)
            cuts = np.flatnonzero(np.diff(where, prepend=-1))
            chunks = np.split(pairs, cuts[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(where[cuts], pa.int32()), pa.array([b""] * len(chunks), pa.binary()),
                 pa.array([c.tobytes() for c in chunks], pa.binary())], names=["bucket", "sig", "node"])

    def send(batches):
        sig, node, held = [], [], 0
        for s, n in read(batches):
            sig.append(s)
            node.append(n)
            held += len(s)
            if held >= HELD:
                yield from flush(sig, node)
                sig, node, held = [], [], 0
        if held:
            yield from flush(sig, node)

    def meet(key, table):
        sigs, nodes = table["sig"].to_pylist(), table["node"].to_pylist()
        known = [np.frombuffer(v, np.int64).reshape(-1, 2) for s, v in zip(sigs, nodes) if not s]
        sig = [np.frombuffer(s, U64) for s in sigs if s]
        if sig:
            known.append(least_and_edges(np.concatenate(sig), np.concatenate([np.frombuffer(v, np.int64) for s, v in zip(sigs, nodes) if s]))[2])
        pairs = np.unique(np.concatenate(known), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return rows.mapInArrow(send, "bucket int, sig binary, node binary").groupBy("bucket").applyInArrow(meet, "a long, b long")


def buckets_for(n_signatures: float) -> int:
    return max(1, int(n_signatures * 16 // BUCKET_BYTES) + 1)


def candidate_edges(docs: DataFrame, size: int, edge: int, n_signatures: float) -> DataFrame:
    """Edges between set digests that share a subset or a list entry."""
    def read(batches):
        for batch in by_bytes(batches):
            owner, hashes = doc_sets(batch.column("text"), size)
            n, h1, _ = set_keys(owner, hashes, batch.num_rows)
            sig, doc = signatures(owner, hashes, n, edge)
            yield sig, h1[doc]
    return shared_edges(with_text(docs), read, buckets_for(n_signatures))


def runs_of_four(hashes: np.ndarray) -> np.ndarray:
    """Subsets of four neighbours among the first ``floor(0.8 n) + 4`` elements of a
    sorted set of at least ``FINE`` elements."""
    first = hashes[:4 * len(hashes) // 5 + 4]
    return mix(mix(mix(mix(first[:-3]) + first[1:-2]) + first[2:-1]) + first[3:])


def finer_clusters(members: DataFrame) -> DataFrame:
    """class_id, finer: components of the members that share a subset of four."""
    def read(batches):
        for batch in batches:
            sets = [np.frombuffer(x, U64) for x in batch.column("set").to_pylist()]
            found = [runs_of_four(x) for x in sets]
            if found:
                yield np.concatenate(found), np.repeat(batch.column("class_id").to_numpy(), [len(x) for x in found])
    total = members.agg(F.sum("n").alias("n")).first()["n"] or 0
    edges = shared_edges(members.select("class_id", "set"), read, buckets_for(0.8 * total))
    return components(edges).select(F.col("node").alias("class_id"), F.col("root").alias("finer"))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each member's component (few members: plain union-find)."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for x, y in zip(a.tolist(), b.tolist()):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    return np.array([find(x) for x in range(n)], np.int64)


def common_counts(sets_a: list[np.ndarray], sets_b: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """Exact sizes of all intersections of ``sets_a`` with ``sets_b``."""
    out = np.zeros((len(sets_a), len(sets_b)), np.float32)
    flat_a, flat_b = np.concatenate(sets_a), np.concatenate(sets_b)
    shared = np.intersect1d(flat_a, flat_b)
    sides = []
    for sets, flat in ((sets_a, flat_a), (sets_b, flat_b)):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(shared, flat)
        at[at == len(shared)] = 0
        hit = shared[at] == flat if len(shared) else np.zeros(len(flat), bool)
        order = np.argsort(at[hit], kind="stable")
        sides.append((at[hit][order], owner[hit][order], len(sets)))
    for low in range(0, len(shared), step):
        dense = []
        for at, owner, n in sides:
            i, j = np.searchsorted(at, (low, low + step))
            m = np.zeros((n, min(step, len(shared) - low)), np.float32)
            m[owner[i:j], at[i:j] - low] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def verify(members: DataFrame, percent: int) -> DataFrame:
    """Rows (a, b, links): ``a`` has ``links`` links in this unit and is connected to
    ``b`` in it. ``members``: cluster, class_id, n, set, rest (pairs of sets that are both
    of ``FINE`` elements or more are another unit's)."""
    by_size = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / percent))) + F.lit(1e-9)).cast("int")
    members = members.withColumn("band", by_size)
    sizes = members.groupBy("cluster", "rest", "band").agg(F.count("*").alias("k")).withColumn("blocks", F.ceil(F.col("k") / BLOCK).cast("int"))
    # A linked pair's sizes differ by a factor of at most 100 / percent: same band or next.
    above = sizes.select("cluster", "rest", (F.col("band") - 1).alias("band"), F.col("blocks").alias("blocks_above"))
    below = sizes.select("cluster", "rest", (F.col("band") + 1).alias("band"), F.col("blocks").alias("blocks_below"))
    shape = sizes.join(above, ["cluster", "rest", "band"], "left").join(below, ["cluster", "rest", "band"], "left").drop("k")
    rows = members.join(shape, ["cluster", "rest", "band"]).withColumn("block", F.pmod(F.xxhash64("class_id"), "blocks").cast("int"))
    none = F.array().cast("array<struct<lo:int,i:int,j:int,side:int>>")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    unit = lambda lo, i, j, side: F.struct(lo.alias("lo"), i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    block = F.col("block")
    inside = F.transform(upto(F.col("blocks")), lambda x: unit(F.col("band") * 2, F.least(x, block), F.greatest(x, block), 0))
    up = F.when(F.col("blocks_above").isNull(), none).otherwise(F.transform(upto(F.col("blocks_above")), lambda x: unit(F.col("band") * 2 + 1, block, x, 0)))
    down = F.when(F.col("blocks_below").isNull(), none).otherwise(F.transform(upto(F.col("blocks_below")), lambda x: unit(F.col("band") * 2 - 1, x, block, 1)))
    rows = rows.select("cluster", "class_id", "n", "set", "rest", "block", F.explode(F.concat(inside, up, down)).alias("u"))
    rows = rows.select("cluster", "class_id", "n", "set", "rest", "block", "u.*")
    total = members.agg(F.sum("n").alias("n")).first()["n"] or 0
    groups = max(members.sparkSession.sparkContext.defaultParallelism, int(total * 8 // UNIT_BYTES) + 1)
    rows = rows.withColumn("group", F.pmod(F.xxhash64("cluster", "rest", "lo", "i", "j"), F.lit(groups)).cast("int"))

    def work(key, table):
        table = table.sort_by([(c, "ascending") for c in ("cluster", "rest", "lo", "i", "j", "class_id")]).combine_chunks()
        ids, n, lo, i, j, block, side = (table[c].to_numpy() for c in ("class_id", "n", "lo", "i", "j", "block", "side"))
        cluster, rest = table["cluster"].to_numpy(), table["rest"].to_numpy(zero_copy_only=False)
        sets = table["set"]
        out = []
        change = (cluster[1:] != cluster[:-1]) | (rest[1:] != rest[:-1]) | (lo[1:] != lo[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        starts = np.concatenate([[0], np.flatnonzero(change) + 1, [len(ids)]])
        for low, high in zip(starts[:-1], starts[1:]):
            at = np.arange(low, high)
            across = lo[low] % 2 != 0
            same = not across and i[low] == j[low]
            if across:
                left, right = at[side[at] == 0], at[side[at] == 1]
            elif same:
                left = right = at
            else:
                left, right = at[block[at] == i[low]], at[block[at] == j[low]]
            if not len(left) or not len(right) or (same and len(left) == 1):
                continue
            sets_l = [np.frombuffer(sets[k].as_py(), U64) for k in left.tolist()]
            sets_r = sets_l if same else [np.frombuffer(sets[k].as_py(), U64) for k in right.tolist()]
            common = common_counts(sets_l, sets_r)
            union = n[left][:, None] + n[right][None, :] - common
            linked = 100 * common.astype(np.float64) >= percent * union.astype(np.float64)
            if same:
                np.fill_diagonal(linked, False)
            if rest[low]:
                linked &= (n[left][:, None] < FINE) | (n[right][None, :] < FINE)
            x, y = np.nonzero(linked)
            if not len(x):
                continue
            both = left if same else np.concatenate([left, right])
            y = y if same else y + len(left)
            links = np.bincount(x, minlength=len(both)) + (0 if same else np.bincount(y, minlength=len(both)))
            root = forest(len(both), x, y)
            has = links > 0
            out.append((ids[both][has], ids[both][root[has]], links[has]))
        a, b, links = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array(links, pa.int64())})

    return rows.groupBy("group").applyInArrow(work, "a long, b long, links long")


def jaccard_groups(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """rid, doc_id, n_shingles, component_id, n_links (linked other classes) of every row."""
    return rooted_groups(docs, size, percent, id_col).drop("root")


def rooted_groups(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """The same and ``root``, the component itself whatever its ids are (null without words)."""
    if percent != 80:
        raise ValueError("the candidate bounds hold for 80 percent")
    sets = saved(set_table(docs, size, id_col))
    histogram = sets.filter("n > 0").groupBy(F.when(F.col("n") < 64, F.col("n")).otherwise(
        F.floor(F.pow(F.lit(1.05), F.floor(F.log("n") / F.lit(float(np.log(1.05))))))).cast("long").alias("n")).agg(F.count("*").alias("c")).collect()
    counts = {r["n"]: r["c"] for r in histogram}
    edge = boundary(counts)
    n_signatures = sum(n * c * (0.4 if n < edge else 0.2) for n, c in counts.items())
    clusters = components(candidate_edges(docs, size, edge, n_signatures))
    classes = saved(sets.filter("n > 0").groupBy("h1", "h2", "n").agg(F.min("rid").alias("class_id"), F.min("doc_id").alias("least")))
    met = clusters.select(F.col("node").alias("h1"), F.col("root").alias("cluster"))
    chosen = classes.join(met, "h1").select("cluster", "class_id", "n")
    sizes = chosen.groupBy("cluster").agg((F.count("*") > BLOCK).alias("large"))
    chosen = chosen.join(sizes, "cluster")

    def to_sets(batches):
        for batch in by_bytes(batches):
            owner, hashes = doc_sets(batch.column("text"), size)
            parts = np.split(hashes, np.cumsum(np.bincount(owner, minlength=batch.num_rows))[:-1])
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("cluster", "class_id", "n", "large")] + [pa.array([p.tobytes() for p in parts], pa.binary())],
                                             names=["cluster", "class_id", "n", "large", "set"])
    texts = numbered(docs).select(F.col("rid").alias("class_id"), F.col("text").cast("string").alias("text"))
    members = saved(texts.join(chosen, "class_id").mapInArrow(to_sets, "cluster long, class_id long, n long, large boolean, set binary"))
    large = members.filter("large")
    fine = large.filter(F.col("n") >= FINE)
    fine = fine.join(finer_clusters(fine), "class_id").withColumn("cluster", F.col("finer"))
    unit = lambda rows, rest: rows.select("cluster", "class_id", "n", "set", F.lit(rest).alias("rest"))
    rest = large.filter(F.col("n") < 1.25 * FINE)
    found = saved(verify(unit(members.filter("NOT large"), False).union(unit(fine, False)).union(unit(rest, True)), percent))
    roots = components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("class_id")).agg(F.sum("links").alias("n_links"))
    grouped = (classes.join(roots.select(F.col("node").alias("class_id"), "root"), "class_id", "left")
               .join(links, "class_id", "left").withColumn("root", F.coalesce("root", "class_id")))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "root").select("h1", "h2", "n", "component_id", "n_links", "root")
    return (sets.join(named, ["h1", "h2", "n"], "left")
            .select("rid", "doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "root"))


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """One document of each component (its first row with the least id); documents
    without words all stay; columns as given."""
    groups = rooted_groups(docs, **options)
    key = F.struct(F.col("doc_id").isNull(), "doc_id", "rid")
    kept = groups.filter("n_shingles > 0").groupBy("root").agg(F.min(key)["rid"].alias("rid")).select("rid")
    kept = kept.union(groups.filter("n_shingles = 0").select("rid"))
    rows, _, restored = set_aside(docs)
    return restored(rows.join(kept, "rid"))
