"""Operator 11: Merkle dataset manifest.

Every row is a leaf; the leaves of a group form a tree in id order, the groups' roots
form the tree of the data set. A tree is built level by level with lag / lead windows:
a node's siblings are the nodes at fixed offsets before and after it, as far as its slot
and the length of its run reach, and the first child of a run hashes its parent. Windows
are cut at the run, so none grows with a tree; leaves are placed by a distributed sort
whose partitions are numbered on from each other. A proof is the siblings of a leaf and
of its ancestors; it is handed down from the root, one level at a time, so what is
joined to the leaves is one row for each run.

``manifest`` is the operator: leaves, roots and proofs of any columns. ``folded``
recomputes a root from a leaf and its proof. ``tamper_report`` is the check of the
query: roots recomputed from leaves of altered rows.

Cases: a null value hashes as ``-``, apart from an empty one (``0:``); null groups form
a group before all others; null ids come first; rows of one id are ordered by their
leaves, so rows that repeat are leaves of their own and may swap places without a trace;
the proof of a lone row is empty; an empty table has no rows and no root; columns that
are not named are ignored, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import read, saved

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts) if parts else F.lit(""), 256)


def part(value: Column) -> Column:
    """A value as it enters a leaf: its UTF-8 byte count, a colon, the value; ``-`` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    return digest(*[part(v) for v in values])


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with idx, each row's place (from 0) in its ``tree`` by ``order``, and n, the
    tree's size. Partitions of a distributed sort are numbered on from each other; the
    last column of ``order`` tells all rows apart, so no partition must take equal ones."""
    ascending = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    at = saved(rows.repartitionByRange(*ascending).sortWithinPartitions(*ascending)
               .withColumn("pos", F.monotonically_increasing_id())).withColumn("run", F.shiftright("pos", 33))
    by_run = Window.partitionBy("tree").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (at.groupBy("tree", "run").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("m"))
            .withColumn("lower", F.coalesce(F.sum("m").over(by_run), F.lit(0)))
            .withColumn("n", F.sum("m").over(Window.partitionBy("tree"))).drop("m"))
    return (at.join(saved(runs), ["tree", "run"])
            .withColumn("idx", F.col("pos") - F.col("first") + F.col("lower")).drop("run", "pos", "first", "lower"))


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Nodes (tree, idx, n, node, ...) of trees that have a parent, with up (the parent's
    idx), slot, and before / after: the digests of the run's nodes on either side."""
    up = F.floor(F.col("idx") / fanout)
    rows = nodes.withColumn("up", up).withColumn("slot", F.col("idx") - F.col("up") * fanout)
    length = F.least(F.lit(fanout), F.col("n") - F.col("up") * fanout)
    run = Window.partitionBy("tree", "up").orderBy("idx")
    lags = [F.when(F.col("slot") >= k, F.lag("node", k).over(run)).otherwise("") for k in range(fanout - 1, 0, -1)]
    leads = [F.when(F.col("slot") + k < length, F.lead("node", k).over(run)).otherwise("") for k in range(1, fanout)]
    return rows.select("*", F.concat(*lags).alias("before"), F.concat(*leads).alias("after"))


def parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """The next level: first children hash themselves and the rest of their run."""
    first = with_siblings(nodes.select("tree", "idx", "n", "node"), fanout).filter("slot = 0")
    return first.select("tree", F.col("up").alias("idx"), F.ceil(F.col("n") / fanout).alias("n"), digest(F.col("node"), F.col("after")).alias("node"))


def levels(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """All levels from the given one up; trees of one node do not go on."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    out = [nodes]
    while largest > 1:
        out.append(saved(parents(out[-1].filter("n > 1"), fanout)))
        largest = -(-largest // fanout)
    return out


def roots(steps: list[DataFrame]) -> DataFrame:
    """(tree, node) of every tree's last node."""
    last = [s.filter("n = 1").select("tree", "node") for s in steps]
    out = last[0]
    for more in last[1:]:
        out = out.union(more)
    return out


def proofs(steps: list[DataFrame], top: DataFrame, fanout: int) -> DataFrame:
    """Lowest level with ``proof``, the (before, after) of each node and its ancestors, on to
    ``top`` (tree, proof, ...): what stands above each tree's root."""
    more = [c for c in top.columns if c not in ("tree", "proof")]
    above = None
    for nodes in reversed(steps):
        done = nodes.filter("n = 1").join(top, "tree")
        if above is not None:
            own = F.array(F.struct("before", "after"))
            below = (with_siblings(nodes.filter("n > 1"), fanout).join(above, ["tree", "up"])
                     .withColumn("proof", F.concat(own, F.col("proof"))).drop("up", "slot", "before", "after"))
            done = done.unionByName(below)
        above = done
        if nodes is not steps[0]:
            above = above.select("tree", F.col("idx").alias("up"), "proof", *more)
    return above


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def proof_digest(proof: Column) -> Column:
    """Digest of all sibling digests from the leaf's run to the root's, left to right."""
    return digest(F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), ""))


def manifest(docs: DataFrame, fields=FIELDS, id_col: str = "doc_id", group_col: str = "lang", fanout: int = FANOUT,
             carry: dict[str, Column] | None = None) -> DataFrame:
    """id, leaf, subroot (the group's root), root, proof (array of before / after, from
    the leaf's run to the root's) of every row, and the columns ``carry`` computes from
    the row itself."""
    carry = carry or {}
    group = F.col(f"`{group_col}`").cast("string")
    tree = F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group))
    rows = saved(docs.select(F.col(f"`{id_col}`").alias("id"), tree.alias("tree"), leaf_digest([F.col(f"`{c}`") for c in fields]).alias("node"),
                             *[c.alias(f"carry_{name}") for name, c in carry.items()], F.monotonically_increasing_id().alias("row")))
    steps = levels(placed(rows, ["id", "node", "row"]), fanout)
    subroots = saved(roots(steps))
    whole = levels(placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "node"), ["group"]), fanout)
    top = roots(whole).select("tree", F.col("node").alias("root"), F.array().cast("array<struct<before:string,after:string>>").alias("proof"))
    top = proofs(whole, top, fanout).select(F.col("group").alias("tree"), F.col("node").alias("subroot"), "root", "proof")
    return proofs(steps, saved(top), fanout).select("id", F.col("node").alias("leaf"), "subroot", "root", "proof",
                                                    *[F.col(f"carry_{name}").alias(name) for name in carry])


def tamper_report(docs: DataFrame) -> DataFrame:
    """The manifest's digests, and what the root becomes when the texts of a third of the
    documents (by crc32 of the id) are lower-cased: doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified."""
    altered = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    tampered = F.when(chosen & (altered != F.col("text")), leaf_digest([altered if c == "text" else F.col(c) for c in FIELDS]))
    rows = manifest(docs, carry={"tampered": tampered})
    rows = rows.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op11_merkle_manifest(spark, sf_dir):
    return tamper_report(read(spark, sf_dir, "documents"))


_PART = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
_LEAF = " || ".join(_PART.format(c) for c in FIELDS[:-1])
_CRC = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(doc_id::VARCHAR) + 1), "
        "lambda i: ('0x' || substr(hex(encode(doc_id::VARCHAR)), 2 * i - 1, 2))::BIGINT)), "
        "lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))")
SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {_LEAF} AS head, text,
         CASE WHEN {_CRC} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END AS altered FROM documents),
l AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree, sha256(head || {_PART.format('text')}) AS h,
         sha256(head || {_PART.format('altered')}) AS tampered FROM d),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM l),
sub AS (
  SELECT tree, 0 AS lvl, idx, n, h FROM leaves
  UNION ALL
  SELECT tree, lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM sub WHERE n > 1 GROUP BY tree, lvl, n, idx // 8),
subroots AS (SELECT tree, h, lvl AS height, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS n FROM sub WHERE n = 1),
top AS (
  SELECT 0 AS lvl, idx, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lvl, n, idx // 8),
way AS (
  SELECT leaves.tree, leaves.idx AS spot, lvl, coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx < leaves.idx // pow(8, lvl)::BIGINT), '') AS before,
         coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx > leaves.idx // pow(8, lvl)::BIGINT), '') AS after
  FROM leaves JOIN sub s ON s.tree = leaves.tree AND s.n > 1 AND s.idx // 8 = leaves.idx // pow(8, s.lvl + 1)::BIGINT GROUP BY ALL
  UNION ALL
  SELECT leaves.tree, leaves.idx AS spot, r.height + s.lvl AS lvl, coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx < r.idx // pow(8, s.lvl)::BIGINT), '') AS before,
         coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx > r.idx // pow(8, s.lvl)::BIGINT), '') AS after
  FROM leaves JOIN subroots r ON r.tree = leaves.tree JOIN top s ON s.n > 1 AND s.idx // 8 = r.idx // pow(8, s.lvl + 1)::BIGINT GROUP BY ALL),
proof AS (SELECT tree, spot, sha256(string_agg(before || after, '' ORDER BY lvl)) AS p FROM way GROUP BY tree, spot),
fold AS (
  SELECT tree, idx AS spot, 0 AS step, tampered AS h FROM leaves
  UNION ALL
  SELECT f.tree, f.spot, f.step + 1, sha256(before || f.h || after) FROM fold f JOIN way ON way.tree = f.tree AND way.spot = f.spot AND way.lvl = f.step),
ends AS (SELECT tree, spot, max_by(h, step) AS h FROM fold GROUP BY tree, spot)
SELECT doc_id, leaves.h AS leaf, r.h AS subroot, root.h AS root, coalesce(p, sha256('')) AS proof_sha256, e.h AS folded_root, e.h = root.h AS verified
FROM leaves JOIN subroots r ON r.tree = leaves.tree JOIN ends e ON e.tree = leaves.tree AND e.spot = leaves.idx
LEFT JOIN proof ON proof.tree = leaves.tree AND proof.spot = leaves.idx JOIN top root ON root.n = 1
"""
