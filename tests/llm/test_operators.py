"""Operators against brute force, on fixtures with nulls, empty and very long texts,
ties, repeated rows, empty tables and columns whose names clash with the operators' own."""

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import (bpe, components, jaccard_join, licenses, mixing, neighbours, pitman_yor, quality, queries,
                         suffix_dedup, text, toxicity)
from tessera.llm.tables import saved
from tessera.llm.token_counts import token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid string, bucket int, n int, rank int, marks string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join("".join(rng.choice(["an", "the", "or", "Ti", "é", "st", "wh"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def make_texts():
    rng = random.Random(5)
    base = prose(rng, 300)
    long = prose(rng, 30_000)
    passage = prose(rng, 60)
    out = [None, "", " \n\t ", "one", "one two three four", "one two three four", "a" * 5000, base, base, base + " tail end",
           long, long + " x", "日本語 テキスト　と  空白\x1c \x85 " + passage, "don't I'LL  <|endoftext|> " + passage + "\n\nend"]
    for k in range(40):
        words = base.split(" ")
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(len(words))] = "zz%d" % rng.randrange(99)
        out.append(" ".join(words))
    out += ["boiler plate line here\n" + prose(rng, rng.randint(3, 80)) + ("\n" + passage if k % 3 == 0 else "") for k in range(60)]
    short = [w for w in prose(rng, 26).split(" ")]
    out += [" ".join(short[rng.randrange(4):len(short) - rng.randrange(5)]) for _ in range(12)]
    out += ["w%d x y z q r" % (k % 3) for k in range(9)] + ["p q r s t u v", "p q r s t u v w", "a b c d e f g h i", "b c d e f g h i"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    source = lambda k: [None, "a", "b", "B", "é"][k % 5] if k % 3 else "hot"
    ids = [19 if k == 20 else k for k in range(len(make_texts()))]  # one id twice
    rows = [(i, t, "en", source(i), len(t or ""), "x", i, i, i, "m") for i, t in zip(ids, make_texts())]
    return saved(spark.createDataFrame(rows, SCHEMA).repartition(5))


@pytest.fixture(scope="module")
def empty(docs):
    return saved(docs.filter("false"))


def texts_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def as_counter(rows):
    return collections.Counter(tuple(r) for r in rows)


# ---- helpers

def test_words_and_hashes_follow_the_contract():
    rows = ["A b\x0bC\x1c d", None, "", "b", "Éa É"]
    buf, offsets = text.text_buffer(pa.array(rows))
    starts, ends, owner = text.words(buf, offsets)
    got = [(d, bytes(buf[s:e]).decode()) for d, s, e in zip(owner.tolist(), starts.tolist(), ends.tolist())]
    assert got == [(k, w) for k, t in enumerate(rows) for w in WORD.findall(t or "")]
    h = text.word_hashes(buf, starts, ends)
    key = lambda w: w[1].translate(LOWER)
    assert all((h[i] == h[j]) == (key(got[i]) == key(got[j])) for i in range(len(h)) for j in range(len(h)))


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(1000, 1100)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 1 suffix arrays

def removed_brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[k:k + length] for _, b in data for k in range(len(b) - length + 1))
    for i, b in data:
        gone = np.zeros(len(b) + 1, np.int64)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k] += 1
                gone[k + length] -= 1
        gone = np.cumsum(gone[:len(b)]) > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        yield (i, len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(1)
    for n, letters in ((1, 2), (2, 1), (60, 1), (700, 2), (3000, 4)):
        t = rng.integers(97, 97 + letters, n).astype(np.uint8)
        order, rank = suffix_dedup.suffix_array(t)
        b = t.tobytes()
        want = sorted(range(n), key=lambda i: b[i:])
        assert order.tolist() == want and rank[order].tolist() == list(range(n))
        common = lambda i, j: next((k for k in range(20) if i + k >= n or j + k >= n or b[i + k] != b[j + k]), 20)
        assert suffix_dedup.common_prefixes(t, order, rank, 20, lane=64).tolist() == [0] + [common(want[k], want[k - 1]) for k in range(1, n)]


def test_suffixes_sorted_to_a_depth_have_equal_ranks_where_their_bytes_are_equal():
    rng = np.random.default_rng(2)
    for n, letters, depth in ((400, 1, 20), (900, 2, 37), (900, 2, 64), (300, 3, 8)):
        t = rng.integers(97, 97 + letters, n).astype(np.uint8)
        b = t.tobytes()
        rank = suffix_dedup.suffix_array(t, depth, np.arange(n, 0, -1))[1]
        whole = range(n - depth + 1)
        order = {x: k for k, x in enumerate(sorted({b[i:i + depth] for i in whole}))}
        ranks = {x: k for k, x in enumerate(sorted({int(rank[i]) for i in whole}))}
        assert [ranks[int(rank[i])] for i in whole] == [order[b[i:i + depth]] for i in whole]


def test_memory_of_a_shard_is_bounded():
    """A full shard's arrays, here of texts equal but for a byte, stay below 150 MB."""
    rng = np.random.default_rng(4)
    base = rng.integers(97, 101, 300).astype(np.uint8)
    texts = []
    for k in range(suffix_dedup.SHARD_BYTES // 8 // 300):
        base[k % 300] = 97 + (base[k % 300] - 96) % 26
        texts.append(base.tobytes())
    tracemalloc.start()
    suffix_dedup.window_classes(texts, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak / sum(map(len, texts)) * suffix_dedup.SHARD_BYTES < 150 << 20


def test_texts_that_share_a_short_phrase_share_no_anchor():
    """Only passages with an anchor in common go on, so chance phrases must not give one."""
    rng = np.random.default_rng(3)
    noise = lambda: bytes(rng.integers(97, 123, 190).astype(np.uint8))
    phrase = b"a phrase of some sixty bytes that very many texts have in it"
    texts = [noise() + phrase + noise() for _ in range(60)]
    buf, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    doc, start, windows, anchor = suffix_dedup.passages(buf, offsets, 200)
    assert len(set(anchor.tolist())) == len(anchor)
    covered = sorted((int(d), int(s) + k) for d, s, w in zip(doc, start, windows) for k in range(w))
    assert covered == [(d, k) for d, t in enumerate(texts) for k in range(len(t) - 199)]


@pytest.mark.parametrize("hot", [4096, 2])
def test_repeats_match_brute_force(docs, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 40_000)
    small = saved(docs.filter("n_chars < 20000"))
    got = as_counter(suffix_dedup.repeat_digests(small).collect())
    assert got == collections.Counter(removed_brute(texts_of(small), 200))


def test_remove_repeats_keeps_columns(docs, empty):
    small = saved(docs.filter("n_chars < 20000"))
    out = suffix_dedup.remove_repeats(small)
    assert out.schema.names == small.schema.names and out.count() == small.count()
    null = out.filter("text IS NULL").count()
    assert null == 1
    assert suffix_dedup.remove_repeats(empty).count() == 0 == suffix_dedup.repeat_digests(empty).count()


# ---- 2 licenses

def test_license_scan(spark, empty):
    apache = licenses.KNOWN[0][1]
    rows = [(1, "  licenced UNDER the apache licence; version 2.0 "), (2, "Copyright 2020 Someone\n" + apache), (3, "text\n" + apache + "\nmore\nReleased under the MIT Licence"),
            (4, None), (5, ""), (6, "no licence"), (6, "no licence")]
    got = sorted((r[0], r[1], r[2], r[3]) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id int, text string")).fillna("").collect())
    assert got == [(1, "Apache-2.0", "Apache-2.0", 1), (2, "Apache-2.0", "Apache-2.0", 1), (3, "", "Apache-2.0,MIT", 2), (4, "", "", 0), (5, "", "", 0), (6, "", "", 0), (6, "", "", 0)]
    assert licenses.license_scan(empty).count() == 0
    known = [("own", "A b c")]
    assert licenses.license_scan(spark.createDataFrame([(1, "a, B! c")], "doc_id int, text string"), known).first()["license"] == "own"


def test_signs_leave_no_match_out(spark, monkeypatch):
    forms = ["licensed under a", "to the extent possible under law", "the extent of it", "version 2 http x"]
    signs = licenses.signs_of(forms)
    assert all(any(w in f.replace("license", "licen") for w in signs) for f in forms) and "licen" in signs
    assert licenses.signs_of(["version 2"]) == ["2"] and licenses.signs_of(["version 2", "version"]) is None and licenses.signs_of([]) == []
    rng = random.Random(8)
    known = [t for _, t in licenses.KNOWN] + [p.read_text() for p in licenses.TEXTS.glob("*.txt")]
    spoil = [lambda t: t, str.upper, lambda t: t.replace("icens", "icenc"), lambda t: t.replace(" ", " -\t"), lambda t: t.replace("http:", "https:"),
             lambda t: t.replace("ersion", "er."), lambda t: t[1:], lambda t: "İ" + t, lambda t: "\n\n".join(["Copyright 1999 X", t, "end"])]
    rows = [(k, rng.choice(spoil)(rng.choice(spoil)(rng.choice(known)))) for k in range(300)] + [(900, None), (901, ""), (902, "no words")]
    df = saved(spark.createDataFrame(rows, "doc_id int, text string"))
    scan = lambda: as_counter(licenses.license_scan(df).collect())
    got = scan()
    monkeypatch.setattr(licenses, "holds_sign", lambda text, signs: text.isNotNull())
    assert got == scan() and sum(r[1] is not None for r in got) > 50


def test_license_scan_of_entire_and_wrapped_texts(spark):
    import textwrap
    entire = {p.stem: p.read_text() for p in licenses.TEXTS.glob("*.txt")}
    fill = lambda x, width: "\n\n".join(textwrap.fill(" ".join(b.split()), width) for b in x.split("\n\n"))
    rows = [("whole " + k, t) for k, t in entire.items()]
    rows += [(f"wrapped{w} {k}", fill("Copyright (c) 2001 Somebody\n\n" + entire[k], w)) for k in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Unlicense") for w in (50, 61, 75, 90)]
    rows += [("part " + k, "intro\n\n" + "\n".join("# " + x for x in entire[k].splitlines()) + "\n\nimport os\n") for k in ("MIT", "ISC")]
    rows += [("part Apache-2.0", "/*\n * Licensed under the Apache License, Version 2.0 (the \"License\");\n * you may not use this file except in compliance with the License.\n"
              " * You may obtain a copy of the License at\n *\n * http://www.apache.org/licenses/LICENSE-2.0\n */\ncode"),
             ("part CC-BY-NC-4.0", "text\nLicensed under CC BY-NC 4.0.\nmore"), ("none", "some\nwrapped lines\n\nof text")]
    got = {r[0]: (r[1] or "", r[2]) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    for key, (license, parts) in got.items():
        want = key.split(" ")[-1]
        want = "BSD" if want.startswith("BSD") else want
        if key == "none":
            assert (license, parts) == ("", "")
        elif key.startswith("part"):
            assert parts == want and not license, key
        else:
            assert license == want, key


# ---- 3 Jaccard join

def shingles(t):
    w = WORD.findall((t or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def linked_brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return collections.Counter((i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows))


def links_brute(rows):
    sets = {shingles(t) for _, t in rows}
    n = {x: sum(x != y and 100 * len(x & y) >= 80 * len(x | y) for y in sets) for x in sets}
    return collections.Counter((i, n[shingles(t)]) for i, t in rows)


@pytest.mark.parametrize("edge,block", [(None, 256), (60, 3), (1, 5), (10 ** 9, 2)])
def test_jaccard_groups_match_brute_force(docs, monkeypatch, edge, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "BUCKET_BYTES", 20_000)
    if edge is not None:
        monkeypatch.setattr(jaccard_join, "boundary", lambda sizes: edge)
    out = saved(jaccard_join.jaccard_groups(docs))
    assert as_counter(out.select("doc_id", "n_shingles", "component_id").collect()) == linked_brute(texts_of(docs))
    assert as_counter(out.select("doc_id", "n_links").collect()) == links_brute(texts_of(docs))


def test_jaccard_edges(spark, docs, empty):
    kept = jaccard_join.drop_near_copies(docs)
    assert kept.schema.names == docs.schema.names
    brute = linked_brute(texts_of(docs))
    assert kept.count() == len({c for _, n, c in brute if n}) + sum(v for (_, n, _), v in brute.items() if not n)
    assert jaccard_join.drop_near_copies(empty).count() == 0
    # 8 of 10 shingles in common link, 7 of 9 do not.
    w = ["w%d" % k for k in range(14)]
    rows = [(1, " ".join(w[:13])), (2, " ".join(w[:12] + ["q"])), (3, " ".join(w)), (4, " ".join(["v"] + w[1:13])), (None, " ".join(w))]
    df = saved(spark.createDataFrame(rows, "doc_id int, text string"))
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_groups(df).collect()}
    want = linked_brute([(i or 99, t) for i, t in rows])
    assert {(99 if i is None else i, c) for i, c in got.items()} == {(i, c) for i, _, c in want}


def test_near_copies_are_grouped_by_component_not_id(spark):
    w = lambda x: " ".join(x + str(k) for k in range(30))
    rows = [(1, w("a")), (1, w("b")), (2, w("b")), (None, w("c")), (None, w("c")), (None, w("c") + " end"), (None, w("d")), (None, ""), (None, None)]
    kept = jaccard_join.drop_near_copies(saved(spark.createDataFrame(rows, "doc_id int, text string"))).collect()
    assert sorted((r.text or "").split(" ")[0] for r in kept) == ["", "", "a0", "b0", "c0", "d0"]


def test_signatures_lose_no_pair():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = rng.choice(10 ** 6, n, replace=False)
        b = np.concatenate([a[rng.permutation(n)[:max(1, n - int(rng.integers(0, n // 4 + 2)))]], 10 ** 7 + rng.choice(1000, int(rng.integers(0, n // 4 + 2)), replace=False)])
        common, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if common == union or 100 * common < 80 * union:
            continue
        sets = [np.sort(text.mix(x.astype(np.uint64))) for x in (a, b)]
        owner = np.repeat([0, 1], [len(x) for x in sets])
        for edge in (1, n, 10 ** 6):
            sig, doc = jaccard_join.signatures(owner, np.concatenate(sets), np.array([len(x) for x in sets]), edge)
            assert np.intersect1d(sig[doc == 0], sig[doc == 1]).size, (n, edge)
        if min(map(len, sets)) >= jaccard_join.FINE:
            assert np.intersect1d(*map(jaccard_join.runs_of_four, sets)).size, n


# ---- 4 token counts

def test_token_counts_match_the_library(docs, empty):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    want = collections.Counter()
    for i, t in texts_of(docs):
        n = len(plain.encode(t or "", add_special_tokens=False))
        want[(i, len((t or "").encode()), n, n > 2048)] += 1
    assert as_counter(token_counts(docs, path).collect()) == want
    assert token_counts(empty, path).count() == 0


# ---- 5 Pitman-Yor

def test_pitman_yor_figures_and_gain(docs, empty):
    rows = texts_of(docs)
    scored = saved(pitman_yor.scores(docs))
    tokens = [(i, WORD.findall((t or "").translate(LOWER)) + [None]) for i, t in rows]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    c = collections.Counter(w for i, t in tokens if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    want = collections.Counter()
    for i, t in tokens:
        want[(i, held(i), len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6))] += 1
    got = collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored.collect())
    assert got == want
    assert all(r.score < 0 for r in scored.collect())
    again = {(r.doc_id, r.score) for r in pitman_yor.scores(docs).collect()}
    assert again == {(r.doc_id, r.score) for r in scored.collect()}
    for r in pitman_yor.perplexity(scored).collect():
        assert r.perplexity < r.base_perplexity
    assert pitman_yor.scores(empty).count() == 0


def test_pitman_yor_is_a_distribution(monkeypatch):
    """Over the vocabulary and the unknown word, each context's chances sum to 1."""
    rng = np.random.default_rng(0)
    words = (text.mix(np.arange(1, 301, dtype=np.uint64)) & pitman_yor._WORD)
    keys = np.unique(words[rng.zipf(1.5, 4000) % 300] | rng.integers(0, pitman_yor.CONTEXTS, 4000).astype(np.uint64))
    counts = rng.integers(1, 300, len(keys))
    v = len(np.unique(keys & pitman_yor._WORD))
    base = {"v": v, "n": int(counts.sum()), "d": 0.6, "d0": 0.7}
    s = pitman_yor.Sampler(keys, counts, 0, base)
    total = s.sums()
    for k in range(3):
        s.sweep(k, total)
        total = s.sums()
        assert (s.tables >= 1).all() and (s.tables <= s.counts).all() and (s.parent_tables <= s.parent).all()
    customers = np.bincount(s.context, weights=s.counts, minlength=pitman_yor.CONTEXTS)
    parent = s.parent_chance(total)
    unknown = (1 + base["d0"] * total["t0"]) * pitman_yor.unknown_mass(base) / (1 + total["c0"])
    assert abs(parent.sum() + unknown - 1) < 1e-9
    for u in range(pitman_yor.CONTEXTS):
        own = (s.counts - base["d"] * s.tables)[s.context == u].sum()
        assert abs((own + (1 + base["d"] * total["t"][u])) / (1 + customers[u]) - 1) < 1e-9


def test_pitman_yor_context_is_the_whole_word_before(spark):
    """Which word follows is certain given the whole word before it, and not given its
    first two bytes or a class of them."""
    rng = random.Random(6)
    pairs = [("stem%03d" % k, "next%03d" % rng.randrange(1000)) for k in range(120)]
    rows = [(k, " ".join(w for _ in range(150) for w in rng.choice(pairs))) for k in range(60)]
    got = {r.held_out: r for r in pitman_yor.perplexity(pitman_yor.scores(saved(spark.createDataFrame(rows, "doc_id int, text string")))).collect()}
    # Half of the tokens are one of 120 at random, the others are certain.
    assert got[True].base_perplexity > 150 and got[True].perplexity < 20


def test_pitman_yor_packing():
    rng = np.random.default_rng(0)
    for n in (0, 1, 1000):
        x = rng.integers(0, 2 ** 32, n)
        h = np.sort(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        assert (pitman_yor.unpacked(pitman_yor.packed(x)) == x).all() and (pitman_yor.unpacked_hashes(pitman_yor.packed_hashes(h)) == h).all()


# ---- 6 BPE

def test_bpe_matches_the_library(docs, empty):
    import tiktoken
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    want = collections.Counter()
    for i, t in texts_of(docs):
        ids = library.encode_ordinary(t or "")
        want[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert as_counter(bpe.encode_digests(docs, path, public_tokenizers.PATTERN).collect()) == want
    assert bpe.encode(empty, path, public_tokenizers.PATTERN).count() == 0


def test_bpe_of_random_unicode():
    import tiktoken
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    pool = " \t\n\r\x0b\x1c\x85\xa0 　​'sdtleABé日語😀1²Ⅷ٣!?-_́"
    rows = ["".join(rng.choice(pool) for _ in range(rng.randrange(40))) for _ in range(2000)] + ["a" * 3000, "", None]
    batch = pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])
    decoder = bpe.Decoder(ranks)
    got = [(i.tolist(), decoder.bytes_of(i)) for _, ids in bpe.encode_batches([batch], path, public_tokenizers.PATTERN) for i in ids]
    assert got == [(library.encode_ordinary(t or ""), (t or "").encode()) for t in rows]


def test_bpe_of_long_unbroken_texts():
    import tiktoken
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng, encoder = random.Random(3), bpe.Encoder(ranks)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(100_000)), "a" * 100_000, "ab" * 50_000, "x", "",
             "".join(rng.choice("etaoinshrdlu") for _ in range(100_000)), "aab" * 400 + "é" * 300, "short"]
    flat, counts = encoder.encode([t.encode() for t in texts if t])
    want = [library._core_bpe.encode_single_piece(t.encode()) for t in texts if t]
    assert counts.tolist() == [len(w) for w in want] and flat.tolist() == [i for w in want for i in w]


# ---- 7 toxicity

def test_toxicity_finds_planted_words(spark, empty):
    rng = random.Random(4)
    bad = ["scumbag", "lowlife", "wretch"]
    rows, labels = [], []
    for k in range(600):
        w = prose(rng, rng.randint(20, 200)).split(" ")
        toxic = k % 7 == 0
        for _ in range(rng.randint(1, 4) if toxic else 0):
            w[rng.randrange(len(w))] = rng.choice(bad)
        rows.append((k, " ".join(w)))
        if k < 450:
            labels.append((k, int(toxic)))
    rows += [(600, None), (601, ""), (602, "word " * 50_000 + "Scumbag!")]
    labels += [(0, 1), (5, None), (None, 1), (9999, 1)]
    df = saved(spark.createDataFrame(rows, "doc_id int, text string"))
    lab = spark.createDataFrame(labels, "doc_id int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(df, lab).collect()}
    wrong = [k for k in range(450, 600) if got[k].toxic != (k % 7 == 0)]
    assert not wrong and got[602].toxic and not got[600].toxic and not got[601].toxic
    assert all(0 <= r.severity <= 2 and abs(r.p_toxic) <= 1 for r in got.values())
    kept = toxicity.drop_toxic(df, lab)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(k for k, r in got.items() if not r.toxic)
    assert not any(r.toxic for r in toxicity.toxicity(df, lab.filter("toxic = 0")).collect())
    assert toxicity.toxicity(saved(df.filter("false")), lab).count() == 0


def test_toxicity_sample_is_bounded_by_ids(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit_ordinal", lambda rows, cols, grades, *a: seen.append(len(grades)) or (np.zeros(a[0]), np.zeros(a[1] - 1)))
    rows = [(k % 20, "scum word", "x", "y", 1) for k in range(5010)] + [(k, f"clean{k % 3} text", "x", "y", 1) for k in range(20, 60)]
    df = saved(spark.createDataFrame(rows, "doc_id int, text string, toxic string, row string, digest int"))
    toxicity.fit(df, spark.createDataFrame([(k, int(k < 20)) for k in range(60)], "doc_id int, toxic int"), max_labelled=40)
    assert seen and seen[0] <= 40


def test_ordinal_fit_recovers_an_order():
    rng = np.random.default_rng(0)
    n, f = 3000, 6
    x = rng.random((n, f)) < 0.3
    w = np.array([3.0, 2.0, 1.0, 0, -1.0, -2.0])
    latent = x @ w + rng.logistic(size=n)
    grades = (latent > 1).astype(int) + (latent > 3)
    rows, cols = np.nonzero(x)
    got, cuts = toxicity.fit_ordinal(rows, cols, grades, f, 3, l2=0)
    assert np.abs(got - w).max() < 0.4 and cuts[0] < cuts[1] and np.abs(cuts - [1, 3]).max() < 0.4


# ---- 8 quality rules

def quality_brute(rows, min_docs, share, min_left):
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ").lower()
    seen, hosts = collections.defaultdict(set), collections.defaultdict(set)
    for _, t, h in rows:
        hosts[h].add(t or "")
        for x in (t or "").split("\n"):
            if norm(x):
                seen[h, norm(x)].add(t)
    for i, t, h in rows:
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        g = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        n = collections.Counter(g)
        rep = len({k + j for k, x in enumerate(g) if n[x] > 1 for j in range(5)})
        gone = sum(len(WORD.findall(x)) for x in lines if len(seen[h, norm(x)]) > min_docs and len(seen[h, norm(x)]) > share * len(hosts[h]))
        failed = len(w) < 10 or 100 * rep > 20 * len(w)
        left = len(w) - gone
        yield (i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep, failed,
               not failed and left > 0 and left >= min_left * len(w), gone)


def test_quality_matches_brute_force(spark, docs, empty):
    extra = [(900, "one two three four five six seven\n" * 9, None), (901, "# * $ & | <>\n\n x \nx\n x ", "a"), (902, "boiler plate line here\n" * 5, "hot"), (902, "boiler plate line here\n" * 5, "hot")]
    df = saved(docs.select("doc_id", "text", "source").union(spark.createDataFrame(extra, "doc_id long, text string, source string")))
    rows = [tuple(r) for r in df.collect()]
    got = as_counter(quality.quality(df, min_docs=4, share=0.02).collect())
    assert got == collections.Counter(quality_brute(rows, 4, 0.02, 0.2))
    cleaned = quality.clean_documents(docs, min_docs=4)
    assert cleaned.schema.names == docs.schema.names
    assert not [r for r in cleaned.filter("source = 'hot'").collect() if "boiler plate line here" in r["text"].split("\n")]
    assert quality.quality(empty).count() == 0


# ---- 9 mixing

def test_mixing_meets_targets(docs, empty):
    rows = mixing.mix_plan(docs).collect()
    size = collections.Counter()
    source = {(r["doc_id"], len(WORD.findall(r["text"] or ""))): r["source"] for r in docs.collect()}
    taken, target = collections.Counter(), {}
    for r in rows:
        s = source[r.doc_id, r["size"]]
        size[s] += r["size"]
        taken[s] += r.taken
        target[s] = r.target
        assert r.taken in (r.reps * r["size"],) and 0 <= r.reps <= 3
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(order)}
    level = sum(size.values()) / sum(weight.values())
    for _ in range(50):
        capped = [s for s in order if 3 * size[s] < weight[s] * level]
        level = (sum(size.values()) - sum(3 * size[s] for s in capped)) / sum(weight[s] for s in order if s not in capped)
    for s in order:
        assert target[s] == pytest.approx(min(3 * size[s], weight[s] * level))
        assert all(r.source_size == size[s] for r in rows if source[r.doc_id, r["size"]] == s)
        largest = max(r["size"] for r in rows if source[r.doc_id, r["size"]] == s)
        assert abs(taken[s] - target[s]) <= largest / 2 + 1
    assert as_counter(mixing.mix_plan(docs).collect()) == as_counter(rows)
    mixed = mixing.mix(docs)
    assert mixed.schema.names == docs.schema.names and mixed.count() == sum(r.reps for r in rows)
    assert mixing.mix_plan(empty).count() == 0 == mixing.mix(empty).count()


# ---- 10 nearest neighbours

def test_nearest_recall_and_order(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 24)).astype(np.float32)
    x[100:140] = x[100]  # ties
    rows = [(k, x[k].tolist()) for k in range(3000)]
    rows += [(4000, None), (4020, [0.0] * 24), (4040, [float("nan")] + [1.0] * 23), (4060, [None] + [1.0] * 23), (4080, [float("inf")] + [1.0] * 23), (None, [1.0] * 24), (4100, [1.0])]
    df = saved(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4))
    got = collections.defaultdict(list)
    for r in sorted(neighbours.nearest(df).collect(), key=lambda r: r.rank):
        got[r.query_id].append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 3000, 20))
    y = x.astype(np.float64)
    recall = []
    for q, found in got.items():
        s = y @ y[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(3000), -s))[:20]
        recall.append(len({v for v, _ in found} & set(best.tolist())) / 20)
        assert len(found) == 20 and all(abs(s[v] - c) < 1e-9 for v, c in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
    assert np.mean(recall) > 0.95


def test_nearest_small_tables(spark):
    make = lambda rows: saved(spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int"))
    assert neighbours.nearest(make([])).count() == 0
    assert neighbours.nearest(make([(20, [1.0, 0.0], 1)])).count() == 0
    got = [tuple(r) for r in neighbours.nearest(make([(20, [1.0, 0.0], 1), (20, [1.0, 0.0], 2), (3, [1.0, 0.0], 3)])).orderBy("query_id", "rank").collect()]
    assert sorted(got) == [(20, 1, 3, 1.0), (20, 1, 3, 1.0), (20, 2, 20, 1.0), (20, 2, 20, 1.0)]


# ---- registration and the pipeline

def test_every_operator_is_registered():
    import __spark_entry__
    names = list(__spark_entry__.queries())
    assert [n for k in range(1, 14) for n in names if n.startswith(f"op{k}_")] == list(queries.QUERIES)
    assert len(queries.QUERIES) == 13 and "pipeline" in names


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline
    small = docs.filter("n_chars < 20000").select("doc_id", "text", "lang", "source", "n_chars")
    small.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k % 9 == 0)) for k in range(20, 100)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        out = saved(stage(spark, at, str(tmp_path)))
        if name != "encode":
            assert out.columns == small.columns
        if name == "repeats":
            again = {r[0]: r[2] for r in removed_brute(texts_of(at), 200)}
            assert {r.doc_id: len((r.text or "").encode()) for r in out.collect()} .keys() == again.keys()
        counts.append(out.count())
        at = out
    assert counts[1] <= counts[0] and counts[2] == counts[1] and counts[4] == counts[3]
    assert all(r.decoded == b.decode() for r in at.collect() for b in [r.decoded.encode()])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == counts[-1]
