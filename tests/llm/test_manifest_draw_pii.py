"""Operators 11 to 13 against brute force: nulls, empty and very long texts, ties,
repeated rows, empty tables and columns whose names clash with the operators' own."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import importance, merkle, personal_data
from tessera.llm.crf import Graph, SkipChain
from tessera.llm.tables import saved

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, rid string, id int, idx int, node string, score int, bucket string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def make_rows():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abÉcD日9") for _ in range(rng.randint(1, 6)))
    rows = []
    for k in range(900):
        lang = rng.choice(["en"] * 9 + ["de", "", None, "zz", "É"])
        text = rng.choice([None, ""]) if rng.random() < 0.05 else " ".join(word() for _ in range(rng.randint(0, 40)))
        rows.append((k, rng.choice([None, "a", "-"]), lang, rng.choice([None, k]), text))
    rows += [(5, "a", "en", 1, "same id"), (5, "a", "en", 1, "other TEXT"), (None, None, None, None, None), (None, "x", "en", 2, "No Id here")]
    rows += [(7, "b", "en", 3, "twice OVER")] * 3 + [(10**12, "b", "lone", 1, "L" * 300_000), (-3, "b", "lone2", 1, "Q x " * 50_000)]
    return [(*r, "x", 1, 2, "n", 3, "b") for r in rows]


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return saved(spark.createDataFrame(rows, SCHEMA).repartition(6))


@pytest.fixture(scope="module")
def empty(docs):
    return saved(docs.filter("false"))


# ---- 11 Merkle manifest

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree_of(nodes, fanout):
    """(root, for every leaf its list of (before, after))."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, k in enumerate(at):
            low = k // fanout * fanout
            steps[leaf].append(("".join(nodes[low:k]), "".join(nodes[k + 1:low + fanout])))
        nodes = [sha(*nodes[k:k + fanout]) for k in range(0, len(nodes), fanout)]
        at = [k // fanout for k in at]
    return nodes[0], steps


def manifest_brute(rows, fanout=8):
    trees = collections.defaultdict(list)
    for r in rows:
        doc_id, source, lang, n_chars, text = r[:5]
        changed = text.translate(LOWER) if text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 else text
        trees[lang].append((doc_id, leaf_of((doc_id, source, lang, n_chars, text)), leaf_of((doc_id, source, lang, n_chars, changed))))
    order = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    for v in order:
        trees[v].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    built = {v: tree_of([t[1] for t in trees[v]], fanout) for v in order}
    root, above = tree_of([built[v][0] for v in order], fanout)
    for v, more in zip(order, above):
        for (doc_id, leaf, other), steps in zip(trees[v], built[v][1]):
            way, node = steps + more, other
            for before, after in way:
                node = sha(before, node, after)
            yield doc_id, leaf, built[v][0], root, sha(*[b + a for b, a in way]), node, node == root


def test_manifest_matches_brute_force(docs, rows):
    got = merkle.tamper_report(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = collections.Counter(tuple(r) for r in got.collect())
    assert got == collections.Counter(manifest_brute(rows))
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n,fanout", [(1, 8), (2, 8), (8, 8), (9, 8), (65, 8), (10, 2), (28, 3)])
def test_runs_at_their_edges(spark, n, fanout):
    table = [(k, None, "en", k, f"text {k}") for k in range(n)]
    docs = saved(spark.createDataFrame(table, "doc_id long, source string, lang string, n_chars long, text string").repartition(3))
    root, ways = tree_of([leaf_of(r) for r in table], fanout)
    got = merkle.manifest(docs, fanout=fanout).orderBy("id").collect()
    assert {r.root for r in got} == {root} == {r.subroot for r in got}
    assert [[(s.before, s.after) for s in r.proof] for r in got] == ways


def test_manifest_of_an_empty_table(empty):
    assert merkle.tamper_report(empty).count() == 0


def test_manifest_tells_null_from_empty(spark):
    table = saved(spark.createDataFrame([(1, None), (2, ""), (3, "-")], "doc_id long, text string").withColumn("lang", F.lit("x")))
    assert len({r.leaf for r in merkle.manifest(table, fields=("text",)).collect()}) == 3


def test_manifest_does_not_depend_on_layout(docs, rows):
    shuffled = saved(docs.repartition(3, "text"))
    assert merkle.manifest(shuffled).first().root == next(manifest_brute(rows))[3]


# ---- 12 importance resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def grams(text, order):
    words = WORD.findall((text or "").translate(LOWER))
    return [" ".join(words[k:k + n]) for n in range(1, order + 1) for k in range(len(words) - n + 1)], len(words)


def resample_brute(rows, target, order=1, percent=10, buckets=10_000):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    corpus = collections.Counter(bucket(g) for r in rows for g in grams(r[4], order)[0])
    aim = collections.Counter(bucket(g) for t in target for g in grams(t, order)[0])
    s_all, t_all = sum(corpus.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets)))) for b, s in corpus.items()}
    out = []
    for r in rows:
        found, n_words = grams(r[4], order)
        weight = sum(gain[bucket(g)] for g in found)
        score = None
        if r[0] is not None:
            h = int(hashlib.sha256(f"2024:{r[0]}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(found), weight, score, None, n_words])
    able = sorted((o for o in out if o[3] is not None and o[5] >= 20), key=lambda o: (-o[3], o[0]))
    for k, o in enumerate(able[:percent * len(able) // 100]):
        o[4] = k + 1
    return collections.Counter(tuple(o[:5]) for o in out)


@pytest.mark.parametrize("order,percent,segment", [(1, 10, 1 << 19), (2, 60, 40), (1, 100, 7)])
def test_draw_matches_brute_force(spark, docs, rows, monkeypatch, order, percent, segment):
    monkeypatch.setattr(importance, "SEGMENT_ROWS", segment)
    target = ["ab 日 C9 ab", None, "", "9 9 9 b Éa"]
    got = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), order=order, percent=percent)
    got = collections.Counter((r.id, r.n_features, r.weight, r.score, r.rank) for r in got.collect())
    assert got == resample_brute(rows, target, order, percent)


def test_drawn_documents_keep_their_columns(spark, docs):
    target = spark.createDataFrame([("ab 日",)], "text string")
    out = importance.drawn(docs, target, percent=20)
    n = docs.filter("doc_id IS NOT NULL").count()
    assert out.columns == docs.columns and 0 < out.count() < n


def test_empty_tables_draw_nothing(spark, docs, empty):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(empty, none).count() == 0
    assert importance.resample(docs, none).count() == docs.count()


def test_crc_of_runs():
    rng = np.random.default_rng(3)
    buf = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 4500, 300)
    ends = starts + np.concatenate([[0, 1, 64, 65, 500], rng.integers(0, 90, 295)])
    assert importance.crc32_runs(buf, starts, ends).tolist() == [zlib.crc32(buf[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert importance.crc32_runs(buf, starts[:0], ends[:0]).tolist() == []


def test_one_score_for_all_is_ranked_by_id(spark, monkeypatch):
    monkeypatch.setattr(importance, "SEGMENT_ROWS", 50)
    rows = saved(spark.range(2000).selectExpr("5L AS score", "id % 700 AS id", "id AS rid").repartition(7))
    got = importance.ranked(rows, 2000, 900).orderBy("id", "rid").collect()
    assert [r["rank"] for r in got] == [k + 1 if k < 900 else None for k in range(2000)]


# ---- 13 personal data

def base_brute(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(d) for d in m.group() if d.isdigit()]
        doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]


def card(rng):
    digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(digits + d for d in "0123456789" if personal_data.luhn(digits + d))


def pii_texts():
    rng = random.Random(13)
    plain = lambda: " ".join("".join(rng.choice("abcdeéñ日") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(2, 12)))
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    make = [lambda: f"{plain()[:4].encode('ascii', 'ignore').decode()}x.{number(2)}@mail{number(1)}.example.com", lambda: ".".join(str(rng.randrange(256)) for _ in range(4)),
            lambda: card(rng), lambda: f"+1 ({number(3)}) 555-{number(4)}", lambda: number(16), lambda: number(rng.randint(1, 6)), lambda: f'"{number(8)}ab{number(9)}"']
    return [" ".join(x for _ in range(rng.randint(1, 6)) for x in (plain(), rng.choice(make)(), plain())) + rng.choice([".", "", "!!", "\n"]) for _ in range(600)]


@pytest.fixture(scope="module")
def model(spark):
    texts = [(k, t) for k, t in enumerate(pii_texts()[:400])]
    return personal_data.fit(spark.createDataFrame(texts, "doc_id long, text string"))


def test_base_spans_match_the_patterns():
    rng = random.Random(1)
    odd = ["", "@", "a@b", "a@b.c", "a@b..c", "a@b.c@d.e", "a@b.co+x@d.e", "a@@b.c", "1.2.3.4.5.6.7.8.9", "1.2.3.256 0001.2.3.4", "+1", "+1 2", "++1 234 5678901", "+1 (2) 3-4.5 6789 01 +44 20 7946 0958"]
    odd += ["".join(rng.choice("aé@.1 +-()5290") for _ in range(rng.randint(1, 60))) for _ in range(4000)]
    for text in odd + pii_texts():
        assert sorted(base_brute(text)) == sorted(personal_data.base_spans(text)), text


@pytest.mark.parametrize("text", ["a" * 400_000, "1" * 400_000, "a@" * 200_000, "1.1." * 100_000, "+1 " * 130_000, "+" + "1-" * 200_000, "(" * 400_000 + "1", "x.1@" * 100_000])
def test_very_long_runs_take_linear_time(text):
    model = SkipChain(4, personal_data.N_FEATURES, 2)
    (base, added), = personal_data.find([text], model)
    assert added == [] and base == personal_data.base_spans(text)


def test_marginals_are_exact_on_chains_and_close_on_loops():
    rng = np.random.default_rng(0)
    for skip, tolerance in (([], 1e-9), ([(0, 4, 0)], 0.05)):
        m = SkipChain(1, 6, 1)
        for w in m.weights.values():
            w += rng.normal(0, 0.6, w.shape)
        g = Graph(rng.integers(0, 6, (5, 2)), np.array([True, False, False, True, False]),
                  np.array([(0, 1), (1, 2), (3, 4)]), np.array(skip, np.int64).reshape(-1, 3))
        unary, tables, left, right, sort = m._potentials(g)
        total = np.zeros((5, 3))
        for y in itertools.product(range(3), repeat=5):
            p = math.exp(sum(unary[k, y[k]] for k in range(5)) + sum(tables[s][y[a], y[b]] for a, b, s in zip(left, right, sort)))
            for k in range(5):
                total[k, y[k]] += p
        assert np.abs(m.infer(g)[0] - total / total.sum(1, keepdims=True)).max() < tolerance


def test_skip_edges_carry_labels():
    """A token without evidence of its own follows a distant one that it repeats."""
    m = SkipChain(1, 2, 1)
    m.weights["label"][0, 1] = 3.0
    m.weights["skip"][0] = (1.0, 2.0)
    features, opens, none = np.array([[0], [1]]), np.array([True, True]), np.zeros((0, 2), np.int64)
    alone = m.infer(Graph(features, opens, none, np.zeros((0, 3), np.int64)))[0]
    joined = m.infer(Graph(features, opens, none, np.array([(0, 1, 0)])))[0]
    assert joined[1, 1] > 0.6 > alone[1, 1] + 0.05


def test_held_out_labels(model):
    texts = [t for t in pii_texts()[400:] if not personal_data.run_together(t)]
    tokens = [personal_data.Tokens(t) for t in texts]
    want = np.array([y for x, t in zip(texts, tokens) for y in personal_data.token_labels(t, personal_data.base_spans(x))])
    got = np.argmax(model.infer(personal_data.graph(tokens))[0], axis=1)
    assert (got[want > 0] == want[want > 0]).mean() > 0.97 and (got[want == 0] > 0).mean() < 0.03


def test_numbers_that_run_together_are_added(model):
    rng = random.Random(4)
    a, b = card(rng), card(rng)
    text = f"abc deé +1 (826) 555-4081 190.137.223.204 bcd ea {a} {b} dab"
    (base, added), = personal_data.find([text], model)
    assert base == [(1, text.index("190"), text.index("190") + 15)] == sorted(base_brute(text))
    assert sorted(text[s:e] for _, s, e in added) == sorted(["+1 (826) 555-4081", a, b])
    assert {k for k, _, _ in added} == {2, 3}


def test_similar_tokens_are_joined():
    t = personal_data.Tokens("call +1 (509) 555-6973 or 509-555-6973, also 555-6973 and x@y.example x@y.example")
    core = ["call +1 (509) 555-6973 or 509-555-6973, also 555-6973 and x@y.example x@y.example"[a:b] for a, b in t.spans]
    assert core == ["+1", "(509)", "555-6973", "509-555-6973", "555-6973", "x@y.example", "x@y.example"]
    assert sorted(t.skip) == [(2, 3, 1), (2, 4, 0), (3, 4, 1)]  # neighbours in a chain have their edge already
    assert t.left == [-1, 0, 1, -1, -1, -1, 5]


def test_spans_of_a_table(spark, model, empty):
    texts = pii_texts()[400:450] + [None, "", "no digits here", "no digits here", "5" * 3000]
    rows = [(k, "x", t, "y") for k, t in enumerate(texts)] + [(None, "x", texts[0], "y")]
    table = saved(spark.createDataFrame(rows, "doc_id long, spans string, text string, n_ip string").repartition(3))
    got = {r.doc_id: r for r in personal_data.personal_data(table, model).collect()}
    for k, _, t, _ in rows:
        base = sorted(base_brute(t or ""))
        r = got[k]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == j for s in base) for j in range(4)]
        said = [f"{personal_data.KINDS[j]}:{a}:{b}" for j, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert set(said) <= set(r.spans.split(",")) and (r.n_added or r.spans == ",".join(said))
    assert personal_data.personal_data(empty).count() == 0


def test_pieces_keep_base_spans(model, monkeypatch):
    texts = pii_texts()[:30] + [" ".join(pii_texts()[:200])]
    whole = personal_data.find(texts, model)
    monkeypatch.setattr(personal_data, "GRAPH_TOKENS", 50)
    assert [b for b, _ in personal_data.find(texts, model)] == [b for b, _ in whole]


def test_long_texts_are_labelled_whole(model, monkeypatch):
    """Links between distant tokens of a text count, however many lie between."""
    texts = pii_texts()[:30] + [" ".join(pii_texts()[:200] * 2)]
    own = personal_data.graph([personal_data.Tokens(texts[-1])])
    assert (own.skip[:, 1] - own.skip[:, 0]).max() > 50
    linked = SkipChain(model.n_kinds, model.n_features, model.n_sorts, weights={**model.weights, "skip": np.array([[0.5, 1.0], [0.3, 0.8]])})
    assert (linked.infer(own, 50)[0] == linked.infer(own)[0]).all()
    whole, seen, infer = personal_data.find(texts, linked), [], SkipChain.infer
    monkeypatch.setattr(SkipChain, "infer", lambda self, g, *a, **k: seen.append(len(g.skip)) or infer(self, g, *a, **k))
    monkeypatch.setattr(personal_data, "GRAPH_TOKENS", 50)
    assert personal_data.find(texts, linked) == whole
    assert sum(seen) == sum(len(personal_data.Tokens(t).skip) for t in texts)
