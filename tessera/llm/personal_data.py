"""Operator 13: personal data (e-mail and IP addresses, card and phone numbers).

Fixed patterns give the base spans. A skip-chain conditional random field (``crf``) adds
spans that the patterns miss, for example a phone number that an address follows at once:
the pattern takes both as one number, which has too many digits, and drops it. Tokens
are the words with a digit or an ``@``; all other words are outside by definition, so
chains break at them and the field is as large as what could be personal data. Skip
edges join each token with the next one of the document that repeats it or ends in the
same seven digits (the digits of its chain up to it counted), so mentions of one number
are labelled together.

The field is trained here: the base spans of a bounded sample of documents are its
labels. The sample is at most ``sample_documents`` texts of at most ``SAMPLE_CHARS``
characters that hold a digit or an ``@``, those of the least hashes, less those in which
numbers run together; everything else sees all texts whole. An added span must hold what its kind needs (an ``@``; 4, 7 to 15 or 12
to 19 digits) and overlap no base span.

Cases: a null or empty text has no spans; rows that repeat get equal spans; a text that
is one very long run costs time in proportion to its length; a text of any number of
tokens is labelled as one graph, whose label tables are held for ``GRAPH_TOKENS`` edges at a time;
an empty table gives an empty result, and without any labelled span nothing is added;
other columns are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .crf import Graph, SkipChain
from .tables import read, with_text
from .text import by_bytes

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCUMENTS, SAMPLE_CHARS = 4_000, 20_000
GRAPH_TOKENS, BATCH_TOKENS = 20_000, 20_000
N_FEATURES = 1 << 14
TAIL = 7

# The base patterns. Runs are taken whole (a match that fails inside a run of
# digits fails everywhere in it), so every pattern is linear in the text.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
WORD = re.compile(r"[\w.%+@()-]++")
HINT = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def emails(text: str):
    """Spans of the e-mail pattern, found from each ``@``: what can stand before it is a run
    that holds no other ``@``, so the scan back never passes the one before."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text, start - 1):
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        at = text.find("@", max(at + 1, end))


def run_together(text: str) -> bool:
    """Whether a pattern takes more digits for one number than any has: such a match may be
    several numbers, so its tokens are no examples of what is not personal data."""
    return (any(len(DIGIT.findall(m.group())) > 19 for m in CARD.finditer(text))
            or any(len(DIGIT.findall(m.group())) > 15 for m in PHONE.finditer(text)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of every base span, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = "".join(DIGIT.findall(m.group())) if m.end() - m.start() <= 40 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(DIGIT.findall(m.group())) <= 15:
            out.append((3, *m.span()))
    return out


# ---- tokens and the graph

def _shape(core: str) -> str:
    return re.sub(r"[^\W\d]+", "a", re.sub(r"[0-9]+", lambda m: f"d{min(len(m.group()), 20)}", core))


def _own_features(core: str) -> tuple[int, ...]:
    digits = "".join(DIGIT.findall(core[:4096]))
    plain = digits == core.replace("-", "")
    checked = str(luhn(digits)) if plain and 13 <= len(digits) <= 19 else "-"
    parts = core.split(".")
    octets = str(all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)) if len(parts) == 4 else "-"
    whole = str(next(emails(core), None) == (0, len(core))) if "@" in core else "-"
    said = ("bias", f"shape {_shape(core[:256])}", f"digits {min(len(digits), 20)}", f"checked {checked}", f"octets {octets}",
            f"address {whole}", f"plus {core[:1] == '+'}")
    return tuple(zlib.crc32(f.encode("utf-8", "surrogatepass")) % N_FEATURES for f in said)


def _word_feature(side: str, word: str) -> int:
    word = word.lower() if not HINT.search(word) else _shape(word[:256])
    return zlib.crc32(f"{side} {word}".encode("utf-8", "surrogatepass")) % N_FEATURES


def _core(text: str, start: int, end: int) -> tuple[int, int]:
    """The token without punctuation around it; brackets stay around digits only."""
    strip = "._%-()" if "@" in text[start:end] or re.search(r"[^\W\d]", text[start:end]) else "._%-"
    while start < end and text[start] in strip:
        start += 1
    while end > start and text[end - 1] in strip + "+":
        end -= 1
    return start, end


class Tokens:
    """Tokens of one text: spans, left neighbours (-1: none) and feature ids, and skip edges.
    ``known`` keeps the features of short tokens from text to text."""

    def __init__(self, text: str, known: dict | None = None):
        known = {} if known is None else known
        if len(known) > 100_000:
            known.clear()
        self.spans, self.left, self.features, self.skip = [], [], [], []
        seen: dict = {}
        before, before_end, last_end, digits = "", -1, -1, ""
        waiting = None  # token whose following word is still to come
        for m in WORD.finditer(text):
            word = m.group()
            if waiting is not None:
                self.features[waiting] += (_word_feature("next", word),)
                waiting = None
            if HINT.search(word):
                start, end = _core(text, m.start(), m.end())
                k = len(self.spans)
                near = k > 0 and start == m.start() and last_end == before_end and 1 <= start - last_end <= 2 and text[last_end:start].isspace()
                core = text[start:end]
                own = "".join(DIGIT.findall(core))
                digits = (digits + own if near else own)[-64:]
                self.spans.append((start, end))
                self.left.append(k - 1 if near else -1)
                features = known.get(core) or _own_features(core)
                if len(core) <= 64:
                    known[core] = features
                self.features.append((*features, _word_feature("prev", before)))
                waiting = k
                keys = [(0, core.lower())] if len(core) >= 4 else []
                if len(digits) >= TAIL and own:
                    keys.append((1, digits[-TAIL:]))
                for key in keys:
                    j = seen.get(key)
                    if j is not None and not (near and j == k - 1):
                        self.skip.append((j, k, key[0]))
                    seen[key] = k
                last_end = end
            before, before_end = word, m.end()
        if waiting is not None:
            self.features[waiting] += (_word_feature("next", ""),)


N_SLOTS = len(_own_features("x")) + 2


def graph(texts: list[Tokens]) -> Graph:
    features, opens, chain, skip, base = [], [], [], [], 0
    for t in texts:
        features += t.features
        opens += [k < 0 for k in t.left]
        chain += [(base + j, base + k) for k, j in enumerate(t.left) if j >= 0]
        skip += [(base + a, base + b, s) for a, b, s in t.skip]
        base += len(t.spans)
    return Graph(np.array(features, np.int64).reshape(base, N_SLOTS), np.array(opens, bool),
                 np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 3))


def token_labels(tokens: Tokens, spans: list[tuple[int, int, int]]) -> list[int]:
    """The label of each token under base spans; the first kind in order wins."""
    out = [0] * len(tokens.spans)
    starts = [s for s, _ in tokens.spans]
    for kind, a, b in sorted(spans, reverse=True):
        k = max(int(np.searchsorted(starts, a, "right")) - 1, 0)
        first = True
        while k < len(starts) and starts[k] < b:
            if tokens.spans[k][1] > a:
                out[k] = 1 + 2 * kind + (not first and tokens.left[k] >= 0)
                first = False
            k += 1
    for k, j in enumerate(tokens.left):  # what a span of another kind has cut starts anew
        if out[k] and out[k] % 2 == 0 and (j < 0 or (out[j] + 1) // 2 != out[k] // 2):
            out[k] -= 1
    return out


def holds(kind: int, text: str) -> bool:
    """What an added span of a kind must hold."""
    n = len(DIGIT.findall(text))
    return (0 < text.find("@") < len(text) - 1, n >= 4, 12 <= n <= 19, 7 <= n <= 15)[kind]


def added_spans(text: str, tokens: Tokens, labels: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the labelled tokens that overlap no base span."""
    found: list[list[int]] = []
    for k, (start, end) in enumerate(tokens.spans):
        label = int(labels[k])
        if not label:
            continue
        kind = (label - 1) // 2
        if label % 2 == 0 and tokens.left[k] >= 0 and labels[k - 1] and (int(labels[k - 1]) - 1) // 2 == kind:
            found[-1][2] = end
        else:
            found.append([kind, start, end])
    taken = sorted((a, b) for _, a, b in base)
    starts, ends = [a for a, _ in taken], np.maximum.accumulate([b for _, b in taken]) if taken else []
    out = []
    for kind, a, b in found:
        k = int(np.searchsorted(starts, b, "left"))  # base spans that start before this one ends
        if holds(kind, text[a:b]) and not (k and ends[k - 1] > a):
            out.append((kind, a, b))
    return out


def fit(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> SkipChain:
    """The field, fitted to the base spans of a bounded sample of the texts."""
    rows = with_text(docs)
    share = min(1.0, 4 * sample_documents / max(rows.count(), 1))
    order = F.xxhash64("text")
    sample = (rows.withColumn("h", order).filter(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
              .filter((F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike("[0-9@]"))
              .orderBy("h", "text").limit(sample_documents).select("text").collect())
    texts = [r["text"] for r in sample if not run_together(r["text"])]
    tokens = [Tokens(t) for t in texts]
    labels = [y for text, t in zip(texts, tokens) for y in token_labels(t, base_spans(text))]
    return SkipChain(len(KINDS), N_FEATURES, 2).fit(graph(tokens), np.array(labels, np.int64))


def find(texts: list[str], model: SkipChain, known: dict | None = None) -> list[tuple[list, list]]:
    """(base spans, added spans) of each text."""
    base = [base_spans(t) for t in texts]
    tokens = [Tokens(t, known) for t in texts]
    labels = []
    group, size = [], 0

    def label() -> None:
        if group:
            labels.extend(np.argmax(model.infer(graph(group), GRAPH_TOKENS, pairs=False)[0], axis=1))

    for t in tokens:
        if not t.spans:
            continue
        if size + len(t.spans) > BATCH_TOKENS:
            label()
            group, size = [], 0
        group.append(t)
        size += len(t.spans)
    label()
    out, low = [], 0
    for text, b, t in zip(texts, base, tokens):
        out.append((b, added_spans(text, t, np.array(labels[low:low + len(t.spans)]), b)))
        low += len(t.spans)
    return out


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def personal_data(docs: DataFrame, model: SkipChain | None = None, id_col: str = "doc_id",
                  sample_documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and added,
    ``kind:start:end`` in code points, by kind and start), n_added of every row."""
    model = model or fit(docs, sample_documents)
    kind = dict(docs.dtypes)[id_col]
    counts = [f"n_{k}" for k in KINDS]
    names = [id_col, *counts, "base_sha256", "spans", "n_added"]

    def scan(batches):
        known: dict = {}
        for batch in by_bytes(batches):
            text = pc.fill_null(batch.column("text"), "")
            at = np.flatnonzero(pc.match_substring_regex(text, "[0-9@]").to_numpy(zero_copy_only=False))
            n = np.zeros((len(KINDS), batch.num_rows), np.int64)
            n_added = np.zeros(batch.num_rows, np.int64)
            digest, spans = [hashlib.sha256(b"").hexdigest()] * batch.num_rows, [""] * batch.num_rows
            for k, (base, added) in zip(at, find(text.take(pa.array(at)).to_pylist(), model, known) if len(at) else ()):
                for s in base:
                    n[s[0], k] += 1
                n_added[k] = len(added)
                digest[k] = hashlib.sha256(written(base).encode()).hexdigest()
                spans[k] = written(base + added)
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *map(pa.array, n), pa.array(digest), pa.array(spans), pa.array(n_added)], names=names)

    schema = f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in counts) + ", base_sha256 string, spans string, n_added long"
    return with_text(docs, id_col).mapInArrow(scan, schema)


def op13_personal_data(spark, sf_dir):
    return personal_data(read(spark, sf_dir, "documents"))
