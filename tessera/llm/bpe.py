"""Operator 6: byte-level BPE encoding and decoding with DuckDB recursive queries.

Each task cuts its texts into units that the pattern's matches never cross: a single
space with the run of characters up to the next one. The matches of the distinct
units that are not vocabulary entries themselves become rows (word, position, token)
of an in-process DuckDB table. A recursive query joins neighbouring tokens to the
merge table and contracts each word's leftmost pair of minimum rank until no word has
a pair left; ordered aggregation of the tokens' bytes decodes, and every decoded word
is compared with its bytes. A match of over ``LONG_BYTES`` bytes is first cut wherever no
vocabulary entry that occurs in it spans, and what stays long contracts all occurrences
of its least pair in a round, so a text without breaks costs about its length. Texts
with other white space next to a space, where the matches depend on more than the unit,
are matched as a whole. Memory is bounded by the distinct words of ``BLOCK_BYTES`` of
text and by the longest text.

Cases: a null or empty text has no ids and the digests of the empty string; repeated
rows are encoded row by row; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .tables import with_text
from .text import by_bytes, spread

BLOCK_BYTES = 32 << 20
SLICE_BYTES = 1 << 20
WORDS_A_QUERY = 20_000
LONG_BYTES = 256
KEPT_UNITS = 400_000

#: A word's state is one row per token, words and positions in order: the connection
#: has one thread and keeps row order, so the row after a token is its right
#: neighbour. Words without a mergeable pair leave the recursion as done.
_ENCODE = """
WITH RECURSIVE state AS (
    SELECT word, pos, token, false AS done FROM start_tokens
  UNION ALL
    (WITH pairs AS (
        SELECT word, pos, token,
               CASE WHEN lead(word) OVER () = word THEN lead(token) OVER () END AS right_token,
               CASE WHEN lag(word) OVER () = word THEN lag(pos) OVER () END AS left_pos
        FROM state WHERE NOT done),
     ranked AS (
        SELECT p.word, p.pos, p.token, p.left_pos, m.rank FROM pairs p
        LEFT JOIN merges m ON m.left_token = p.token AND m.right_token = p.right_token),
     best AS (
        SELECT word, min(rank::BIGINT << 32 | pos) AS k FROM ranked WHERE rank IS NOT NULL GROUP BY word)
     SELECT r.word, r.pos, CASE WHEN r.pos = b.k & 4294967295 THEN (b.k >> 32)::INT ELSE r.token END AS token,
            b.k IS NULL AS done
     FROM ranked r LEFT JOIN best b ON b.word = r.word
     WHERE b.k IS NULL OR r.left_pos IS NULL OR r.left_pos <> b.k & 4294967295)
)
SELECT word, pos, token FROM state WHERE done ORDER BY word, pos
"""
#: The same for long words, all occurrences of a word's least pair in one round: overlapping
#: ones (a run of marked rows) every other one from the left, as one by one. A word in which
#: a new token would rank lower with a neighbour than the pair itself, so that one by one
#: another pair came first, contracts only its leftmost pair in that round.
_ENCODE_LONG = """
WITH RECURSIVE state AS (
    SELECT word, pos, token, false AS done FROM start_tokens
  UNION ALL
    (WITH pairs AS (
        SELECT word, pos, token, lag(token) OVER w AS before, lead(token) OVER w AS right_token, lead(token, 2) OVER w AS beyond
        FROM state WHERE NOT done WINDOW w AS (PARTITION BY word ORDER BY pos)),
     ranked AS (
        SELECT p.*, m.rank FROM pairs p LEFT JOIN merges m ON m.left_token = p.token AND m.right_token = p.right_token),
     best AS (SELECT word, min(rank) AS least FROM ranked GROUP BY word),
     marked AS (
        SELECT r.word, r.pos, r.token, r.before, r.beyond, b.least, coalesce(r.rank = b.least, false) AS hit,
               row_number() OVER (PARTITION BY r.word ORDER BY r.pos) AS i FROM ranked r JOIN best b ON b.word = r.word),
     disturbed AS (
        SELECT DISTINCT h.word FROM (
            SELECT word, least, least AS l, beyond AS r FROM marked WHERE hit UNION ALL SELECT word, least, before, least FROM marked WHERE hit
            UNION ALL SELECT word, least, least, least FROM best) h
        JOIN merges m ON m.left_token = h.l AND m.right_token = h.r WHERE m.rank < h.least),
     runs AS (SELECT *, i - row_number() OVER (PARTITION BY word, hit ORDER BY pos) AS run,
                     row_number() OVER (PARTITION BY word, hit ORDER BY pos) AS nth FROM marked),
     chosen AS (
        SELECT r.word, r.pos, r.token, r.least, r.hit AND CASE WHEN d.word IS NOT NULL THEN r.nth = 1
               ELSE row_number() OVER (PARTITION BY r.word, r.hit, r.run ORDER BY r.pos) % 2 = 1 END AS head
        FROM runs r LEFT JOIN disturbed d ON d.word = r.word),
     after AS (SELECT *, coalesce(lag(head) OVER (PARTITION BY word ORDER BY pos), false) AS taken FROM chosen)
     SELECT word, pos, CASE WHEN head THEN least ELSE token END AS token, least IS NULL AS done FROM after WHERE NOT taken)
)
SELECT word, pos, token FROM state WHERE done ORDER BY word, pos
"""
_DECODE = """
SELECT word, string_agg(hex, '') AS hex
FROM (SELECT e.word, v.hex FROM encoded e JOIN vocabulary v ON v.token = e.token ORDER BY e.word, e.pos)
GROUP BY word ORDER BY word
"""


#: Empty, or begins or ends with Unicode white space (the property's members, fixed).
_OUTER = (r"^$|^[\x{9}-\x{d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
          r"|[\x{9}-\x{d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]$")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """Every pair of vocabulary entries whose concatenation is an entry."""
    rows = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() if len(t) > 1
            for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
    return pa.table({n: pa.array(c, pa.int32()) for n, c in zip(("left_token", "right_token", "rank"), zip(*rows) if rows else ((), (), ()))})


class Encoder:
    """Distinct byte strings -> token ids, on one DuckDB connection of the task."""

    def __init__(self, ranks: dict[bytes, int]):
        import duckdb
        self.ranks, self.finder = ranks, None
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "preserve_insertion_order": True,
                                         "autoinstall_known_extensions": False, "autoload_known_extensions": False})
        for name, rows in (("merges", merge_table(ranks)),
                           ("vocabulary", pa.table({"token": pa.array(list(ranks.values()), pa.int32()), "hex": [t.hex() for t in ranks]}))):
            self.db.register("incoming", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
            self.db.unregister("incoming")

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each word). Long words are encoded by their parts."""
        long = {k: self.parts(w) for k, w in enumerate(words) if len(w) > LONG_BYTES}
        if not long:
            return self._all(words)
        pieces, first = [], np.zeros(len(words) + 1, np.int64)
        for k, w in enumerate(words):
            pieces += long.get(k, [w])
            first[k + 1] = len(pieces)
        ids: list = [None] * len(pieces)
        for wanted, query in ((lambda p: len(p) <= LONG_BYTES, _ENCODE), (lambda p: len(p) > LONG_BYTES, _ENCODE_LONG)):
            at = [k for k, p in enumerate(pieces) if wanted(p)]
            flat, counts = self._all([pieces[k] for k in at], query)
            for k, part in zip(at, np.split(flat, np.cumsum(counts)[:-1]) if at else []):
                ids[k] = part
        counts = np.array([len(x) for x in ids], np.int64)
        return np.concatenate(ids), np.add.reduceat(counts, first[:-1])

    def parts(self, word: bytes) -> list[bytes]:
        """``word`` cut wherever no vocabulary entry found in it spans: no token can reach over
        such a place, so the parts are encoded each by itself."""
        if self.finder is None:
            import ahocorasick
            self.finder = ahocorasick.Automaton()
            for t in self.ranks:
                if len(t) > 1:
                    self.finder.add_word(t.decode("latin-1"), len(t))
            self.finder.make_automaton()
        spanned = np.zeros(len(word) + 1, np.int64)
        for end, size in self.finder.iter(word.decode("latin-1")):
            spanned[end - size + 2] += 1  # places between its bytes
            spanned[end + 1] -= 1
        cuts = np.flatnonzero(np.cumsum(spanned[:-1])[1:] == 0) + 1
        edges = [0, *cuts.tolist(), len(word)]
        return [word[low:high] for low, high in zip(edges[:-1], edges[1:])]

    def _all(self, words: list[bytes], query: str = _ENCODE) -> tuple[np.ndarray, np.ndarray]:
        parts = [self._encode(words[low:low + WORDS_A_QUERY], query) for low in range(0, len(words), WORDS_A_QUERY)]
        none = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(none, *parts))

    def _encode(self, words: list[bytes], query: str) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        self.db.register("start_tokens", pa.table({
            "word": pa.array(np.repeat(np.arange(len(words)), sizes), pa.int32()),
            "pos": pa.array(spread(np.zeros(len(sizes), np.int64), sizes), pa.int32()),
            "token": pa.array(self.single[data], pa.int32())}))
        encoded = self.db.sql(query).to_arrow_table()
        self.db.unregister("start_tokens")
        self.db.register("encoded", encoded)
        decoded = self.db.sql(_DECODE).to_arrow_table()["hex"].to_pylist()
        self.db.unregister("encoded")
        if decoded != [w.hex() for w in words]:
            raise AssertionError("a decoded word differs from its bytes")
        return encoded["token"].to_numpy().astype(np.uint32), np.bincount(encoded["word"].to_numpy(), minlength=len(words))


class Runs:
    """Numbered runs of ids in one flat array."""

    def __init__(self):
        self.flat = np.zeros(0, np.uint32)
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, counts: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.flat = np.concatenate([self.flat, flat.astype(np.uint32)])

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return self.flat[spread(self.starts[numbers], self.counts[numbers])]


class Units:
    """Ids of each distinct unit a task has seen; a unit's decoded bytes are its words',
    which the encoder has compared with theirs."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        # The library's white space is the Unicode property.
        pattern = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.find = regex.compile(pattern).findall
        self.encoder = Encoder(ranks)
        self.entries = {}
        for t, r in ranks.items():
            try:
                self.entries[t.decode()] = r
            except UnicodeDecodeError:  # part of a character: never a whole match
                pass
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {}    # match -> number
        self.units: dict[str, int] = {}    # unit -> number
        self.word_ids, self.unit_ids = Runs(), Runs()

    def learn(self, units: list[str], matches: list[str]) -> None:
        """Units to know; matches of texts matched as a whole are known as words."""
        units = [u for u in units if u not in self.units]
        parts = list(map(self.find, units))
        flat = list(chain.from_iterable(parts))
        new = [w for w in dict.fromkeys(chain(flat, matches)) if w not in self.words]
        apart = [w for w in new if w not in self.entries]
        entire = [w for w in new if w in self.entries]
        self.words.update(zip(apart + entire, range(len(self.words), len(self.words) + len(new))))
        self.word_ids.add(*self.encoder.encode([w.encode() for w in apart]))
        self.word_ids.add(np.array([self.entries[w] for w in entire], np.uint32), np.ones(len(entire), np.int64))
        self.units.update(zip(units, range(len(self.units), len(self.units) + len(units))))
        numbers = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.concatenate([[0], np.cumsum(self.word_ids.counts[numbers])])
        edges = np.concatenate([[0], np.cumsum(sizes)])
        self.unit_ids.add(self.word_ids.of(numbers), ends[edges[1:]] - ends[edges[:-1]])


def encode_batches(batches, ranks_path: str, pattern: str):
    """For each slice of the batches: (slice, ids of each row)."""
    table = Units(load_ranks(ranks_path), pattern)
    for block in by_bytes(batches, limit=BLOCK_BYTES):
        if len(table.units) > KEPT_UNITS:
            table.clear()
        texts = pc.fill_null(block.column("text"), "")
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        strings = coded.dictionary.to_pylist()
        index = coded.indices.to_numpy()
        edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        bare = pc.match_substring_regex(coded.dictionary, _OUTER).to_numpy(zero_copy_only=False)
        mixed = np.flatnonzero(np.add.reduceat(bare[index].astype(np.int64), edges[:-1]))
        found = {k: table.find(texts[k].as_py()) for k in mixed.tolist()}
        first = [strings[k] for k in index[edges[:-1]].tolist()]
        spaced = [" " + s for s in strings]
        table.learn(list(dict.fromkeys(chain(spaced, first))), list(chain.from_iterable(found.values())))
        at = np.fromiter(map(table.units.__getitem__, spaced), np.int32, len(spaced))[index]
        at[edges[:-1]] = [table.units[u] for u in first]
        low = 0
        for part in by_bytes([block], limit=SLICE_BYTES):
            ids = []
            for k in range(low, low + part.num_rows):
                if k in found:
                    ids.append(table.word_ids.of(np.array([table.words[m] for m in found[k]], np.int64)))
                else:
                    ids.append(table.unit_ids.of(at[edges[k]:edges[k + 1]]))
            low += part.num_rows
            yield part, ids


class Decoder:
    """Token ids -> bytes: each id's bytes, gathered in order. (The encoder decodes every
    distinct word by the ordered aggregation; this only lines up whole texts.)"""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        lengths = np.zeros(size, np.int64)
        for t, r in ranks.items():
            lengths[r] = len(t)
        starts = np.cumsum(lengths) - lengths
        data = np.zeros(int(lengths.sum()), np.uint8)
        for t, r in ranks.items():
            data[starts[r]:starts[r] + len(t)] = np.frombuffer(t, np.uint8)
        self.data, self.starts, self.lengths = data, starts, lengths

    def bytes_of(self, ids: np.ndarray) -> bytes:
        return self.data[spread(self.starts[ids], self.lengths[ids])].tobytes()


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    def run(batches):
        decoder = Decoder(load_ranks(ranks_path))
        for part, ids in encode_batches(batches, ranks_path, pattern):
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                 pa.array([hashlib.sha256(decoder.bytes_of(x)).hexdigest() for x in ids], pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
    kind = dict(docs.dtypes)[id_col]
    return with_text(docs, id_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """doc_id, token ids and decoded text of every row."""
    def run(batches):
        decoder = Decoder(load_ranks(ranks_path))
        for part, ids in encode_batches(batches, ranks_path, pattern):
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                 pa.array([decoder.bytes_of(x).decode() for x in ids], pa.string())], names=[id_col, "ids", "decoded"])
    kind = dict(docs.dtypes)[id_col]
    return with_text(docs, id_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string")
