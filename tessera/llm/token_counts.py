"""Operator 4: token counts.

Arrow functions encode batches and return lengths only. A text is split at ASCII
white space, which no token of the tokenizer crosses (its pre-tokenizer drops white
space, NFC and lower-casing never reach over it), so a long text needs no more
memory than its distinct words; distinct words are encoded in batches of about the
same number of bytes and kept, up to a bound, for the next batches of the task.

Cases: a null or empty text has 0 bytes and 0 tokens; repeated rows are counted row
by row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import with_text
from .text import by_bytes

BATCH_BYTES = 1 << 20
KEPT_WORDS = 400_000


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row."""
    def count(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(tokenizer_path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        known: dict[str, int] = {}

        def learn(new: list[str]) -> None:
            new.sort(key=len)
            low, size = 0, 0
            for k, w in enumerate(new):
                size += len(w)
                if size >= BATCH_BYTES or k == len(new) - 1:
                    part = new[low:k + 1]
                    known.update(zip(part, (len(e) for e in tokenizer.encode_batch_fast(part, add_special_tokens=False))))
                    low, size = k + 1, 0

        for batch in by_bytes(batches, limit=4 * BATCH_BYTES):
            text = pc.fill_null(batch.column("text"), "")
            parts = pc.ascii_split_whitespace(text)
            coded = parts.flatten().dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            if len(known) > KEPT_WORDS:
                known.clear()
            new = [w for w in distinct if w not in known]
            if new:
                learn(new)
            lengths = np.fromiter((known[w] for w in distinct), np.int64, len(distinct))
            total = np.zeros(len(coded) + 1, np.int64)
            if len(distinct):
                np.cumsum(lengths[coded.indices.to_numpy()], out=total[1:])
            edges = parts.offsets.to_numpy()
            edges = edges - edges[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pc.cast(pc.binary_length(text), pa.int64()), pa.array(total[edges[1:]] - total[edges[:-1]])],
                names=[id_col, "n_bytes", "n_tokens"])

    kind = dict(docs.dtypes)[id_col]
    counted = with_text(docs, id_col).mapInArrow(count, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
