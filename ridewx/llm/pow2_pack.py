"""Packing by power-of-two decomposition.

A document of n ids is cut into n // seq_len pieces of ``seq_len`` and one
piece for each set bit of the rest, longest first. Every piece has a
power-of-two length and is a sequence of its own in the bucket of its
length, so no sequence crosses documents and none needs padding; a batch
is drawn from one bucket.

Ids equal those of the tokenizers library. They are computed with tiktoken
from the same vocabulary as ranks, with a possessive spelling of the same
split pattern (about three times faster); texts that hold the special
string, and texts that tiktoken's regex refuses (white-space runs of more
than about a million characters), go whole through the tokenizers library
itself.

Defined results: null text is empty, a document then has only the end id;
repeated rows are packed each on its own; an empty table gives no piece.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewx.llm.common import keyed, slices

SEQ_LEN, END_ID = 2048, 1
#: Fixed values of the vocabulary: its split pattern and special string.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
SPECIAL = "<|endoftext|>"
_PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def encoder(ranks_path: str, json_path: str):
    """A function from text to its uint32 ids."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow: list = []

    def ids(text: str) -> np.ndarray:
        if SPECIAL not in text:
            try:
                return np.asarray(fast.encode_to_numpy(text), np.uint32)
            except ValueError:  # the regex ran out of its backtracking stack
                pass
        if not slow:
            slow.append(Tokenizer.from_file(json_path))
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)

    return ids


def lengths(n: int, seq_len: int = SEQ_LEN) -> list[int]:
    """Binary lengths of a document of ``n`` ids, longest first."""
    out = [seq_len] * (n // seq_len)
    rest = n % seq_len
    return out + [1 << b for b in range(seq_len.bit_length() - 1, -1, -1) if rest >> b & 1]


def _cut(ranks_path: str, json_path: str, seq_len: int, end_id: int):
    def run(batches):
        ids = encoder(ranks_path, json_path)
        for batch in slices(batches):
            cols: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = np.append(ids(text), np.uint32(end_id)).astype("<u4")
                raw, at = tokens.tobytes(), 0
                for n in lengths(len(tokens), seq_len):
                    for col, v in zip(cols, (doc_id, at, n, len(tokens), raw[4 * at:4 * (at + n)])):
                        col.append(v)
                    at += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [*[pa.int64()] * 4, pa.binary()])],
                names=["doc_id", "start", "length", "doc_tokens", "ids"])

    return run


def pack(docs: DataFrame, ranks_path: str | None = None, json_path: str | None = None,
         seq_len: int = SEQ_LEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece, which is one sequence: doc_id, start, length,
    doc_tokens, ids (little-endian uint32), bucket (= length), sequence_id,
    offset (always 0). Write it with ``partitionBy("bucket")`` to get one
    folder per length. ``seq_len`` must be a power of two.

    The work is one map over the scan: nothing is shuffled. Sequence ids
    are unique and repeat when the same files are read again."""
    if seq_len & (seq_len - 1) or seq_len < 1:
        raise ValueError("seq_len must be a power of two")
    if ranks_path is None or json_path is None:
        import public_tokenizers

        ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        json_path = json_path or public_tokenizers.path("byte_bpe_50k.json")
    pieces = (keyed(docs, "doc_id", "text").select("doc_id", "text")
              .mapInArrow(_cut(ranks_path, json_path, seq_len, end_id), _PIECES))
    return pieces.select("*", F.col("length").alias("bucket"),
                         F.monotonically_increasing_id().alias("sequence_id"),
                         F.lit(0).cast("long").alias("offset"))
