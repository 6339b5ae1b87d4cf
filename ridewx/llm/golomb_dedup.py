"""Exact deduplication by Golomb-coded fingerprint exchange.

1. One scan normalises every text and keeps its SHA-256 and a 64-bit hash.
   Senders cut the hashes to fingerprints of log2(rows) + ``EXTRA_BITS``
   bits, sort them and send each owner (a range of fingerprints) its part
   as Golomb-Rice coded gaps.
2. Each owner answers every message with a bitmap of the fingerprints that
   another message holds too. A fingerprint that occurs many times in one
   message is sent once, so a hot text costs one code per message.
3. Rows under a set bit, and rows that share a fingerprint inside a
   message, are suspects. Only their texts are grouped, byte for byte, with
   map-side combining, so a group of any size is one row per task.

Defined results: null text equals empty text; all rows with equal
normalised text are one group whatever their ids; the row with the
smallest doc_id stays (null ids last, ties by place in the scan); an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewx.llm.common import SPACE_RUN, cut, keyed, partitions, without_rows

EXTRA_BITS = 12
#: Rows of one message set, and fingerprints one owner holds (16 MB).
CHUNK_ROWS, OWNER_ROWS = 1 << 17, 1 << 21

_MESSAGE = ("chunk long, owner int, n int, low int, unary binary, rest binary, "
            "slots binary, rows binary")


def rice_encode(values: np.ndarray, low: int) -> tuple[bytes, bytes]:
    """Gaps of sorted distinct ``values``: quotients in unary, ``low``-bit
    remainders, as two bit strings."""
    gaps = np.diff(values, prepend=np.uint64(0))
    q = (gaps >> np.uint64(low)).astype(np.int64)
    ones = np.cumsum(q + 1) - 1
    unary = np.zeros(int(ones[-1]) + 1 if len(ones) else 0, np.uint8)
    unary[ones] = 1
    bits = (gaps[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(unary).tobytes(), np.packbits(bits.astype(np.uint8).ravel()).tobytes()


def rice_decode(n: int, low: int, unary: bytes, rest: bytes) -> np.ndarray:
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    q = (np.diff(ones, prepend=-1) - 1).astype(np.uint64)
    bits = np.unpackbits(np.frombuffer(rest, np.uint8))[:n * low].reshape(n, low)
    r = (bits.astype(np.uint64) << np.arange(low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum((q << np.uint64(low)) + r, dtype=np.uint64)


def _messages(width: int, owner_bits: int):
    def send(rows: list[np.ndarray], hashes: list[np.ndarray]):
        row, h = np.concatenate(rows), np.concatenate(hashes).view(np.uint64)
        fp = h >> np.uint64(64 - width)
        distinct, slot = np.unique(fp, return_inverse=True)
        order = np.argsort(slot, kind="stable")
        row_sorted, slot_sorted = row[order], slot[order]
        owner = (distinct >> np.uint64(width - owner_bits)).astype(np.int64)
        span = np.uint64(1) << np.uint64(width - owner_bits)
        edges = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
        out = []
        for a, b in zip(edges[:-1], edges[1:]):
            part = distinct[a:b] & (span - np.uint64(1))
            low = max(0, int(np.log2(max(1, int(span)) / (b - a))))
            unary, rest = rice_encode(part, low)
            x, y = np.searchsorted(slot_sorted, [a, b])
            out.append((int(row[0]), int(owner[a]), int(b - a), low, unary, rest,
                        (slot_sorted[x:y] - a).astype("<i4").tobytes(),
                        row_sorted[x:y].astype("<i8").tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (
                pa.int64(), pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4))],
            names=["chunk", "owner", "n", "low", "unary", "rest", "slots", "rows"])

    def run(batches):
        rows, hashes, n = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows.append(batch.column(0).to_numpy())
            hashes.append(batch.column(1).to_numpy())
            n += batch.num_rows
            if n >= CHUNK_ROWS:
                yield send(rows, hashes)
                rows, hashes, n = [], [], 0
        if n:
            yield send(rows, hashes)

    return run


def _answer(table: pa.Table) -> pa.Table:
    """One owner: a bitmap per message of fingerprints seen in others too."""
    cols = [table.column(c).to_pylist() for c in ("n", "low", "unary", "rest")]
    parts = [rice_decode(*m) for m in zip(*cols)]
    seen, back, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    repeated = count[back] > 1
    at = np.cumsum([0] + [len(p) for p in parts])
    maps = [np.packbits(repeated[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])]
    return pa.table({"chunk": table.column("chunk"), "owner": table.column("owner"),
                     "bitmap": pa.array(maps, pa.binary())})


def _suspects(batches):
    for batch in batches:
        for slots, rows, n, bitmap in zip(*(batch.column(i).to_pylist() for i in range(4))):
            slot = np.frombuffer(slots, "<i4")
            flags = np.unpackbits(np.frombuffer(bitmap, np.uint8))[:n].astype(bool)
            flags |= np.bincount(slot, minlength=n) > 1
            hit = np.frombuffer(rows, "<i8")[flags[slot]]
            if len(hit):
                yield pa.RecordBatch.from_arrays([pa.array(hit)], names=["row"])


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """row, doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    texts = keyed(docs, "doc_id", "text")
    normal = F.regexp_replace("text", SPACE_RUN, " ")
    digests = cut(texts.select("row", "doc_id", normal.alias("text"))
                  .select("row", "doc_id", F.xxhash64("text").alias("h"),
                          F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")),
                  "digests")
    total = max(1, digests.count())
    width = min(60, total.bit_length() + EXTRA_BITS)
    owners = max(partitions(docs), -(-total // OWNER_ROWS))
    owner_bits = min(width - 8, max(1, (owners - 1).bit_length()))
    messages = cut(digests.select("row", "h").mapInArrow(_messages(width, owner_bits), _MESSAGE),
                   "messages")
    answers = (messages.select("chunk", "owner", "n", "low", "unary", "rest")
               .groupBy("owner").applyInArrow(_answer, "chunk long, owner int, bitmap binary"))
    suspects = cut(messages.select("chunk", "owner", "slots", "rows", "n")
                   .join(answers, ["chunk", "owner"])
                   .select("slots", "rows", "n", "bitmap")
                   .mapInArrow(_suspects, "row long"), "suspects")
    # Bytes are compared by grouping the suspects' normalised texts.
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    groups = (texts.join(suspects, "row")
              .select(order.alias("o"), F.regexp_replace("text", SPACE_RUN, " ").alias("text"))
              .groupBy("text").agg(F.min("o").alias("first"), F.count(F.lit(1)).alias("size"))
              .filter("size > 1")
              .select(F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
                      F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"),
                      "size"))
    single = F.col("size").isNull()
    return (digests.join(groups, "text_sha256", "left")
            .select("row", "doc_id",
                    F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
                    (single | (F.col("row") == F.col("keep_row"))).alias("kept"),
                    "text_sha256"))


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    return without_rows(docs, exact_duplicates(docs).filter(~F.col("kept")))
