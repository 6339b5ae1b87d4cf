"""Substring deduplication with prefix-partitioned suffix trees.

The suffixes of all texts are cut at ``DEPTH`` words and written over an
alphabet of ``SYMBOL``-word symbols (64-bit hashes over the words' BLAKE2b;
the second and later symbols of a path keep 32 bits, so two windows are
equal when 160 bits are; inside a slice, 256). Suffixes are dealt out by a prefix of
variable length: one symbol, and more for prefixes that a sample of the
documents shows to be heavy, so that every group fits in memory. A group
builds its subtree by sorting its suffixes; common prefixes of neighbours
give the internal nodes, and a node of full depth with several leaves is a
repeated window. Of its leaves the earliest (doc_id, start) stays.

Two exact filters keep the shuffles small:

* Only windows whose anchor repeats become suffixes. The anchor is the
  ``SYMBOL``-word gram of least hash in the window (its first, on ties):
  equal windows have equal anchors at equal places.
* Inside a slice of text, equal anchors are sent once, and of equal windows
  only the earliest is sent; the others are known to repeat. So a hot
  passage reaches its group once per slice, however many texts hold it.

Defined results: words are unchanged; null text has no word; texts of fewer
than ``DEPTH`` words keep all; rows are ordered by doc_id (null last), rows
with the same doc_id by their place in the scan; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewx.llm import textops as t
from ridewx.llm.common import cut, keyed, partitions, slices

DEPTH, SYMBOL = 20, 5
SYMBOLS = DEPTH // SYMBOL
REACH = DEPTH - SYMBOL + 1
#: Suffixes of one group, and the share of documents sampled for prefixes.
GROUP_ROWS, SAMPLE = 400_000, 64
#: Windows in one list of a group's answer.
PACKED = 1 << 16
#: Bytes of text inside which equal windows are sent once.
LOCAL_BYTES = 4 << 20
U = np.uint64
_NO_ID = (1 << 63) - 1


def anchors(col: pa.Array):
    """(windows' first word, their text, their anchor's word, symbol hash at
    every word, words before each text) of a slice."""
    (h,), bounds = t.word_ids(col)
    g = t.grams(h, SYMBOL)
    first, doc = t.gram_docs(bounds, DEPTH)
    if not len(first):
        e = np.empty(0, np.int64)
        return e, e, e, g, bounds
    value, place, width = g, np.arange(len(g)), 1
    while width < REACH:
        step = min(width, REACH - width)
        a, b = value[:len(value) - step], value[step:]
        right = b < a
        place = np.where(right, place[step:], place[:len(place) - step])
        value = np.where(right, b, a)
        width += step
    return first, doc, place[first], g, bounds


def _anchor_rows(batches):
    for batch in slices(batches, "text", LOCAL_BYTES):
        first, doc, place, g, bounds = anchors(batch.column(1))
        if not len(first):
            continue
        at = np.unique(place)
        text = np.searchsorted(bounds, at, side="right") - 1
        _, back, n = np.unique(g[at], return_inverse=True, return_counts=True)
        known = n[back] > 1
        leader = np.zeros(len(at), bool)
        leader[np.unique(back, return_index=True)[1]] = True
        key = np.where(leader, g[at], t.mix(t.mix(at.astype(U)) + g[at]))
        rows = batch.column(0).to_numpy()[text]
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(rows),
             pa.array((at - bounds[text]).astype(np.int32)), pa.array(known)],
            names=["a", "row", "pos", "known"])


def _repeated(batches):
    """Rows sorted by ``a``: those known to repeat or beside an equal ``a``."""
    def out(a, row, pos, known):
        same = np.zeros(len(a), bool)
        same[1:] = a[1:] == a[:-1]
        same[:-1] |= same[1:]
        keep = known | same
        return pa.RecordBatch.from_arrays([pa.array(row[keep]), pa.array(pos[keep])], names=["row", "pos"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        last = int(np.searchsorted(cols[0], cols[0][-1]))
        held = [x[last:] for x in cols]
        if last:
            yield out(*[x[:last] for x in cols])
    if held is not None:
        yield out(*held)


def _symbols(g: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.stack([g[first + SYMBOL * j] for j in range(SYMBOLS)])


def prefix_keys(s: np.ndarray, heavy: list[np.ndarray]) -> np.ndarray:
    """Hash of each suffix's variable-length prefix: extended by a symbol
    while it is heavy."""
    key = t.mix(s[0])
    for d in range(1, SYMBOLS):
        if d > len(heavy) or not len(heavy[d - 1]):
            break
        at = np.minimum(np.searchsorted(heavy[d - 1], key), len(heavy[d - 1]) - 1)
        key = np.where(heavy[d - 1][at] == key, t.mix(key + (s[d] >> U(32))), key)
    return key


def _prefix_rows(heavy: list[np.ndarray]):
    """Sampled prefixes, one symbol longer than the last heavy ones."""
    def run(batches):
        for batch in slices(batches):
            first, _, _, g, _ = anchors(batch.column(0))
            if not len(first):
                continue
            s = _symbols(g, first)
            key = prefix_keys(s, heavy)
            if heavy:
                key = key[key != prefix_keys(s, heavy[:-1])]
            u, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], names=["key", "n"])

    return run


def heavy_prefixes(texts: DataFrame, group_rows: int) -> list[np.ndarray]:
    """Prefixes of 1, 2, … symbols with about a quarter of ``group_rows``
    suffixes or more, estimated from one document in ``SAMPLE``. The sample
    only balances groups; results don't depend on it. There are at most
    4 * windows / group_rows of a length."""
    sample = texts.filter(F.pmod(F.xxhash64("row"), F.lit(SAMPLE)) == 0).select("text")
    heavy: list[np.ndarray] = []
    while len(heavy) < SYMBOLS - 1:
        found = (sample.mapInArrow(_prefix_rows(heavy), "key long, n long")
                 .groupBy("key").agg(F.sum("n").alias("n"))
                 .filter(F.col("n") >= max(2, group_rows // 4 // SAMPLE)).select("key").toPandas())
        if not len(found):
            break
        heavy.append(np.sort(found["key"].to_numpy(np.int64).view(U)))
    return heavy


_SUFFIX = "bin int, known boolean, s0 long, s12 long, s3pos long, row long, doc_id long"


def _suffix_rows(heavy: list[np.ndarray], bins: int):
    def run(batches):
        for batch in slices(batches, "text", LOCAL_BYTES):
            first, doc, place, g, bounds = anchors(batch.column(2))
            if not len(first):
                continue
            wanted = np.zeros(len(g) + 1, bool)
            lists = batch.column(3)
            flat = lists.flatten().to_numpy()
            counts = np.diff(lists.offsets.to_numpy())
            wanted[np.repeat(bounds[:-1], counts) + flat] = True
            chosen = wanted[place]
            first, doc = first[chosen], doc[chosen]
            if not len(first):
                continue
            s = _symbols(g, first)
            rows = batch.column(0).to_numpy()[doc]
            ids = batch.column(1).fill_null(_NO_ID).to_numpy()[doc]
            pos = first - bounds[doc]
            order = np.lexsort((pos, rows, ids, *s[::-1]))
            again = np.zeros(len(order), bool)
            again[1:] = (s[:, order[1:]] == s[:, order[:-1]]).all(axis=0)
            known = np.zeros(len(order), bool)
            known[order] = again
            # Known windows leave as runs: row, start, length.
            k = np.flatnonzero(known)
            if len(k):
                new = np.ones(len(k), bool)
                new[1:] = (np.diff(first[k]) != 1) | (doc[k][1:] != doc[k][:-1])
                start = k[new]
                length = np.diff(np.append(np.flatnonzero(new), len(k)))
                spread = (t.mix(rows[start].astype(U)) % U(bins)).astype(np.int32)
                zero = np.zeros(len(start), np.int64)
                yield _suffix_batch(spread, True, length, zero, pos[start], rows[start], zero)
            u = ~known
            key = prefix_keys(s, heavy)[u]
            packed = ((s[1][u] >> U(32)) << U(32)) | (s[2][u] >> U(32))
            tail = ((s[3][u] >> U(32)) << U(32)) | pos[u].astype(U)
            yield _suffix_batch((key % U(bins)).astype(np.int32), False, s[0][u].view(np.int64),
                                packed.view(np.int64), tail.view(np.int64), rows[u], ids[u])

    return run


def _suffix_batch(bins, known, s0, s12, s3pos, row, ids):
    return pa.RecordBatch.from_arrays(
        [pa.array(bins), pa.array(np.full(len(bins), known)),
         *[pa.array(np.asarray(x, np.int64)) for x in (s0, s12, s3pos, row, ids)]],
        names=["bin", "known", "s0", "s12", "s3pos", "row", "doc_id"])


def _subtree(table: pa.Table) -> pa.Table:
    """One group: the windows that aren't their node's earliest leaf, as
    lists of rows and of start << 32 | number of windows."""
    known, s0, s12, s3pos, row, ids = (table.column(c).to_numpy() for c in
                                       ("known", "s0", "s12", "s3pos", "row", "doc_id"))
    runs_row = row[known]
    runs = (s3pos[known] << 32) | s0[known]
    s0, s12, s3pos, row, ids = (x[~known] for x in (s0, s12, s3pos, row, ids))
    pos, s3 = s3pos & 0xFFFFFFFF, s3pos >> 32
    order = np.lexsort((pos, row, ids, s3, s12, s0))
    s0, s12, s3 = s0[order], s12[order], s3[order]
    # Symbols that neighbouring suffixes share: the depth of their node.
    lcp = np.zeros(len(order), np.int64)
    same = s0[1:] == s0[:-1]
    lcp[1:] += same
    for a, b in ((s12 >> 32, s12 & 0xFFFFFFFF), (s3, None)):
        for x in (a, b):
            if x is not None:
                same = same & (x[1:] == x[:-1])
                lcp[1:] += same
    later = order[lcp == SYMBOLS]
    out_row = np.concatenate([runs_row, row[later]])
    out = np.concatenate([runs, (pos[later] << 32) | 1])
    edges = np.append(np.arange(0, len(out), PACKED), len(out)).astype(np.int32)
    return pa.table({"rows": pa.ListArray.from_arrays(pa.array(edges), pa.array(out_row)),
                     "runs": pa.ListArray.from_arrays(pa.array(edges), pa.array(out))})


def _keep(batches):
    for batch in slices(batches, "text"):
        h, bounds, starts, ends, data = t.words(batch.column(2))
        cover = np.zeros(len(h) + DEPTH + 1, np.int64)
        lists = batch.column(3)
        counts = np.diff(lists.offsets.to_numpy())
        runs = lists.flatten().to_numpy()
        at = np.repeat(bounds[:-1], counts) + (runs >> 32)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + (runs & 0xFFFFFFFF) + DEPTH - 1, -1)
        gone = np.cumsum(cover)[:len(h)] > 0
        removed = np.concatenate([[0], np.cumsum(gone)])
        buf = data.copy()
        level = np.zeros(len(data) + 1, np.int8)
        level[starts[~gone]] += 1
        level[ends[~gone]] -= 1
        take = np.cumsum(level[:-1], dtype=np.int8) > 0
        # The byte after each kept word, set to a space, joins the words.
        _, offs = t.text_bytes(batch.column(2))
        last = np.zeros(len(data) + 1, bool)
        last[offs] = True
        gap = ends[~gone]
        gap = gap[~last[gap]]
        buf[gap] = 32
        take[gap] = True
        kept = [buf[a:b][take[a:b]].tobytes().removesuffix(b" ") for a, b in zip(offs[:-1], offs[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.diff(bounds)),
             pa.array((removed[bounds[1:]] - removed[bounds[:-1]]).astype(np.int64)),
             pa.array(kept, pa.binary()).cast(pa.string())],
            names=["row", "doc_id", "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """row, doc_id, n_words, n_removed, kept_text (kept words joined by one
    space) of every row: each word covered by a 20-word window that also
    starts earlier is removed."""
    texts = keyed(docs, "doc_id", "text")
    repeated = (texts.select("row", "text")
                .mapInArrow(_anchor_rows, "a long, row long, pos int, known boolean")
                .repartition(partitions(docs), "a").sortWithinPartitions("a")
                .mapInArrow(_repeated, "row long, pos int"))
    wanted = cut(repeated.groupBy("row").agg(F.collect_list("pos").alias("positions")), "anchors")
    expected = wanted.agg(F.sum(F.size("positions"))).first()[0] or 0
    # An anchor stands for REACH windows at most.
    bins = max(partitions(docs), -(-int(expected) * REACH // group_rows))
    heavy = heavy_prefixes(texts, group_rows)
    runs = (texts.join(wanted, "row").select("row", "doc_id", "text", "positions")
            .mapInArrow(_suffix_rows(heavy, bins), _SUFFIX)
            .groupBy("bin").applyInArrow(_subtree, "rows array<long>, runs array<long>")
            .select(F.inline(F.arrays_zip("rows", "runs")))
            .groupBy(F.col("rows").alias("row")).agg(F.collect_list("runs").alias("runs")))
    none = F.array().cast("array<long>")
    return (texts.join(runs, "row", "left")
            .select("row", "doc_id", "text", F.coalesce("runs", none).alias("runs"))
            .mapInArrow(_keep, "row long, doc_id long, n_words long, n_removed long, kept_text string"))
