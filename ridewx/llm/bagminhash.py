"""Near-duplicate detection with BagMinHash over counted word shingles.

A text is a bag of 5-word shingles weighted by their counts. Weights are
discretised in units: cell [i, i+1) of a shingle's weight line is in a bag
iff its count exceeds i. Poisson processes of rate 1 per cell run over a
hierarchy of intervals [0,1), [1,2), [2,4), [4,8), …; a point carries a
time, a position (which cell) and one of ``SIZE`` components, all drawn from
the shingle's hash. A bag sees the points whose cell it has; component k of
its signature is the earliest time seen there. Two signatures agree in a
component with probability equal to the weighted Jaccard similarity. A
process stops as soon as its time passes the largest component.

Signatures are cut into ``BANDS`` bands of ``ROWS`` components; texts that
share a band are candidates (a pair at 0.8 is missed with probability
7e-5). Candidates are checked by exact multiset overlap of their texts:

* equal word sequences are first reduced to one representative (equal in
  two independent 64-bit hashes of all words and their places, from 64 bits
  of the words' BLAKE2b each; the bytes are not compared again);
* in every band bucket each member is checked against the member with the
  smallest id (a star, not all pairs), and components are found;
* buckets that still hold several components are cut into blocks; inside a
  block, then between its blocks, texts of different components are
  compared exactly over an inverted index of their shingles. Texts of the
  largest component are not compared with each other and don't leave their
  block, and only links that join two components are returned.

Hence no link between different texts is lost by the stars, and no bucket
emits all its pairs. Classes are the connected components of the links.

Defined results: words are unchanged; a text of one to four words is one
shingle; texts without a word (null, empty) are classes of their own;
repeated rows are one class; the class is named by its smallest doc_id
(null ids last, ties by place in the scan); an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewx.llm import textops as t
from ridewx.llm.common import cut, keyed, slices, without_rows

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 5
SIZE = BANDS * ROWS
#: Texts, and words, of one block of a bucket.
BLOCK, BLOCK_WORDS = 1024, 1 << 20
U = np.uint64


def signatures(doc: np.ndarray, shingle: np.ndarray, n: int) -> np.ndarray:
    """BagMinHash times (n × SIZE, inf for empty bags)."""
    best = np.full(n * SIZE, np.inf)
    if not len(doc):
        return best.reshape(n, SIZE)
    order = np.lexsort((shingle, doc))
    d, s = doc[order], shingle[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
    at = np.flatnonzero(new)
    d, s, weight = d[at], s[at], np.diff(np.append(at, len(new)))
    # Intervals of the hierarchy that the weight reaches into.
    levels = np.where(weight > 1, np.ceil(np.log2(weight)).astype(np.int64), 0) + 1
    rep = np.repeat(np.arange(len(d)), levels)
    level = np.arange(len(rep)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    width = np.maximum(low, 1)
    d, weight = d[rep], weight[rep]
    seed = t.mix(s[rep] + level.astype(U) * U(0x9E3779B97F4A7C15))
    time = np.zeros(len(d))
    limit = np.full(n, np.inf)
    while len(d):
        seed = seed + U(0xD1B54A32D192ED03)
        r = t.mix(seed)
        time = time - np.log((r >> U(11)).astype(np.float64) * 2.0 ** -53 + 2.0 ** -54) / width
        r = t.mix(r)
        component = ((r >> U(32)) * U(SIZE) >> U(32)).astype(np.int64)
        cell = low + (((r & U(0xFFFFFFFF)) * width.astype(U)) >> U(32)).astype(np.int64)
        seen = cell < weight
        np.minimum.at(best, d[seen] * SIZE + component[seen], time[seen])
        # Bags with running processes (``d`` is sorted); the rest are done.
        running = d[np.append(True, d[1:] != d[:-1])]
        limit[running] = best.reshape(n, SIZE)[running].max(axis=1)
        going = time < limit[d]
        d, weight, low, width, seed, time = (x[going] for x in (d, weight, low, width, seed, time))
    return best.reshape(n, SIZE)


_SIGNED = "row long, doc_id long, h1 long, h2 long, bands array<long>, words int"


def _sign(batches):
    for batch in slices(batches):
        col = batch.column(2)
        n = batch.num_rows
        sig = t.mix(signatures(*t.shingles(col, SHINGLE), n).view(U))
        hashes, bounds = t.word_ids(col, 2)
        inner = (np.arange(bounds[-1]) - np.repeat(bounds[:-1], np.diff(bounds))).astype(U)
        total = np.zeros((2, len(inner) + 1), U)
        for total_of, h in zip(total, hashes):
            # Each word is mixed with its place, so that no pattern of words cancels out.
            total_of[1:] = np.cumsum(t.mix(h ^ t.mix(inner + U(1))))
        ident = t.mix(total[:, bounds[1:]] - total[:, bounds[:-1]])
        band = np.zeros((n, BANDS), U)
        parts = sig.reshape(n, BANDS, ROWS)
        for j in range(ROWS):
            band = band * U(0x9E3779B97F4A7C15) + parts[:, :, j]
        band = t.mix(band + np.arange(BANDS, dtype=U))
        filled = np.diff(bounds) > 0
        # Texts without a word have no bands and an identity of their own.
        ident[0][~filled] = batch.column(0).to_numpy()[~filled].astype(U)
        ident[1][~filled] = 1
        offsets = np.concatenate([[0], np.cumsum(np.where(filled, BANDS, 0))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(ident[0].view(np.int64)),
             pa.array(ident[1].view(np.int64)),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(band[filled].ravel().view(np.int64))),
             pa.array(np.diff(bounds).astype(np.int32))],
            names=["row", "doc_id", "h1", "h2", "bands", "words"])


def overlap(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Exact weighted Jaccard of the shingle bags of a[i] and b[i]."""
    (da, sa), (db, sb) = t.shingles(a, SHINGLE), t.shingles(b, SHINGLE)
    n = len(a)
    d, s = np.concatenate([da, db]), np.concatenate([sa, sb])
    side = np.concatenate([np.ones(len(da), np.int64), np.zeros(len(db), np.int64)])
    if not len(d):
        return np.zeros(n)
    order = np.lexsort((s, d))
    d, s, side = d[order], s[order], side[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
    at = np.flatnonzero(new)
    in_a = np.add.reduceat(side, at)
    in_b = np.diff(np.append(at, len(d))) - in_a
    both = np.bincount(d[at], np.minimum(in_a, in_b), n)
    either = np.bincount(d[at], np.maximum(in_a, in_b), n)
    return both / np.maximum(either, 1)


def _verify(threshold: float):
    def run(batches):
        for whole in batches:
            for batch in slices([whole], "a_text"):
                for piece in slices([batch], "b_text"):
                    ok = overlap(piece.column(2), piece.column(3)) >= threshold
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(0).filter(pa.array(ok)), piece.column(1).filter(pa.array(ok))],
                        names=["a", "b"])
    return run


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts' exact similarity reaches the threshold."""
    left = texts.select(F.col("row").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("row").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "a_text", "b_text")
    return both.mapInArrow(_verify(threshold), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(v, c): the smallest vertex connected to each vertex of the links.

    Each round takes the smallest label among the neighbours, then jumps to
    that label's own label, so long chains shorten by half a round."""
    edges = cut(links.select(F.col("a").alias("v"), F.col("b").alias("w"))
                .unionByName(links.select(F.col("b").alias("v"), F.col("a").alias("w"))).distinct(), "edges")
    labels = cut(edges.groupBy("v").agg(F.least(F.min("w"), F.col("v")).alias("c")), "labels")
    while True:
        near = (edges.join(labels.select(F.col("v").alias("w"), "c"), "w")
                .groupBy("v").agg(F.min("c").alias("m")))
        step = labels.join(near, "v").select("v", "c", F.least("c", "m").alias("m"))
        jump = labels.select(F.col("v").alias("m"), F.col("c").alias("far"))
        new = cut(step.join(jump, "m").select("v", F.least("m", "far").alias("c"),
                                               (F.least("m", "far") < F.col("c")).alias("moved")), "labels")
        if not new.filter("moved").head(1):
            return new.select("v", "c")
        labels = new.select("v", "c")


def linked(comp: np.ndarray, side: np.ndarray, doc: np.ndarray, shingle: np.ndarray,
           threshold: float) -> list[tuple[int, int]]:
    """Links between texts of different components that join all components
    linked in this block: a spanning set, found over an inverted index.
    Texts of side 0 are compared with side 1 only; side 2 with all."""
    n = len(comp)
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    # The i-th copy of a shingle in a text is an element of its own, so the
    # overlap of sets is the overlap of bags.
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    copy = np.arange(len(doc)) - np.repeat(at, np.diff(np.append(at, len(doc))))
    _, element = np.unique(t.mix(shingle + copy.astype(U)), return_inverse=True)
    size = np.bincount(doc, minlength=n)
    by_element = np.argsort(element, kind="stable")
    holders = doc[by_element]
    count = np.bincount(element)
    first = np.cumsum(count) - count
    own = np.concatenate([[0], np.cumsum(size)])
    _, root = np.unique(comp, return_inverse=True)
    out, waiting = [], np.ones(n, bool)
    while True:
        # Of two components one is not the largest: only texts outside it
        # need comparing, each once.
        members = np.bincount(root)
        todo = np.flatnonzero(waiting & (root != members.argmax()))
        if not len(todo):
            return out
        i = todo[members[root[todo]].argmin()]
        waiting[i] = False
        e = element[own[i]:own[i + 1]]
        length = count[e]
        places = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(first[e], length)
        common = np.bincount(holders[places], minlength=n)
        near = (common >= threshold * (size + size[i] - common)) & (root != root[i])
        near &= (side == 2) | (side[i] == 2) | (side != side[i])
        for j in np.flatnonzero(near):
            if root[j] != root[i]:
                out.append((int(i), int(j)))
                root[root == root[j]] = root[i]


def _between(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        v = table.column("v").to_numpy()
        doc, shingle = t.shingles(table.column("text").combine_chunks(), SHINGLE)
        found = np.array(linked(table.column("c").to_numpy(), table.column("side").to_numpy(),
                                doc, shingle, threshold), np.int64).reshape(-1, 2)
        a, b = v[found[:, 0]], v[found[:, 1]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def between_components(members: DataFrame, labels: DataFrame, sized: DataFrame, texts: DataFrame,
                       threshold: float, across: bool) -> DataFrame:
    """Links inside the blocks of buckets that hold several components, or
    (``across``) between the blocks. Of two texts of different components one
    is outside the bucket's largest: only such texts visit the other blocks,
    so a large group of near copies costs its strangers a visit per block
    and its own members none."""
    marked = members.join(sized, "v").join(labels, "v", "left").withColumn("c", F.coalesce("c", "v"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("words") / BLOCK_WORDS))
    mixed = (marked.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"),
                                       F.count(F.lit(1)).alias("n"), F.sum("words").alias("words"))
             # In a bucket of two the star has been the only pair.
             .filter("lo < hi and n > 2").select("key", blocks.alias("blocks")))
    if across:
        mixed = mixed.filter("blocks > 1")
        largest = (marked.join(mixed.select("key"), "key", "left_semi").groupBy("key", "c")
                   .agg(F.count(F.lit(1)).alias("m")).groupBy("key")
                   .agg(F.max(F.struct("m", "c"))["c"].alias("largest")))
        mixed = mixed.join(largest, "key")
    rows = marked.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")))
    if across:
        own = F.array("block")
        visits = F.when(F.col("c") == F.col("largest"), own).otherwise(F.expr("sequence(0L, blocks - 1)"))
        rows = (rows.withColumn("at", F.explode(visits))
                .withColumn("side", F.when(F.col("at") == F.col("block"), 0).otherwise(1)))
    else:
        rows = rows.withColumns({"at": F.col("block"), "side": F.lit(2)})
    return (rows.select("key", "at", "side", "v", "c").join(texts.withColumnRenamed("row", "v"), "v")
            .groupBy("key", "at").applyInArrow(_between(threshold), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """row, doc_id, class_id, class_size, kept of every row."""
    texts = keyed(docs, "doc_id", "text")
    signed = cut(texts.mapInArrow(_sign, _SIGNED), "signatures")
    return _classes(texts, signed, threshold)


def _classes(texts: DataFrame, signed: DataFrame, threshold: float) -> DataFrame:
    ranked = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    reps = cut(signed.groupBy("h1", "h2").agg(F.min("row").alias("v"), F.min(ranked).alias("first"),
                                              F.count(F.lit(1)).alias("n"),
                                              F.min_by("bands", "row").alias("bands"),
                                              F.max("words").alias("words")), "representatives")
    members = reps.select("v", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min("v").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = cut(members.join(buckets.select("key", "a"), "key"), "buckets")
    pairs = (members.filter("v <> a").select("a", F.col("v").alias("b")).distinct())
    texts = texts.select("row", "text")
    links = cut(verify(pairs, texts, threshold), "links")
    labels = components(links)
    for across in (False, True):
        more = cut(between_components(members.select("v", "key"), labels, reps.select("v", "words"),
                                      texts, threshold, across), "between")
        if more.head(1):
            links = cut(links.unionByName(more), "links")
            labels = components(links)
    classes = cut(reps.select("h1", "h2", "v", "first", "n").join(labels, "v", "left")
                  .withColumn("c", F.coalesce("c", "v")), "classes")
    best = classes.groupBy("c").agg(F.min("first").alias("best"), F.sum("n").alias("class_size"))
    named = (classes.join(best, "c").select("h1", "h2", "best", "class_size"))
    return (signed.select("row", "doc_id", "h1", "h2").join(named, ["h1", "h2"])
            .select("row", "doc_id", F.col("best.doc_id").alias("class_id"), "class_size",
                    (F.col("row") == F.col("best.row")).alias("kept")))


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, with the columns of ``docs``."""
    return without_rows(docs, near_duplicates(docs, threshold).filter(~F.col("kept")))
