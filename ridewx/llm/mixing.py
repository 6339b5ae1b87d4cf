"""Mixing sources to target weights with a splitting tree of block quotas.

1. Sources weigh 5, 2, 1, repeating in code-point order (null last) and
   share all words; a source's target stops at ``MAX_REPEAT`` times its
   size and the excess is shared again by weight (water filling).
2. Every source's documents stand in an order drawn from a hash; the
   stream of their words is cut into blocks of ``BLOCK_WORDS``. A target of
   p sizes and a rest draws every block p times and the first blocks of the
   order once more, the last of them cut so that the target is met to the
   word.
3. A splitting tree deals the exact numbers of draws to output shards: each
   node gives its left half a multivariate hypergeometric sample of its
   quotas. The sample is drawn down a tree over the sources, pairs first
   split between halves of the sources; every node has a seed of its own. A
   source needs the sums on its path and beside it only, so sources are dealt
   apart, in parallel, and agree.
4. A permutation of each source's draws and the running sums of its quotas
   give every shard disjoint blocks. A document goes where the block of its
   first word goes, so shards hold whole documents; they are shuffled inside
   a shard by a seeded key. What the mix takes of a document is what the
   shards hold of it.

Of each source the last document drawn is cut after the word that meets the
target; all others are whole. Blocks hold ``BLOCK_WORDS`` words, twice as
many as often as needed to keep a table at ``MOST_BLOCKS``, within which
hypergeometric numbers are exact.

Defined results: null text has no words; a source is its exact string, and
null is a source of its own; repeated rows count and are drawn each on
their own (which of several identical rows is drawn is open, their number is
not); sources without words have target 0; an empty table gives an empty
result. Nothing that grows with rows or sources is on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewx.llm.common import SPACE_RUN, WORD, cut, free_name, keyed, own_columns, partitions

WEIGHTS, MAX_REPEAT, SEED = (5, 2, 1), 3, 17
BLOCK_WORDS, SHARD_WORDS = 8192, 4_000_000
MOST_BLOCKS = 1 << 29
#: Shards that one task deals a source's draws to.
DEALT = 4096
#: Documents whose words one window adds up.
BUCKET_DOCS = 10_000


def ordinals(sources: DataFrame) -> DataFrame:
    """Number the rows by source in code-point order, null last, from 0,
    without sorting in one task."""
    parts = max(1, min(partitions(sources), 200))
    placed = cut(sources.repartitionByRange(parts, F.col("source").asc_nulls_last())
                 .sortWithinPartitions(F.col("source").asc_nulls_last())
                 .withColumn("part", F.spark_partition_id())
                 .withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
                 "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    return (placed.join(offsets, "part")
            .withColumn("source_no", F.col("before") + F.col("at")).drop("part", "at", "n", "before"))


def targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """source, source_no, source_size, weight, target of every source.

    Each round of the water filling is one small aggregate; sources only
    ever join the capped set, so it ends."""
    sources = ordinals(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("source_no") % len(weights) + 1).cast("int"))
    sources = cut(sources.withColumn("weight", weight), "weights")
    cap = F.col("source_size") * float(max_repeat)
    level, capped_before = None, -1
    while True:
        capped = F.lit(False) if level is None else cap <= F.col("weight") * level
        r = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"),
                        F.coalesce(F.sum(F.when(capped, cap)), F.lit(0.0)).alias("filled"),
                        F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)).alias("open"),
                        F.count(F.when(capped, 1)).alias("capped")).first()
        if r["open"] <= 0 or r["capped"] == capped_before:
            break
        level, capped_before = (r["total"] - r["filled"]) / r["open"], r["capped"]
    share = F.col("weight") * (level or 0.0)
    return sources.withColumn("target", F.least(cap, share))


def hypergeometric(seed: list[int], good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good; exact, and the
    same for the same seed."""
    if not good or not n:
        return 0
    if not bad:
        return n
    return int(np.random.default_rng(seed).hypergeometric(good, bad, n))


def dealt(own: list[int], beside: list[int], source_no: int, shards: int, seed: int,
          first: int = 0, last: int | None = None) -> Iterator[tuple[int, int, int]]:
    """(shard, draws before it, draws) of one source, for the shards from
    ``first`` up to ``last``, those without draws left out.

    ``own[l]`` sums the quotas of the 2**l sources that share
    ``source_no >> l``, up to all sources; ``beside[l]`` those of the group
    beside it."""
    levels = len(own) - 1
    last = shards if last is None else last
    before, todo = 0, [(0, shards, own, beside)]
    while todo:
        lo, hi, own, beside = todo.pop()
        if not own[0] or lo >= last:
            continue
        if hi <= first:
            before += own[0]
            continue
        if hi - lo == 1:
            yield lo, before, own[0]
            before += own[0]
            continue
        mid = (lo + hi) // 2
        left, left_beside = [0] * (levels + 1), [0] * levels
        left[levels] = own[levels] * (mid - lo) // (hi - lo)
        for l in range(levels, 0, -1):
            even = (source_no >> (l - 1)) % 2 == 0
            good, bad = (own[l - 1], beside[l - 1]) if even else (beside[l - 1], own[l - 1])
            n = hypergeometric([seed, lo, hi, l, source_no >> l], good, bad, left[l])
            left[l - 1], left_beside[l - 1] = (n, left[l] - n) if even else (left[l] - n, n)
        todo.append((mid, hi, [a - b for a, b in zip(own, left)], [a - b for a, b in zip(beside, left_beside)]))
        todo.append((lo, mid, left, left_beside))


def tree_sums(quotas: list[int], source_no: int) -> tuple[list[int], list[int]]:
    """``own`` and ``beside`` of a source, from all quotas."""
    own, beside, level, at = [], [], [int(q) for q in quotas], source_no
    while True:
        own.append(level[at])
        if len(level) == 1:
            return own, beside
        level += [0] * (len(level) % 2)
        beside.append(level[at ^ 1])
        level, at = [a + b for a, b in zip(level[::2], level[1::2])], at >> 1


def shard_quotas(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """One leaf's quotas, and the quotas of all leaves before it."""
    here, before = np.zeros(len(quotas), np.int64), np.zeros(len(quotas), np.int64)
    for no in range(len(quotas)):
        own, beside = tree_sums(list(quotas), no)
        for at, earlier, n in dealt(own, beside, no, shards, seed, 0, shard + 1):
            before[no], here[no] = (earlier, n) if at == shard else (earlier + n, 0)
    return here, before


def with_tree_sums(plan: DataFrame) -> DataFrame:
    """source_no, own, beside of every source in ``plan`` (source_no from 0,
    quota); each source meets the sums on its path only."""
    most = plan.agg(F.max("source_no")).first()[0] or 0
    levels = int(most).bit_length()
    level = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")
    up = lambda c: F.expr(f"shiftright({c}, level)")
    sums = cut(plan.select("source_no", "quota", level).groupBy("level", up("source_no").alias("node"))
               .agg(F.sum("quota").alias("n")), "quota_sums")
    wanted = plan.select("source_no", level).select(
        "source_no", "level", F.explode(F.array(F.struct(F.lit(False).alias("other"), up("source_no").alias("node")),
                                                F.struct(F.lit(True).alias("other"),
                                                         up("source_no").bitwiseXOR(1).alias("node")))).alias("w"))
    found = (wanted.select("source_no", "level", "w.*").filter(~F.col("other") | (F.col("level") < levels))
             .join(sums, ["level", "node"], "left"))
    listed = lambda other: F.transform(F.sort_array(F.collect_list(F.when(
        F.col("other") == other, F.struct("level", F.coalesce("n", F.lit(0).cast("long")).alias("n"))))), lambda x: x["n"])
    return found.groupBy("source_no").agg(listed(False).alias("own"), listed(True).alias("beside"))


def word_sizes(docs: DataFrame) -> DataFrame:
    """row, doc_id, source, size (words), text_key (a hash of the text) of
    every row."""
    return cut(keyed(docs, "doc_id", "source", "text")
               .select("row", "doc_id", "source", F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"),
                       F.xxhash64("text").alias("text_key")), "sizes")


def _streams(placed: DataFrame, n: int, seed: int) -> DataFrame:
    """row, source_no, size, at: where each row's words begin in its source's
    stream.

    Rows alike in source, id, size and text stand side by side, so that the
    order of the others does not depend on row numbers. The order is drawn
    from a hash in two levels, buckets and their groups; rows of a group are
    numbered in two levels as well, so no task takes a whole source or group."""
    alike = ["source_no", "doc_id", "size", "text_key"]
    buckets = -(-n // BUCKET_DOCS)
    key = F.xxhash64(F.lit(seed), "doc_id", "text_key")
    groups = (placed.groupBy(*alike).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("some_row"))
              .withColumns({"key": key, "bucket": F.pmod(key, F.lit(buckets))}))
    earlier = Window.unboundedPreceding, -1
    words = F.col("size") * F.col("n")
    offsets = (groups.groupBy("source_no", "bucket").agg(F.sum(words).alias("words"))
               .withColumn("offset", F.coalesce(F.sum("words").over(
                   Window.partitionBy("source_no").orderBy("bucket").rowsBetween(*earlier)), F.lit(0))).drop("words"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("key", "doc_id", "text_key", "size").rowsBetween(*earlier)
    groups = cut(groups.withColumn("inside", F.coalesce(F.sum(words).over(inside), F.lit(0)))
                 .join(offsets, ["source_no", "bucket"])
                 .select(*alike, "n", "some_row", (F.col("inside") + F.col("offset")).alias("begin")), "groups")
    single = groups.filter("n = 1").select(F.col("some_row").alias("row"), "source_no", "size", F.col("begin").alias("at"))
    # Rows of larger groups: their place in a slice of the group, after the slices before it.
    same = [placed[c].eqNullSafe(F.col(f"g_{c}")) for c in alike]
    several = groups.filter("n > 1").select(*[F.col(c).alias(f"g_{c}") for c in alike], "begin")
    of = placed.join(several, same[0] & same[1] & same[2] & same[3]).select(
        "row", "source_no", "size", "begin", F.pmod(F.xxhash64("row"), F.lit(1024)).alias("slice"))
    group = ["source_no", "begin"]
    slices = (of.groupBy(*group, "slice").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(
                  Window.partitionBy(*group).orderBy("slice").rowsBetween(*earlier)), F.lit(0))).drop("n"))
    numbered = (of.withColumn("i", F.row_number().over(Window.partitionBy(*group, "slice").orderBy("row")) - 1)
                .join(slices, [*group, "slice"]))
    return single.unionByName(numbered.select(
        "row", "source_no", "size", (F.col("begin") + F.col("size") * (F.col("before") + F.col("i"))).alias("at")))


def mix_pieces(docs: DataFrame, weights=WEIGHTS, max_repeat: float = MAX_REPEAT, seed: int = SEED,
               block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(documents with their source's target, drawn pieces).

    A piece: row, copy (0, 1, …), first word of the document it takes (0),
    words, shard, shuffle_key.
    """
    spark = docs.sparkSession
    sizes = word_sizes(docs)
    per_source = cut(targets(sizes, weights, max_repeat), "targets")
    words = per_source.agg(F.sum("target")).first()[0] or 0
    while words > MOST_BLOCKS // 2 * block_words:
        block_words *= 2
    goals = per_source.select("source_no", "source_size", F.round("target").cast("long").alias("goal"))
    plan = cut(goals.filter("source_size > 0 AND goal > 0")
               .withColumn("passes", F.expr("goal div source_size"))
               .withColumn("rest", F.col("goal") % F.col("source_size"))
               .withColumn("blocks", F.ceil(F.col("source_size") / block_words))
               .withColumn("quota", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block_words)), "plan")
    named = sizes.join(per_source.select(F.col("source").alias("s"), "source_no", "source_size", "target"),
                       F.col("source").eqNullSafe(F.col("s"))).drop("s")
    placed = cut(named.filter("size > 0").select("row", "doc_id", "size", "source_no", "text_key"), "placed")
    streams = _streams(placed, max(1, placed.count()), seed)

    # Shards and the draws each of them takes of every source.
    draws = plan.agg(F.sum("quota")).first()[0] or 0
    shards = max(1, -(-int(draws) * block_words // shard_words))

    def leaves(batches) -> Iterator:
        import pandas as pd

        for pdf in batches:
            for no, own, beside, part in zip(pdf["source_no"], pdf["own"], pdf["beside"], pdf["part"]):
                ways = dealt([int(v) for v in own], [int(v) for v in beside], int(no), shards, seed,
                             int(part) * DEALT, min(shards, (int(part) + 1) * DEALT))
                yield pd.DataFrame([(no, *way) for way in ways], columns=["source_no", "shard", "first", "n"])

    parts = F.explode(F.sequence(F.lit(0), F.lit((shards - 1) // DEALT))).alias("part")
    owned = (with_tree_sums(plan).select("source_no", "own", "beside", parts)
             .mapInPandas(leaves, "source_no long, shard long, first long, n long")
             .select("source_no", "shard", F.explode(F.expr("sequence(first, first + n - 1)")).alias("place")))

    # Draw d of a source takes place (a * d + b) mod quota, a prime to it.
    stride = F.lit(2_147_483_647)
    place = F.when(F.col("quota") % stride == 0, F.col("draw")).otherwise(
        (F.col("draw").cast("decimal(38,0)") * stride + seed) % F.col("quota")).cast("long")
    drawn = (streams.join(plan, "source_no")
             .withColumn("copy", F.explode(F.expr("sequence(0L, passes)")))
             .withColumn("upto", F.when(F.col("copy") < F.col("passes"), F.col("source_size"))
                         .otherwise(F.col("rest")))
             .filter("at < upto")
             .withColumn("words", F.least(F.col("upto") - F.col("at"), F.col("size")))
             .withColumn("draw", F.col("copy") * F.col("blocks") + F.expr(f"at div {block_words}"))
             .withColumn("place", place))
    pieces = (drawn.join(owned, ["source_no", "place"])
              .select("row", "copy", F.lit(0).cast("long").alias("first"), "words", "shard",
                      F.xxhash64(F.lit(seed), "shard", "row", "copy").alias("shuffle_key")))
    return named, cut(pieces, "pieces")


def mix(docs: DataFrame, **options) -> DataFrame:
    """row, doc_id, size, source_size, target, taken, copies of every row:
    ``taken`` adds up the words that the shards hold of it, ``copies`` how
    often they hold it (the last time perhaps in part)."""
    named, pieces = mix_pieces(docs, **options)
    taken = pieces.groupBy("row").agg(F.sum("words").alias("taken"), F.count(F.lit(1)).alias("copies"))
    return named.join(taken, "row", "left").select(
        "row", "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("copies", F.lit(0)).cast("int").alias("copies"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word, white space as it is."""
    ends = f"(?<={WORD[:-1]})(?={SPACE_RUN[:-1]})"
    return F.array_join(F.slice(F.split(text, ends), F.lit(1), n.cast("int")), "")


def _drawn(docs: DataFrame, options: dict) -> tuple[DataFrame, str, str]:
    """The drawn rows with the columns of ``docs``, their shard and key."""
    names = {c: free_name(docs, f"_{c}") for c in ("row", "size", "words", "shard", "shuffle_key")}
    named, pieces = mix_pieces(docs, **options)
    each = pieces.join(named.select("row", "size"), "row").select(
        *[F.col(c).alias(name) for c, name in names.items()])
    part = F.when(F.col(names["words"]) < F.col(names["size"]), first_words(docs["text"], F.col(names["words"])))
    text = F.coalesce(part, docs["text"])
    rows = docs.withColumn(names["row"], F.monotonically_increasing_id()).join(each, names["row"])
    columns = [text.alias(c) if c == "text" else own for c, own in zip(docs.columns, own_columns(docs))]
    return rows.select(*columns, names["shard"], names["shuffle_key"]), names["shard"], names["shuffle_key"]


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix with the columns of ``docs``, each as often as it
    is drawn; the document that meets its source's target is cut there. A
    source's words add up to its target, rounded to whole words."""
    rows, *_ = _drawn(docs, options)
    return rows.select(*own_columns(docs))


def write_mix(docs: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Write the mix by output shard, one folder ``shard=<n>`` each, its
    documents in the order of the shuffle inside the shard."""
    if "shard" in {c.lower() for c in docs.columns}:
        raise ValueError("the documents have a column named shard")
    rows, shard, key = _drawn(docs, options)
    (rows.repartition(shard).sortWithinPartitions(shard, key).withColumnRenamed(shard, "shard").drop(key)
     .write.partitionBy("shard").format(fmt).save(path))
