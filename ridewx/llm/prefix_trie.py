"""Conversation prefix trie with totals of subtrees, by depth-band rollup.

A node is a distinct sequence of first turns. Its key follows from its
turns: every turn gives five 32-bit numbers (from the SHA-256 of its depth,
role and text), a prefix the five sums over its turns, and a key of 128
bits is hashed from depth and sums. Sums run in parallel over a long
conversation, so no task needs a whole one.

Totals over subtrees: depths are cut into bands of ``BAND``. Inside its
band a node goes to its ancestors (at most ``BAND``), all bands at once.
The band's roots, at depths 0, BAND, 2 * BAND, ..., form a trie of their
own, ``BAND`` times shallower, whose totals are found in the same way; a
completed band root then goes to its ancestors in the band above. There are
2 * log_BAND(depth) rounds, and no node is exploded to more than ``BAND``
ancestors in any.

Defined results: rows with a null conv_id belong to no conversation and are
left out. Turns are ordered by turn (null first), equal ones by the SHA-256
of role and text. Null role or text is empty. Repeated rows are turns of
their own. conv_id % 20 has the sign of conv_id. An empty table has no
nodes. Texts enter as digest and word count only, so their length does not
matter. ``ends_sha256`` reads a node's conv_ids as a sorted stream of text
pieces, in bounded memory.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewx.llm.common import cut, partitions
from ridewx.llm.line_rules import word_count

GROUP, HEADS = 20, 4
BAND = 16
#: conv_ids in a piece of text for the digest.
PIECE = 256
LANES = 5
KEY = ["k1", "k2"]


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _place(batches):
    """``at``: the place of each row in its conversation, within this task."""
    last, seen = None, 0
    for batch in batches:
        conv = batch.column("conv_id").to_numpy()
        n = len(conv)
        if not n:
            continue
        new = np.ones(n, bool)
        new[1:] = conv[1:] != conv[:-1]
        starts = np.flatnonzero(new)
        at = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n))) + 1
        if conv[0] == last:
            to = starts[1] if len(starts) > 1 else n
            at[:to] += seen
        last, seen = conv[-1], int(at[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=[*batch.schema.names, "at"])


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, at (from 1), digest, words of every turn. Rows are sorted by
    ranges, so a conversation may lie in several tasks; each task numbers its
    own rows and is told how many came before."""
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
                       .cast("binary"), 256)).alias("digest"),
        word_count(text).cast("long").alias("words"))
    order = ["conv_id", F.asc_nulls_first("turn"), "digest"]
    ranged = (rows.repartitionByRange(partitions(rows), *order).sortWithinPartitions(*order)
              .select("conv_id", "digest", "words", F.spark_partition_id().alias("task")))
    placed = cut(ranged.mapInArrow(_place, "conv_id long, digest binary, words long, task int, at long"), "turns")
    # Each task continues one conversation at most: no more rows than tasks.
    earlier = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = (placed.groupBy("conv_id", "task").agg(F.max("at").alias("n"))
              .withColumn("before", F.sum("n").over(earlier)).filter("before > 0").select("conv_id", "task", "before"))
    return (placed.join(F.broadcast(before), ["conv_id", "task"], "left")
            .select("conv_id", (F.col("at") + F.coalesce("before", _long(0))).alias("at"), "digest", "words"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths): conv_id, depth, digest, words of every turn of the
    rebuilt conversations; conv_id and number of turns of each."""
    turns = cut(numbered(conversations), "numbered")
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    # At most three turns of each group's first conversation.
    heads = (turns.filter((F.col("conv_id") % GROUP == 0) & (F.col("at") < HEADS)).groupBy(F.col("conv_id").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("at", "digest", "words"))).alias("heads")))
    convs = (turns.groupBy("conv_id").agg(F.max("at").alias("own")).withColumn("base", base)
             .join(heads, "base", "left")
             .select("conv_id", "own", h.alias("h"),
                     F.coalesce(F.slice("heads", 1, h.cast("int")), F.array().cast(heads.schema["heads"].dataType)).alias("heads"))
             .withColumn("taken", F.size("heads").cast("long")))
    convs = cut(convs, "conversations")
    short = convs.filter("taken < h").select("conv_id", (F.col("h") - F.col("taken")).alias("missing"))
    own = (turns.filter(F.col("at") > h).join(short, "conv_id", "left")
           .select("conv_id", (F.col("at") - F.coalesce("missing", _long(0))).alias("depth"), "digest", "words"))
    first = convs.select("conv_id", F.inline("heads")).select("conv_id", F.col("at").alias("depth"), "digest", "words")
    lengths = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), _long(0))).alias("turns"))
    return own.unionByName(first), lengths


def _key(depth: Column, sums: list[Column]) -> list[Column]:
    return [F.xxhash64(F.lit(lane), depth, *sums).alias(name) for lane, name in enumerate(KEY)]


def paths(turns: DataFrame, band: int = BAND) -> DataFrame:
    """conv_id, depth, band, k1, k2, p1, p2, words: the node each rebuilt
    conversation passes at each depth, and that node's parent."""
    digest = F.sha2(F.concat(F.col("depth").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("digest")), 256)
    lane = [F.conv(F.substring("d", 8 * i + 1, 8), 16, 10).cast("long").alias(f"x{i}") for i in range(LANES)]
    rows = turns.withColumn("d", digest).select(
        "conv_id", "depth", "words", F.floor(F.col("depth") / band).cast("long").alias("band"), *lane)
    x = [f"x{i}" for i in range(LANES)]
    # Sums before a band, for conversations that reach beyond the first one.
    earlier = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    long_ones = rows.groupBy("conv_id", "band").agg(*[F.sum(c).alias(c) for c in x])
    before = (long_ones.select("conv_id", "band", *[F.sum(c).over(earlier).alias(f"b{c}") for c in x])
              .filter("band > 0").filter(F.col("bx0").isNotNull()))
    inside = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = (rows.select("*", *[F.sum(c).over(inside).alias(f"s{c}") for c in x])
            .join(before, ["conv_id", "band"], "left"))
    total = [F.col(f"s{c}") + F.coalesce(f"b{c}", _long(0)) for c in x]
    parent = [t - F.col(c) for t, c in zip(total, x)]
    p = [k.alias("p" + n[1]) for k, n in zip(_key(F.col("depth") - 1, parent), KEY)]
    return rows.select("conv_id", "depth", "band", *_key(F.col("depth"), total), *p, "words")


def root_key(spark) -> tuple[int, int]:
    """The key of the empty prefix."""
    return tuple(spark.range(1).select(*_key(_long(0), [_long(0)] * LANES)).first())


def _ancestors(items: DataFrame, ways: DataFrame, step: int, band: int, root: tuple[int, int],
               shift: int = 0) -> DataFrame:
    """(k1, k2, leaves, saved) of ``items`` (conv_id, depth, leaves, saved)
    sent to each of their ancestors at multiples of ``step`` inside a band
    of ``band`` steps: their own, or (``shift`` 1) the one above it. The
    ways of their conversations hold the keys."""
    height = step * band
    of = lambda depth: F.floor(depth / height).cast("long")
    keys = (ways.filter(F.col("depth") % step == 0)
            .groupBy("conv_id", of(F.col("depth")).alias("part"))
            .agg(F.collect_list(F.struct("depth", *KEY)).alias("way")))
    start = F.struct(_long(0).alias("depth"), *[_long(v).alias(k) for v, k in zip(root, KEY)])
    items = items.withColumn("part", of(F.col("depth")) - shift)
    reached = items.join(keys, ["conv_id", "part"], "left")
    way = F.coalesce("way", F.array().cast("array<struct<depth:bigint,k1:bigint,k2:bigint>>"))
    way = F.when(F.col("part") == 0, F.array_append(way, start)).otherwise(way)
    return reached.select(
        F.explode(F.filter(way, lambda w: w["depth"] <= F.col("depth"))).alias("w"), "leaves", "saved"
    ).select("w.k1", "w.k2", "leaves", "saved")


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def rollup(nodes: DataFrame, ways: DataFrame, deepest: int, root: tuple[int, int], band: int = BAND) -> DataFrame:
    """k1, k2, leaves, saved: the sums of ``nodes``' leaves and saved over
    each node's subtree."""
    place = nodes.select(*KEY, "conv_id", "depth")
    items, levels, step = nodes.select("conv_id", "depth", "leaves", "saved"), [], 1
    while True:
        # Totals inside bands of ``step * band`` depths, at multiples of ``step``.
        totals = cut(_added(_ancestors(items, ways, step, band, root)), f"within_{step}")
        levels.append(totals)
        step *= band
        if step > deepest:
            break
        # The band's roots carry on, each with its band's total.
        items = (totals.join(place.filter(F.col("depth") % step == 0), KEY)
                 .select("conv_id", "depth", "leaves", "saved"))
    done = levels.pop()
    while levels:
        step //= band
        # ``done`` is complete at multiples of ``step``; each goes to the band above.
        below = (done.join(place.filter((F.col("depth") % step == 0) & (F.col("depth") > 0)), KEY)
                 .select("conv_id", "depth", "leaves", "saved"))
        above = _ancestors(below, ways, step // band, band, root, shift=1)
        done = cut(_added(levels.pop().select(*KEY, "leaves", "saved").unionByName(above)), f"complete_{step}")
    return done


def _pieces(batches):
    """Sorted (k1, k2, conv_id) as pieces of comma-joined ids."""
    for batch in batches:
        k1, k2, conv = (batch.column(c).to_numpy() for c in (*KEY, "conv_id"))
        if not len(conv):
            continue
        new = np.ones(len(conv), bool)
        new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(conv))
        cuts = np.concatenate([np.arange(s, e, PIECE) for s, e in zip(starts, ends)])
        to = np.append(cuts[1:], len(conv))
        text = batch.column("conv_id").cast(pa.string()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(k1[cuts]), pa.array(k2[cuts]), pa.array(conv[cuts]),
             pa.array([",".join(text[a:b]) for a, b in zip(cuts, to)], pa.string())],
            names=[*KEY, "conv_id", "ids"])


def _digests(batches):
    """Sorted pieces of each key to the SHA-256 of all its ids."""
    key, state = None, None
    for batch in batches:
        out = []
        for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
            if (k1, k2) == key:
                state.update(b",")
            else:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256()
            state.update(ids.encode())
        yield _batch(out)
    if key is not None:
        yield _batch([(*key, state.hexdigest())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                       pa.array([r[2] for r in rows], pa.string())], names=[*KEY, "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256 of ``ends`` (k1, k2, conv_id). Ids are sorted and
    joined by ranges in parallel; a node's pieces then pass one task as a
    stream, as SHA-256 has to read them in order."""
    order = [*KEY, "conv_id"]
    pieces = (ends.repartitionByRange(partitions(ends), *order).sortWithinPartitions(*order)
              .mapInArrow(_pieces, "k1 long, k2 long, conv_id long, ids string"))
    return (pieces.repartition(partitions(ends), *KEY).sortWithinPartitions(*order)
            .select(*KEY, "ids").mapInArrow(_digests, "k1 long, k2 long, ends_sha256 string"))


def trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 of every node."""
    spark = conversations.sparkSession
    turns, lengths = rebuilt(conversations)
    ways = cut(paths(turns, band), "paths")
    root = root_key(spark)
    start = [_long(v).alias(k) for v, k in zip(root, KEY)]
    top = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")).first()
    deepest = ways.agg(F.max("depth")).first()[0] or 0

    found = ways.groupBy("depth", *KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max("words").alias("words"))
    # The root, if there is any conversation.
    found = found.unionByName(spark.range(1 if top["n"] else 0).select(
        _long(0).alias("depth"), *start, F.lit(top["conv_id"]).cast("long").alias("conv_id"),
        _long(top["n"]).alias("n_convs"), F.lit(None).cast("long").alias("p1"),
        F.lit(None).cast("long").alias("p2"), _long(0).alias("words")))
    found = cut(found, "nodes")
    children = found.filter("depth > 0").groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n_children"))
    children = children.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "n_children")
    nodes = cut(found.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", _long(0)))
                .withColumns({"leaves": (F.col("n_children") == 0).cast("long"),
                              "saved": (F.col("n_convs") - 1) * F.col("words")}), "family")
    totals = rollup(nodes, ways, deepest, root, band)

    # Where each rebuilt conversation ends.
    last = ways.groupBy("conv_id").agg(F.max(F.struct("depth", *KEY)).alias("e")).select("e.k1", "e.k2", "conv_id")
    ends = end_digests(last.unionByName(lengths.filter("turns = 0").select(*start, "conv_id")))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    # All nodes of depth 1 have one parent, known here; it is not joined.
    named = (nodes.filter("depth > 1").join(parents, ["p1", "p2"])
             .unionByName(nodes.filter("depth < 2").withColumn(
                 "parent_conv_id", F.when(F.col("depth") == 1, F.lit(top["conv_id"])).cast("long"))))
    return (named.select(*KEY, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children")
            .join(totals, KEY).join(ends, KEY, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


#: Nodes are lists of turns; subtrees are found by the prefixes of each
#: node's smallest member.
ORACLE_SQL = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns FROM t GROUP BY conv_id),
crc_bits AS (SELECT conv_id, conv_id::VARCHAR AS s FROM l),
crc AS (
  WITH RECURSIVE c AS (
    SELECT conv_id, s, 1 AS i, 0 AS bit, xor(4294967295::BIGINT, ascii(substr(s, 1, 1))::BIGINT) AS v FROM crc_bits
    UNION ALL
    SELECT conv_id, s, CASE WHEN bit = 7 THEN i + 1 ELSE i END, (bit + 1) % 8,
      CASE WHEN bit = 7 AND i < length(s)
        THEN xor(CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END, ascii(substr(s, i + 1, 1))::BIGINT)
        ELSE CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END END
    FROM c WHERE i <= length(s))
  SELECT conv_id, xor(v, 4294967295::BIGINT) % 4 AS h FROM c WHERE i = length(s) + 1),
r AS (SELECT l.conv_id, coalesce(b.turns[1:h], []) || l.turns[h + 1:] AS turns
      FROM l JOIN crc USING (conv_id) LEFT JOIN l b ON b.conv_id = l.conv_id - l.conv_id % 20),
p AS (SELECT conv_id, d, turns[1:d] AS node, len(turns) = d AS last
      FROM (SELECT *, unnest(generate_series(0, len(turns))) AS d FROM r)),
n AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256,
        CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(node[d].text, '[^\x20\x09-\x0D]+')) END AS words
      FROM p GROUP BY node, d),
k AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.node = n.node AND n.d >= 0),
s AS (SELECT p.node, sum((f.n_children = 0)::INT) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved_tokens
      FROM f JOIN p ON p.conv_id = f.conv_id AND p.d <= f.d GROUP BY p.node)
SELECT f.conv_id, f.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs,
  f.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN s ON s.node = f.node LEFT JOIN n parent ON f.d > 0 AND parent.node = f.node[1:f.d - 1] AND parent.d = f.d - 1
"""
