"""Embedding near-duplicates by collision-counting projections.

Every vector, scaled to length 1, is projected onto ``counted`` random
lines. Two vectors collide on a line when their projections differ by at
most half a window, so the window is centred on each vector in turn. Two
vectors at distance d differ on a Gaussian line by N(0, d), whatever the
data: a pair at the threshold collides on a line with a known probability,
and the number of its collisions is binomial. The count that a pair must
reach is the largest one which a pair at the threshold misses with
probability ``MISS`` at most; pairs that reach it are verified by their
cosine in double precision, so a link is never wrong.

Pairs meet in ``orders`` sorted projections. Sorting alone would bring half
of all pairs together on every line, so each order is read in cells, the
sign patterns over ``bits`` random hyperplanes of its own (none for a small
table: then it is the plain method). ``bits`` grows with the logarithm of
the number of rows, which holds a cell near ``CELL`` vectors, and ``orders``
follows from it so that a pair at the threshold misses all its meetings
with probability ``MISS`` at most. Closer pairs miss less. A pair counts
in the first order in which it meets, so links are counted without a
shuffle of pairs; a task gives one row per vector, not per pair.

Equal vectors are one vector with a weight. A cell of more than ``BLOCK``
vectors is split into blocks by a hash and its pairs of blocks are tasks:
a dense group of n different vectors costs n * n comparisons (its links are
to be counted), but never n * n rows.

Defined results: a vector that is null, empty, all zero or holds a null or
non-finite component links with nothing and keeps its row. Vectors of
different lengths don't link. Repeated vec_ids stay separate rows, each
with its own links; a null vec_id never names a component that holds
another id. Ties in no respect matter. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewx.llm.bagminhash import components
from ridewx.llm.common import cut
from ridewx.operators.enrich import size_checked

COSINE = 0.9
#: Probability that a pair at the threshold never meets, or is counted short.
MISS = 1e-4
#: Projections to count over, at least.
COUNTED = 32
#: Half a window, in standard deviations of a pair at the threshold.
HALF = 2.0
#: Vectors of a cell, about, and of a block at most, about.
CELL, BLOCK = 4096, 8192
#: Steps of a projection's stored value in 1.
STEPS = 1000
SEED = 17


@dataclass(frozen=True)
class Plan:
    cosine: float
    bits: int
    orders: int
    counted: int
    needed: int
    window: int


def calibrate(rows: int, cosine: float = COSINE, miss: float = MISS, cell: int = CELL) -> Plan:
    """Orders, count and window that keep a pair at the threshold with
    probability 1 - 2 * ``miss``."""
    if not 0 < cosine < 1:
        raise ValueError("cosine must lie between 0 and 1")
    half = HALF * math.sqrt(2 - 2 * cosine)
    hit = math.erf(HALF / math.sqrt(2))
    bits = max(0, math.ceil(math.log2(max(rows, 1) / cell)))
    meet = hit * (1 - math.acos(cosine) / math.pi) ** bits
    orders = math.ceil(math.log(miss) / math.log(1 - meet))
    counted = max(COUNTED, orders)
    needed, below = 0, 0.0  # P(fewer than ``needed`` collisions)
    while True:
        below += math.comb(counted, needed) * hit ** needed * (1 - hit) ** (counted - needed)
        if below > miss:
            # One step of rounding on either side of the stored values.
            return Plan(cosine, bits, orders, counted, needed, math.ceil(half * STEPS) + 1)
        needed += 1


def unit(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision and without overflow."""
    x = values.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def matrix(column) -> np.ndarray:
    """A list column whose lists have one length, as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _project(plan: Plan):
    def run(batches):
        for batch in batches:
            lists = batch.column("embedding")
            size = np.diff(np.asarray(lists.offsets))
            at = batch.schema.get_field_index("embedding")
            for dim in np.unique(size):
                part = batch.take(pa.array(np.flatnonzero(size == dim)))
                rng = np.random.default_rng([SEED, int(dim)])
                lines = rng.standard_normal((dim, plan.counted))
                planes = rng.standard_normal((dim, plan.orders * plan.bits))
                for start in range(0, part.num_rows, 4096):
                    some = part.slice(start, 4096)
                    x = unit(matrix(some.column(at)))
                    n = len(x)
                    limit = np.iinfo(np.int16).max
                    place = np.clip(np.rint(x @ lines * STEPS), -limit, limit).astype("<i2")
                    signs = ((x @ planes) > 0).reshape(n, plan.orders, plan.bits)
                    cell = (signs @ (1 << np.arange(plan.bits, dtype=np.int64))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [*some.columns, pa.array(np.full(n, dim, np.int32)),
                         pa.array([r.tobytes() for r in place], pa.binary()),
                         pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * plan.orders, cell.ravel())],
                        names=[*some.schema.names, "dim", "places", "cells"])

    return run


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (the smallest place connected so far) with links a-b added."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def links_in(x: np.ndarray, place: np.ndarray, cell: np.ndarray, side: np.ndarray | None, weight: np.ndarray,
             order: int, plan: Plan, queries: int = 128, width: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """(links, smallest connected place) of the vectors of one cell, from
    the pairs that meet in ``order`` first. ``side``: only pairs of unlike
    sides."""
    n = len(x)
    by = np.argsort(place[:, order], kind="stable")
    v = place[by, order].astype(np.int32)
    across = np.ascontiguousarray(place[by].T).view(np.uint16)
    reach, twice = np.uint16(plan.window), np.uint16(2 * plan.window)
    end = np.searchsorted(v, v + plan.window, side="right")
    links, label = np.zeros(n, np.int64), np.arange(n)
    for s in range(0, n, queries):
        e = min(n, s + queries)
        for lo in range(s, int(end[e - 1]), width):
            hi = min(lo + width, int(end[e - 1]))
            count = np.zeros((e - s, hi - lo), np.uint16)
            for line in across:
                count += (line[s:e, None] - line[None, lo:hi] + reach) <= twice
            near = count >= plan.needed
            # The window of each query, from the next place on.
            column = np.arange(lo, hi)
            near &= (column[None, :] > np.arange(s, e)[:, None]) & (column[None, :] < end[s:e, None])
            if side is not None:
                near &= side[by[s:e], None] != side[by[None, lo:hi]]
            i, j = np.nonzero(near)
            if not len(i):
                continue
            if len(i) > near.size // 16:
                cosine = (x[by[s:e]] @ x[by[lo:hi]].T)[i, j]
            else:
                cosine = np.einsum("ij,ij->i", x[by[s + i]], x[by[lo + j]])
            a, b = by[s + i], by[lo + j]
            close = np.flatnonzero(np.abs(cosine - plan.cosine) < 1e-9)
            # The same sum for a pair wherever it is met.
            cosine[close] = np.einsum("ij,ij->i", x[np.minimum(a, b)[close]], x[np.maximum(a, b)[close]])
            keep = cosine >= plan.cosine
            a, b = a[keep], b[keep]
            for t in range(order):
                met = (cell[a, t] == cell[b, t]) & (
                    np.abs(place[a, t].astype(np.int32) - place[b, t]) <= plan.window)
                a, b = a[~met], b[~met]
            if len(a):
                links += np.bincount(a, weight[b], n).astype(np.int64) + np.bincount(b, weight[a], n).astype(np.int64)
                label = joined(label, a, b)
    return links, label


def _tile(plan: Plan):
    def run(table: pa.Table) -> pa.Table:
        n = table.num_rows
        # One order of rows, so that a pair's sums don't depend on the task.
        table = table.take(pa.array(np.argsort(table.column("node").to_numpy())))
        node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        place = np.frombuffer(b"".join(table.column("places").to_pylist()), "<i2").reshape(n, plan.counted)
        cell = matrix(table.column("cells"))
        lo, hi = table.column("lo").to_numpy(), table.column("hi").to_numpy()
        side = table.column("own").to_numpy() if lo[0] != hi[0] else None
        links, label = links_in(unit(matrix(table.column("embedding"))), place, cell, side, weight,
                                int(table.column("order")[0].as_py()), plan)
        some = np.flatnonzero(links)
        return pa.table({"node": node[some], "links": links[some], "first": node[label[some]]})

    return run


def usable(vector) -> Column:
    """Neither null nor empty nor zero, and every component finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, miss: float = MISS, cell: int = CELL,
                    block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors``
    (vec_id, embedding)."""
    kind = vectors.schema["embedding"].dataType
    if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
        kind = T.ArrayType(T.DoubleType())
    rows = vectors.select(vectors["vec_id"], vectors["embedding"].cast(kind).alias("embedding"))
    distinct = (rows.filter(usable(F.col("embedding"))).groupBy("embedding")
                .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("weight")))
    plan = calibrate(rows.count(), cosine, miss, cell)
    nodes = cut(distinct.mapInArrow(_project(plan), T.StructType(
        [*distinct.schema.fields, T.StructField("dim", T.IntegerType()), T.StructField("places", T.BinaryType()),
         T.StructField("cells", T.ArrayType(T.IntegerType()))]))
        .withColumn("node", F.monotonically_increasing_id()), "projected")

    where = ["dim", "order", "cell"]
    sizes = nodes.select("dim", F.posexplode("cells").alias("order", "cell")).groupBy(where).count()
    split = size_checked(sizes.filter(F.col("count") > block)
                         .select(*where, F.ceil(F.col("count") / block).alias("blocks")), "split_cells").df
    spread = nodes.select("node", "weight", "embedding", "places", "cells", "dim",
                          F.posexplode("cells").alias("order", "cell")).join(split, where, "left")
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    tiles = (spread.withColumn("own", F.pmod(F.xxhash64("node"), blocks))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
             .withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("blocks", "other"))
    found = cut(tiles.groupBy(*where, "lo", "hi").applyInArrow(_tile(plan), "node long, links long, first long"),
                "found")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")))
    named = (nodes.select("node", "embedding", "first_id", "weight").join(links, "node", "left")
             .join(labels.withColumnRenamed("v", "node"), "node", "left")
             .withColumn("c", F.coalesce("c", "node")))
    ids = cut(named.groupBy("c").agg(F.min("first_id").alias("component_id")), "component_ids")
    named = named.join(ids, "c").select(
        "embedding", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.lit(True).alias("usable"))
    out = rows.join(named, "embedding", "left").withColumn(
        "component_id", F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id")))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "component_id",
                      F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


#: Every pair by its cosine; components by reachability.
ORACLE_SQL = f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, x -> x::DOUBLE) AS e FROM embeddings),
ok AS (SELECT r, vec_id, e, sqrt(list_sum(list_transform(e, x -> x * x))) AS norm FROM v
       WHERE len(e) > 0 AND len(list_filter(e, x -> x IS NULL OR isnan(x) OR isinf(x))) = 0
         AND len(list_filter(e, x -> x <> 0)) > 0),
link AS (SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.r <> b.r AND len(a.e) = len(b.e)
         AND list_inner_product(a.e, b.e) / (a.norm * b.norm) >= {COSINE}),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
named AS (SELECT a, min(vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN named ON named.a = v.r LEFT JOIN degree ON degree.a = v.r
"""
