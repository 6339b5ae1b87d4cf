"""The mix's words by source, its shards, and the splitting tree."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridewx.llm import mixing

SCHEMA = "doc_id long, text string, source string, extra int"


def per_source(df, column="text"):
    counts = collections.Counter()
    for r in df.collect():
        counts[r.source] += len((r[column] or "").split())
    return counts


def wanted(docs):
    """Words of every source: its target, rounded."""
    named, _ = mixing.mix_pieces(docs)
    return {r.source: round(r.target) for r in named.select("source", "target").distinct().collect() if round(r.target)}


def test_a_long_document_is_not_lost(spark):
    """A source whose only document is long against its target is cut."""
    docs = spark.createDataFrame([(i, "a b c d e " * 20, "a", 1) for i in range(12)]
                                 + [(50, " ".join(f"w{i}" for i in range(6000)), "b", 1)], SCHEMA).coalesce(1)
    got, want = mixing.mixed_documents(docs), wanted(docs)
    assert set(want) == {"a", "b"} and per_source(got) == want
    text = got.filter("source = 'b'").first().text
    assert text == " ".join(f"w{i}" for i in range(want["b"]))


def test_words_of_every_source_meet_its_target(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), " \n".join(["x"] * int(n)) + " ", "abcde"[i % 5] if i % 7 else None, int(i))
            for i, n in enumerate(rng.integers(0, 400, 300))]
    rows += [rows[5]] * 3 + [(None, "same text here", None, 0)] * 40
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    docs = mixing.cut(docs, "docs")
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns and per_source(got) == wanted(docs)
    taken = mixing.mix(docs).collect()
    assert all(0 <= r.taken <= 3 * r.size for r in taken)
    # Documents are whole, but for one of each source at most.
    whole = {r.text for r in docs.collect()}
    cut = [r.source for r in got.collect() if r.text not in whole]
    assert len(cut) == len(set(cut))


def test_the_mix_does_not_depend_on_row_numbers(spark):
    rows = [(i % 30, f"text of {i % 45} " * (i % 9 + 1), "ab"[i % 2], 0) for i in range(200)]
    seen = []
    for parts in (1, 4):
        docs = mixing.cut(spark.createDataFrame(rows, SCHEMA).repartition(parts), "docs")
        seen.append(sorted((str(r.doc_id), r.size, r.taken) for r in mixing.mix(docs, block_words=64).collect()))
    assert seen[0] == seen[1]


def test_written_shards_hold_the_mix(spark, tmp_dir):
    rows = [(i, "some words " * (i % 13), "abc"[i % 3], i) for i in range(400)]
    docs = mixing.cut(spark.createDataFrame(rows, SCHEMA), "docs")
    options = {"block_words": 50, "shard_words": 1000}
    mixing.write_mix(docs, f"{tmp_dir}/mix", **options)
    written = spark.read.parquet(f"{tmp_dir}/mix")
    assert sorted(map(str, written.drop("shard").collect())) == sorted(map(str, mixing.mixed_documents(docs, **options).collect()))
    size = {r.shard: r.n for r in written.groupBy("shard").agg(F.sum(F.size(F.split(F.trim("text"), " "))).alias("n")).collect()}
    assert len(size) > 3 and max(size.values()) < 2 * 1000
    # Sources are mixed inside shards.
    assert written.groupBy("shard").agg(F.countDistinct("source").alias("n")).filter("n < 2").count() == 0
    with pytest.raises(ValueError):
        mixing.write_mix(docs.withColumn("Shard", F.lit(1)), f"{tmp_dir}/x")


def test_sources_deal_alike_alone_and_together(spark):
    quotas = [3, 0, 50, 7, 1, 200, 9]
    whole = [mixing.shard_quotas(np.array(quotas), 11, k, 5)[0] for k in range(11)]
    plan = spark.createDataFrame([(i, q) for i, q in enumerate(quotas) if q], "source_no long, quota long")
    for r in mixing.with_tree_sums(plan).collect():
        assert (list(r.own), list(r.beside)) == mixing.tree_sums(quotas, r.source_no)
        alone = {k: n for k, _, n in mixing.dealt(list(r.own), list(r.beside), r.source_no, 11, 5)}
        assert alone == {k: w[r.source_no] for k, w in enumerate(whole) if w[r.source_no]}
        # A range of shards gives the same draws at the same places.
        part = list(mixing.dealt(list(r.own), list(r.beside), r.source_no, 11, 5, 4, 8))
        assert part == [x for x in mixing.dealt(list(r.own), list(r.beside), r.source_no, 11, 5) if 4 <= x[0] < 8]


def test_one_split_is_hypergeometric():
    """First shard of two: mean and variance of a source's draws."""
    quotas = np.array([40, 60, 100])
    drawn = np.array([mixing.shard_quotas(quotas, 2, 0, seed)[0] for seed in range(400)])
    assert (drawn.sum(axis=1) == 100).all()
    assert np.abs(drawn.mean(axis=0) - quotas / 2).max() < 0.6
    var = 100 * (quotas / 200) * (1 - quotas / 200) * 100 / 199
    assert np.abs(drawn.var(axis=0) / var - 1).max() < 0.3


def test_first_words_keep_white_space(spark):
    df = spark.createDataFrame([("  a\tb \n c  ", n) for n in (1, 2, 3)], "t string, n int")
    got = [r[0] for r in df.select(mixing.first_words(F.col("t"), F.col("n"))).collect()]
    assert got == ["  a", "  a\tb", "  a\tb \n c"]
