"""Different words and texts that collide under polynomial hashes are kept
apart."""

import pyarrow as pa

from ridewx.llm import bagminhash, suffix_trees, textops


def thue_morse(a, b, bits):
    return [(a, b)[bin(i).count("1") & 1] for i in range(1 << bits)]


#: 1,024 letters each: equal under any polynomial over bytes modulo 2**64.
X = "".join(thue_morse("a", "b", 10))
Y = "".join(thue_morse("b", "a", 10))


def test_the_words_collide_as_polynomials_only():
    col = pa.array([X, Y])
    old = textops.words(col)[0]
    assert old[0] == old[1]
    for h in textops.word_ids(col, 2)[0]:
        assert h[0] != h[1]


def test_word_ids_do_not_depend_on_the_slice():
    col = pa.array(["a bb", None, "", "bb\nccc a \x00é"])
    (h,), bounds = textops.word_ids(col)
    assert bounds.tolist() == [0, 2, 2, 2, 6]
    assert h[0] == h[4] and h[1] == h[2] and len(set(h.tolist())) == 4
    assert textops.word_ids(pa.array(["ccc"]))[0][0][0] == h[3]
    assert len(textops.word_ids(pa.array([], pa.string()))[0][0]) == 0


def test_substring_dedup_keeps_colliding_words(spark):
    rest = [f"w{i}" for i in range(26)]
    docs = [" ".join(rest[:13] + [w] + rest[13:]) for w in (X, Y, X)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.n_removed for r in suffix_trees.remove_repeats(df).collect()}
    assert got == {0: 0, 1: 0, 2: 27}


def test_near_dedup_keeps_colliding_texts(spark):
    texts = [" ".join([X] * 30), " ".join([Y] * 30), " ".join([X] * 30)]
    # 2,048 words in two patterns that cancel out in any polynomial over words, inside unlike texts.
    texts += [" ".join(thue_morse("p", "q", 11)), " ".join(thue_morse("q", "p", 11))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.class_id, r.class_size) for r in bagminhash.near_duplicates(df).collect()}
    assert got[0] == got[2] == (0, 2) and got[1] == (1, 1)
    signed = {r.doc_id: (r.h1, r.h2) for r in bagminhash.keyed(df, "doc_id", "text").mapInArrow(
        bagminhash._sign, bagminhash._SIGNED).collect()}
    assert signed[3][0] != signed[4][0] and signed[3][1] != signed[4][1]


def test_strangers_visit_the_blocks_of_a_large_group(spark, monkeypatch):
    """A bucket of n texts of one component and one stranger makes O(n) rows."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(bagminhash, "BLOCK", 8)
    n = 200
    members = spark.range(n).select(F.col("id").alias("v"), F.lit(1).cast("long").alias("key"))
    labels = spark.range(n - 1).select(F.col("id").alias("v"), F.lit(0).cast("long").alias("c"))
    sized = spark.range(n).select(F.col("id").alias("v"), F.lit(10).alias("words"))
    base = " ".join(f"w{i}" for i in range(60))
    texts = spark.range(n).select(F.col("id").alias("row"), F.lit(base).alias("text"))
    seen = []
    monkeypatch.setattr(bagminhash, "_between", lambda threshold: lambda table: __import__("pyarrow").table(
        {"a": [table.num_rows], "b": [int((table.column("side").to_numpy() == 1).sum()) + 1000 * table.column("v")[0].as_py()]}))
    seen = bagminhash.between_components(members, labels, sized, texts, 0.8, True).collect()
    blocks = -(-n // 8)
    assert sum(r.a for r in seen) == n + blocks - 1 and sum(r.b % 1000 for r in seen) == blocks - 1


def test_links_between_blocks_are_found(spark, monkeypatch):
    """Near copies that only blocks of other texts hold are still linked."""
    monkeypatch.setattr(bagminhash, "BLOCK", 4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):  # a chain: each shares 0.9 of its shingles with the next
        base = base[2:] + [f"x{i}", f"y{i}"]
        rows.append((i, " ".join(base)))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {r.class_id for r in bagminhash.near_duplicates(df).collect()} == {0}
