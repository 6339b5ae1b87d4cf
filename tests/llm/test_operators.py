"""The operators on small fixtures: whole results against brute force, and
the defined results for nulls, empty and long texts, ties, repeated rows,
empty tables and columns with clashing names."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ridewx.llm import (bagminhash, chat_windows, common, golomb_dedup, langid, line_rules, mixing, pow2_pack,
                        quality_crf, suffix_trees, textops, toxicity_gbt)

random.seed(11)
VOCAB = [f"w{i}" for i in range(400)]


def words(n):
    return " ".join(random.choice(VOCAB) for _ in range(n))


PASSAGE = words(60)
BASE = words(300)
TEXTS = [None, "", " \t\n", "one", "one two", "a b c d e", BASE, BASE.replace(" ", "\n"), BASE + " tail",
         words(40) + " " + PASSAGE + " " + words(30), words(20) + "\n" + PASSAGE, "x " * 70, words(5000),
         words(5) + " ümläut " + words(30), "one two"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", None][i % 2], ["a", "b", None, ""][i % 4], "row", 1, "copy") for i, t in enumerate(TEXTS)]
    rows += [(6, BASE, "en", "a", "row", 2, "again"), (None, "one two", None, None, None, None, None)]
    # Columns that share names with the operators' own.
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "row string, size int, _row string").coalesce(1)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("doc_id = -5")


def normal(text):
    out, space = [], False
    for c in text or "":
        if c in " \t\n\x0b\f\r":
            if not space:
                out.append(" ")
            space = True
        else:
            out.append(c)
            space = False
    return "".join(out)


def test_exact_duplicates(docs, none):
    rows = docs.select("doc_id", "text").collect()
    got = golomb_dedup.exact_duplicates(docs).orderBy("row").collect()
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        groups[normal(r.text)].append((r.doc_id is None, r.doc_id, i))
    for i, (r, g) in enumerate(zip(rows, got)):
        first = min(groups[normal(r.text)], key=lambda x: (x[0], x[1] or 0, x[2]))
        assert (g.keep_id, g.group_size, g.kept) == (first[1], len(groups[normal(r.text)]), first[2] == i)
        assert g.text_sha256 == hashlib.sha256(normal(r.text).encode()).hexdigest()
    kept = golomb_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert golomb_dedup.exact_duplicates(none).count() == 0


def test_rice_code_round_trip():
    rng = np.random.default_rng(1)
    for low in (0, 3, 17):
        v = np.unique(rng.integers(0, 1 << 20, 500)).astype(np.uint64)
        assert (golomb_dedup.rice_decode(len(v), low, *golomb_dedup.rice_encode(v, low)) == v).all()


def bag(text):
    w = (text or "").split()
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def test_signatures_estimate_weighted_similarity():
    a = " ".join(["p q r s t u v"] * 6 + [BASE])
    b = " ".join(["p q r s t u v"] * 3 + [BASE[: len(BASE) * 3 // 4]])
    texts = pa.array([a, b] * 1)
    true = similarity(bag(a), bag(b))
    assert bagminhash.overlap(texts.slice(0, 1), texts.slice(1, 1))[0] == pytest.approx(true)
    agree = []
    for salt in range(30):
        doc, sh = textops.shingles(texts, 5)
        sig = bagminhash.signatures(doc, textops.mix(sh + np.uint64(salt)), 2)
        agree.append((sig[0] == sig[1]).mean())
    assert np.mean(agree) == pytest.approx(true, abs=0.03)


def test_near_duplicates_match_brute_force(spark, docs, none, monkeypatch):
    base = words(120).split()
    chain = []
    for i in range(40):  # a chain of copies: neighbours are similar, ends are not
        if i:
            base = list(base)
            base[(7 * i) % 120] = f"new{i}"
        chain.append(" ".join(base))
    texts = TEXTS + chain + [words(80) for _ in range(10)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bags = [bag(t) for t in texts]
    parent = list(range(len(texts)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(texts)):
        for j in range(i):
            if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    # Small blocks, so that comparing between blocks is exercised too.
    monkeypatch.setattr(bagminhash, "BLOCK", 4)
    got = {r.doc_id: r for r in bagminhash.near_duplicates(df).collect()}
    assert {i: r.class_id for i, r in got.items()} == {i: find(i) for i in range(len(texts))}
    sizes = collections.Counter(map(find, range(len(texts))))
    assert all(r.class_size == sizes[r.class_id] and r.kept == (i == r.class_id) for i, r in got.items())
    out = bagminhash.near_duplicates(docs).collect()
    assert len(out) == len(TEXTS) + 2 and sum(r.kept for r in out if r.class_id == 6) == 1
    assert bagminhash.drop_near_duplicates(docs).columns == docs.columns
    assert bagminhash.near_duplicates(none).count() == 0


def test_packing_round_trip(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special = "a <|endoftext|> b 's 12  \n\n x"
    df = docs.select("doc_id", "text", "row").unionByName(
        docs.sparkSession.createDataFrame([(99, special, "r")], "doc_id long, text string, row string"))
    pieces = collections.defaultdict(list)
    for p in pow2_pack.pack(df).collect():
        assert p.length & (p.length - 1) == 0 and p.length <= 2048 and p.offset == 0
        pieces[p.doc_id].append(p)
    ids = [p.sequence_id for ps in pieces.values() for p in ps]
    assert len(ids) == len(set(ids))
    for doc_id, text in [(i, t) for i, t in enumerate(TEXTS) if i != 6] + [(99, special)]:
        want = tok.encode(text or "", add_special_tokens=False).ids + [1]
        got = sorted(pieces[doc_id], key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in got) == np.array(want, "<u4").tobytes()
        assert [p.length for p in got] == pow2_pack.lengths(len(want)) and got[0].doc_tokens == len(want)
    assert pow2_pack.pack(none).count() == 0
    with pytest.raises(ValueError):
        pow2_pack.pack(docs, seq_len=1000)


def test_packing_of_texts_the_fast_encoder_refuses(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["before", "a" + " " * 1_100_000 + "b", "c" + "\u3000" * 1_100_000 + "d", "after"]
    pieces = collections.defaultdict(list)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for p in pow2_pack.pack(df).collect():
        pieces[p.doc_id].append(p)
    for doc_id, text in enumerate(texts):
        want = tok.encode(text, add_special_tokens=False).ids + [1]
        got = b"".join(bytes(p.ids) for p in sorted(pieces[doc_id], key=lambda p: p.start))
        assert got == np.array(want, "<u4").tobytes()


def repeats(rows):
    seen, out = set(), {}
    for key in sorted(rows, key=lambda k: (k[0] is None, k[0] or 0, k[1])):
        w = (rows[key] or "").split()
        gone = set()
        for i in range(len(w) - 19):
            g = tuple(w[i:i + 20])
            if g in seen:
                gone |= set(range(i, i + 20))
            seen.add(g)
        out[key] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("group_rows", [400_000, 64])
def test_repeats_match_brute_force(docs, none, group_rows):
    rows = {(r.doc_id, i): r.text for i, r in enumerate(docs.select("doc_id", "text").collect())}
    want = repeats(rows)
    got = suffix_trees.remove_repeats(docs, group_rows).orderBy("row").collect()
    assert [(r.n_words, r.n_removed, r.kept_text) for r in got] == [want[k] for k in rows]
    if group_rows > 64:
        assert suffix_trees.remove_repeats(none).count() == 0


def test_heavy_prefixes_are_extended():
    s = np.arange(40, dtype=np.uint64).reshape(4, 10) << np.uint64(33)
    s[0] = 7
    light = suffix_trees.prefix_keys(s, [])
    assert len(set(light.tolist())) == 1
    assert len(set(suffix_trees.prefix_keys(s, [np.unique(light)]).tolist())) == 10


def test_line_rules(spark, none):
    random.seed(5)
    good = "This line is fine and it ends well."
    texts = [None, "", good, "\n".join([good] * 3), "home | about | news | help\n" + words(40) + ".",
             "a*** b### c$$$ d%%% e&&& f*** g### h$$$ i%%% j&&&", "one two three four five " * 4,
             "Click here to go on now.\n" + good + " " + good]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    r = {x.doc_id: x for x in line_rules.clean(df).collect()}
    assert [r[i].n_words for i in range(4)] == [0, 0, 8, 24] and r[0].base_failed and not r[0].kept
    assert r[3].n_dup_lines == 2 and r[3].n_repeat_words == 24 and r[3].base_failed
    assert r[4].kept and "home" not in r[4].clean_text and r[4].lost_words == 7
    assert not r[5].base_failed and not r[5].kept and r[5].n_symbols == 30
    assert r[6].n_repeat_words == 20 and r[6].word_chars == len(texts[6].replace(" ", ""))
    assert r[7].clean_text == good + " " + good
    assert line_rules.clean(none).count() == 0


def test_chat_windows_round_trip(spark):
    long = "word " * 3000
    turns = [(1, 0, "system", "be <|good|> \\e"), (1, 1, "user", "hi [INST]"), (1, 2, "assistant", "yes </s> \\l"),
             (2, 0, "user", None), (2, 1, "assistant", long), (2, 2, "assistant", "done"), (3, 0, "system", "alone"),
             (4, 0, None, "x"), (4, 0, None, "x"), (None, None, "assistant", "n"), (6, 0, "assistant", "first")]
    turns += [(5, i, ["user", "assistant"][i % 2], f"t{i} " + "z" * 90) for i in range(300)]
    df = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, turns string")
    windows = chat_windows.windows(df)
    got = {r.conv_id: r for r in chat_windows.read_back(windows).collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in turns:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, rows in by.items():
        rows.sort()
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in rows)
        loss = "".join(x for _, _, r, x in rows if r == "assistant")
        assert got[c].n_turns == len(rows)
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    out = windows.filter("conv_id = 5").collect()
    assert len(out) > 3 and all(w.repeated <= 2 and len(w.text) // 4 <= 2048 and not w.over_budget for w in out)
    assert [w.over_budget for w in windows.filter("conv_id = 2 and over_budget").collect()] == [True]
    assert chat_windows.read_back(chat_windows.windows(df.filter("conv_id = 77"))).count() == 0


def test_turn_numbers_match_one_sort(spark):
    rows = [(c, t, r, x) for c in (1, 2, None) for t in (None, None, -3, 0, 1023, 1024, 1024, 5000)
            for r, x in (("user", "b"), ("assistant", "a"))]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_windows.numbered(df).collect()
    for c in (1, 2, None):
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2:]))
        assert [tuple(r)[:4] for r in sorted((g for g in got if g.conv_id == c), key=lambda g: g.at)] == mine
        assert sorted(g.at for g in got if g.conv_id == c) == list(range(len(mine)))


def fill(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in sizes if s not in capped)
        level = rest / free if free else 0
        new = {s for s in sizes if 3 * sizes[s] <= level * weight[s]}
        if new <= capped:
            return {s: 3.0 * sizes[s] if s in capped else level * weight[s] for s in sizes}
        capped |= new


def test_mix_meets_targets(docs, none):
    rows = docs.select("doc_id", "text", "source").collect()
    size = [len((r.text or "").split()) for r in rows]
    per = collections.Counter()
    for r, n in zip(rows, size):
        per[r.source] += n
    want = fill(dict(per))
    named, pieces = mixing.mix_pieces(docs, block_words=64, shard_words=700)
    drawn = pieces.collect()
    got = mixing.mix(docs, block_words=64, shard_words=700).orderBy("row").collect()
    taken = collections.Counter()
    for r, n, g in zip(rows, size, got):
        assert (g.size, g.source_size) == (n, per[r.source]) and g.target == pytest.approx(want[r.source])
        assert 0 <= g.taken <= 3 * n
        taken[r.source] += g.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in per)
    spans = sorted((p.row, p.copy, p.first, p.words) for p in drawn)
    for a, b in zip(spans, spans[1:]):
        assert a[:2] != b[:2] or a[2] + a[3] == b[2]
    assert len({p.shard for p in drawn}) > 3
    assert sorted(map(tuple, drawn)) == sorted(map(tuple, mixing.mix_pieces(docs, block_words=64, shard_words=700)[1].collect()))
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mix(none).count() == 0


def test_splitting_tree_is_exact():
    quotas = np.array([70, 0, 13, 200])
    parts = [mixing.shard_quotas(quotas, 7, k, 3) for k in range(7)]
    assert (sum(p[0] for p in parts) == quotas).all()
    for k in range(1, 7):
        assert (parts[k][1] == parts[k - 1][0] + parts[k - 1][1]).all()
    totals = [p[0].sum() for p in parts]
    assert max(totals) - min(totals) <= 2


LETTERS = {"en": "the and of ing tion er", "de": "der und ung schen ein ü"}


def sentence(lang, n=40):
    return " ".join(random.choice(LETTERS[lang].split()) + random.choice(LETTERS[lang].split()) for _ in range(n)) + "."


def test_language_id(spark, docs, none):
    rows = [(i, sentence(lang), lang, "s") for i, lang in enumerate(["en", "de"] * 80)]
    rows += [(500, None, "en", "s"), (501, "123 !!", "en", "s"), (502, "", None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = langid.train(df, F.col("doc_id") % 4 != 2)
    got = {r.doc_id: r for r in langid.predict(df, model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang, _ in rows[:160]) and len(got) == len(rows)
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (500, 501, 502))
    assert (model.weights == 0).mean() > 0.2  # the L1 penalty leaves a sparse model
    assert langid.predict(none, model).count() == 0
    empty = langid.train(df, F.lit(False))
    assert {r.lang_pred for r in langid.predict(df, empty).collect()} == {"und"}


def test_quality_and_toxicity(spark, none):
    good, bad = (lambda: sentence("en") + "\n" + sentence("de")), (lambda: sentence("en").upper().replace(" ", "!! "))
    rows, labels = [], []
    for i in range(240):
        clean, nice = i % 2, i % 3 != 0
        text = good() if clean else sentence("en") + "\n" + bad()
        rows.append((i, text if nice else text + " you idiot and moron and scum", "x"))
        labels.append((i, clean, int(not nice)))
    rows += [(900, None, "x"), (901, "", "x"), (902, sentence("en", 9000), "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, predicted string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for module, column in ((quality_crf, 1), (toxicity_gbt, 2)):
        model = module.train(df, lab, F.col("id") % 5 != 0)
        got = {r.doc_id: r.score for r in module.score(df, model).collect()}
        held = [(got[x[0]] >= 0.5) == bool(x[column]) for x in labels if x[0] % 5 == 0]
        assert np.mean(held) > 0.95 and all(0 <= s <= 1 for s in got.values()) and len(got) == len(rows)
        assert got[900] == got[901]
        assert module.train(df, lab, F.lit(False)) is None
        assert {r.score for r in module.score(df, None).collect()} == {0.5}
        assert module.score(none, model).count() == 0


def test_forward_backward_matches_enumeration():
    import itertools

    rng = np.random.default_rng(2)
    score, trans, before = rng.normal(size=7), rng.normal(size=(2, 2)), np.array([0, 3, 3, 7])
    p, pairs = quality_crf.marginals(score, trans, before)
    want, total = np.zeros(7), np.zeros((2, 2))
    for a, b in zip(before[:-1], before[1:]):
        states = list(itertools.product((0, 1), repeat=b - a))
        weight = np.array([np.exp(sum(score[a + i] * s for i, s in enumerate(z))
                                  + sum(trans[x, y] for x, y in zip(z, z[1:]))) for z in states])
        weight /= weight.sum()
        for z, w in zip(states, weight):
            want[a:b] += w * np.array(z)
            for x, y in zip(z, z[1:]):
                total[x, y] += w
    assert np.allclose(p, want) and np.allclose(pairs, total)


def test_isotonic_is_monotone():
    rng = np.random.default_rng(4)
    m = rng.normal(size=300)
    knots, levels = toxicity_gbt.isotonic(m, (m + rng.normal(size=300) > 0).astype(int))
    assert (np.diff(knots) >= 0).all() and (np.diff(levels) >= 0).all()


def test_pipeline_stages(spark, tmp_dir, docs):
    import os

    import corpus_pipeline

    rows = [(i, sentence(lang, 60), lang, f"s{i % 3}", 1) for i, lang in enumerate(["en", "de"] * 30)]
    rows += [(100, rows[0][1], "en", "s0", 1), (101, rows[1][1] + " end", "de", "s1", 1), (102, None, None, None, None)]
    path = os.path.join(tmp_dir, "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    current, seen = spark.read.parquet(path), {}
    for name, stage in corpus_pipeline.STAGES:
        out = os.path.join(tmp_dir, name)
        stage(spark, current, tmp_dir).write.parquet(out)
        seen[name] = spark.read.parquet(out)
        if name != "packing":
            assert seen[name].columns == current.columns
        current = seen[name]
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in seen.items()}
    assert ids["language_id"] == set(range(60)) | {100, 101}
    assert ids["exact_dedup"] == ids["language_id"] - {100}
    assert ids["near_dedup"] == ids["exact_dedup"] - {101}
    tokens = current.filter("start + length = doc_tokens").count()
    assert tokens == seen["mixing"].count()


def test_pipeline_keeps_documents_between_languages(spark, monkeypatch):
    import corpus_pipeline

    # Three languages of one and the same text: none is likelier than a third.
    rows = [(i, "ab cd ef", lang, "s") for i, lang in enumerate(["da", "nb", "sv"] * 40)] + [(500, "123", "da", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)
    monkeypatch.setattr(corpus_pipeline, "fold", lambda *_: F.lit(False))
    scores = langid.predict(df, langid.train(df, F.lit(True))).filter("doc_id < 500").collect()
    assert all(r.lang_pred != langid.UNKNOWN and r.score < 0.4 for r in scores)
    kept = corpus_pipeline.identify_language(spark, df, "").select("doc_id").collect()
    assert {r.doc_id for r in kept} == set(range(120))


def test_row_keys_stay_when_executors_change(spark, tmp_dir):
    path = f"{tmp_dir}/many_files"
    spark.range(400).selectExpr("id AS doc_id", "cast(id AS string) AS text").repartition(16).write.parquet(path)
    common.fix_splits(spark)
    docs, seen = spark.read.parquet(path), []
    for cores in ("1", "64"):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", cores)
        try:
            seen.append({tuple(r) for r in common.keyed(docs, "doc_id").collect()})
        finally:
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert seen[0] == seen[1]
