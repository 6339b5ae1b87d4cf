"""Language identification: n-gram counts, the FTRL step and scripts other
than Latin."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ridewx.llm import langid, textops

#: Words of four languages in the Cyrillic and Greek alphabets.
WORDS = {
    "ru": "это был человек который сказал что он уже видел её вчера и они решили пойти домой потому время было позднее ещё",
    "uk": "це був чоловік який сказав що він вже бачив її вчора і вони вирішили піти додому бо час був пізній ще",
    "bg": "това беше човек който каза че той вече я видя вчера и те решиха да отидат у дома защото времето беше късно още",
    "el": "αυτός ήταν ένας άνθρωπος που είπε ότι την είδε χθες και αποφάσισαν να πάνε σπίτι γιατί η ώρα ήταν αργά",
}


def sentence(lang, rng, n):
    return " ".join(rng.choices(WORDS[lang].split(), k=n))


def test_counts_are_character_ngrams():
    texts = ["abca", "", "ёж ёж", "字 a", "x" * 10000, "🙂é"]
    got = langid.counts(pa.array(texts))
    cp, before = langid.code_points(textops.text_bytes(pa.array(texts))[0])
    assert "".join(map(chr, cp)) == "".join(texts) and before[-1] == sum(map(len, texts))
    for i, text in enumerate(texts):
        want = collections.Counter(text[j:j + k] for k in langid.ORDERS for j in range(len(text) - k + 1))
        mine = got.values[got.first[i]:got.first[i + 1]]
        # 65,536 slots: no two of these few n-grams share one.
        assert sorted(mine.tolist()) == sorted(want.values())


def test_folding(spark):
    df = spark.createDataFrame([("ÄB — c1d…Ё",), ("«х»",), ("",)], "t string")
    assert [r[0] for r in df.select(langid.folded(F.col("t"))).collect()] == ["äb c d ё", " х ", ""]


def dense(x, n):
    out = np.zeros((len(x), n))
    out[x.of(), x.slots] = x.values
    return out


def test_ftrl_matches_the_dense_step(monkeypatch):
    rng = np.random.default_rng(1)
    first = np.array([0, 3, 3, 6, 10, 11])
    slots = np.concatenate([np.sort(rng.choice(12, k, replace=False)) for k in np.diff(first)])
    x = langid.Rows(slots, rng.random(11).astype(np.float32), first)
    y = np.array([0, 1, 2, 1, 0])
    monkeypatch.setattr(langid, "BATCH", 2)
    monkeypatch.setattr(langid, "DIM", 12)
    got = langid.fit_ftrl(x, y, 3)
    full, z, n, order = dense(x, 12), np.zeros((12, 3)), np.zeros((12, 3)), np.random.default_rng(7)
    w = lambda: np.where(np.abs(z) > langid.L1, -(z - np.sign(z) * langid.L1) / (
        (langid.BETA + np.sqrt(n)) / langid.ALPHA + langid.L2), 0)
    for _ in range(langid.EPOCHS):
        rows = order.permutation(5)
        for at in range(0, 5, 2):
            pick = rows[at:at + 2]
            p = langid.softmax(full[pick] @ w())
            p[np.arange(len(pick)), y[pick]] -= 1
            g, now = full[pick].T @ p, w()
            z = z + g - (np.sqrt(n + g * g) - np.sqrt(n)) / langid.ALPHA * now
            n = n + g * g
    assert got == pytest.approx(w(), abs=1e-4)
    assert x.times(got) == pytest.approx(full @ got, abs=1e-6)
    assert dense(x.take(np.array([3, 1, 3])), 12) == pytest.approx(full[[3, 1, 3]])


def test_temperature_weighs_rows_and_prefers_one():
    z = np.array([[2.0, 0.0], [2.0, 0.0]])
    assert langid.fit_temperature(np.zeros((3, 2)), np.array([0, 1, 1])) == pytest.approx(1, rel=0.05)
    sure = langid.fit_temperature(z, np.array([0, 1]), np.array([99.0, 1.0]))
    unsure = langid.fit_temperature(z, np.array([0, 1]), np.array([60.0, 40.0]))
    assert sure < unsure


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(6)
    rows = [(i, sentence(lang, rng, rng.randrange(5, 25)), lang) for i, lang in enumerate(list(WORDS) * 60)]
    return langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))


@pytest.mark.parametrize("change", [str, str.upper, lambda t: "«" + t.title() + "» — …"])
def test_cyrillic_and_greek_in_any_case(spark, model, change):
    rng = random.Random(7)
    rows = [(i, change(sentence(lang, rng, 8)), lang) for i, lang in enumerate(list(WORDS) * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    for lang in WORDS:
        mine = [got[i] == lang for i, _, want in rows if want == lang]
        assert np.mean(mine) >= 0.95, lang


def test_long_and_repeated_texts(spark, model):
    rng = random.Random(8)
    text = sentence("uk", rng, 40_000)
    docs = spark.createDataFrame([(1, text), (1, text), (2, "¿? 12 —"), (None, "это")], "doc_id long, text string")
    got = [(r.doc_id, r.lang_pred) for r in langid.predict(docs, model).collect()]
    assert sorted(got, key=str) == [(1, "uk"), (1, "uk"), (2, "und"), (None, "ru")]


def test_copies_of_an_id_are_sampled_apart(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_PER_LABEL", 50)
    seen = []
    real = langid._fit
    rows = [(7, f"{'ab cd'[:i % 4 + 1]} x", ["en", "de"][i % 2]) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def counting(idf):
        def run(batches):
            batches = list(batches)
            n = sum(b.num_rows for b in batches)
            for out in real(idf)(iter(batches)):
                yield pa.RecordBatch.from_arrays([pa.array([[f"{n}"]]), out.column(1)], names=["langs", "model"])
        return run

    monkeypatch.setattr(langid, "_fit", counting)
    seen = langid.train(df, F.lit(True)).langs
    assert 40 < int(seen[0]) < 180
