"""Embedding near-duplicates, the prefix trie and collocations: whole
results against brute force, and the defined results for nulls, empty and
long inputs, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ridewx.llm import collision_projections, prefix_trie, setm_phrases

# --- embeddings -------------------------------------------------------------


def near(v, cosine, rng):
    """A unit vector at exactly this cosine from the unit vector ``v``."""
    side = rng.standard_normal(len(v))
    side -= side @ v * v
    return cosine * v + math.sqrt(1 - cosine ** 2) * side / np.linalg.norm(side)


def brute_links(rows, cosine=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
          for _, v in rows]
    scaled = [np.array(v, float) / max(abs(x) for x in v) if k else None for (_, v), k in zip(rows, ok)]
    unit = [None if v is None else v / np.linalg.norm(v) for v in scaled]
    n = len(rows)
    links = [[j for j in range(n) if j != i and ok[i] and ok[j] and len(unit[i]) == len(unit[j])
              and unit[i] @ unit[j] >= cosine] for i in range(n)]
    out, seen = {}, set()
    for i in range(n):
        if i in seen:
            continue
        todo, group = [i], {i}
        while todo:
            for j in links[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        ids = [rows[g][0] for g in group if rows[g][0] is not None]
        for g in group:
            out[g] = min(ids) if ids else None
    return sorted(((rows[i][0], len(links[i]), out[i], rows[i][0] == out[i]) for i in range(n)), key=str)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    rows, i = [], 0
    for _ in range(40):
        v = rng.standard_normal(16)
        v /= np.linalg.norm(v)
        for w in [v, v, 3 * v, near(v, 0.9001, rng), near(v, 0.8999, rng), near(v, 0.97, rng)]:
            rows.append((i, [float(x) for x in w]))
            i += 1
    centre = rng.standard_normal(16)
    for _ in range(150):  # a dense group
        rows.append((i, [float(x) for x in centre + 0.1 * rng.standard_normal(16)]))
        i += 1
    chain = rng.standard_normal(16)
    chain /= np.linalg.norm(chain)
    for _ in range(30):  # neighbours link, ends don't
        rows.append((i, [float(x) for x in chain]))
        chain = near(chain, 0.93, rng)
        i += 1
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] + [1.0] * 15,
           [1.0, 2.0], [2.0, 4.0], [1e-300] * 16, [1e300] * 16]
    rows += [(i + k, v) for k, v in enumerate(odd)]
    return rows + [(0, rows[0][1]), (None, rows[6][1]), (None, [float(x) for x in rng.standard_normal(16)])]


@pytest.mark.parametrize("cell, block", [(4096, 8192), (32, 24)])
def test_embedding_links_match_brute_force(spark, vectors, cell, block):
    # Columns that share names with the operator's own.
    df = spark.createDataFrame([(*r, "x", 1, "c") for r in vectors],
                               "vec_id long, embedding array<double>, node string, cell int, first string").repartition(3)
    got = collision_projections.near_duplicates(df, cell=cell, block=block)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_links(vectors)


def test_embedding_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert collision_projections.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    alone = collision_projections.near_duplicates(spark.createDataFrame([(4, [1.0, 0.0]), (2, None)], schema)).collect()
    assert sorted(map(tuple, alone)) == [(2, 0, 2, True), (4, 0, 4, True)]
    whole = spark.createDataFrame([(1, [1, 0]), (2, [5, 0])], "vec_id long, embedding array<int>")
    assert sorted(map(tuple, collision_projections.near_duplicates(whole).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]
    with pytest.raises(ValueError):
        collision_projections.calibrate(10, cosine=1.5)


def test_recall_at_the_threshold():
    """Pairs at cosine 0.9 keep the calibrated share of meetings and counts."""
    rng = np.random.default_rng(2)
    plan = collision_projections.calibrate(4096 * 8)
    assert plan.bits == 3
    kept = 0
    for _ in range(400):
        v = rng.standard_normal(64)
        v /= np.linalg.norm(v)
        pair = np.stack([v, near(v, 0.9, rng)])
        place = np.rint(pair @ rng.standard_normal((64, plan.counted)) * collision_projections.STEPS)
        close = np.abs(place[0] - place[1]) <= plan.window
        signs = (pair @ rng.standard_normal((64, plan.orders * plan.bits)) > 0).reshape(2, plan.orders, plan.bits)
        meets = (signs[0] == signs[1]).all(axis=1) & close[:plan.orders]
        kept += close.sum() >= plan.needed and meets.any()
    assert kept >= 398


# --- prefix trie ------------------------------------------------------------


def brute_trie(rows):
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[c].append(((t is not None, t or 0), tie, (role, text)))
    turns = {c: [x[2] for x in sorted(v)] for c, v in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
    members = collections.defaultdict(list)
    for c, v in made.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not children[p]
        saved[p] += (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(made[c]) == len(p)).encode()).hexdigest())
                   for p, m in members.items()), key=str)


TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(3)
    rows = [(None, 1, "user", "nobody's")]
    for c in [*range(-25, 45), 1000, 1007]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 40])):
            rows.append((c, rng.choice([None, t, t, t]), rng.choice(["user", "assistant", None]),
                         rng.choice(["a b", None, "", "c", "x y z "])))
    rows += [(c, t, "user", "same words here") for c in range(60, 75) for t in range(100)]  # copies, deep
    rows += [(61, t, "user", "same words here") for t in range(3)]  # repeated rows
    rows += [(80, t, "user", "w " * 2000) for t in range(400)]  # one long conversation
    return rows


@pytest.mark.parametrize("band", [2, 16])
def test_trie_matches_brute_force(spark, talks, band):
    df = spark.createDataFrame([(*r, 9, "x", "y") for r in talks], TURNS + ", depth long, words string, k1 string")
    got = prefix_trie.trie(df.repartition(5), band)
    assert sorted(map(tuple, got.collect()), key=str) == brute_trie(talks)


def test_trie_edges(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    # Conversation 3 takes over its group's turns or has none; 2 loses its only turn.
    for rows in ([(5, 1, None, None)], [(1, 1, "user", "x")], [(7, None, "user", "x"), (7, None, "user", "x")]):
        got = prefix_trie.trie(spark.createDataFrame(rows, TURNS)).collect()
        assert sorted(map(tuple, got), key=str) == brute_trie(rows)


def test_long_conversation_lies_in_several_tasks(spark, talks):
    """Numbers run on over task borders: turns of conversation 80 are 1 to 400."""
    turns = prefix_trie.numbered(spark.createDataFrame(talks, TURNS).repartition(6))
    got = [r["at"] for r in turns.filter("conv_id = 80").collect()]
    assert sorted(got) == list(range(1, 401))


def test_end_digests_join_pieces(spark):
    ids = list(range(5000))
    random.Random(1).shuffle(ids)
    ends = spark.createDataFrame([(i % 2, 7, i) for i in ids], "k1 long, k2 long, conv_id long").repartition(4)
    for r in prefix_trie.end_digests(ends).collect():
        joined = ",".join(str(i) for i in range(5000) if i % 2 == r.k1)
        assert r.ends_sha256 == hashlib.sha256(joined.encode()).hexdigest()


# --- collocations -----------------------------------------------------------


def brute_phrases(rows, top, least, most):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    n, f = collections.Counter(), collections.defaultdict(collections.Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        held = collections.Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i:i + k]] = max(held[p[i:i + k]], a)
        best = []
        for p, a in found.items():
            if 100 * held[p] >= 80 * a:
                continue
            score, _, l, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                 for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (score, a, p, l, r) in enumerate(sorted(best)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    vocab = ["Of", "THE", "new", "york", "city", "hall", "é", "Éa", "x-y", "zz z", "end"]
    rows = [(None, "en"), ("", None), (" \t ..!?", "en"), ("one", "und"), ("a\rb\x0bc\x0cd", None)]
    for i in range(120):
        words = [rng.choice(vocab) + rng.choice(["", "", "", ",", "\n", " \t", "."]) for _ in range(rng.choice([1, 5, 60]))]
        if i % 3 == 0:
            words += ["New", "York", "City", "Hall"] * rng.choice([1, 2])
        rows.append((" ".join(words), ["en", "de", None, "und"][i % 4]))
    rows += [("ta " * 30000, "en"), ("No stop at all " * 50, "de")] + rows[20:24]
    return rows


@pytest.mark.parametrize("stretch, top", [(1 << 20, 2000), (100, 7)])
def test_collocations_match_brute_force(spark, texts, monkeypatch, stretch, top):
    monkeypatch.setattr(setm_phrases, "STRETCH", stretch)
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in texts],
                               "text string, lang string, n int, phrase string, stretch string").repartition(3)
    got = setm_phrases.collocations(df, top=top, min_count=4)
    assert sorted(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == \
        brute_phrases(texts, top, 4, 4)


def test_collocations_of_an_empty_table(spark):
    assert setm_phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_relations_and_answers_are_small(spark, monkeypatch):
    written = []

    def cut(df, label, compression=None):
        out = write(df, label, compression)
        if label[0] in "RF":
            written.extend(os.path.getsize(f.removeprefix("file://")) for f in out.inputFiles())
        return out

    write = setm_phrases.cut
    monkeypatch.setattr(setm_phrases, "cut", cut)
    monkeypatch.setattr(setm_phrases, "STRETCH", 50_000)
    rng = random.Random(3)
    rows = [(" ".join(f"w{min(int(rng.paretovariate(0.8)), 20_000)}" for _ in range(5_000)), "en") for _ in range(60)]
    df = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    assert setm_phrases.collocations(df, min_count=4).count() > 100
    # Numbers as they were, not byte by byte: 5.3 bytes a word.
    assert sum(written) < 4.7 * 60 * 5_000


def test_pieces_and_words():
    words, text, new = setm_phrases.tokens(pa.array(["Ab c.d", None, "É,\tX"]))
    assert words.to_pylist() == ["ab", "c", "d", "É", "x"]
    assert text.tolist() == [0, 0, 0, 2, 2] and new.tolist() == [True, False, True, True, True]
