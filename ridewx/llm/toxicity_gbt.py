"""Toxicity: gradient-boosted trees over dense features, calibrated.

Features of a text: hits of a lexicon per word (plain, after undoing
look-alike characters, weighted by log-odds, and near a second-person
pronoun), shares of capitals, punctuation, exclamation marks and digits,
rates of obfuscated words (letters mixed with look-alike characters) and of
stretched letters, and length. The lexicon is learned: words much more
frequent in toxic than in clean training texts, together with a short fixed
list. Histogram trees are boosted on the logistic loss and an isotonic
curve maps their sum to a probability; it is fitted on sums of trees that
have not seen the text (cross-fitting), with each label weighing what it
weighs in the corpus. All is fitted on about ``SAMPLE_PER_LABEL`` training
rows of each label at most, and within the byte bound of
``quality_crf.labelled_sample``; equal texts count once. Scores use the text
alone.

Defined results: null text is empty and scored by its (zero) features; with
no label of one kind all scores are 0.5; equal sums of trees have equal
scores; a very long text is scored whole, by rates over its length; repeated
rows are scored each on their own; an empty table gives an empty result.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from ridewx.llm import textops as t
from ridewx.llm.quality_crf import gather, labelled_sample, score  # noqa: F401

SAMPLE_PER_LABEL = 3000
FOLDS = 4
TREES, DEPTH, RATE, BINS, LAMBDA = 80, 3, 0.2, 32, 1.0
LEXICON, LEAST_TEXTS, LEAST_ODDS = 400, 5, 3.0
REACH = 5

# General insults, second-person words, look-alikes.
SEED_WORDS = ("idiot moron stupid dumb loser trash garbage scum worthless pathetic disgusting "
              "clown fool imbecile bastard jerk").split()
SECOND_PERSON = "you your yours yourself u du dich dir dein deine ihr euch tu te toi ton ta vous votre usted tú ti tus".split()
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_A = np.arange(256)
_FOLD = _A.astype(np.uint8)
_FOLD[65:91] += 32
_LETTER = ((_FOLD >= 97) & (_FOLD <= 122)) | (_A >= 128)
_PLAIN = _FOLD.copy()
_PLAIN[[ord(c) for c in LOOKALIKES]] = [ord(c) for c in LOOKALIKES.values()]
_MIXED = _LETTER.copy()
_MIXED[[ord(c) for c in LOOKALIKES]] = True
_MIXED[ord("*")] = True
_UPPER = (_A >= 65) & (_A <= 90)
_SPACE = np.isin(_A, [32, 9, 10, 11, 12, 13])
_PUNCT = ~(_LETTER | _SPACE | ((_A >= 48) & (_A <= 57)))


def word_key(words: list[str]) -> np.ndarray:
    """Sorted hashes of folded words, as ``tokens`` computes them."""
    if not words:
        return np.empty(0, np.uint64)
    return np.sort(t.words(pa.array(words))[0])


def tokens(col: pa.Array):
    """Letter runs, folded: hash per token, tokens before each text, and
    their place; then bytes and offsets."""
    data, offs = t.text_bytes(col)
    starts, ends, bounds = t.runs(_LETTER[data], offs)
    return t.span_hash(_FOLD[data], starts, ends), bounds, starts, data, offs


def _found(h: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys) or not len(h):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return keys[at] == h, at


def features(col: pa.Array, keys: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Dense features (texts × 15)."""
    h, bounds, _, data, offs = tokens(col)
    n = len(bounds) - 1
    words = np.diff(bounds)
    doc = np.repeat(np.arange(n), words)
    hit, at = _found(h, keys)
    weight = np.where(hit, odds[at] if len(odds) else 0.0, 0.0)
    near = np.zeros(len(h), bool)
    you, _ = _found(h, word_key(SECOND_PERSON))
    for gap in range(1, REACH + 1):
        same = doc[gap:] == doc[:-gap] if gap < len(h) else np.zeros(0, bool)
        near[gap:] |= you[:-gap] & same if len(same) else False
        near[:len(same)] |= you[gap:] & same
    # Words with look-alike characters or stars inside, read as letters.
    starts, ends, _ = t.runs(_MIXED[data], offs)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    inside = letters[ends] - letters[starts]
    odd = (inside > 0) & (inside < ends - starts)
    starts, ends = starts[odd], ends[odd]
    # Trailing marks are punctuation, not disguise.
    while len(ends):
        tail = ~_LETTER[data[ends - 1]] & (ends - starts > 1)
        if not tail.any():
            break
        ends = ends - tail
    odd_doc = np.searchsorted(offs, starts, side="right") - 1
    disguised = letters[ends] - letters[starts] < ends - starts
    odd_hit, _ = _found(t.span_hash(_PLAIN[data], starts, ends), keys)
    stretched = np.zeros(len(data), bool)
    if len(data) > 3:
        stretched[3:] = (data[3:] == data[2:-1]) & (data[2:-1] == data[1:-2]) & (data[1:-2] == data[:-3]) & _LETTER[data[3:]]
    size = np.maximum(np.diff(offs), 1).astype(float)
    per = np.maximum(words, 1).astype(float)

    def share(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag)])
        return (total[offs[1:]] - total[offs[:-1]]) / size

    count = np.bincount(doc[hit], minlength=n).astype(float)
    best = np.zeros(n)
    np.maximum.at(best, doc, weight)
    odd_count = np.bincount(odd_doc[odd_hit & disguised], minlength=n)
    return np.stack([
        count, count / per, np.bincount(doc, weight, n) / per, best,
        np.bincount(doc[hit & near], minlength=n), np.bincount(doc[you], minlength=n) / per,
        odd_count, odd_count / per, np.bincount(odd_doc[disguised], minlength=n) / per,
        share(_UPPER[data]), share(_PUNCT[data]), share(data == ord("!")), share((_A[data] >= 48) & (_A[data] <= 57)),
        share(stretched), np.log1p(words)], axis=1)


def learn_lexicon(texts: pa.Array, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted word hashes and their smoothed log-odds."""
    h, bounds, *_ = tokens(texts)
    doc = np.repeat(np.arange(len(y)), np.diff(bounds))
    order = np.lexsort((h, doc))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    h, doc = h[order][new], doc[order][new]
    u, back = np.unique(h, return_inverse=True)
    toxic = np.bincount(back, y[doc], len(u))
    clean = np.bincount(back, 1 - y[doc], len(u))
    odds = np.log((toxic + 0.1) / (y.sum() + 1)) - np.log((clean + 0.5) / ((1 - y).sum() + 1))
    good = (toxic >= LEAST_TEXTS) & (odds >= LEAST_ODDS)
    rank = np.argsort(-(odds * toxic)[good], kind="stable")[:LEXICON]
    keys, odds = u[good][rank], odds[good][rank]
    extra = np.setdiff1d(word_key(SEED_WORDS), keys)
    keys = np.concatenate([keys, extra])
    odds = np.concatenate([odds, np.full(len(extra), LEAST_ODDS)])
    order = np.argsort(keys)
    return keys[order], odds[order]


def boost(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Complete trees of ``DEPTH`` levels over binned features."""
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]
    # A rare feature's first step (above its commonest value) is kept too.
    edges = [np.unique(np.append(e, np.min(col[col > col.min()], initial=np.inf) * 0.999
                                 if (col > col.min()).any() else [])) for e, col in zip(edges, x.T)]
    binned = np.stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T)], axis=1)
    width = BINS + 2
    base = np.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6))
    total = np.full(len(y), base)
    inner, leaves = (1 << DEPTH) - 1, 1 << DEPTH
    feature, cutoff, value = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(y), np.int64)
        f_tree, c_tree = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            lo, n = (1 << level) - 1, 1 << level
            best = np.zeros(n)
            choice = [None] * n
            for f in range(x.shape[1]):
                key = (node - lo) * width + binned[:, f]
                sg = np.cumsum(np.bincount(key, g, n * width).reshape(n, width), axis=1)
                sh = np.cumsum(np.bincount(key, hess, n * width).reshape(n, width), axis=1)
                gain = (sg ** 2 / (sh + LAMBDA) + (sg[:, -1:] - sg) ** 2 / (sh[:, -1:] - sh + LAMBDA)
                        - sg[:, -1:] ** 2 / (sh[:, -1:] + LAMBDA))[:, :len(edges[f])]
                if gain.shape[1]:
                    k = gain.argmax(axis=1)
                    for i in range(n):
                        if gain[i, k[i]] > best[i] + 1e-9:
                            best[i], choice[i] = gain[i, k[i]], (f, k[i])
            for i, c in enumerate(choice):
                if c:
                    f_tree[lo + i], c_tree[lo + i] = c[0], edges[c[0]][c[1]]
            right = x[np.arange(len(y)), f_tree[node]] > c_tree[node]
            node = 2 * node + 1 + right
        leaf = node - inner
        v = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, hess, leaves) + LAMBDA)
        total += v[leaf]
        feature.append(f_tree), cutoff.append(c_tree), value.append(v)
    return {"feature": np.array(feature), "cutoff": np.array(cutoff), "value": np.array(value),
            "base": np.array(base)}


def margin(x: np.ndarray, trees: dict[str, np.ndarray]) -> np.ndarray:
    out = np.full(len(x), float(trees["base"]))
    rows = np.arange(len(x))
    for f, c, v in zip(trees["feature"], trees["cutoff"], trees["value"]):
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, f[node]] > c[node])
        out += v[node - len(f)]
    return out


def isotonic(m: np.ndarray, y: np.ndarray, share: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators, rows weighing ``share``: knots and their
    non-decreasing values."""
    share = np.ones(len(y)) if share is None else share * (len(y) / share.sum())
    order = np.argsort(m, kind="stable")
    at, inverse = np.unique(m[order], return_inverse=True)
    weight = np.bincount(inverse, share[order])
    value = np.bincount(inverse, (share * y)[order]) / weight
    blocks: list[list[float]] = []  # sum, weight, first knot, last knot
    for k, (v, w) in enumerate(zip(value, weight)):
        blocks.append([v * w, w, k, k])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w2, _, last = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += w2
            blocks[-1][3] = last
    # Shrunk a little towards one half, so no block claims certainty.
    level = [(s + 0.5) / (w + 1) for s, w, _, _ in blocks]
    knots = np.array([at[i] for _, _, a, b in blocks for i in (a, b)])
    return knots, np.maximum.accumulate(np.repeat(level, 2))


class Model:
    """Lexicon, trees and curve; size bounded by the constants above."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.a = arrays

    def score(self, col: pa.Array) -> np.ndarray:
        x = features(col, self.a["keys"], self.a["odds"])
        return np.interp(margin(x, self.a), self.a["knots"], self.a["levels"])


def fit(texts: pa.Array, y: np.ndarray, share: np.ndarray | None = None) -> Model:
    """Cross-fitted in ``FOLDS`` parts, for samples of any size: a part's
    features come from the other parts' lexicon, and the curve from margins
    of trees that the other parts grew. The lexicon and the trees that stay
    are made from all parts."""
    part = np.arange(len(y)) % FOLDS
    x = None
    for k in range(FOLDS):
        mine, rest = np.flatnonzero(part == k), np.flatnonzero(part != k)
        if len(mine):
            f = features(texts.take(pa.array(mine)), *learn_lexicon(texts.take(pa.array(rest)), y[rest]))
            x = np.zeros((len(y), f.shape[1])) if x is None else x
            x[mine] = f
    m = np.zeros(len(y))
    for k in range(FOLDS):
        mine, rest = np.flatnonzero(part == k), np.flatnonzero(part != k)
        if len(mine) and len(rest):
            m[mine] = margin(x[mine], boost(x[rest], y[rest]))
    keys, odds = learn_lexicon(texts, y)
    knots, levels = isotonic(m, y, share)
    return Model({**boost(x, y), "keys": keys, "odds": odds, "knots": knots, "levels": levels})


def _fit(batches):
    texts, y, share = gather(batches)
    if len(set(y.tolist())) < 2:
        return
    model = fit(texts, y, share)
    buf = io.BytesIO()
    np.savez(buf, **model.a)
    yield pa.RecordBatch.from_arrays([pa.array([buf.getvalue()])], names=["model"])


def train(docs: DataFrame, labels: DataFrame, is_training: Column) -> Model | None:
    """Fit on the labelled rows where ``is_training`` (over ``id``) holds."""
    sample = labelled_sample(docs, labels, is_training, "toxic", SAMPLE_PER_LABEL)
    found = sample.repartition(1).mapInArrow(_fit, "model binary").first()
    if found is None:
        return None
    with np.load(io.BytesIO(bytes(found["model"]))) as m:
        return Model({k: m[k] for k in m.files})
