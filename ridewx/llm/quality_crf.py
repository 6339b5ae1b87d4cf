"""Document quality from a linear-chain conditional random field on lines.

Every line that holds a word is labelled good or bad by a two-state chain.
A line's features (character classes, word shapes, repeats) come with those
of the line before and after it. The chain is fitted by gradient ascent on
about ``SAMPLE_PER_LABEL`` documents of each label at most, and within
``SAMPLE_BYTES``, whose lines carry their document's label; forward-backward
marginals of the good state, weighted by line length, give the document's
raw quality, and a logistic curve, fitted on a held-back part of the sample
in which each label weighs what it weighs in the corpus, turns that into a
probability. Scores use the text alone.

Defined results: a text without a word (null, empty) has the raw quality 0
and the lowest score; with no label of one kind all scores are 0.5; equal
raw qualities have equal scores; a very long text is a chain of all its
lines; repeated rows are scored each on their own; an empty table gives an
empty result.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewx.llm import textops as t
from ridewx.llm.common import cut, keyed, slices

SAMPLE_PER_LABEL = 1500
#: Bytes of a fitted sample, about, and what the features of a line take.
SAMPLE_BYTES, LINE_BYTES = 512 << 20, 600
EPOCHS, BATCH, RATE, PENALTY = 30, 64, 0.05, 1e-4

_ASCII = np.arange(256)
_UPPER = (_ASCII >= 65) & (_ASCII <= 90)
_LOWER = (_ASCII >= 97) & (_ASCII <= 122)
_DIGIT = (_ASCII >= 48) & (_ASCII <= 57)
_HIGH = _ASCII >= 128
_SPACE = np.isin(_ASCII, [32, 9, 10, 11, 12, 13])
_STOP = np.isin(_ASCII, [ord(c) for c in ".,;:?"])
_BANG = _ASCII == ord("!")
_PIPE = _ASCII == ord("|")
_OTHER = ~(_UPPER | _LOWER | _DIGIT | _HIGH | _SPACE | _STOP | _BANG | _PIPE)
_CLASSES = (_UPPER, _LOWER, _DIGIT, _HIGH, _STOP, _BANG, _PIPE, _OTHER)
_END = np.isin(_ASCII, [ord(c) for c in ".?!:;\"')"])


def lines(col: pa.Array):
    """(features per line, bytes per line, lines before each text)."""
    h, bounds, starts, ends, data = t.words(col)
    _, offs = t.text_bytes(col)
    begin, stop, _ = t.runs(data != 10, offs)
    first = np.searchsorted(starts, begin)
    last = np.searchsorted(starts, stop)
    has = last > first
    begin, stop, first, last = begin[has], stop[has], first[has], last[has]
    before = np.searchsorted(begin, offs)
    n = len(begin)
    if not n:
        return np.zeros((0, 18)), np.zeros(0, np.int64), before
    share = []
    size = (stop - begin).astype(float)
    for cls in _CLASSES:
        total = np.concatenate([[0], np.cumsum(cls[data])])
        share.append((total[stop] - total[begin]) / size)
    words = (last - first).astype(float)

    def per_word(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag)])
        return (total[last] - total[first]) / words

    doc = np.searchsorted(bounds, np.arange(len(h)), side="right")
    near = np.zeros(len(h), bool)
    for gap in (1, 2, 3):
        near[gap:] |= (h[gap:] == h[:-gap]) & (doc[gap:] == doc[:-gap])
    odd_end = ~(_LOWER | _UPPER | _HIGH | _DIGIT | _STOP)[data[ends - 1]] if len(h) else np.zeros(0, bool)
    line_doc = np.searchsorted(before, np.arange(n), side="right")
    line_hash = t.span_hash(data, begin, stop)
    order = np.lexsort((np.arange(n), line_hash, line_doc))
    again = np.zeros(n, bool)
    same = (line_hash[order][1:] == line_hash[order][:-1]) & (line_doc[order][1:] == line_doc[order][:-1])
    again[order[1:][same]] = True
    x = np.stack([*share, np.log1p(size), np.log1p(words), size / words / 10, per_word(near),
                  per_word(odd_end), per_word((ends - starts) == 1), again.astype(float),
                  _END[data[ends[last - 1] - 1]].astype(float), (words < 4).astype(float),
                  np.minimum(share[7] * 10, 1)], axis=1)
    return x, (stop - begin), before


def with_neighbours(x: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Own features, those of the lines around (zero outside the text), 1."""
    prev, nxt = np.zeros_like(x), np.zeros_like(x)
    prev[1:], nxt[:-1] = x[:-1], x[1:]
    n = len(x)
    prev[before[:-1][before[:-1] < n]] = 0
    last = before[1:] - 1
    nxt[last[last >= 0]] = 0
    return np.concatenate([x, prev, nxt, np.ones((n, 1))], axis=1)


def marginals(score: np.ndarray, trans: np.ndarray, before: np.ndarray):
    """Forward-backward for many chains at once, longest first.

    ``score``: log potential of state 1 against 0 per line; ``trans``: 2 × 2
    log potentials. Returns P(state 1) per line and the expected number of
    each transition over all chains."""
    lens = np.diff(before)
    order = np.argsort(-lens, kind="stable")
    start, lens = before[:-1][order], lens[order]
    node = np.stack([np.zeros(len(score)), score], axis=1)
    fwd, bwd = np.zeros_like(node), np.zeros_like(node)
    steps = int(lens[0]) if len(lens) else 0
    alive = [int(np.searchsorted(-lens, -k, side="left")) for k in range(steps + 1)]
    for k in range(steps):
        at = start[:alive[k]] + k
        if k:
            a = fwd[at - 1][:, :, None] + trans[None]
            fwd[at] = np.logaddexp(a[:, 0], a[:, 1])
        fwd[at] += node[at]
    for k in range(steps - 2, -1, -1):
        at = start[:alive[k + 1]] + k
        a = trans[None] + (node[at + 1] + bwd[at + 1])[:, None, :]
        bwd[at] = np.logaddexp(a[:, :, 0], a[:, :, 1])
    both = fwd + bwd
    z = np.logaddexp(both[:, 0], both[:, 1])
    p = np.exp(both[:, 1] - z)
    inner = np.ones(len(score), bool)
    inner[before[:-1][before[:-1] < len(score)]] = False
    at = np.flatnonzero(inner)
    pair = fwd[at - 1][:, :, None] + trans[None] + (node[at] + bwd[at])[:, None, :] - z[at][:, None, None]
    return p, np.exp(pair).sum(axis=0)


def raw_quality(p: np.ndarray, size: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the marginals of each text; 0 without lines."""
    total = np.concatenate([[0], np.cumsum(p * size)])
    weight = np.concatenate([[0], np.cumsum(size)])
    w = weight[before[1:]] - weight[before[:-1]]
    return (total[before[1:]] - total[before[:-1]]) / np.maximum(w, 1)


class Model:
    """Scaling, line weights, transitions, and the final curve."""

    def __init__(self, mean, scale, weights, trans, curve):
        self.mean, self.scale, self.weights, self.trans, self.curve = mean, scale, weights, trans, curve

    def quality(self, col: pa.Array) -> np.ndarray:
        x, size, before = lines(col)
        f = with_neighbours((x - self.mean) / self.scale, before)
        p, _ = marginals(f @ self.weights, self.trans, before)
        return raw_quality(p, size, before)

    def score(self, col: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.curve[0] * self.quality(col) + self.curve[1])))


def fit(texts: pa.Array, label: np.ndarray, share: np.ndarray | None = None, seed: int = 3) -> Model:
    """Line weights from three quarters of the texts, the final curve from
    the rest; ``share``: what each text weighs in the curve."""
    x, size, before = lines(texts)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    f = with_neighbours((x - mean) / scale, before)
    y = np.repeat(label, np.diff(before)).astype(float)
    held = np.arange(len(label)) % 4 == 0
    weights, trans = np.zeros(f.shape[1]), np.zeros((2, 2))
    m = [np.zeros_like(weights), np.zeros_like(trans)]
    v = [np.zeros_like(weights), np.zeros_like(trans)]
    rng, step = np.random.default_rng(seed), 0
    train = np.flatnonzero(~held & (np.diff(before) > 0))
    for _ in range(EPOCHS):
        rng.shuffle(train)
        for k in range(0, len(train), BATCH):
            docs = train[k:k + BATCH]
            lens = np.diff(before)[docs]
            part = np.concatenate([[0], np.cumsum(lens)])
            at = np.arange(part[-1]) - np.repeat(part[:-1], lens) + np.repeat(before[:-1][docs], lens)
            p, pairs = marginals(f[at] @ weights, trans, part)
            seen = np.zeros((2, 2))
            for s in (0, 1):
                seen[s, s] = (lens[label[docs] == s] - 1).sum()
            grads = ((f[at].T @ (y[at] - p)) / len(at) - PENALTY * weights,
                     (seen - pairs) / len(at) - PENALTY * trans)
            step += 1
            for i, (w, g) in enumerate(zip((weights, trans), grads)):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w += RATE * m[i] / (1 - 0.9 ** step) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    p, _ = marginals(f @ weights, trans, before)
    q = raw_quality(p, size, before)[held]
    return Model(mean, scale, weights, trans, logistic(q, label[held], None if share is None else share[held]))


def logistic(q: np.ndarray, y: np.ndarray, share: np.ndarray | None = None) -> np.ndarray:
    """Slope and offset of a logistic curve, rows weighing ``share`` (classes
    weigh alike without it) and the slope kept from running away (ridge)."""
    c = np.array([4.0, -2.0])
    x = np.stack([q, np.ones(len(q))], axis=1)
    if len(y) and 0 < y.sum() < len(y):
        if share is None:
            share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        weight = share / share.sum()
        def loss(c: np.ndarray) -> float:
            z = x @ c
            return (weight * (np.logaddexp(0, z) - y * z)).sum() + 5e-5 * c @ c

        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
            g = x.T @ (weight * (y - p)) - 1e-4 * c
            hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
            step, now = np.linalg.solve(hess, g), loss(c)
            # Newton's step, halved until it helps.
            while np.abs(step).max() > 1e-9 and loss(c + step) > now:
                step = step / 2
            c = c + step
    return c


def labelled_sample(docs: DataFrame, labels: DataFrame, is_training: Column, label: str,
                    per_label: int, line_bytes: int = 0) -> DataFrame:
    """text, y, n: about ``per_label`` training rows of each label at most,
    and rows of about ``SAMPLE_BYTES`` in all, where a row takes its text's
    bytes and ``line_bytes`` for each line. A hash of the row chooses, so
    rows that share a doc_id are chosen apart. Whole texts, null as empty;
    ``n`` counts the label's rows."""
    known = (labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y"))
             .filter("id is not null and y in (0, 1)")
             .groupBy("id").agg(F.max("y").alias("y")))
    known = known.filter(is_training)
    texts = keyed(docs, "doc_id", "text")
    lines = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    rows = cut(texts.select("row", F.col("doc_id").alias("id"),
                            (F.octet_length("text") + lines * line_bytes).cast("long").alias("bytes"))
               .join(known, "id").select("row", "y", "bytes"), "labelled_rows")
    # Two labels: two rows.
    sizes = rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("total"))
    unit = F.pmod(F.xxhash64("row"), F.lit(1 << 62)) / (1 << 62)
    share = F.least(F.lit(float(per_label)) / F.col("n"), F.lit(SAMPLE_BYTES / 2) / F.greatest("total", F.lit(1)))
    chosen = rows.join(F.broadcast(sizes), "y").filter(unit < share).select("row", "y", "n")
    # About 2 * per_label rows of three numbers: bounded, so broadcast.
    return texts.select("row", "text").join(F.broadcast(chosen), "row").select("text", "y", "n")


def gather(batches) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct texts of the sample in a random order, their label, and how
    much of the corpus each stands for. Equal texts are one example, so
    groups of copies don't fill the sample."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0)
    table = pa.Table.from_batches(got)
    table = table.set_column(0, "text", table.column("text").cast(pa.large_string())).sort_by(
        [("text", "ascending"), ("y", "ascending")])
    texts, y = table.column("text").combine_chunks(), table.column("y").to_numpy().astype(np.int64)
    first = np.array([i for i in range(len(y)) if i == 0 or texts[i] != texts[i - 1]])
    order = np.random.default_rng(5).permutation(first)
    y, n = y[order], table.column("n").to_numpy()[order]
    return texts.take(pa.array(order)), y, n / np.bincount(y, minlength=2)[y]


def _fit(batches):
    texts, y, share = gather(batches)
    if len(set(y.tolist())) < 2:
        return
    m = fit(texts, y, share)
    buf = io.BytesIO()
    np.savez(buf, mean=m.mean, scale=m.scale, weights=m.weights, trans=m.trans, curve=m.curve)
    yield pa.RecordBatch.from_arrays([pa.array([buf.getvalue()])], names=["model"])


def train(docs: DataFrame, labels: DataFrame, is_training: Column) -> Model | None:
    """Fit on the labelled rows where ``is_training`` (over ``id``) holds."""
    sample = labelled_sample(docs, labels, is_training, "quality", SAMPLE_PER_LABEL, LINE_BYTES)
    found = sample.repartition(1).mapInArrow(_fit, "model binary").first()
    if found is None:
        return None
    with np.load(io.BytesIO(bytes(found["model"]))) as m:
        return Model(*(m[k] for k in ("mean", "scale", "weights", "trans", "curve")))


def scorer(model):
    """A map function from (row, doc_id, text) to (row, doc_id, score)."""
    def run(batches):
        for batch in slices(batches):
            s = model.score(batch.column(2)) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s)],
                                             names=["row", "doc_id", "score"])

    return run


def score(docs: DataFrame, model) -> DataFrame:
    """row, doc_id, score of every row."""
    return keyed(docs, "doc_id", "text").mapInArrow(scorer(model), "row long, doc_id long, score double")
