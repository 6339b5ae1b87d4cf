"""Language identification: sparse multinomial logistic regression.

Texts are lower-cased and every run of characters other than letters and
combining marks becomes one gap, both by Unicode's tables. Features are
n-grams of 1 to 3 characters (code points; the gap is one), hashed into
``DIM`` slots, as log counts times inverse document frequency, scaled to
length one. Document frequencies cover all training rows. Weights are fitted
with follow-the-regularised-leader with proximal L1 and L2 penalties; a step
touches the slots of its batch only. The temperature is the one of least log
loss over predictions for rows that training has not seen: two halves of the
sample predict each other, with each label weighing what it weighs in the
corpus; the final weights then come from the whole sample.

The sample is bounded: about ``SAMPLE_PER_LABEL`` rows of each label and
``SAMPLE_ROWS`` in all; a hash of row and text chooses, so copies of an id
or a text are chosen apart. Rows without doc_id are not learned from. The
model has ``DIM`` weights for each label. Predictions use the text alone.

Defined results: null text, empty text and text without a letter are
``und`` with score 0; without any training row every text is ``und``;
equally likely labels go to the first in code-point order; a very long text
is one row of counts, read whole; repeated rows are scored each on their
own; an empty table gives an empty result.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewx.llm.common import keyed, slices
from ridewx.llm.textops import mix, text_bytes
from ridewx.operators.enrich import size_checked

BITS, ORDERS = 16, (1, 2, 3)
DIM = 1 << BITS
UNKNOWN = "und"
#: Bound of the fitted sample: expected rows of a label (texts are whole).
SAMPLE_PER_LABEL = 1500
#: The same for all labels together.
SAMPLE_ROWS = 16_000
EPOCHS, BATCH, ALPHA, BETA, L1, L2 = 4, 32, 0.5, 1.0, 1e-3, 1e-4
LETTER, GAP = r"\p{L}", r"[^\p{L}\p{M}]+"
U = np.uint64


def folded(text: Column) -> Column:
    """Lower-case letters with single spaces between their runs."""
    return F.regexp_replace(F.lower(text), F.lit(GAP), F.lit(" "))


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 bytes, and how many begin before each byte."""
    starts = (data & 0xC0) != 0x80
    at = np.flatnonzero(starts)
    lead = data[at].astype(np.int64)
    tail = np.append(data, np.zeros(3, np.uint8)).astype(np.int64) & 0x3F
    a, b, c = tail[at + 1], tail[at + 2], tail[at + 3]
    cp = np.where(lead < 0x80, lead, np.where(
        lead < 0xE0, (lead & 0x1F) << 6 | a, np.where(
            lead < 0xF0, (lead & 0x0F) << 12 | a << 6 | b, (lead & 0x07) << 18 | a << 12 | b << 6 | c)))
    return cp, np.concatenate([[0], np.cumsum(starts)])


class Rows:
    """Sparse rows: the slots and values of row i are at first[i]:first[i + 1]."""

    def __init__(self, slots: np.ndarray, values: np.ndarray, first: np.ndarray):
        self.slots, self.values, self.first = slots, values, first

    def __len__(self) -> int:
        return len(self.first) - 1

    def take(self, rows: np.ndarray) -> "Rows":
        size = (self.first[1:] - self.first[:-1])[rows]
        first = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(first[-1]) - np.repeat(first[:-1] - self.first[:-1][rows], size)
        return Rows(self.slots[at], self.values[at], first)

    def of(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def sums(self, entries: np.ndarray) -> np.ndarray:
        """Entries (one row of numbers each) added up by row."""
        out = np.zeros((len(self), entries.shape[1]))
        full = np.flatnonzero(np.diff(self.first))
        if len(full):
            out[full] = np.add.reduceat(entries, self.first[full], axis=0)
        return out

    def times(self, weights: np.ndarray) -> np.ndarray:
        return self.sums(self.values[:, None] * weights[self.slots])


def joined(parts: list[Rows]) -> Rows:
    first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p.first) for p in parts]))]) if parts else np.zeros(1, int)
    return Rows(np.concatenate([p.slots for p in parts]) if parts else np.empty(0, np.int32),
                np.concatenate([p.values for p in parts]) if parts else np.empty(0, np.float32), first)


def counts(col: pa.Array) -> Rows:
    """Hashed character n-gram counts of folded texts."""
    data, offs = text_bytes(col)
    cp, before = code_points(data)
    edges = before[offs]
    grams, key = [], cp.astype(U)
    for order in range(1, max(ORDERS) + 1):
        if order > 1:  # up to three code points of 21 bits, exactly
            key = (key[:-1] << U(21)) | cp[order - 1:].astype(U)
        if order in ORDERS:
            grams.append((order, (mix(key) >> U(64 - BITS)).astype(np.int32)))
    slots, values = [], []
    for a, b in zip(edges[:-1], edges[1:]):
        mine = np.concatenate([g[a:max(a, b - order + 1)] for order, g in grams])
        if len(mine) > DIM // 16:
            n = np.bincount(mine, minlength=DIM)
            found = np.flatnonzero(n)
            n = n[found]
        else:
            found, n = np.unique(mine, return_counts=True)
        slots.append(found.astype(np.int32))
        values.append(n.astype(np.float32))
    first = np.concatenate([[0], np.cumsum([len(s) for s in slots])]).astype(np.int64)
    return Rows(np.concatenate(slots), np.concatenate(values), first)


def _frequencies(batches):
    total = np.zeros(DIM, np.int64)
    for batch in slices(batches):
        total += np.bincount(counts(batch.column(0)).slots, minlength=DIM)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["slot", "n"])


def vectors(count: Rows, idf: np.ndarray) -> Rows:
    x = np.log1p(count.values) * idf[count.slots]
    norm = np.sqrt(count.sums((x * x)[:, None])[:, 0])
    return Rows(count.slots, (x / np.maximum(norm, 1e-9)[count.of()]).astype(np.float32), count.first)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_ftrl(x: Rows, y: np.ndarray, classes: int, seed: int = 7) -> np.ndarray:
    """FTRL-proximal weights (DIM × classes); zero where L1 wins."""
    z = np.zeros((DIM, classes), np.float32)
    n = np.zeros_like(z)
    rng = np.random.default_rng(seed)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, w, 0.0)

    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            pick = order[at:at + BATCH]
            rows = x.take(pick)
            used, place = np.unique(rows.slots, return_inverse=True)
            w = weights(z[used], n[used])
            p = softmax(rows.sums(rows.values[:, None] * w[place]))
            p[np.arange(len(pick)), y[pick]] -= 1
            g = np.zeros_like(w)
            np.add.at(g, place, rows.values[:, None] * p[rows.of()])
            sigma = (np.sqrt(n[used] + g * g) - np.sqrt(n[used])) / ALPHA
            z[used] += g - sigma * w
            n[used] += g * g
    return weights(z, n)


def fit_temperature(logits: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> float:
    """The temperature of least log loss on a grid of ratios; of equal ones
    the nearest to 1."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(5), 120))
    grid = grid[np.argsort(np.abs(np.log(grid)), kind="stable")]
    weight = np.ones(len(y)) if weight is None else weight
    loss = [-(weight * np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12))).sum() for t in grid]
    return float(grid[int(np.argmin(np.round(np.array(loss) / weight.sum(), 12)))])


def _fit(idf: np.ndarray):
    def run(batches):
        xs, langs, size = [], [], []
        for batch in slices(batches):
            xs.append(vectors(counts(batch.column(0)), idf))
            langs += batch.column(1).to_pylist()
            size += batch.column(2).to_pylist()
        if not langs:
            return
        x = joined(xs)
        names = sorted(set(langs))
        y = np.searchsorted(names, langs)
        # The rows of each label stand for all of its label.
        weight = np.array(size, float) / np.bincount(y)[y]
        logits = np.zeros((len(y), len(names)))
        half = np.arange(len(y)) % 2
        for k in (0, 1):
            seen, unseen = np.flatnonzero(half != k), np.flatnonzero(half == k)
            logits[unseen] = x.take(unseen).times(fit_ftrl(x.take(seen), y[seen], len(names)))
        buf = io.BytesIO()
        np.savez_compressed(buf, w=fit_ftrl(x, y, len(names)).astype(np.float32), t=fit_temperature(logits, y, weight))
        yield pa.RecordBatch.from_arrays([pa.array([names]), pa.array([buf.getvalue()])],
                                         names=["langs", "model"])

    return run


class Model:
    """Label names, weights (DIM × labels), inverse document frequencies
    and temperature; its size does not depend on the corpus."""

    def __init__(self, langs: list[str], weights: np.ndarray, idf: np.ndarray, temperature: float):
        self.langs, self.weights, self.idf, self.temperature = langs, weights, idf, temperature


def train(docs: DataFrame, is_training: Column) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text, lang) where
    ``is_training`` holds, doc_id and lang are known and the text has a
    letter."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].alias("id"),
                       docs["text"].alias("text"), docs["lang"].alias("lang"), is_training.alias("training"))
    rows = rows.filter(F.col("training") & F.expr("id is not null and lang is not null and text is not null")
                       & F.col("text").rlike(LETTER)).select("row", "text", "lang")
    df = (rows.select(folded(F.col("text")).alias("text")).mapInArrow(_frequencies, "slot long, n long")
          .groupBy("slot").agg(F.sum("n").alias("n")).toPandas())
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    n, labels = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    per_label = min(SAMPLE_PER_LABEL, SAMPLE_ROWS / max(1, labels))
    freq = np.zeros(DIM)
    freq[df["slot"]] = df["n"]
    idf = np.log((1 + n) / (1 + freq)) + 1
    unit = F.pmod(F.xxhash64("row", "text"), F.lit(1 << 62)) / (1 << 62)
    sample = (rows.join(size_checked(sizes, "label_sizes").df, "lang").filter(unit * F.col("n") < per_label)
              .select(folded(F.col("text")).alias("text"), "lang", "n").repartition(1))
    found = sample.mapInArrow(_fit(idf), "langs array<string>, model binary").first()
    if found is None:
        return Model([], np.zeros((DIM, 0)), idf, 1.0)
    with np.load(io.BytesIO(bytes(found["model"]))) as m:
        return Model(list(found["langs"]), m["w"], idf, float(m["t"]))


def _predict(model: Model):
    def run(batches):
        for batch in slices(batches):
            n = batch.num_rows
            known = batch.column(3).to_numpy(zero_copy_only=False) & bool(model.langs)
            lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
            if known.any():
                p = softmax(vectors(counts(batch.column(2)), model.idf).times(model.weights) / model.temperature)
                best = p.argmax(axis=1)
                lang[known] = np.array(model.langs, object)[best[known]]
                score[known] = p[np.arange(n), best][known]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score)],
                names=["row", "doc_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """row, doc_id, lang_pred, score of every row."""
    texts = keyed(docs, "doc_id", "text").select(
        "row", "doc_id", folded(F.col("text")).alias("text"), F.col("text").rlike(LETTER).alias("letters"))
    return texts.mapInArrow(_predict(model), "row long, doc_id long, lang_pred string, score double")
