"""Phrase collocation mining with SETM's relations.

Occurrence relations R1, R2, ... hold (piece, place, item) in order of
place. R1 holds the words. The occurrences of R(k) are merged on the
adjacent place of the same piece, the longer phrases are counted, and a
semi-join with the frequent ones gives R(k+1), which is persisted.

A persisted row is one stretch of text: the places and items of the stretch
in sorted, packed arrays. Places are numbered with a gap between pieces, and
a stretch ends where a piece ends, so the merge on adjacent places stays
inside a row and no occurrence is ever shuffled by itself. For counting, a
stretch sends each of its distinct items once, in one packed message to each
owner (items are dealt to owners by a hash); the owner adds up and answers
each stretch with the numbers of its frequent items; the answers of a
stretch meet its relation and filter it. An item that holds a third of all
occurrences thus gives one entry per stretch. An owner numbers its frequent
items in a row and names an entry by its place in the message, so that
numbers stay small; they are packed byte by byte (all lowest bytes first).

An item is a pair of numbers (frequent phrase, next word) and words are
compared as text, so nothing rests on hashes. Numbers are exact: scores are
computed in 38-digit decimals.

Defined results: null text counts as empty; a null lang is ``und`` and one
with the literal ``und``. Only A-Z are lower-cased. Very long texts are cut
into stretches at piece ends; one piece without any end is one stretch.
Repeated rows count as often as they occur. Equal scores are ordered by
count, then by the phrase's UTF-8 bytes. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewx.llm.common import cut, slices
from ridewx.llm.textops import mix, runs, span_hash, text_bytes

MIN_COUNT, MAX_WORDS, TOP = 30, 4, 2000
#: A candidate goes when a longer one holds this share (percent) of it.
HELD_PERCENT = 80
SCORE_SCALE = 2_000_000
NO_LANG = "und"
#: Words of a stretch, about.
STRETCH = 1 << 20
#: Bits of a stretch's number in its task, and of a frequent item's number
#: at its owner; the owner's number stands above them.
STRETCH_BITS, RANK_BITS = 16, 32
#: Items counted by one owner, about.
OWNED = 1 << 20

_PIECE_END = np.zeros(256, bool)
_PIECE_END[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_BETWEEN = _PIECE_END.copy()
_BETWEEN[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: R(k): places, the number of the phrase that starts at each, and its last
#: word's number (null: the phrase is a word).
_RELATION = "stretch long, size long, places binary, items binary, ids binary, lasts binary"


def tokens(col: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(every word, its text's number, whether a piece ends before it)."""
    data, offs = text_bytes(col)
    data = _LOWER[data]
    inside = ~_BETWEEN[data]
    starts, ends, bounds = runs(inside, offs)
    text = np.repeat(np.arange(len(col)), np.diff(bounds))
    ended = np.concatenate([[0], np.cumsum(_PIECE_END[data])])
    new = np.ones(len(starts), bool)
    new[1:] = (ended[starts[1:]] != ended[starts[:-1]]) | (text[1:] != text[:-1])
    size = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(size.astype(np.int64)),
                                             pa.py_buffer(np.ascontiguousarray(data[inside])))
    return words, text, new


def counted(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (left, right), their counts, and each pair's number."""
    order = np.lexsort((right, left))
    l, r = left[order], right[order]
    first = np.ones(len(l), bool)
    first[1:] = (l[1:] != l[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(first)
    item = np.empty(len(l), np.int32)
    item[order] = np.cumsum(first) - 1
    return l[at], r[at], np.diff(np.append(at, len(l))), item


def _planes(values: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones, and so on."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _numbers(planes: bytes, kind: np.dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def packed(*columns: np.ndarray) -> bytes:
    """Columns of one length as one compressed buffer."""
    return pa.compress(b"".join(map(_planes, columns)), "zstd", asbytes=True)


def unpacked(cell, size: int, *kinds: str) -> list[np.ndarray]:
    kinds = [np.dtype(k) for k in kinds]
    data = pa.decompress(cell.as_py(), size * sum(k.itemsize for k in kinds), "zstd", asbytes=True)
    ends = np.cumsum([size * k.itemsize for k in kinds])
    return [_numbers(data[e - size * k.itemsize:e], k) for e, k in zip(ends, kinds)]


def _stretch(number: int, parts: list) -> pa.RecordBatch:
    words = pa.chunked_array([p[0] for p in parts]).combine_chunks().dictionary_encode()
    langs = pa.chunked_array([p[1] for p in parts]).combine_chunks().dictionary_encode()
    lang, word, n, item = counted(langs.indices.to_numpy(), words.indices.to_numpy())
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    named = lambda array, at: one(array.dictionary.take(pa.array(at)).cast(pa.string()))
    return pa.RecordBatch.from_pydict({
        "stretch": pa.array([number], pa.int64()), "size": pa.array([len(item)], pa.int64()),
        "starts": pa.array([packed(np.packbits(np.concatenate([p[2] for p in parts])))], pa.binary()),
        "items": pa.array([packed(item.astype("<i4"))], pa.binary()),
        "lang": named(langs, lang), "word": named(words, word), "n": one(pa.array(n, pa.int64()))})


def _words(batches):
    """R1 of every stretch, with the stretch's words and their counts."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << STRETCH_BITS
    parts, held = [], 0
    for batch in slices(batches):
        words, text, new = tokens(batch.column("text"))
        if not len(words):
            continue
        lang = batch.column("lang").cast(pa.large_string()).take(pa.array(text))
        # Cut at piece ends only.
        starts = np.flatnonzero(new)
        at = 0
        while at < len(words):
            to = len(words)
            if held + to - at > STRETCH:
                after = starts[np.searchsorted(starts, at + max(1, STRETCH - held)):]
                to = int(after[0]) if len(after) else to
            parts.append((words.slice(at, to - at), lang.slice(at, to - at), new[at:to]))
            held, at = held + to - at, to
            if held >= STRETCH:
                yield _stretch(number, parts)
                number, parts, held = number + 1, [], 0
    if parts:
        yield _stretch(number, parts)


def _known(answers: pa.Table, size: int, owned: dict | None = None) -> np.ndarray:
    """The number of each of a stretch's items, -1 for those not frequent;
    ``owned``: the items of each owner's message."""
    known = np.full(size, -1, np.int64)
    columns = (answers.column(c).to_pylist() for c in ("bucket", "size"))
    for bucket, n, message in zip(*columns, answers.column("message")):
        place, rank = (np.cumsum(steps, dtype=np.int64) for steps in unpacked(message, n, "<u4", "<i4"))
        known[place if owned is None else owned[bucket][place]] = (bucket << RANK_BITS) + rank
    return known


def by_bucket(bucket: np.ndarray):
    """(bucket, places) for every bucket in ``bucket``, places rising."""
    order = np.argsort(bucket, kind="stable")
    first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, b in zip(first, np.append(first[1:], len(order))):
        yield int(bucket[order[a]]), order[a:b]


def _messages(rows: list[tuple], *more: tuple) -> pa.RecordBatch:
    names = [("bucket", pa.int64()), ("stretch", pa.int64()), ("size", pa.int64()), ("message", pa.binary()), *more]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(names)],
                                      names=[name for name, _ in names])


def _word_messages(buckets: int):
    """The words of every stretch and their counts, to the words' owners."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                stretch = batch.column("stretch")[i].as_py()
                lang, word, n = (batch.column(c)[i].values for c in ("lang", "word", "n"))
                data, offs = text_bytes(word)
                bucket = (span_hash(data, offs[:-1], offs[1:]) % np.uint64(buckets)).astype(np.int64)
                n, size = n.to_numpy(), np.diff(offs)
                out = []
                for b, at in by_bucket(bucket):
                    langs = lang.take(pa.array(at)).dictionary_encode()
                    message = packed(np.diff(at, prepend=0).astype("<u4"), n[at].astype("<u4"),
                                     langs.indices.to_numpy().astype("<u4"), size[at].astype("<u4"))
                    text = pa.compress(text_bytes(word.take(pa.array(at)))[0].tobytes(), "zstd", asbytes=True)
                    out.append((b, stretch, len(at), message, text, langs.dictionary.to_pylist()))
                yield _messages(out, ("text", pa.binary()), ("langs", pa.list_(pa.string())))

    return run


def _answers(bucket: int, stretch: np.ndarray, place: np.ndarray, rank: np.ndarray, named: dict) -> pa.Table:
    """Rows (bucket, stretch, message) of the frequent entries, and one row
    with the columns ``named``, which name each frequent item once."""
    order = np.lexsort((place, stretch))
    place, rank = place[order], rank[order]
    out = [(bucket, s, len(at), packed(np.diff(place[at], prepend=0).astype("<u4"),
                                       np.diff(rank[at], prepend=0).astype("<i4")))
           for s, at in by_bucket(stretch[order])]
    table = _messages([*out, (bucket, None, None, None)])
    empty = [None] * len(out)
    return pa.table({**{c: table.column(c) for c in table.schema.names},
                     **{name: pa.array([*empty, values], pa.list_(values.type)) for name, values in named.items()}})


def _summed(group: np.ndarray, n: np.ndarray, min_count: int):
    """Groups (sorted in ``group``) that add up to ``min_count``: (places of
    their entries, each one's group by its rank, first entries, totals)."""
    first = np.flatnonzero(np.diff(group, prepend=-1))
    if not len(first):
        return first, first, first, first
    f = np.add.reduceat(n, first)
    frequent = f >= min_count
    size = np.diff(np.append(first, len(group)))
    kept = np.flatnonzero(np.repeat(frequent, size))
    return kept, np.repeat(np.cumsum(frequent) - 1, size)[kept], first[frequent], f[frequent]


def _ids(bucket: int, f: np.ndarray) -> dict:
    return {"id": pa.array((bucket << RANK_BITS) + np.arange(len(f), dtype=np.int64)), "f": pa.array(f)}


def _count_words(min_count: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        size = table.column("size").to_numpy()
        read = [unpacked(m, n, "<u4", "<u4", "<u4", "<u4") for m, n in zip(table.column("message"), size.tolist())]
        item = np.concatenate([np.cumsum(r[0], dtype=np.int64) for r in read])
        names: dict[str, int] = {}
        lang = np.concatenate([np.array([names.setdefault(x, len(names)) for x in langs], np.int64)[r[2]]
                               for r, langs in zip(read, table.column("langs").to_pylist())])
        text = b"".join(pa.decompress(t.as_py(), int(r[3].sum()), "zstd", asbytes=True)
                        for r, t in zip(read, table.column("text")))
        ends = np.cumsum(np.concatenate([[0], *(r[3] for r in read)]), dtype=np.int64)
        words = pa.LargeStringArray.from_buffers(len(item), pa.py_buffer(ends), pa.py_buffer(text)).dictionary_encode()
        word = words.indices.to_numpy().astype(np.int64)
        stretch = np.repeat(table.column("stretch").to_numpy(), size)
        order = np.lexsort((lang, word))
        n = np.concatenate([r[1] for r in read]).astype(np.int64)[order]
        kept, rank, first, f = _summed((word * max(1, len(names)) + lang)[order], n, min_count)
        bucket, at = key[0].as_py(), order[first]
        return _answers(bucket, stretch[order[kept]], item[order[kept]], rank, {
            **_ids(bucket, f), "lang": pa.array(list(names), pa.string()).take(pa.array(lang[at])),
            "word": words.dictionary.take(pa.array(word[at])).cast(pa.string())})

    return run


def _count_phrases(min_count: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        size = table.column("size").to_numpy()
        read = [unpacked(m, n, "<i8", "<i8", "<u4") for m, n in zip(table.column("message"), size.tolist())]
        left = np.concatenate([np.cumsum(r[0]) for r in read])
        right, n = (np.concatenate([r[k] for r in read]) for k in (1, 2))
        stretch = np.repeat(table.column("stretch").to_numpy(), size)
        place = np.concatenate([np.arange(k) for k in size])
        order = np.lexsort((right, left))
        left, right, stretch, place = left[order], right[order], stretch[order], place[order]
        group = np.cumsum((np.diff(left, prepend=-1) != 0) | (np.diff(right, prepend=-1) != 0))
        kept, rank, first, f = _summed(group, n[order].astype(np.int64), min_count)
        bucket = key[0].as_py()
        return _answers(bucket, stretch[kept], place[kept], rank, {
            **_ids(bucket, f), "left": pa.array(left[first]), "right": pa.array(right[first])})

    return run


def _relation(stretch, places: np.ndarray, phrase: np.ndarray, last: np.ndarray | None = None) -> pa.Table:
    ids, first, item = np.unique(phrase, return_index=True, return_inverse=True)
    return pa.table({
        "stretch": pa.array([stretch.as_py()], pa.int64()), "size": pa.array([len(places)], pa.int64()),
        "places": pa.array([packed(np.diff(places, prepend=0).astype("<u4"))], pa.binary()),
        "items": pa.array([packed(item.astype("<i4"))], pa.binary()),
        "ids": pa.array([packed(np.diff(ids, prepend=0).astype("<i8"))], pa.binary()),
        "lasts": pa.array([None if last is None else packed(last[first].astype("<i8"))], pa.binary())})


_NOTHING = pa.schema([("stretch", pa.int64()), ("size", pa.int64()), ("places", pa.binary()), ("items", pa.binary()),
                      ("ids", pa.binary()), ("lasts", pa.binary())]).empty_table()


def _frequent_words(key, relation: pa.Table, answers: pa.Table) -> pa.Table:
    """R1 of a stretch without its rare words."""
    if not relation.num_rows or not answers.num_rows:
        return _NOTHING
    size = relation.column("size")[0].as_py()
    item, = unpacked(relation.column("items")[0], size, "<i4")
    starts, = unpacked(relation.column("starts")[0], -(-size // 8), "u1")
    # A gap before each piece, so that adjacent places share a piece.
    places = np.arange(size) + np.cumsum(np.unpackbits(starts, count=size), dtype=np.int64)
    word = _known(answers, int(item.max()) + 1)[item]
    kept = word >= 0
    return _relation(key[0], places[kept], word[kept])


def _longer(row) -> tuple:
    """The merge of R(k) with itself on the next place: a phrase and the
    last word of the one that starts a place later. (places, distinct left,
    right and n, item of each place). What R1 has on the place after a
    phrase is that word, unless the phrase it ends is rare."""
    size, places, items, ids, lasts = row
    places, = unpacked(places, size.as_py(), "<u4")
    items, = unpacked(items, size.as_py(), "<i4")
    distinct = int(items.max(initial=-1)) + 1
    ids = np.cumsum(unpacked(ids, distinct, "<i8")[0])
    lasts = unpacked(lasts, distinct, "<i8")[0] if lasts.is_valid else ids
    places = np.cumsum(places, dtype=np.int64)
    next_to = np.flatnonzero(places[1:] == places[:-1] + 1)
    return places[next_to], *counted(ids[items[next_to]], lasts[items[next_to + 1]])


def _owned(left: np.ndarray, right: np.ndarray, buckets: int):
    """(owner, places) of the phrases, places rising."""
    key = mix(mix(left.astype(np.uint64)) + right.astype(np.uint64))
    return by_bucket((key % np.uint64(buckets)).astype(np.int64))


def _phrase_messages(buckets: int):
    """The longer phrases of every stretch and their counts, to their owners."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                stretch = batch.column("stretch")[i].as_py()
                _, left, right, n, _ = _longer([batch.column(c)[i] for c in ("size", "places", "items", "ids", "lasts")])
                yield _messages([(b, stretch, len(at), packed(
                    np.diff(left[at], prepend=0).astype("<i8"), right[at].astype("<i8"), n[at].astype("<u4")))
                    for b, at in _owned(left, right, buckets)])

    return run


def _frequent_phrases(buckets: int):
    """R(k + 1) of a stretch: the longer phrases that are frequent."""
    def run(key, relation: pa.Table, answers: pa.Table) -> pa.Table:
        if not relation.num_rows or not answers.num_rows:
            return _NOTHING
        places, left, right, _, item = _longer(
            [relation.column(c)[0] for c in ("size", "places", "items", "ids", "lasts")])
        phrase = _known(answers, len(left), dict(_owned(left, right, buckets)))[item]
        kept = phrase >= 0
        return _relation(key[0], places[kept], phrase[kept], right[item[kept]])

    return run


_SENT = "bucket long, stretch long, size long, message binary"
_ANSWERS = "bucket long, stretch long, size long, message binary, id array<long>, f array<long>, "


def counts(sent: DataFrame, count, columns: str, label: str) -> tuple[DataFrame, DataFrame]:
    """(answers, items) of the owners: per message its frequent items and
    their numbers, packed; and every frequent item once."""
    names = [c.split()[0] for c in columns.split(", ")]
    back = cut(sent.groupBy("bucket").applyInArrow(count, _ANSWERS + columns), label, "zstd")
    items = back.filter("id IS NOT NULL").select(F.inline(F.arrays_zip("id", "f", *names)))
    return back.filter("stretch IS NOT NULL").select("bucket", "stretch", "size", "message"), items


def _buckets(rows: DataFrame, size) -> int:
    """Owners for as many items as ``size`` adds up to over ``rows``."""
    return 1 + (rows.agg(F.sum(size)).first()[0] or 0) // OWNED


def mine(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): every phrase of 1 to ``max_words`` words with
    ``min_count`` occurrences in its lang: lang, words, f; and lang, n."""
    texts = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit(NO_LANG)).alias("lang"),
                        F.coalesce(docs["text"], F.lit("")).alias("text"))
    stretches = cut(texts.mapInArrow(_words, "stretch long, size long, starts binary, items binary, "
                                             "lang array<string>, word array<string>, n array<long>"), "R1", "zstd")
    totals = stretches.select(F.inline(F.arrays_zip("lang", "n"))).groupBy("lang").agg(F.sum("n").alias("n"))
    answers, items = counts(
        stretches.select("stretch", "lang", "word", "n").mapInArrow(
            _word_messages(_buckets(stretches, F.size("n"))), _SENT + ", text binary, langs array<string>"),
        _count_words(min_count), "lang array<string>, word array<string>", "F1")
    known = items.select("id", "lang", F.array("word").alias("words"), "f")
    phrases, single = known, known.select(F.col("id").alias("right"), F.col("words").alias("next"))
    relation, semi_join = stretches.select("stretch", "size", "starts", "items"), _frequent_words
    for length in range(2, max_words + 1):
        relation = cut(relation.groupBy("stretch").cogroup(answers.groupBy("stretch"))
                       .applyInArrow(semi_join, _RELATION), f"R{length - 1}", "zstd")
        owners = _buckets(relation, F.col("size"))
        answers, items = counts(
            relation.mapInArrow(_phrase_messages(owners), _SENT),
            _count_phrases(min_count), "left array<long>, right array<long>", f"F{length}")
        semi_join = _frequent_phrases(owners)
        known = cut(items.join(known.select(F.col("id").alias("left"), "lang", "words"), "left")
                    .join(single, "right")
                    .select("id", "lang", F.concat("words", "next").alias("words"), "f"), f"phrases{length}")
        phrases = phrases.unionByName(known)
    return phrases.select("lang", "words", "f"), totals


def _phrase(words: Column) -> Column:
    return F.array_join(words, " ")


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` candidates
    of every lang."""
    phrases, totals = mine(docs, min_count, max_words)
    counts = cut(phrases.withColumn("phrase", _phrase(F.col("words"))), "phrases")
    longer = counts.filter(F.size("words") > 1)

    # Candidates that a longer one holds.
    inner = F.expr("flatten(transform(sequence(2, size(words) - 1), k -> "
                   "transform(sequence(1, size(words) - k + 1), i -> array_join(slice(words, i, k), ' '))))")
    held = (counts.filter(F.size("words") > 2).select("lang", F.explode(inner).alias("phrase"), "f")
            .groupBy("lang", "phrase").agg(F.max("f").alias("held")))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    left = (longer.withColumnRenamed("f", "a").join(held, ["lang", "phrase"], "left")
            .filter(F.col("held").isNull() | (wide("held") * 100 < wide("a") * HELD_PERCENT))
            .select("lang", "phrase", "words", "a"))

    # Every cut of a candidate with the counts of its two parts.
    cuts = left.select("lang", "phrase", "a", F.explode(F.expr(
        "transform(sequence(1, size(words) - 1), k -> struct(k, array_join(slice(words, 1, k), ' ') AS head, "
        "array_join(slice(words, k + 1, size(words)), ' ') AS tail))")).alias("c")).select(
        "lang", "phrase", "a", "c.*")
    count = lambda part, f: counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(f))
    cuts = cuts.join(count("head", "l"), ["lang", "head"]).join(count("tail", "r"), ["lang", "tail"])
    score = F.call_function("div", wide("a") * SCORE_SCALE, wide("l") + wide("r"))
    best = (cuts.groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
            .select("lang", "phrase", "a", "best.l", "best.r", "best.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
        F.col("score").cast("long").alias("score"))


ORACLE_SQL = rf"""
WITH p AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, k, ws[i:i + k - 1] AS words FROM (
        SELECT lang, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i
        FROM (SELECT lang, ws, unnest(generate_series(1, {MAX_WORDS})) AS k FROM w))),
f AS (SELECT lang, words, array_to_string(words, ' ') AS phrase, k, count(*) AS f FROM g
      GROUP BY lang, words, k HAVING count(*) >= {MIN_COUNT}),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
held AS (SELECT lang, array_to_string(words[i:i + s - 1], ' ') AS phrase, max(f) AS held
         FROM (SELECT *, unnest(generate_series(1, k - s + 1)) AS i
               FROM (SELECT *, unnest(generate_series(2, k - 1)) AS s FROM f WHERE k > 2)) GROUP BY 1, 2),
c AS (SELECT f.* FROM f LEFT JOIN held USING (lang, phrase)
      WHERE k > 1 AND (held IS NULL OR 100 * held::HUGEINT < {HELD_PERCENT} * f::HUGEINT)),
cuts AS (SELECT c.lang, c.phrase, c.f AS a, x.cut, l.f AS l, r.f AS r,
                ({SCORE_SCALE} * c.f::HUGEINT) // (l.f + r.f) AS score
         FROM (SELECT *, unnest(generate_series(1, k - 1)) AS cut FROM c) x JOIN c USING (lang, phrase)
         JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(x.words[1:x.cut], ' ')
         JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(x.words[x.cut + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n.n AS n,
       score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}
"""
