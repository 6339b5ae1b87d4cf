"""Quality rules, line first, in DataFrame functions only.

Every line that holds a word is judged by itself:

* punctuation: at least ``MARKED_WORDS`` of its words end in a symbol, an
  exclamation mark or a repeated mark, or more than ``SYMBOL_SHARE`` of its
  characters are symbols;
* navigation: at least ``PIPES`` separators (``|``, ``»``, ``>``, ``•``)
  that stand alone, one for every five words or more;
* boilerplate: a phrase of ``BOILERPLATE`` in a line of at most
  ``BOILERPLATE_WORDS`` words.

Lines that fail are removed. A document is rejected when the base rules
fail (fewer than ``LEAST_WORDS`` words, or more than a fifth of its words
inside repeated 5-word windows) or when removed lines held more than
``MOST_LOST`` of its words.

Defined results: null text is empty and fails the base rules; words are
runs of code points other than space and 0x09-0x0D; repeated rows are
judged each on their own; an empty table gives an empty result. 5-word
windows are compared by 64-bit hashes inside one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewx.llm.common import SPACE_RUN, WORD, keyed

LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5
MARKED_WORDS, SYMBOL_SHARE, PIPES, BOILERPLATE_WORDS, MOST_LOST = 0.3, 0.1, 2, 40, 0.3
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
BOILERPLATE = ("all rights reserved|terms of (use|service)|privacy policy|cookie policy|"
               "enable javascript|subscribe to our|sign up for|click here")

#: One marked word, one separator that stands alone (both with the space
#: before them), as regular expressions.
MARKED = r"[^\x20\x09-\x0D][#*$%&|<>!]+[.,;:]?(?:[\x20\x09-\x0D]|$)"
SEPARATOR = r"(?:^|[\x20\x09-\x0D])[|»>•](?:[\x20\x09-\x0D]|$)"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def removed_chars(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are in ``chars``."""
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def repeated_words(words: Column, k: int = WINDOW) -> Column:
    """Words inside k-word windows that occur twice or more. Windows without
    a twin cost one hash each; only texts with twins are sorted."""
    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(F.slice(w, i, k)))

    def covered(pos: Column) -> Column:
        # Sorted starts: each adds the words up to the next start, k at most.
        gap = F.transform(pos, lambda x, i: F.least(F.coalesce(F.get(pos, i + 1) - x, F.lit(k)), F.lit(k)))
        return F.aggregate(gap, F.lit(0), lambda a, x: a + x)

    def twins(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            hit = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
            return F.array_sort(F.transform(hit, lambda x: x["i"]))

        return let(let(pairs, starts), covered)

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(twins(h))

    return let(words, lambda w: F.when(F.size(w) < k, 0).otherwise(let(windows(w), count)))


def line_fails(line: Column, n: Column) -> Column:
    """Whether a line of ``n`` (> 0) words fails a rule."""
    symbols = removed_chars(line, SYMBOLS)
    marked = F.regexp_count(line, F.lit(MARKED))
    bars = F.regexp_count(line, F.lit(SEPARATOR))
    some = symbols + removed_chars(line, "!»•") > 0
    return ((some & ((marked >= n * MARKED_WORDS) | (symbols > F.char_length(line) * SYMBOL_SHARE)
                     | ((bars >= PIPES) & (bars * 5 >= n))))
            | ((n <= BOILERPLATE_WORDS) & F.lower(line).rlike(BOILERPLATE)))


def word_count(text: Column) -> Column:
    return F.size(word_list(text))


def clean(docs: DataFrame) -> DataFrame:
    """row, doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, lost_words, kept, clean_text (the lines
    that pass, and those without a word, in order)."""
    rows = keyed(docs, "doc_id", "text")
    text = F.col("text")

    def judged(line: Column) -> Column:
        return let(word_count(line), lambda n: F.struct(
            line.alias("line"), n.alias("n"), F.when(n > 0, line_fails(line, n)).otherwise(False).alias("fails")))

    def summary(lines: Column) -> Column:
        full = F.filter(lines, lambda x: x["n"] > 0)
        return F.struct(
            F.aggregate(lines, F.lit(0), lambda a, x: a + x["n"]).alias("n_words"),
            let(F.transform(full, lambda x: x["line"]),
                lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
            F.aggregate(lines, F.lit(0), lambda a, x: a + F.when(x["fails"], x["n"]).otherwise(0)).alias("lost"),
            F.array_join(F.transform(F.filter(lines, lambda x: ~x["fails"]), lambda x: x["line"]), "\n").alias("clean"))

    lines = F.transform(F.split(text, "\n"), judged)
    out = rows.select("row", "doc_id", let(lines, summary).alias("s"),
                      (F.char_length(text) - removed_chars(text, SPACES)).alias("word_chars"),
                      removed_chars(text, SYMBOLS).alias("n_symbols"),
                      repeated_words(word_list(text)).alias("n_repeat_words"))
    n, rep = F.col("s.n_words"), F.col("n_repeat_words")
    out = out.select("row", "doc_id", n.cast("long").alias("n_words"), F.col("word_chars").cast("long"),
                     F.col("n_symbols").cast("long"), F.col("s.n_dup_lines").cast("long").alias("n_dup_lines"),
                     rep.cast("long"), ((n < LEAST_WORDS) | (100 * rep > MOST_REPEATED * n)).alias("base_failed"),
                     F.col("s.lost").cast("long").alias("lost_words"), F.col("s.clean").alias("clean_text"))
    kept = ~F.col("base_failed") & (F.col("lost_words") <= F.col("n_words") * MOST_LOST)
    return out.withColumn("kept", kept)


# The same in DuckDB, over ``documents``.
_SYM = "length(regexp_replace({0}, '[^#*$%&|<>]', '', 'g'))"
ORACLE_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS words FROM t),
windows AS (
  SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS g
  FROM (SELECT r, words, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS i FROM w)),
twins AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n
        FROM (SELECT r, unnest(generate_series(i, i + {WINDOW - 1})) AS p FROM twins) GROUP BY r),
lines AS (SELECT r, line, len(regexp_extract_all(line, '{WORD}')) AS n
          FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t)),
judged AS (
  SELECT r, line, n,
    ((({_SYM.format('line')} + length(regexp_replace(line, '[^!»•]', '', 'g'))) > 0
      AND (len(regexp_extract_all(line, '{MARKED}')) >= n * {MARKED_WORDS}
           OR {_SYM.format('line')} > length(line) * {SYMBOL_SHARE}
           OR (len(regexp_extract_all(line, '{SEPARATOR}')) >= {PIPES}
               AND len(regexp_extract_all(line, '{SEPARATOR}')) * 5 >= n)))
     OR (n <= {BOILERPLATE_WORDS} AND regexp_matches(lower(line), '{BOILERPLATE}'))) AS fails
  FROM lines WHERE n > 0),
per_doc AS (SELECT r, count(*) - count(DISTINCT line) AS dup,
                   sum(CASE WHEN fails THEN n ELSE 0 END) AS lost FROM judged GROUP BY r),
m AS (
  SELECT doc_id, len(words) AS n_words,
    length(regexp_replace(text, '{SPACE_RUN}', '', 'g')) AS word_chars,
    {_SYM.format('text')} AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM w LEFT JOIN rep USING (r) LEFT JOIN per_doc USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words)
    AND lost <= n_words * {MOST_LOST} AS kept
FROM m
"""
