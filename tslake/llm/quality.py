"""Line-first quality rules, in DataFrame functions only.

Every line of a text with a word in it is judged on its own:

- punctuation: more than ``SYMBOL_SHARE`` of its visible characters are
  symbols, or more than ``SHOUT_SHARE`` are exclamation or question marks, or
  it has fewer than ``FRAGMENT_GAPS`` blanks and does not end a sentence;
- navigation: ``NAV_MARKS`` separators or more between short entries, of
  ``NAV_ENTRY`` visible characters each on average, or fewer;
- boilerplate: it holds one of the phrases ``BOILERPLATE`` and is at most
  ``BOILERPLATE_SPAN`` times as long as the phrase, so that a paragraph that once
  mentions one stands.

Failing lines are removed; a document is rejected when the removed lines held
more than ``MAX_LOST`` of its visible characters, or by the base rules.

Defined results: null text counts as empty, has no words and is rejected; rows
are independent, so repeated rows and ids stay; a text is judged whole; an
empty table gives no rows. The arrays of a text live inside its row: nothing
is shuffled, and a hot source or copy group costs no more than its rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslake.llm.common import let

OTHER_SPACE = r"[\x09-\x0D]"
SYMBOLS, SHOUTS, SEPARATORS = "#*$%&|<>", "!?", "|»›•"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOL_SHARE = 0.1
SHOUT_SHARE = 0.1
FRAGMENT_GAPS = 2
NAV_MARKS, NAV_ENTRY = 3, 40
BOILERPLATE_SPAN = 10
MAX_LOST = 0.3
TERMINAL = [".", "!", "?", "…", ":", ";", '"', "'", "”", "’", "»", ")", "。"]
BOILERPLATE = [
    "accept cookies",
    "cookie policy",
    "enable javascript",
    "privacy policy",
    "sign up for our newsletter",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
]


def count_of(text: Column, characters: str) -> Column:
    kind = f"[{characters}]"
    return F.when(text.rlike(kind), F.length(text) - F.length(F.regexp_replace(text, kind, ""))).otherwise(0)


def without_space(text: Column) -> Column:
    """``text`` without its white space; blanks go first, by a plain search."""
    solid = F.replace(text, F.lit(" "), F.lit(""))
    return let(solid, lambda x: F.when(x.rlike(OTHER_SPACE), F.regexp_replace(x, OTHER_SPACE, "")).otherwise(x))


def visible(text: Column) -> Column:
    """Code points that are not white space."""
    return F.length(without_space(text))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def repeated_words(word: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, the first included.

    Windows are first compared by 32 bits of a hash packed with the position,
    in one sort of long integers; only windows with equal bits are then
    compared as text, so the count is exact.
    """

    def window(w: Column, i: Column) -> list[Column]:
        return [F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)]

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(F.shiftright(a, 32) == F.shiftright(b, 32), F.lit(False))

    def candidates(w: Column) -> Column:
        keys = F.sort_array(
            F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.shiftleft(F.xxhash64(*window(w, i)), 32).bitwiseOR(i.cast("long")))
        )
        return let(keys, lambda k: F.filter(k, lambda x, j: same(x, F.get(k, j - 1)) | same(x, F.get(k, j + 1))))

    def covered(w: Column) -> Column:
        texts = F.sort_array(
            F.transform(
                candidates(w),
                lambda x: let(x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"), lambda i: F.struct(F.concat_ws(" ", *window(w, i)).alias("t"), i.alias("i"))),
            )
        )
        found = let(
            texts,
            lambda s: F.filter(s, lambda x, j: F.coalesce(x["t"] == F.get(s, j - 1)["t"], F.lit(False)) | F.coalesce(x["t"] == F.get(s, j + 1)["t"], F.lit(False))),
        )
        return F.size(F.array_distinct(F.flatten(F.transform(found, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    return F.when(F.size(word) >= 3, covered(word)).otherwise(F.lit(0)).cast("long")


def line_fails(line: Column) -> Column:
    def by_marks(solid: Column) -> Column:
        chars = F.length(solid)
        return (
            (count_of(solid, SYMBOLS) > SYMBOL_SHARE * chars)
            | (count_of(solid, SHOUTS) > SHOUT_SHARE * chars)
            | let(count_of(solid, SEPARATORS), lambda n: (n >= NAV_MARKS) & (chars <= NAV_ENTRY * (n + 1)))
        )

    def judged(solid: Column) -> Column:
        marks = F.when(solid.rlike(f"[{SYMBOLS}{SHOUTS}{SEPARATORS}]"), by_marks(solid)).otherwise(False)
        fragment = (F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) < FRAGMENT_GAPS) & ~F.substring(F.rtrim(line), -1, 1).isin(TERMINAL)
        # no phrase is long enough for a longer line
        short = F.length(line) <= BOILERPLATE_SPAN * max(map(len, BOILERPLATE))
        phrase = let(F.lower(line), lambda x: reduce(or_, [x.contains(p) & (F.length(line) <= BOILERPLATE_SPAN * len(p)) for p in BOILERPLATE]))
        boilerplate = F.when(short, phrase).otherwise(False)
        return (solid != "") & (marks | fragment | boilerplate)

    return let(without_space(line), judged)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the struct ``_quality``: the counts, the verdict and the
    cleaned text. A column of that name is replaced."""
    body = F.coalesce(F.col(text), F.lit(""))

    def by_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))

    def by_lines(lines: Column) -> Column:
        cleaned = F.array_join(F.filter(lines, lambda line: ~line_fails(line)), "\n")
        with_word = let(F.filter(lines, lambda line: line.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.size(x) - F.size(F.array_distinct(x)))
        return F.struct(with_word.cast("long").alias("n_dup_lines"), cleaned.alias("cleaned"))

    found = F.struct(
        let(words(body), by_words).alias("w"),
        let(F.split(body, "\n"), by_lines).alias("l"),
        visible(body).cast("long").alias("word_chars"),
        count_of(body, SYMBOLS).cast("long").alias("n_symbols"),
    )
    # generated, so that a filter on the verdict does not evaluate all of it once more
    first = docs.select(*[c for c in docs.columns if c != "_quality"], F.explode(F.array(found)).alias("_quality"))
    q = F.col("_quality")
    n_words, n_repeat = q["w"]["n_words"], q["w"]["n_repeat_words"]
    base_failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    lost = q["word_chars"] - visible(q["l"]["cleaned"])
    return first.withColumn(
        "_quality",
        F.struct(
            n_words.alias("n_words"),
            q["word_chars"].alias("word_chars"),
            q["n_symbols"].alias("n_symbols"),
            q["l"]["n_dup_lines"].alias("n_dup_lines"),
            n_repeat.alias("n_repeat_words"),
            base_failed.alias("base_failed"),
            (~base_failed & (lost <= MAX_LOST * q["word_chars"])).alias("kept"),
            lost.cast("long").alias("lost_chars"),
            q["l"]["cleaned"].alias("cleaned"),
        ),
    )


REPORT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars"]


def report(docs: DataFrame) -> DataFrame:
    """doc_id with the counts and verdicts of every whole text."""
    return measure(docs.select("doc_id", "text")).select("doc_id", *[F.col("_quality")[c].alias(c) for c in REPORT])


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The kept documents with their failing lines removed; all columns stay."""
    return measure(docs, text).filter(F.col("_quality")["kept"]).withColumn(text, F.col("_quality")["cleaned"]).select(*[c for c in docs.columns])


def _sql_count(expression: str, characters: str) -> str:
    quoted = characters.replace("'", "''")
    return f"(length({expression}) - length(translate({expression}, '{quoted}', '')))"


_WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_VISIBLE = f"length(translate(%s, {_WS}, ''))"
_TERMINAL = ", ".join("'" + t.replace("'", "''") + "'" for t in TERMINAL)
_PHRASES = " OR ".join(f"(contains(lower(line), '{p}') AND length(line) <= {BOILERPLATE_SPAN * len(p)})" for p in BOILERPLATE)

SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS tri
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT rid, count(DISTINCT p) AS n
        FROM (SELECT win.rid, unnest([i, i + 1, i + 2]) AS p
              FROM win JOIN (SELECT rid, tri FROM win GROUP BY ALL HAVING count(*) > 1) USING (rid, tri))
        GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
vis AS (SELECT rid, line, {_VISIBLE % 'line'} AS chars FROM lines),
judged AS (SELECT rid, line, chars,
             {_sql_count('line', SYMBOLS)} > {SYMBOL_SHARE}::DOUBLE * chars
             OR {_sql_count('line', SHOUTS)} > {SHOUT_SHARE}::DOUBLE * chars
             OR ({_sql_count('line', ' ')} < {FRAGMENT_GAPS} AND right(rtrim(line, ' '), 1) NOT IN ({_TERMINAL}))
             OR ({_sql_count('line', SEPARATORS)} >= {NAV_MARKS} AND chars <= {NAV_ENTRY} * ({_sql_count('line', SEPARATORS)} + 1))
             OR {_PHRASES} AS failed
           FROM vis WHERE chars > 0),
by_line AS (SELECT rid, count(*) - count(DISTINCT line) AS dup, coalesce(sum(chars) FILTER (failed), 0) AS lost
            FROM judged GROUP BY rid),
b AS (SELECT d.rid, doc_id, len(ws)::BIGINT AS n_words, ({_VISIBLE % 't'})::BIGINT AS word_chars,
        ({_sql_count('t', SYMBOLS)})::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_chars
      FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN by_line USING (rid)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND lost_chars <= {MAX_LOST}::DOUBLE * word_chars AS kept, lost_chars
FROM f
"""
