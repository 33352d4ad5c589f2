"""Line-first quality rules, in DataFrame functions only.

Each line with a word is judged alone: navigation (menu separators, or a very
short line without end punctuation), boilerplate phrases in short lines, symbol
noise and shouting fail. Failing lines are removed; a document that loses too
large a share of its words that way, or that fails the base rules (too short,
too repetitive), is rejected. Every text is handled inside its row: no shuffle.

``let`` binds an array once as a lambda variable; otherwise Catalyst may copy
an expensive expression into the body that runs for every element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.common import SPACE_CLASS

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
MIN_WORDS, MAX_REPEAT_PCT, MAX_LOST_PCT = 50, 50, 50
SHORT_LINE_WORDS, PHRASE_LINE_WORDS = 4, 15
NAV_SEPARATORS = "|»›•"
END_MARKS = r"""[.!?:;…。][\x20\x09-\x0D"'”»)\]]*$"""
# fixed values: phrases that mark page furniture rather than prose
BOILERPLATE = ("accept cookies", "all rights reserved", "click here", "cookie policy", "log in", "privacy policy",
               "read more", "sign up", "skip to content", "subscribe now", "terms of service", "terms of use")


def let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def words_of(text: Column) -> Column:
    """Array of words ``[^\\x20\\x09-\\x0D]+``."""
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Windows are compared by the 64-bit hash of their three words: a false match
    needs a collision within one text. Sorting (hash, position) puts equal
    windows side by side; texts whose hashes are all distinct skip the sort.
    """

    def covered(hashes):
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        hits = let(ordered, lambda m: F.filter(F.transform(m, lambda x, k: F.when(
            (F.get(m, k - 1)["h"] == x["h"]) | (F.get(m, k + 1)["h"] == x["h"]), x["i"])), lambda i: i.isNotNull()))
        # every window adds its three words less those that the next one adds again
        return let(F.array_sort(hits), lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
            F.lit(0).cast("long"), lambda total, x: total + x))

    def count(w):
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))

    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(count(w)))


def line_fails(line: Column, n: Column) -> Column:
    """Verdict on one line of ``n`` words."""
    phrase = F.lower(line).rlike("|".join(BOILERPLATE)) & (n <= PHRASE_LINE_WORDS)
    menu = (count_of(line, NAV_SEPARATORS) >= 2) & (count_of(line, NAV_SEPARATORS) * 4 >= n)
    label = (n < SHORT_LINE_WORDS) & ~line.rlike(END_MARKS)
    noise = count_of(line, SYMBOLS) >= n
    shouting = (count_of(line, "!") >= 3) & (count_of(line, "!") >= n)
    return phrase | menu | label | noise | shouting


def with_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, clean_text)``; ``row`` packs all input columns, whatever their names.

    A NULL or empty text has no words: all counts are 0, it fails the base rules,
    and its clean text is the text itself. Lines are split at ``\\n``; a clean text
    differs from the text only if a line failed, and then holds the remaining
    lines with a word. Repeated rows are judged one by one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    one = base.select("row", "doc_id", "text", words_of(text).alias("words"), F.transform(lines, lambda x: let(
        F.size(words_of(x)), lambda n: F.struct(x.alias("line"), n.alias("n"), line_fails(x, n).alias("fails")))).alias("lines"))
    two = one.select(
        "row", "doc_id", "text", "lines", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct(F.transform("lines", lambda x: x["line"])))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.aggregate("lines", F.lit(0).cast("long"), lambda t, x: t + F.when(x["fails"], x["n"]).otherwise(0)).alias("lost"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)
    clean = F.when(F.col("lost") == 0, F.col("text")).otherwise(
        F.array_join(F.transform(F.filter("lines", lambda x: ~x["fails"]), lambda x: x["line"]), "\n"))
    return two.select("row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                      (~failed & (F.col("lost") * 100 <= F.col("n_words") * MAX_LOST_PCT)).alias("kept"), clean.alias("clean_text"))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of counts and verdicts per input row; see ``with_quality``."""
    return with_quality(docs, id_col, text_col).drop("row", "clean_text")


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The kept rows with their failing lines removed, columns as they came.
    ``length_col`` (if given) is set to the new text's length. No rows in, no rows out."""
    kept = with_quality(docs, id_col, text_col).filter("kept")
    return kept.select([F.col("clean_text").alias(c) if c == text_col else
                        F.length("clean_text").cast(docs.schema[c].dataType).alias(c) if c == length_col else
                        F.col("row").getField(c).alias(c) for c in docs.columns])


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
ws AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM ws),
win AS (SELECT doc_id, i, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c
        FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM win WHERE c IS NOT NULL) x WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, i FROM rep UNION ALL SELECT doc_id, i + 1 FROM rep
            UNION ALL SELECT doc_id, i + 2 FROM rep) x GROUP BY doc_id),
ls AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
l AS (SELECT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM ls WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
f AS (SELECT doc_id, line, n,
        (regexp_matches(lower(line), '@PHRASES@') AND n <= 15)
        OR (length(line) - length(translate(line, '|»›•', '')) >= 2 AND (length(line) - length(translate(line, '|»›•', ''))) * 4 >= n)
        OR (n < 4 AND NOT regexp_matches(line, '@END@'))
        OR length(line) - length(translate(line, '#*$%&|<>', '')) >= n
        OR (length(line) - length(replace(line, '!', '')) >= 3 AND length(line) - length(replace(line, '!', '')) >= n) AS fails
      FROM l),
g AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN fails THEN n ELSE 0 END) AS lost FROM f GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(ws.ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(d.text) - length(translate(d.text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(coalesce(g.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, coalesce(g.lost, 0) AS lost
      FROM d JOIN ws USING (doc_id) LEFT JOIN g USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost <= 50 * n_words AS kept
FROM m
""".replace("@PHRASES@", "|".join(BOILERPLATE)).replace("@END@", END_MARKS.replace("'", "''"))
