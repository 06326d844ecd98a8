"""Line-first quality rules, with DataFrame functions only.

Each line of a text is judged by itself; lines that fail a rule, and repeats of
earlier lines, go; a document that loses more than half of the characters of
its lines is rejected, as is one that fails the two base rules.

Everything is computed inside the row, so there is no shuffle. Repeated
8-word windows are found by sorting hashes of the windows of one text.

Defined results: a null or empty text has no words, zero counts, base_failed,
kept false and cleaned text "". Repeated rows give repeated results. An empty
table gives an empty table. Other columns pass through in clean(); those named
like an output are replaced.
"""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import SPACES, let

#: Fixed values of the base rules: symbols, window, share of repeated words in percent, least words.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MOST_REPEATED = 30
LEAST_WORDS = 20

#: Phrases of boilerplate lines, in four languages; matched without regard to ASCII case.
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "enable javascript",
    "click here",
    "sign up for our newsletter",
    "skip to content",
    "lorem ipsum",
    "tous droits r[ée]serv[ée]s",
    "politique de confidentialit[ée]",
    "mentions l[ée]gales",
    "accepter les cookies",
    "alle rechte vorbehalten",
    "datenschutzerkl[äa]rung",
    "cookies akzeptieren",
    "todos los derechos reservados",
    "pol[íi]tica de privacidad",
    "aceptar cookies",
)
#: Whole lines of navigation, in four languages.
NAVIGATION = (
    *("home", "menu", "login", "log in", "sign in", "next", "previous", "back to top", "read more", "share", "search"),
    *("accueil", "connexion", "rechercher", "partager", "suivant", "haut de page", "lire la suite"),
    *("startseite", "anmelden", "suche", "teilen", "weiter", "nach oben", "mehr lesen"),
    *("inicio", "iniciar sesi[óo]n", "buscar", "compartir", "siguiente", "volver arriba", "leer m[áa]s"),
)
#: Three separators of a menu or a path with short labels between them; a rule of structure, for any language.
SEPARATED = "([|»›·•→][^|»›·•→]{0,30}){3}"
#: A line of this many characters without any sentence punctuation is no prose.
LONG_LINE = 80
#: A line fails with one symbol, or one double exclamation mark, for at most this many characters.
CHARS_PER_MARK = 20

#: The longest plain piece of each phrase; a text without any of them in lower case has no boilerplate line.
BOILERPLATE_PIECES = tuple(max(re.split(r"\[.*?\]", phrase), key=len) for phrase in BOILERPLATE)
BOILERPLATE_PATTERN = "(?i)(" + "|".join(BOILERPLATE) + ")"
NAVIGATION_PATTERN = "(?i)^[ \\t\\r]*(" + "|".join(NAVIGATION) + ")[ \\t\\r.:>|]*$"


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def may_be_boilerplate(text: Column) -> Column:
    """Cheap and never false for a text with a boilerplate line, so that most texts are spared the patterns."""
    return let(F.lower(text), lambda low: functools.reduce(operator.or_, (F.contains(low, F.lit(p)) for p in BOILERPLATE_PIECES)))


def line_fails(line: Column, may_be: Column) -> Column:
    """Punctuation, shouting, navigation and boilerplate rules for one line of a text with this may_be_boilerplate."""
    size = F.length(line)
    symbols = size - F.length(F.translate(line, SYMBOLS, ""))
    shouts = (size - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
    return (
        (symbols * CHARS_PER_MARK > size)
        | (shouts * CHARS_PER_MARK > size)
        | ((size >= LONG_LINE) & ~line.rlike("[.!?:;…]"))
        | (line.rlike("[A-Z]{2}") & ~line.rlike("[a-z]") & (size >= LONG_LINE))
        | line.rlike(SEPARATED)
        | line.rlike(NAVIGATION_PATTERN)
        | (may_be & line.rlike(BOILERPLATE_PATTERN))
    )


def repeated_words(tokens: Column) -> Column:
    """Number of words in windows of WINDOW words that occur twice or more in the text."""

    def covered(hashes: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            marks = F.transform(
                s,
                lambda e, j: F.when(
                    (e["h"] == F.get(s, j - 1)["h"]) | (e["h"] == F.get(s, j + 1)["h"]),
                    e["i"],
                ),
            )
            return let(
                F.sort_array(F.filter(marks, lambda i: i.isNotNull())),
                lambda at: F.aggregate(
                    F.transform(at, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW)))),
                    F.lit(0).cast("long"),
                    lambda total, x: total + x,
                ),
            )

        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(F.sort_array(pairs), of_sorted))

    def wider(hashes: Column, by: int) -> Column:
        """Hashes of windows of 2 * by words from those of `by` words."""
        return let(hashes, lambda h: F.zip_with(F.slice(h, 1, F.size(h) - by), F.slice(h, by + 1, F.size(h) - by), lambda a, b: F.xxhash64(a, b)))

    def windows(ids: Column) -> Column:
        return wider(wider(wider(ids, 1), 2), 4)

    return F.when(F.size(tokens) < WINDOW, F.lit(0).cast("long")).otherwise(let(windows(F.transform(tokens, lambda w: F.xxhash64(w))), covered))


def judge(text: Column) -> Column:
    """A struct of a text's counts, base_failed, kept and the cleaned text."""
    raw = F.coalesce(text.cast("string"), F.lit(""))
    size = F.length(raw)
    n_symbols = size - F.length(F.translate(raw, SYMBOLS, ""))
    word_chars = F.length(F.translate(raw, " \t\n\x0b\x0c\r", ""))
    lines = F.filter(F.split(raw, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def chars(of: Column) -> Column:
        return F.aggregate(of, F.lit(0).cast("long"), lambda total, x: total + F.length(x))

    def by_line(all_lines: Column, may_be: Column) -> Column:
        def of_distinct(once: Column) -> Column:
            return let(
                F.filter(once, lambda x: ~line_fails(x, may_be)),
                lambda good: F.struct(
                    (F.size(all_lines) - F.size(once)).cast("long").alias("n_dup_lines"),
                    (F.size(once) - F.size(good)).cast("long").alias("n_failed_lines"),
                    chars(all_lines).alias("line_chars"),
                    chars(good).alias("good_chars"),
                    F.array_join(good, "\n").alias("cleaned"),
                ),
            )

        return let(F.array_distinct(all_lines), of_distinct)

    def by_word(tokens: Column) -> Column:
        return F.struct(F.size(tokens).cast("long").alias("n_words"), repeated_words(tokens).alias("n_repeat_words"))

    def verdict(x: Column) -> Column:
        failed = (x["w"]["n_words"] < LEAST_WORDS) | (100 * x["w"]["n_repeat_words"] > MOST_REPEATED * x["w"]["n_words"])
        loses = 2 * x["l"]["good_chars"] < x["l"]["line_chars"]
        return F.struct(
            x["w"]["n_words"].alias("n_words"),
            word_chars.cast("long").alias("word_chars"),
            n_symbols.cast("long").alias("n_symbols"),
            x["l"]["n_dup_lines"].alias("n_dup_lines"),
            x["w"]["n_repeat_words"].alias("n_repeat_words"),
            x["l"]["n_failed_lines"].alias("n_failed_lines"),
            failed.alias("base_failed"),
            (~failed & ~loses).alias("kept"),
            x["l"]["cleaned"].alias("cleaned"),
        )

    return let(F.struct(let(may_be_boilerplate(raw), lambda may_be: let(lines, lambda x: by_line(x, may_be))).alias("l"), let(words(raw), by_word).alias("w")), verdict)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: its counts and the verdict."""
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines", "base_failed", "kept")
    judged = docs.select(docs[doc_id].alias("doc_id"), judge(docs[text]).alias("rules"))
    return judged.select("doc_id", *(F.col(f"rules.{x}").alias(x) for x in fields))


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, with their cleaned text; n_chars follows the text where there is such a column."""
    kept = F.filter(F.array(judge(docs[text])), lambda rules: rules["kept"])  # a filter after the projection would judge twice
    both = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), F.explode(kept).alias("rules"))
    changed = {text: F.col("rules.cleaned")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("rules.cleaned").cast(docs.schema["n_chars"].dataType)
    return both.select(*(changed.get(c, F.col("doc")[c]).alias(c) for c in docs.columns))


_LINE_FAILS = f"""(
   (length(x) - length(translate(x, '{SYMBOLS}', ''))) * {CHARS_PER_MARK} > length(x)
   OR (length(x) - length(replace(x, '!!', ''))) / 2 * {CHARS_PER_MARK} > length(x)
   OR (length(x) >= {LONG_LINE} AND NOT regexp_matches(x, '[.!?:;…]'))
   OR (length(x) >= {LONG_LINE} AND regexp_matches(x, '[A-Z][A-Z]') AND NOT regexp_matches(x, '[a-z]'))
   OR regexp_matches(x, '{SEPARATED}')
   OR regexp_matches(x, '{NAVIGATION_PATTERN.replace(chr(92) + "t", chr(9)).replace(chr(92) + "r", chr(13))}')
   OR regexp_matches(x, '{BOILERPLATE_PATTERN}'))"""

ORACLE_COUNTS = f"""
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda t: t <> '') AS ws,
        list_filter(string_split(text, chr(10)), lambda t: regexp_matches(t, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
u AS (SELECT doc_id, i, list_aggregate(ws[i:i + {WINDOW - 1}], 'string_agg', ' ') AS win
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - {WINDOW - 1})) AS i FROM w WHERE len(ws) >= {WINDOW})),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM u) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM r, range({WINDOW}) AS t(o) GROUP BY doc_id),
l AS (SELECT doc_id, text, ws, ls, list_distinct(ls) AS once FROM w),
g AS (SELECT doc_id, text, len(ws) AS n_words, len(ls) - len(once) AS n_dup_lines,
        coalesce(list_sum(list_transform(ls, lambda t: length(t))), 0) AS line_chars,
        coalesce(list_sum(list_transform(list_filter(once, lambda x: NOT {_LINE_FAILS}), lambda t: length(t))), 0) AS good_chars,
        len(list_filter(once, lambda x: {_LINE_FAILS})) AS n_failed_lines
      FROM l),
q AS (SELECT g.doc_id, g.n_words::BIGINT AS n_words,
        length(regexp_replace(g.text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(g.text) - length(translate(g.text, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
        g.n_dup_lines::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
        g.n_failed_lines::BIGINT AS n_failed_lines, 2 * good_chars < line_chars AS loses
      FROM g LEFT JOIN c ON g.doc_id IS NOT DISTINCT FROM c.doc_id)"""

ORACLE_SQL = f"""WITH {ORACLE_COUNTS}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_failed_lines,
  (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AS base_failed,
  (NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND NOT loses) AS kept
FROM q"""
