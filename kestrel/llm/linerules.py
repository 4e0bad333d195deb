"""Quality rules by line-first cleaning, in DataFrame functions only.

Every line that holds a word is put to three families of rules; a line that fails
one is removed, and a document that loses too much of its text is rejected.

- Navigation: bars, bullets and arrows make up over a fifth of the line's words, or
  the line consists of menu words alone.
- Boilerplate: the line holds a phrase of notices, consent banners and sign-up calls
  (``BOILERPLATE``, in any case).
- Punctuation: over a fifth of the words carry runs of marks (``!!``, ``***``,
  ``%%%``), or the line neither ends with a sentence mark (closing quotes and brackets
  may follow) nor has one sentence mark in ``PROSE`` words inside.

A document is rejected when the removed lines hold more than ``max_lost`` of its word
characters. The base rules come first: fewer than ``least_words`` words, or more than
half of the words in three-word windows that occur twice or more in the text.

Everything is an expression of one row (no shuffle, no explode), so no document meets
another, and skew of any key plays no part. A row's working memory is a small multiple
of its longest text: its words, and an array of window hashes; only texts with a
repeated hash build the windows themselves, which are then compared whole.

Defined results: null and empty texts have no words, so all counts are 0, and they fail
the base rules; lines are cut at ``\\n`` alone; lines without a word are neither counted
nor removed; repeated rows and null ids keep their rows; an empty table gives an empty
result; columns named like the added ones are replaced, others are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SEPARATORS = r"[|»›•·→]"
MARK_RUNS = r"[!?*#$%&~^=_]{2,}"
SENTENCE_END = r"""[.!?…。！？]["'”’»)\]]*[\x20\x09-\x0D]*$"""
SENTENCE_MARK = r"[.!?…。！？][\x20\x09-\x0D]"
MENU = (r"(?i)^[^a-z]*(?:home|menu|about(?: us)?|contact(?: us)?|login|log in|sign in|sign up|register|search|sitemap|next|previous"
        r"|back|top|share|print|help|faq|shop|cart|blog|news|archive|forum|read more|more|skip to content)"
        r"(?:[^a-z]+(?:home|menu|about(?: us)?|contact(?: us)?|login|log in|sign in|sign up|register|search|sitemap|next|previous"
        r"|back|top|share|print|help|faq|shop|cart|blog|news|archive|forum|read more|more|skip to content))*[^a-z]*$")
BOILERPLATE = ("all rights reserved", "cookie policy", "uses cookies", "accept cookies", "privacy policy", "terms of use",
               "terms of service", "lorem ipsum", "enable javascript", "subscribe to our", "sign up for our", "newsletter",
               "click here", "follow us on", "powered by", "copyright ©", "copyright (c)")
PROSE = 60  # words to a sentence mark, at most, in a line without a mark at its end
RULES = ("navigation", "boilerplate", "punctuation")
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_ADDED = [*MEASURES, "_lines", "_rules", "_words", "_hashes", "_text"]


def bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once a row: inside the function of another
    array it would be worked out for every element."""
    return F.get(F.transform(F.array(value), use), 0)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _notice(text: Column) -> Column:
    low = F.lower(text)
    return F.greatest(*[F.contains(low, F.lit(p)) for p in BOILERPLATE])


def line_rules(text: Column) -> Column:
    """For each line the place in ``RULES`` (from 1) of the first rule that it fails,
    else 0."""
    def rule(x: Column, notice: Column) -> Column:
        line, n = x["line"], x["n"]
        menu = (F.regexp_count(line, F.lit(SEPARATORS)) * 5 > n) | line.rlike(MENU)
        marks = F.regexp_count(line, F.lit(MARK_RUNS)) * 5 > n
        open_end = ~line.rlike(SENTENCE_END) & (F.regexp_count(line, F.lit(SENTENCE_MARK)) * PROSE < n)
        return (F.when(n == 0, 0).when(menu, 1).when(notice & _notice(line), 2)
                .when(marks | open_end, 3).otherwise(0))

    counted = F.transform(F.split(text, "\n"), lambda x: F.struct(x.alias("line"), F.regexp_count(x, F.lit(WORD)).alias("n")))
    return bound(F.struct(counted.alias("lines"), _notice(text).alias("notice")),
                 lambda t: F.transform(t["lines"], lambda x: rule(x, t["notice"])))


def _repeat_words(words: Column, hashes: Column, window: int) -> Column:
    """Words inside windows that occur twice or more. Windows are sorted with their
    words, so that equal ones are neighbours; their places cover ``window`` words each."""
    at_place = F.transform(hashes, lambda h, i: F.struct(
        h.alias("h"), *[F.get(words, i + k).alias(f"w{k}") for k in range(window)], i.alias("at")))
    same = lambda x, y: F.coalesce((x["h"] == y["h"]), F.lit(False)) & F.forall(
        F.array(*[x[f"w{k}"] == y[f"w{k}"] for k in range(window)]), lambda b: F.coalesce(b, F.lit(False)))
    found = bound(F.sort_array(at_place), lambda p: F.transform(
        F.filter(F.transform(p, lambda x, i: F.struct(
            x["at"].alias("at"), (same(x, F.get(p, i - 1)) | same(x, F.get(p, i + 1))).alias("twice"))),
            lambda x: x["twice"]), lambda x: x["at"]))
    step = lambda acc, p: F.struct(
        (acc["total"] + window - F.greatest(F.lit(0), acc["until"] - p)).cast("long").alias("total"), (p + window).alias("until"))
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("until"))
    return F.aggregate(F.sort_array(found), start, step, lambda acc: acc["total"])


def measured(docs: DataFrame, text: str = "text", window: int = 3) -> DataFrame:
    """``docs`` with the base measures (``MEASURES``), ``_lines`` (of the text) and
    ``_rules``: the rule that each line fails, 0 for none."""
    docs = docs.drop(*[c for c in _ADDED if c != text])
    whole = F.coalesce(F.col(text), F.lit(""))
    split = docs.withColumns({"_words": words_of(whole), "_lines": F.split(whole, "\n"), "_text": whole})
    last = F.size("_words") - window
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    single = split.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    hashed = single.withColumns({
        "_hashes": F.transform(places, lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(window)])),
        "_rules": line_rules(F.col("_text"))})
    counted = F.filter("_lines", lambda x: x.rlike(WORD))
    return hashed.select(
        *docs.columns, "_lines", "_rules", F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.char_length("_text") - F.char_length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(counted) - F.size(F.array_distinct(counted))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("_hashes")) == F.size("_hashes"), F.lit(0).cast("long"))
        .otherwise(_repeat_words(F.col("_words"), F.col("_hashes"), window)).alias("n_repeat_words"))


def clean(docs: DataFrame, text: str = "text", least_words: int = 50, max_repeat: int = 50, max_lost: int = 40) -> DataFrame:
    """``docs`` with the base measures, ``base_failed``, ``kept``, ``failed_lines`` (lines
    removed by each of ``RULES``), ``lost_chars`` (word characters in them) and
    ``clean_text``: the text without them (``max_*`` in per cent)."""
    added = [*_ADDED, "base_failed", "kept", "failed_lines", "lost_chars", "clean_text"]
    docs = docs.drop(*[c for c in added if c != text])
    rows = measured(docs, text)
    pairs = F.arrays_zip("_lines", "_rules")
    removed = F.aggregate(pairs, F.lit(0).cast("long"), lambda acc, x: acc + F.when(
        x["_rules"] > 0, F.char_length(F.regexp_replace(x["_lines"], SPACE, ""))).otherwise(0))
    kept_lines = F.transform(F.filter(pairs, lambda x: x["_rules"] == 0), lambda x: x["_lines"])
    failed = F.transform(F.sequence(F.lit(1), F.lit(len(RULES))),
                         lambda n: F.size(F.filter("_rules", lambda r: r == n)).cast("long"))
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    out = rows.withColumns({"base_failed": base, "failed_lines": failed, "lost_chars": removed,
                            "clean_text": F.array_join(kept_lines, "\n")})
    verdict = ~F.col("base_failed") & (100 * F.col("lost_chars") <= max_lost * F.col("word_chars"))
    return out.select(*docs.columns, *MEASURES, "base_failed", verdict.alias("kept"), "failed_lines", "lost_chars", "clean_text")
