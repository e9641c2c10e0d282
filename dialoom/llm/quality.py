"""Line-first quality rules, DataFrame functions only."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, functions as F

from dialoom.llm.common import BLANKS, words

#: Marks that may end a line of prose.
ENDINGS = (".", "!", "?", "…", ":", ";", "。", "！", "？", '"', "'", "”", "’", "»", ")", "]")
#: Phrases of site furniture and licence notices, matched without case anywhere in a line.
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "terms of use", "terms of service", "privacy policy", "cookie policy", "cookie settings", "use cookies", "uses cookies",
    "enable javascript", "lorem ipsum", "subscribe to our", "click here", "copyright ©", "copyright (c)",
)
#: How a short line of navigation begins, without case.
NAVIGATION = r"^\W*(home|menu|log ?in|sign (in|up)|next page|previous page|read more|share (this|on)|skip to content|back to top|search)\b"
#: Separators of menu entries or table cells.
SEPARATORS = ("|", "›", "»", "•")


def count_of(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def line_passes(line: Column, nav_words: int = 8) -> Column:
    """The punctuation, navigation and boilerplate rules over one line.

    Blank lines pass: they carry no text. A line is shouted if it has cased letters,
    none of them small. The cheap tests come first: lambdas are evaluated in order.
    """

    def judge(x: Column) -> Column:
        low = F.lower(x)
        spaces = count_of(x, " ")
        symbols = F.regexp_count(x, F.lit(r"[#*$%&|<>{}\\]"))
        short_menu = (spaces < nav_words) & (low.rlike(NAVIGATION) | _any(x.contains(m) for m in SEPARATORS))
        long_menu = _any(x.contains(m) & (count_of(x, m) >= 2) for m in SEPARATORS)
        shouted = (x == F.upper(x)) & (x != low)
        boilerplate = F.exists(F.array(low), lambda y: _any(y.contains(p) for p in BOILERPLATE))
        return (x == "") | (F.substring(x, -1, 1).isin(*ENDINGS) & (symbols * 10 <= spaces + 1) & ~short_menu & ~long_menu & ~shouted & ~boilerplate)

    return F.exists(F.array(F.btrim(line, F.lit(BLANKS))), judge)  # binds the trimmed line once


def _any(tests) -> Column:
    return functools.reduce(operator.or_, tests)


def quality(docs: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, max_lost_percent: int = 30, keep: tuple[str, ...] = ()) -> DataFrame:
    """Judge whole texts line by line, then by what is left of them.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, kept_chars, lost_chars, clean_text (the passing lines),
    and those named in ``keep``. A document is rejected if it fails the base
    thresholds, or if failing lines hold more than ``max_lost_percent`` of the
    characters of its lines. A null text has no words and is rejected; repeated
    rows are judged alike; an empty table gives an empty one.

    Three-word windows are compared by 64-bit hashes within one text: their chance
    of a false repeat is below 1e-10 for a text of 20,000 words.
    """
    # Each of these steps is read more than once by the next, so that Catalyst doesn't inline it into a lambda.
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", *keep, text.alias("text"), words(F.col("text")).alias("w"), F.split(text, "\n", -1).alias("lines"))
    at = F.when(F.size("w") >= 3, F.sequence(F.lit(0), F.size("w") - 3)).otherwise(F.array().cast("array<int>"))
    window = F.transform(at, lambda i: F.struct(F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")))
    passed = F.filter("lines", line_passes)
    d = d.select(
        "doc_id", *keep, "text",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.filter("lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("worded"),
        F.aggregate("lines", F.lit(0), lambda a, x: a + F.length(x)).cast("long").alias("line_chars"),
        passed.alias("passed"), F.sort_array(window).alias("s"),
    )
    h = lambda i: F.get("s", i)["h"]
    twice = F.filter("s", lambda x, k: F.coalesce(x["h"] == h(k - 1), F.lit(False)) | F.coalesce(x["h"] == h(k + 1), F.lit(False)))
    d = d.select(
        "doc_id", *keep, "n_words", "word_chars", "line_chars",
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
        F.aggregate("passed", F.lit(0), lambda a, x: a + F.length(x)).cast("long").alias("kept_chars"),
        F.array_join("passed", "\n").alias("clean_text"),
        F.sort_array(F.transform(twice, lambda x: x["i"])).alias("p"),
    )
    covered = F.aggregate(F.transform("p", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("p", k + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    # Spark would push a filter on the verdict below all of this and spell every step out within its lambdas;
    # a projection with a row number it leaves as it is.
    d = d.withColumns({"n_repeat_words": covered.cast("long"), "row": F.monotonically_increasing_id()}).drop("p")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    d = d.withColumn("base_failed", failed | (F.col("row") < 0)).withColumn("lost_chars", F.col("line_chars") - F.col("kept_chars"))
    kept = ~F.col("base_failed") & (100 * F.col("lost_chars") <= max_lost_percent * F.col("line_chars"))
    return d.select("doc_id", *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "kept_chars", "lost_chars", "clean_text")
