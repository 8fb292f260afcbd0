"""Line-first quality rules, in DataFrame functions only.

Every line is judged by itself: it must end like a sentence, must not be a
menu, a boilerplate phrase, a line of symbols or shouting. Failing lines are
removed, and a document that loses too much of its text is rejected.

Defined results: a null text counts as empty; an empty text has no words and is
rejected by the base rule; repeated rows are judged alike; columns of the input
other than the text are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import stored

SPACE = r"[\x20\x09-\x0D]"
WORD_LINE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Percentage of words in repeated three-word windows above which a document is rejected.
MAX_REPEAT_PERCENT = 50
#: Least percentage of the characters of the lines that has to be left after the failing lines are gone.
MIN_LEFT_PERCENT = 50

#: How a sentence ends: one of the marks, then any closing quotes, brackets and white space.
END_MARKS, CLOSERS = ".!?:;…。！？", "\"'”’»)]\x20\x09\x0a\x0b\x0c\x0d"
#: A line with three of these separators, and one for every six words at least, is navigation.
SEPARATORS, MENU_SEPARATORS, MENU_WORDS = "|»›•·", 3, 6
#: Quotation marks: a separator that has its counterpart in the line is none.
COUNTERPARTS = {"»": "«", "›": "‹"}
# Phrases of boilerplate lines, lower case.
BOILERPLATE = (
    "all rights reserved", "licensed under", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "accept cookies", "enable javascript", "lorem ipsum", "subscribe to our newsletter", "sign up for", "click here",
    "copyright (c)", "copyright ©",
)
#: A line fails above this percentage of symbols among its characters.
MAX_SYMBOL_PERCENT = 8


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit("\x20\x09\x0a\x0b\x0c\x0d"))
    return F.when(trimmed != "", F.split(trimmed, SPACE + "+")).otherwise(F.array().cast("array<string>"))


def symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, "[" + SYMBOLS + "]+", ""))


def line_ok(line: Column, any_symbols: Column) -> Column:
    """The rules for one line; ``any_symbols`` says if the document has a symbol at all."""
    lower = F.lower(line)
    lower = F.lower(line)
    count = lambda mark: F.length(line) - F.length(F.replace(line, F.lit(mark), F.lit("")))
    boilerplate, separated, separators = F.lit(False), F.lit(False), F.lit(0)
    for mark in SEPARATORS:
        separated = separated | line.contains(mark)
        quotes = count(COUNTERPARTS[mark]) if mark in COUNTERPARTS else F.lit(0)
        separators = separators + F.greatest(count(mark) - quotes, F.lit(0))
    menu = separated & (separators >= MENU_SEPARATORS) & (separators * MENU_WORDS >= F.size(words(line)))
    for phrase in BOILERPLATE:
        boilerplate = boilerplate | lower.contains(phrase)
    return (
        F.substring(F.rtrim(line, F.lit(CLOSERS)), -1, 1).isin(*END_MARKS)
        & ~(any_symbols & (symbols(line) * 100 > F.length(line) * MAX_SYMBOL_PERCENT))
        & ~menu & ~(line.contains("!!") & (line == F.upper(line))) & ~boilerplate
    )


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and, under ``__q_`` names, the measures and verdicts of each row."""
    df = docs.withColumn("__q_text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumns({
        "__q_words": words(F.col("__q_text")),
        "__q_lines": F.filter(F.split(F.col("__q_text"), "\n"), lambda x: x.rlike(WORD_LINE)),
        "__q_symbols": symbols(F.col("__q_text")),
    })
    df = df.withColumns({
        "__q_n": F.size("__q_words"),
        "__q_chars": F.length(F.array_join("__q_words", "")),
        "__q_good": F.filter(F.col("__q_lines"), lambda x: line_ok(x, F.col("__q_symbols") > 0)),
        "__q_dup_lines": F.size("__q_lines") - F.size(F.array_distinct("__q_lines")),
        "__q_windows": window_hashes(F.col("__q_words")),
    }).drop("__q_words")
    df = df.withColumn("__q_bits", F.length(F.bin(F.size("__q_windows"))))
    df = df.withColumns({
        "__q_keys": sorted_windows(F.col("__q_windows"), F.col("__q_bits")),
        "__q_low": F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("__q_bits")) - 1,
    })
    df = df.withColumn("__q_repeats", repeated_starts(F.col("__q_keys"), F.col("__q_windows"), F.col("__q_low")))
    df = df.withColumns({
        "__q_repeat_words": covered_words(F.col("__q_repeats")),
        "__q_total": F.length(F.array_join("__q_lines", "")), "__q_left": F.length(F.array_join("__q_good", "")),
    })
    failed = (F.col("__q_n") < MIN_WORDS) | (F.col("__q_repeat_words") * 100 > F.col("__q_n") * MAX_REPEAT_PERCENT)
    df = df.withColumn("__q_failed", failed)
    return df.withColumn("__q_kept", ~F.col("__q_failed") & (F.col("__q_left") * 100 >= F.col("__q_total") * MIN_LEFT_PERCENT))


def window_hashes(w: Column) -> Column:
    """A 64-bit hash of each window of three words, in text order."""
    hashed = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) >= 3, hashed).otherwise(F.array().cast("array<bigint>"))


def sorted_windows(h: Column, bits: Column) -> Column:
    """Hash and position of each window in one 64-bit number, sorted, so that equal windows are neighbours.

    The position takes as many low bits as the number of windows needs.
    """
    packed = F.transform(h, lambda x, i: F.call_function("shiftleft", x, bits).bitwiseOR(i.cast("bigint")))
    return F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(packed)).otherwise(F.array().cast("array<bigint>"))


def repeated_starts(keys: Column, h: Column, low: Column) -> Column:
    """Sorted starts of the windows that occur twice or more; neighbours are compared by their full hashes."""
    start = lambda k: k.bitwiseAND(low).cast("int")
    hashed = lambda i: F.get(h, start(F.get(keys, i)))
    twice = F.filter(keys, lambda k, i: F.coalesce(F.get(h, start(k)) == hashed(i - 1), F.lit(False))
                     | F.coalesce(F.get(h, start(k)) == hashed(i + 1), F.lit(False)))
    return F.sort_array(F.transform(twice, start))


def covered_words(starts: Column) -> Column:
    """Words inside at least one of the three-word windows at these sorted starts."""
    steps = F.transform(starts, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - x, F.lit(3))))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _measures() -> list[Column]:
    long = lambda c: F.col(c).cast("bigint")
    return [
        long("__q_n").alias("n_words"), long("__q_chars").alias("word_chars"), long("__q_symbols").alias("n_symbols"),
        long("__q_dup_lines").alias("n_dup_lines"), long("__q_repeat_words").alias("n_repeat_words"),
        F.col("__q_failed").alias("base_failed"), F.col("__q_kept").alias("kept"), F.size("__q_lines").cast("bigint").alias("n_lines"),
        F.size("__q_good").cast("bigint").alias("n_good_lines"), long("__q_left").alias("left_chars")]


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document with the measures, the base verdict and the verdict of the line rules."""
    return judged(docs.select("doc_id", "text")).select("doc_id", *_measures())


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their failing lines removed and ``n_chars`` brought up to date.

    The verdicts are written before they filter: a filter or a narrow selection on top of the measures would make the
    optimizer put their expressions into each other and evaluate them once for every use.
    """
    own = F.struct(*(F.array_join("__q_good", "\n").alias("text") if c == "text" else F.col(c) for c in docs.columns))
    kept = stored(judged(docs).select(own.alias("row"), F.struct(*_measures()).alias("quality")), "quality").where("quality.kept").select("row.*")
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept
