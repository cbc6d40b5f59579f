"""Line-first cleaning: rules per line, failing lines go, documents that lose too much are rejected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

# Characters and phrases that the rules look for.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
SEPARATORS = r"[|»›>•·]"
TERMINAL = r"[.!?:;…。\"'”’»)\]]$"
MARKS = r"[\p{Punct}\p{IsPunctuation}&&[^'’-]]+"
BOILERPLATE = (
    "lorem ipsum", "javascript", "cookie policy", "we use cookies", "accept all cookies", "privacy policy",
    "terms of use", "terms of service", "all rights reserved", "click here", "subscribe to our", "sign up for",
    "log in to", "share this", "follow us on", "back to top", "powered by",
)

#: A document needs so many words, and at most so many percent of them in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: A line without a closing mark passes if it has at least so many words.
OPEN_LINE_WORDS = 5
#: Punctuation and symbols may be so large a share of a line's characters in words.
MAX_MARK_SHARE = 0.25
#: A line is navigation if it has so many separators and one for so many words or fewer.
MIN_SEPARATORS, WORDS_PER_SEPARATOR = 3, 5
#: A line of at most so many words with a boilerplate phrase goes.
BOILERPLATE_WORDS = 25
#: A document is rejected if less than this share of its characters in words stays.
MIN_KEPT_SHARE = 0.5


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def _first_words(text: Column) -> Column:
    """The words, with all after the first BOILERPLATE_WORDS in one: as many as the rules on few words look at."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE, BOILERPLATE_WORDS + 1))


def _line_parts(line: Column) -> Column:
    """What the rules look at, so that each is computed once per line."""
    bare = F.regexp_replace(line, SPACE, "")
    return F.struct(
        line.alias("line"),
        F.length(bare).alias("letters"),
        F.length(F.regexp_replace(bare, MARKS, "")).alias("unmarked"),
        F.size(_first_words(line)).alias("words"),
    )


def line_verdict(part: Column) -> Column:
    """Name of the first rule that a line fails, else null; a line without words passes.

    `part` comes from _line_parts; `words` is exact up to BOILERPLATE_WORDS and larger by one where there are more.
    """
    line, letters = part["line"], part["letters"]
    separators = F.length(line) - F.length(F.regexp_replace(line, SEPARATORS, ""))
    navigation = line.rlike(f"{SEPARATORS}.*{SEPARATORS}") & (separators >= MIN_SEPARATORS) & (
        F.size(_words(line)) <= WORDS_PER_SEPARATOR * separators
    )
    low = F.lower(line)
    boilerplate = F.lit(False)
    for phrase in BOILERPLATE:
        boilerplate = boilerplate | low.contains(phrase)
    return (
        F.when(letters == 0, None)
        .when(navigation, "navigation")
        .when(letters - part["unmarked"] > MAX_MARK_SHARE * letters, "punctuation")
        .when((part["words"] < OPEN_LINE_WORDS) & ~F.rtrim(line).rlike(TERMINAL), "punctuation")
        .when((part["words"] <= BOILERPLATE_WORDS) & boilerplate, "boilerplate")
    )


def _is_repeated(pairs: Column) -> Callable[[Column, Column], Column]:
    def repeated(pair: Column, at: Column) -> Column:
        before = F.when(at > 0, F.get(pairs, at - 1)["h"] == pair["h"])
        return F.coalesce(before, F.lit(False)) | F.coalesce(F.get(pairs, at + 1)["h"] == pair["h"], F.lit(False))

    return repeated


def _covered(starts: Column) -> Column:
    """Words inside windows that begin at the sorted `starts`."""
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + s + WINDOW - F.greatest(s, acc["end"])).alias("n"), (s + WINDOW).alias("end")
        ),
        lambda acc: acc["n"].cast("long"),
    )


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Windows are compared by 64-bit hashes within one text. Only texts with a repeated window are sorted.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = docs.withColumn("_words", _words(text))
    parts = parts.withColumn(
        "_grams",
        F.when(
            F.size("_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, WINDOW))
            ),
        ),
    )
    parts = parts.withColumn("_repeats", F.size(F.array_distinct("_grams")) < F.size("_grams"))
    # (hash, place) of every window, sorted: equal windows are neighbours. A column of its own, as lambdas look into it
    parts = parts.withColumn(
        "_pairs",
        F.when(
            F.col("_repeats"),
            F.array_sort(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    parts = parts.withColumn(
        "_starts",
        F.sort_array(F.transform(F.filter("_pairs", _is_repeated(F.col("_pairs"))), lambda pair: pair["i"])),
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (
        parts.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"))
        .withColumn(
            "n_dup_lines",
            F.when(F.instr(text, "\n") > 0, F.size(lines) - F.size(F.array_distinct(lines))).otherwise(0).cast("long"),
        )
        .withColumn(
            "n_repeat_words",
            F.coalesce(_covered(F.col("_starts")), F.lit(0).cast("long")),
        )
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
        .drop("_words", "_grams", "_repeats", "_pairs", "_starts")
    )


def clean_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with clean_text, n_lines, n_removed and kept_share: lines that fail a rule are removed.

    A text without characters in words keeps all it has (share 1). A null text counts as empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = F.transform(F.split(text, "\n"), _line_parts)
    judged = docs.withColumn(
        "_lines", F.transform(parts, lambda x: F.struct(x["line"].alias("line"), line_verdict(x).alias("rule")))
    )
    kept = F.filter("_lines", lambda x: x["rule"].isNull())
    judged = judged.withColumn(
        "clean_text",
        F.when(F.size(kept) == F.size("_lines"), text).otherwise(F.array_join(F.transform(kept, lambda x: x["line"]), "\n")),
    )

    def bare(c: Column) -> Column:
        return F.length(F.regexp_replace(c, SPACE, ""))

    all_chars = bare(text)
    return (
        judged.withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_removed", F.size(F.filter("_lines", lambda x: x["rule"].isNotNull())).cast("long"))
        .withColumn(
            "kept_share",
            F.when((F.col("n_removed") == 0) | (all_chars == 0), 1.0).otherwise(bare(F.col("clean_text")) / all_chars),
        )
        .drop("_lines")
    )


def quality_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with the measures, clean_text, n_removed, kept_share and kept.

    kept is false if the base rules fail or if less than MIN_KEPT_SHARE of the characters stays after line cleaning.
    Rows are judged one by one, so repeated rows and ties get equal verdicts; null and empty texts have no words and
    fail. Other columns are carried along, and an empty table gives an empty result. No shuffle.
    """
    judged = clean_lines(measure(docs, text_col), text_col)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("kept_share") >= MIN_KEPT_SHARE))
