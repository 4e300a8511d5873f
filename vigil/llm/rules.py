"""Quality rules: a table of thresholds, compiled into Spark expressions and evaluated in one pass.

A rule bounds the ratio of two measures of a text, in hundredths, so that every comparison is one
of whole numbers. Measures are built-in functions over the words and the lines of the text; no
row leaves the JVM, nothing is shuffled.

Words are runs of other characters than x20 and x09-x0D, lines are parted by ``\\n``. A word is
repeated when one of the windows of ``WINDOW`` words around it occurs twice or more in the text.
Windows are told apart by a hash, made by doubling: of words, then of two, four and eight. Texts
without two equal hashes have no repeated window. In the others the windows of equal hashes are compared word by word, and should two differ, that text's
windows are compared as strings.

Defined cases: null is an empty text, with all measures 0; a ratio over 0 fails no rule; texts of
any length are read whole; repeated rows are judged each; an empty table gives no rows. Input
columns stay, but those named as a result, in any letter case, give way to it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8  # a power of two
LEAST_WORDS = 20
MOST_REPEATED = 30  # hundredths of the words

# Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by this are at from "
    "der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als "
    "de la le et les des en un du une que pour est par dans qui avec pas sur au "
    "el y los se las del por con no su para es al lo"
).split()

_SPACES = r"[\x20\x09-\x0D]+"
_WORDY = r"[^\x20\x09-\x0D]"
_SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``low <= 100 * top / bottom <= high``; without ``bottom``, ``low <= top <= high``."""

    name: str
    top: str
    bottom: str | None = None
    low: int | None = None
    high: int | None = None

    def fails(self) -> Column:
        """True where a bound is passed."""
        value, scale = F.col(self.top), F.lit(1)
        if self.bottom is not None:
            value, scale = value * 100, F.col(self.bottom)
        under = F.lit(False) if self.low is None else value < scale * self.low
        over = F.lit(False) if self.high is None else value > scale * self.high
        outside = under | over
        return outside if self.bottom is None else outside & (F.col(self.bottom) > 0)


BASE = (
    Rule("words", "n_words", low=LEAST_WORDS),
    Rule("repeated_words", "n_repeat_words", "n_words", high=MOST_REPEATED),
)

RULES = (
    Rule("word_length", "word_chars", "n_words", low=300, high=1000),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("stop_words", "n_stop_words", low=2),
    Rule("stop_word_share", "n_stop_words", "n_words", low=2),
    Rule("equal_lines", "n_dup_lines", "n_lines", high=50),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=90),
    Rule("open_lines", "n_open_lines", "n_lines", high=30),
)

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_stop_words",
    "n_lines",
    "n_bullet_lines",
    "n_open_lines",
)
RESULTS = (*MEASURES, "base_failed", "failed_rules", "kept")


def _long(number: Column) -> Column:
    return number.cast("long")


def _window(words: Column, i: Column) -> Column:
    return F.slice(words, i, WINDOW)


def _places(words: Column) -> Column:
    """Starts of all windows, from 1; none in short texts."""
    last = F.size(words) - (WINDOW - 1)
    return F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def _doubled(hashes: Column, size: int) -> Column:
    """Hashes of runs of twice ``size`` words from those of ``size``; the last ones overhang."""
    later = F.slice(hashes, size + 1, F.greatest(F.size(hashes), F.lit(1)))
    return F.zip_with(hashes, later, lambda a, b: F.xxhash64(a, b))


def _again(ordered: Column, field: str) -> Column:
    """Starts of the windows that have an equal neighbour in the sorted list, ascending."""

    def repeated(one: Column, at: Column) -> Column:
        before, after = F.get(ordered, at - 1)[field], F.get(ordered, at + 1)[field]
        same = (before == one[field]) | (after == one[field])
        return F.coalesce(same, F.lit(False))

    return F.sort_array(F.transform(F.filter(ordered, repeated), lambda one: one["i"]))


def _impure(words: Column, ordered: Column) -> Column:
    """Whether two windows of equal hashes, next to each other in the list, differ in a word."""

    def differs(one: Column, at: Column) -> Column:
        before = F.get(ordered, at - 1)
        return (before["key"] == one["key"]) & (
            _window(words, before["i"]) != _window(words, one["i"])
        )

    return F.size(F.filter(ordered, lambda one, at: F.coalesce(differs(one, at), F.lit(False)))) > 0


def _covered(starts: Column) -> Column:
    """Words under windows that begin at the ascending ``starts``."""

    def own(start: Column, at: Column) -> Column:
        following = F.coalesce(F.get(starts, at + 1), start + WINDOW)
        return F.least(F.lit(WINDOW), following - start)

    return F.aggregate(
        F.transform(starts, own), F.lit(0).cast("long"), lambda total, n: total + n
    )


def measured(docs: DataFrame, text: str = "text", stop_words: Sequence[str] = STOP_WORDS):
    """``docs`` packed as ``row``, beside the measures of its texts.

    Each step is a projection whose columns the next one reads more than once.
    """
    read = docs.select(F.struct("*").alias("row"), F.coalesce(text, F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(_WORDY))
    listed = read.select(
        "row",
        F.array_remove(F.split("text", _SPACES), "").alias("words"),
        lines.alias("lines"),
        _long(F.size(F.split("text", _SYMBOLS, -1)) - 1).alias("n_symbols"),
    )
    words, kept_lines = F.col("words"), F.col("lines")
    counted = listed.select(
        "row",
        "words",
        F.transform(words, lambda w: F.xxhash64(w)).alias("hashes"),
        _long(F.size(words)).alias("n_words"),
        _long(F.length(F.array_join(words, ""))).alias("word_chars"),
        "n_symbols",
        _long(F.size(F.filter(words, lambda w: F.lower(w).isin(*stop_words)))).alias(
            "n_stop_words"
        ),
        _long(F.size(kept_lines)).alias("n_lines"),
        _long(F.size(kept_lines) - F.size(F.array_distinct(kept_lines))).alias("n_dup_lines"),
        _long(F.size(F.filter(kept_lines, lambda x: x.rlike(r"^\s*[-*•]")))).alias(
            "n_bullet_lines"
        ),
        _long(F.size(F.filter(kept_lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$")))).alias(
            "n_open_lines"
        ),
    )
    size = 1
    while size < WINDOW:
        counted = counted.withColumn("hashes", _doubled(F.col("hashes"), size))
        size *= 2
    hashes = F.slice("hashes", 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
    counted, hashes = counted.withColumn("hashes", hashes), F.col("hashes")
    by_hash = F.transform(
        hashes, lambda key, at: F.struct(key.alias("key"), (at + 1).alias("i"))
    )
    suspects = F.size(F.array_distinct(hashes)) < F.size(hashes)
    ordered = counted.withColumn("ordered", F.when(suspects, F.sort_array(by_hash)))
    as_text = F.transform(
        _places(words),
        lambda i: F.struct(F.array_join(_window(words, i), " ").alias("key"), i.alias("i")),
    )
    plain = ordered.withColumn(
        "plain", F.when(_impure(words, F.col("ordered")), F.sort_array(as_text))
    )
    starts = F.when(F.col("plain").isNotNull(), _again(F.col("plain"), "key")).when(
        F.col("ordered").isNotNull(), _again(F.col("ordered"), "key")
    )
    found = plain.withColumn("starts", starts)
    repeated = F.coalesce(_covered(F.col("starts")), F.lit(0).cast("long"))
    return found.withColumn("n_repeat_words", repeated).select("row", *MEASURES)


def judge(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    base: Sequence[Rule] = BASE,
    text: str = "text",
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, the names of all ``failed_rules`` (those of
    ``base`` first) and ``kept``: no rule fails."""
    given = [f"row.`{name}`" for name in docs.drop(*RESULTS).columns]
    any_base = F.lit(False)
    for rule in base:
        any_base = any_base | rule.fails()
    failed = F.array_compact(
        F.array(*[F.when(rule.fails(), F.lit(rule.name)) for rule in (*base, *rules)])
    )
    judged = measured(docs, text, stop_words).select(
        *given, *MEASURES, any_base.alias("base_failed"), failed.alias("failed_rules")
    )
    return judged.withColumn("kept", F.size("failed_rules") == 0)
