"""Spelling variants by permuterm rotations.

A word of m letters is written with a terminator and rotated. Its rotation that begins after
letter i ends with that letter, so without the last letter it is the word with letter i skipped:
what follows the letter, the terminator, what precedes it. Sorted, all words that differ in that
letter only stand together, behind the one word that lacks it, whose whole rotation is the same
string. So one scan over the sorted rotations meets every replacement, insertion and deletion of
one letter.

A group is one skipped rotation: at most one shorter word, and one longer word per letter that
can stand in the gap. It gives each member the number of its neighbours there and the best of
them, never a list of pairs. A word of m letters stands in 2m + 1 groups, so the work is linear.
The same two words meet again only by deleting another letter of a run of equal letters; only
the first letter of a run counts for that.

Everything is a DataFrame operation: rotations are exploded from distinct words, grouped and
sorted by Spark; words are counted per document before a shuffle.

Defined cases: null and empty texts have no words, texts are read whole, repeated rows count
again; a null id is the text ``null`` in the hash; an empty table gives no rows; other input
columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import Scratch

LEAST_LETTERS = 6
LEAST_COUNT = 5
TIMES = 5
EDITED = 199  # about one word in so many loses a letter

_RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_END = "$"


def lowered(run: Column) -> Column:
    """A-Z in lower case; other letters as they are."""
    ascii_only = F.octet_length(run) == F.length(run)
    return F.when(ascii_only, F.lower(run)).otherwise(F.translate(run, _UPPER, _LOWER))


def _edited(doc_id: Column, run: Column, one_in: int) -> Column:
    """The run, without one letter where its hash with the document says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % one_in == 0, less).otherwise(run)


def vocabulary(
    docs: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    one_in: int = EDITED,
) -> DataFrame:
    """(word, n): the words of all texts with at least so many letters and occurrences."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(_RUN), 0)).alias("run"))
    # A deletion takes one letter, so shorter runs can give no word.
    runs = runs.filter(F.length("run") >= least_letters)
    words = runs.select("doc_id", lowered(F.col("run")).alias("run")).select(
        _edited(F.col("doc_id"), F.col("run"), one_in).alias("word")
    )
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.length("word") >= least_letters) & (F.col("n") >= least_count))


def rotations(words: DataFrame) -> DataFrame:
    """(gap, longer, first, word, n): both uses of every rotation of the terminated words.

    ``longer``: the rotation without its last letter, so the word has a letter in the gap, and
    ``first`` says that this letter does not repeat the one before. Otherwise the whole
    rotation: the word lacks the letter.
    """
    word, i = F.col("word"), F.col("i")
    length = F.length(word)
    placed = words.select("word", "n", F.explode(F.sequence(F.lit(0), length)).alias("i"))
    before = F.substring(word, F.lit(1), i)
    whole = F.concat(F.substring(word, i + 1, length), F.lit(_END), before)
    skipped = F.concat(F.substring(word, i + 2, length), F.lit(_END), before)
    first = (i == 0) | (F.substring(word, i, F.lit(1)) != F.substring(word, i + 1, F.lit(1)))
    kinds = F.array(
        F.struct(whole.alias("gap"), F.lit(False).alias("longer"), F.lit(False).alias("first")),
        F.when(
            i < length,
            F.struct(skipped.alias("gap"), F.lit(True).alias("longer"), first.alias("first")),
        ),
    )
    return placed.select("word", "n", F.inline(F.array_compact(kinds))).select(
        "gap", "longer", "first", "word", "n"
    )


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, near_rank): for words with neighbours, how many there are, and the best of
    them as a struct of its negated count and the word, so that the least one is the best."""
    # Sorted by gap; the shorter word first, then by count. One gap holds few words.
    scan = Window.partitionBy("gap").orderBy("longer", "rank")
    whole = scan.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    longer = F.struct((-F.col("n")).alias("minus_n"), "word")
    ranked = rotations(words).withColumn("rank", longer)
    of_longer = F.when(F.col("longer"), F.col("rank"))
    of_first = F.when(F.col("longer") & F.col("first"), F.col("rank"))
    scanned = ranked.withColumns(
        {
            "members": F.count(F.lit(1)).over(whole),
            "n_longer": F.count(of_longer).over(whole),
            "n_first": F.count(of_first).over(whole),
            "best_longer": F.min(of_longer).over(whole),
            "best_first": F.min(of_first).over(whole),
            "shorter": F.min(F.when(~F.col("longer"), F.col("rank"))).over(whole),
            "next": F.lead("rank").over(scan),
        }
    ).filter("members > 1")
    # Of the longer words, the best one's best neighbour is the next in order.
    other = F.when(F.col("rank") == F.col("best_longer"), F.col("next")).otherwise(
        F.col("best_longer")
    )
    also = F.when(F.col("first"), F.col("shorter"))
    count = F.when(
        F.col("longer"), F.col("n_longer") - 1 + also.isNotNull().cast("long")
    ).otherwise(F.col("n_first"))
    best = F.when(F.col("longer"), F.least(other, also)).otherwise(F.col("best_first"))
    found = scanned.select("word", count.alias("n_near"), best.alias("near_rank"))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min("near_rank").alias("near_rank"))
        .filter("n_near > 0")
    )


def variants(docs: DataFrame, scratch: Scratch, times: int = TIMES, **bounds: int) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of ``vocabulary``.

    ``form`` is the neighbour of largest count (the least of equal ones) if that count is at
    least ``times`` the word's. Counts grow by that factor along forms, so chains are short and
    end; roots are found by pointer doubling over the words that have a form.
    """
    words = scratch.put(vocabulary(docs, **bounds), "vocabulary")
    near = neighbours(words)
    joined = words.join(near, "word", "left")
    enough = -F.col("near_rank.minus_n") >= F.col("n") * times
    formed = scratch.put(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("near_rank.word")).alias("form"),
            F.when(enough, -F.col("near_rank.minus_n")).alias("form_n"),
        ),
        "forms",
    )
    steps = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    for turn in range(64):
        onward = steps.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = steps.join(onward, steps["root"] == onward["at"], "left")
        jumped = scratch.put(
            moved.select(
                "word",
                F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            ),
            f"roots{turn}",
        )
        steps = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            break
    return formed.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))
