"""Quality rules against plain Python, and their defined cases."""

import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.llm import rules

SCHEMA = "doc_id long, text string"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    under = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(under),
    )


def measures(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    return {r.doc_id: r for r in rules.judge(docs).collect()}


CASES = [
    None,
    "",
    " \n\t\r\x0b\x0c ",
    "a b c d e f g h",
    "a b c d e f g h a b c d e f g",
    "a b c d e f g h a b c d e f g h",
    "x " * 40,
    "same line\nsame line\nsame line \n\n \n",
    "# * $ % & | < > ## é漢𝄞 word",
    "tab\tand\x0bother\x0cspaces\rhere\x1fno split",
    " ".join(f"w{i % 97}" for i in range(30_000)),
    ("the quick of a line\n" * 9) + " ".join(map(str, range(60))),
]


def test_measures_equal_plain_python(spark):
    got = measures(spark, CASES)
    for i, text in enumerate(CASES):
        r = got[i]
        want = brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r.kept == (not r.failed_rules)
        assert not (r.base_failed and r.kept)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet="ab \n#", max_size=90), min_size=20, max_size=60))
def test_repeats_of_small_alphabets(spark, texts):
    got = measures(spark, texts)
    for i, text in enumerate(texts):
        assert got[i].n_repeat_words == brute(text)[4]
        assert got[i].n_dup_lines == brute(text)[3]


def test_equal_hashes_are_looked_at(spark, monkeypatch):
    """With a hash that is the same for all windows the windows are compared as strings."""
    monkeypatch.setattr(rules, "_doubled", lambda hashes, size: F.transform(hashes, lambda h: h * 0))
    got = measures(spark, CASES)
    assert [got[i].n_repeat_words for i in range(len(CASES))] == [brute(t)[4] for t in CASES]


PROSE = "the river of the valley and a road to it is in this old land that was for us"


@pytest.mark.parametrize(
    "text, failed",
    [
        (PROSE + " ten more words stand here", []),
        ("the of", ["words", "word_length"]),
        ((PROSE + " ten more words stand here ") * 2, ["repeated_words"]),
        (PROSE.replace(" ", " | ") + " ten more words", ["word_length", "symbols"]),
        (" ".join(f"wort{i}" for i in range(30)), ["stop_words", "stop_word_share"]),
        ("\n".join(f"- the longest item{i} of this list" for i in range(9)), ["bullet_lines"]),
        ("\n".join(f"the longest item{i} of this list..." for i in range(9)), ["open_lines"]),
    ],
)
def test_thresholds(spark, text, failed):
    assert measures(spark, [text])[0].failed_rules == failed


def test_rules_are_data(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], SCHEMA)
    table = [rules.Rule("two", "n_words", high=2), rules.Rule("long", "word_chars", "n_words", low=100)]
    got = {r.doc_id: r for r in rules.judge(docs, table, base=()).collect()}
    assert got[1].failed_rules == ["two"] and not got[1].base_failed
    assert got[2].failed_rules == [] and got[2].kept


def test_columns_ids_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(None, "a b", 7, "w", "r"), (None, "a b", 7, "w", "r"), (3, None, None, None, None)],
        "doc_id long, text string, N_words int, words string, row string",
    )
    got = rules.judge(docs)
    assert got.columns[:4] == ["doc_id", "text", "words", "row"]
    assert "N_words" not in got.columns and got.columns.count("n_words") == 1
    out = got.collect()
    assert sorted(r.n_words for r in out) == [0, 2, 2]
    assert sorted((r.words or "", r.row or "") for r in out) == [("", ""), ("w", "r"), ("w", "r")]
    assert rules.judge(docs.limit(0)).count() == 0


def test_no_row_leaves_the_jvm_or_is_shuffled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas", plan)
