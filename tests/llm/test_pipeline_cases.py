"""Every stage of the pipeline on nulls, repeats, empty tables and columns of clashing names."""

import pytest

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
EXTRA = "score string, predicted int, kept string, n_words int, n_removed string, n_hit string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
SAID = " ".join(f"plain{i} word" for i in range(40))


def row(doc_id, text):
    size = None if text is None else len(text)
    return (doc_id, text, "en", "src", size, "mine", 7, "mine too", None, "gone", "hit")


ROWS = [
    row(1, SAID), row(1, SAID), row(2, None), row(None, "a null id"), row(None, None),
    row(3, ""), row(4, "long " * 30_000), row(5, SAID + " and more"),
]


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_columns_stay_the_users(spark, name):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = STAGES[name](spark, docs, FOLDER)
    assert got.columns == docs.columns
    out = got.collect()
    assert out and all((r.score, r.predicted, r.kept, r.n_words) == ("mine", 7, "mine too", None) for r in out)
    assert all((r.n_removed, r.n_hit) == ("gone", "hit") for r in out)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out)
    if name != "near_dedup":
        assert len(out) == len(ROWS)
    assert STAGES[name](spark, docs.limit(0), FOLDER).count() == 0


def test_stages_need_only_id_and_text(spark):
    docs = spark.createDataFrame([r[:2] for r in ROWS], "doc_id long, text string")
    for name in list(STAGES)[:-1]:
        assert STAGES[name](spark, docs, FOLDER).columns == ["doc_id", "text"]


def test_packing_of_all_cases(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = STAGES["packing"](spark, docs, FOLDER).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert STAGES["packing"](spark, docs.limit(0), FOLDER).count() == 0
