"""Registered queries against SQL, and the pipeline's stages against brute force."""

import re

import pytest

import check_queries
import corpus_pipeline
from tests.llm.test_contamination import words as benchmark_words
from tests.llm.test_neardup import brute as brute_components
from vigil.llm import queries
from vigil.llm.common import Scratch, table

FOLDER = "/root/testdata/sf0.001"
NAMES = [f"op{n}_" for n in range(1, 14)]


def test_names():
    import __spark_entry__

    assert sorted(re.match(r"op\d+_", n)[0] for n in queries.QUERIES) == sorted(NAMES)
    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_dedup", "substring_dedup", "decontamination", "packing"
    ]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, monkeypatch, name):
    monkeypatch.setattr(check_queries, "queries", lambda: queries.QUERIES)
    monkeypatch.setattr(check_queries, "oracle_sql", lambda: queries.ORACLE)
    outcome = check_queries.compare(spark, check_queries.connect(FOLDER), name, FOLDER)
    assert outcome.startswith("equal"), outcome


def test_pipeline_stages(spark):
    scratch = Scratch(spark)
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.put(stage(spark, docs, FOLDER), name)
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in kept[name])

    everything = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
    labels = {r.doc_id: r.toxic for r in table(spark, FOLDER, "labels").collect()}
    gone = everything.keys() - {r.doc_id for r in kept["toxicity"]}
    known = [labels[i] for i in gone if i in labels]
    assert known and all(known)

    given = [(r.doc_id, r.text) for r in kept["toxicity"]]
    want = {i for i, (_, root) in brute_components(given, 5).items() if i == root}
    assert {r.doc_id for r in kept["near_dedup"]} == want

    n, seen, want = corpus_pipeline.REPEATED_WORDS, set(), {}
    for r in sorted(kept["near_dedup"], key=lambda r: r.doc_id):
        said = re.findall(r"[^\x20\x09-\x0D]+", r.text)
        cut = [False] * len(said)
        for i in range(len(said) - n + 1):
            window = tuple(said[i : i + n])
            if window in seen:
                cut[i : i + n] = [True] * n
            seen.add(window)
        left = " ".join(w for w, c in zip(said, cut) if not c)
        want[r.doc_id] = left if any(cut) else r.text
    assert {r.doc_id: r.text for r in kept["substring_dedup"]} == want

    windows = set()
    for item in table(spark, FOLDER, "benchmark").collect():
        said = benchmark_words(item.text)
        m = min(10, len(said))
        windows |= {tuple(said[i : i + m]) for i in range(len(said) - m + 1) if m}
    sizes = {len(w) for w in windows}

    def leaks(text):
        said = benchmark_words(text)
        return any(tuple(said[i : i + m]) in windows for m in sizes for i in range(len(said) - m + 1))

    clean = {r.doc_id for r in kept["substring_dedup"] if not leaks(r.text)}
    assert {r.doc_id for r in kept["decontamination"]} == clean
    assert {r.doc_id for r in kept["packing"]} == clean
    assert corpus_pipeline.run(spark, FOLDER).count() == len(kept["packing"])
