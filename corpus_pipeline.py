"""A corpus pipeline: each stage works on what its predecessor kept.

    toxicity            documents scored as toxic go
    near_dedup          of near-duplicates (five-word shingles, similarity 0.8) one stays
    substring_dedup     runs of 30 words that occur earlier in the corpus are cut out
    decontamination     documents that hold a benchmark window of 10 words go
    packing             what is left becomes sequences of at most 4096 tokens

All but the last return the columns of their input, which must have ``doc_id`` and ``text``. The
other columns travel in one struct, so that none is taken for a result of an operator; only
``n_chars`` follows a text that is cut. Null texts and ids, repeated rows and empty tables pass
every stage: a null text is never toxic, contaminated or a near-duplicate, and of rows that
repeat a document near-dedup keeps one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import toxicity
from vigil.llm.common import Scratch, ready, table
from vigil.llm.contamination import remove_contaminated
from vigil.llm.neardup import drop_near_duplicates
from vigil.llm.packing import pack_documents
from vigil.llm.substring import strip_repeats

REPEATED_WORDS = 30
BENCHMARK_WORDS = 10
SEQUENCE_TOKENS = 4096


OWN = ("doc_id", "text")
GIVEN = "__given__"


def _bundled(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the other columns as one struct."""
    rest = [F.col(f"`{name}`") for name in docs.columns if name not in OWN]
    return docs.select(*OWN, *([F.struct(*rest).alias(GIVEN)] if rest else []))


def _as_before(out: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs``, those named in ``changed`` with new values."""

    def column(name: str) -> Column:
        before = F.col(name) if name in OWN else F.col(f"{GIVEN}.`{name}`")
        return (changed[name] if name in changed else before).alias(name)

    return out.select(*map(column, docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5; the classifier learns from ``labels``."""
    ready(spark)
    known = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.score(_bundled(docs), toxicity.fit(known, labels))
    return _as_before(scored.filter("predicted = 0"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near-duplicates."""
    ready(spark)
    return _as_before(drop_near_duplicates(_bundled(docs), shingle=5, percent=80), docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; texts without any stay as they are."""
    ready(spark)
    stripped = strip_repeats(_bundled(docs), min_words=REPEATED_WORDS)
    cut = F.col("n_removed") > 0
    changed = {"text": F.when(cut, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        before = F.col(f"{GIVEN}.n_chars")
        changed["n_chars"] = F.when(cut, F.length("kept").cast("long")).otherwise(before)
    return _as_before(stripped, docs, **changed)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    ready(spark)
    items = table(spark, sf_dir, "benchmark")
    return _as_before(remove_contaminated(_bundled(docs), items, n=BENCHMARK_WORDS), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of token sequences."""
    ready(spark)
    return pack_documents(docs.select(*OWN), size=SEQUENCE_TOKENS, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Models and packing are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark)
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = scratch.put(docs, name)
    return docs
