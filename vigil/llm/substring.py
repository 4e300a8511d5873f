"""Substring dedup: suffix automata of reference passages remove repeated word spans.

``strip_reference`` removes from documents what a given, bounded reference holds: the automata
of its shards are broadcast and every document is streamed through them for its matching
statistics; maximal matches of at least ``min_words`` words go.

``strip_repeats`` uses the corpus as its own reference: of each run of ``min_words`` words the
earliest occurrence stays. A corpus has no size bound, so its shards cannot be broadcast; they
are routed instead. Every window of ``min_words`` words has an anchor, the word group of least
hash inside it. Neighbouring windows with one anchor form a passage; equal windows have equal
anchors. Only anchors that occur more than once can matter, which leaves the repeated part of
the corpus. All passages of an anchor meet in one shard, in corpus order: each is streamed
through the suffix automaton of the earlier ones, whose matching statistics tell which of its
windows occurred before, and then extends the automaton. Anchors of more than ``hot``
occurrences are split: their windows are routed by the hash of the window.

Defined cases: null and empty texts have no words and keep nothing; rows that repeat an id are
ordered by text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vigil.llm.common import ROW, SPANS, Scratch, keyed, lean, record_batch
from vigil.llm.words import Words, joined, mix, runs, split

ANCHOR_WORDS = 8
HOT = 4096
REFERENCE_WORDS = 2_000_000
SHARD_WORDS = 200_000


class SuffixAutomaton:
    """All word sequences that occur in the texts added so far."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, words: Iterable) -> None:
        """Add a text; linear in its words."""
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            there = nxt[last].get(word)
            if there is not None and length[there] == length[last] + 1:
                last = there
                continue
            if there is not None:
                last = self._clone(last, word, there)
                continue
            state = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at != -1 and word not in nxt[at]:
                nxt[at][word] = state
                at = link[at]
            if at != -1:
                there = nxt[at][word]
                if length[there] != length[at] + 1:
                    there = self._clone(at, word, there)
                link[state] = there
            last = state

    def _clone(self, at: int, word, there: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[there]))
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[there])
        self.link[there] = copy
        while at != -1 and self.next[at].get(word) == there:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def match(self, words: Iterable) -> list[int]:
        """Matching statistics: for each word, how many words up to it occur in the texts."""
        nxt, link, length = self.next, self.link, self.length
        state, size, out = 0, 0, []
        for word in words:
            while state and word not in nxt[state]:
                state = link[state]
                size = length[state]
            if word in nxt[state]:
                state = nxt[state][word]
                size += 1
            out.append(size)
        return out


def _passages(words: Words, n: int):
    """Anchor hash, passage hash, first word and number of windows of every passage of a batch,
    and the text it belongs to."""
    k = min(ANCHOR_WORDS, n)
    span = n - k + 1
    window, inside = runs(words, n)
    at = np.flatnonzero(inside)
    if not len(at):
        empty = np.zeros(0, dtype=np.int64)
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    group, _ = runs(words, k)
    best = group[at]
    where = at.copy()
    for j in range(1, span):
        other = group[at + j]
        less = other < best
        best = np.where(less, other, best)
        where = np.where(less, at + j, where)
    text = np.searchsorted(words.first, at, side="right") - 1
    new = np.concatenate([[True], (where[1:] != where[:-1]) | (text[1:] != text[:-1])])
    head = np.flatnonzero(new)
    count = np.diff(np.concatenate([head, [len(at)]]))
    first, last = window[at[head]], window[at[head] + count - 1]
    whole = mix(first * np.uint64(0x9FB21C651E98DF25) + last + count.astype(np.uint64))
    return best[head], whole, at[head] - words.first[text[head]], count, text[head]


_FOUND = pa.schema(
    [
        ("anchor", pa.int64()),
        ("passage", pa.int64()),
        ("row", pa.int64()),
        ("start", pa.int32()),
        ("windows", pa.int32()),
    ]
)


def _find(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            anchor, passage, start, count, text = _passages(split(batch.column(1)), n)
            yield record_batch(
                _FOUND,
                anchor.view(np.int64),
                passage.view(np.int64),
                rows[text],
                start.astype(np.int32),
                count.astype(np.int32),
            )

    return run


_ROUTED = pa.schema(
    [
        ("shard", pa.int64()),
        ("row", pa.int64()),
        ("start", pa.int32()),
        ("words", pa.binary()),
    ]
)

_COMBINED = 50_000


def _route(n: int):
    """Texts of the listed passages with their shard. Input columns: row, text, list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot: dict[int, tuple] = {}

        def flush():
            out = [(key, *value) for key, value in hot.items()]
            hot.clear()
            return record_batch(_ROUTED, *zip(*out))

        for batch in batches:
            words = split(batch.column(1))
            window, _ = runs(words, n)
            out = []
            for i, (row, listed) in enumerate(
                zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())
            ):
                for item in listed:
                    start, count = item["start"], item["windows"]
                    if not item["hot"]:
                        text = b" ".join(words.words(i, start, start + count + n - 1))
                        out.append((item["anchor"], row, start, text))
                        continue
                    for at in range(start, start + count):  # combined before the shuffle
                        key = int(window[words.first[i] + at].view(np.int64))
                        if key not in hot or hot[key][:2] > (row, at):
                            hot[key] = (row, at, b" ".join(words.words(i, at, at + n)))
            if out:
                yield record_batch(_ROUTED, *zip(*out))
            if len(hot) > _COMBINED:
                yield flush()
        if hot:
            yield flush()

    return run


_NOVEL = pa.schema([("row", pa.int64()), ("start", pa.int32()), ("novel", pa.binary())])


def _judge(n: int):
    """Windows of each passage that no earlier passage of its shard holds.

    Rows arrive by (shard, row, start). One automaton lives at a time; the first text alone
    needs none, and a text seen whole is known to add nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first, automaton, seen = None, None, None, set()
        for batch in batches:
            rows, starts, novel = [], [], []
            for key, row, start, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key != shard:
                    shard, first, automaton, seen = key, None, None, set()
                if text in seen:
                    continue
                seen.add(text)
                words = text.split()
                if first is None:
                    first = words
                    fresh = b"\x01" * (len(words) - n + 1)
                else:
                    if automaton is None:
                        automaton = SuffixAutomaton()
                        automaton.add(first)
                    sizes = automaton.match(words)
                    fresh = bytes(size < n for size in sizes[n - 1 :])
                    if any(fresh):
                        automaton.add(words)
                if any(fresh):
                    rows.append(row)
                    starts.append(start)
                    novel.append(fresh)
            yield record_batch(_NOVEL, rows, starts, novel)

    return run


def covered(n_words: int, n: int, spans: list[dict]) -> np.ndarray:
    """Words covered by repeated windows. ``spans``: passages with all windows repeated
    (``novel`` is null), and passages whose windows marked in ``novel`` are not."""
    repeated = np.zeros(n_words + 1, dtype=bool)
    for s in spans:
        if s["novel"] is None:
            repeated[s["start"] : s["start"] + s["windows"]] = True
    for s in spans:
        if s["novel"] is not None:
            marks = np.frombuffer(s["novel"], dtype=np.uint8).astype(bool)
            repeated[s["start"] : s["start"] + len(marks)] &= ~marks
    edge = np.zeros(n_words + 1, dtype=np.int64)
    at = np.flatnonzero(repeated)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge)[:n_words] > 0


_RESULT = [
    StructField("n_words", LongType()),
    StructField("n_removed", LongType()),
    StructField("kept", StringType()),
]


def _with(batch: pa.RecordBatch, names: list[str], sizes, removed, kept) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            *(batch.column(batch.schema.get_field_index(name)) for name in names),
            pa.array(sizes, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(kept, pa.string()),
        ],
        names=[*names, "n_words", "n_removed", "kept"],
    )


def _strip(n: int, names: list[str]):
    """Applies the spans, the last column, to the text; passes the columns named on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = split(batch.column(batch.schema.get_field_index("text")), hashed=False)
            sizes, removed, kept = [], [], []
            for i, spans in enumerate(batch.columns[-1].to_pylist()):
                size = int(words.first[i + 1] - words.first[i])
                gone = covered(size, n, spans or [])
                sizes.append(size)
                removed.append(int(gone.sum()))
                kept.append(joined(words, i, ~gone).decode())
            yield _with(batch, names, sizes, removed, kept)

    return run


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"`{f.name}` {kinds[f.type]}" for f in schema)


def repeated_spans(docs: DataFrame, scratch: Scratch, min_words: int, hot: int = HOT) -> DataFrame:
    """Per ``__row__`` of ``docs``: the list of passages with repeated windows (see ``covered``)."""
    found = scratch.put(
        docs.select(ROW, "text").mapInArrow(lean(_find(min_words)), _ddl(_FOUND)), "passages"
    )
    often = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Written, so that both sides of the join are shuffled and a hot anchor can be split.
    often = scratch.put(often, "often")
    shared = scratch.put(found.join(often, "anchor"), "shared")
    scratch.drop("passages", "often")
    firsts = shared.groupBy("anchor", "passage").agg(
        F.min(F.struct("row", "start", "windows")).alias("at"), F.max("n").alias("n")
    )
    listed = (
        firsts.select("at.*", "anchor", (F.col("n") > hot).alias("hot"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "windows", "anchor", "hot")).alias("listed"))
    )
    routed = (
        docs.select(F.col(ROW).alias("row"), "text")
        .join(listed, "row")
        .select("row", "text", "listed")
        .mapInArrow(lean(_route(min_words)), _ddl(_ROUTED))
    )
    novel = (
        routed.repartition("shard")
        .sortWithinPartitions("shard", "row", "start")
        .mapInArrow(lean(_judge(min_words)), _ddl(_NOVEL))
        .select("row", "start", F.lit(None).cast("int").alias("windows"), "novel")
    )
    novel = scratch.put(novel, "novel")
    return (
        shared.select("row", "start", "windows", F.lit(None).cast("binary").alias("novel"))
        .unionByName(novel)
        .groupBy(F.col("row").alias(ROW))
        .agg(F.collect_list(F.struct("start", "windows", "novel")).alias(SPANS))
    )


def strip_repeats(
    docs: DataFrame, min_words: int = 20, hot: int = HOT, with_text: bool = True
) -> DataFrame:
    """Rows of ``docs`` with ``n_words``, ``n_removed`` and ``kept``: the words outside of all
    windows of ``min_words`` words that occur earlier in the corpus, joined by one space.
    Input columns of these three names are replaced; without ``with_text`` the text is left out.

    Windows are judged on the input: what is removed still counts as an earlier occurrence.
    """
    scratch = Scratch(docs.sparkSession)
    rows = keyed(docs, scratch)
    spans = repeated_spans(rows, scratch, min_words, hot)
    rest = docs.drop(*(f.name for f in _RESULT))
    joined_up = rows.select(*rest.columns, ROW).join(spans, ROW, "left")
    kept = [f for f in rest.schema if with_text or f.name != "text"]
    return joined_up.select(*rest.columns, SPANS).mapInArrow(
        lean(_strip(min_words, [f.name for f in kept])), StructType(kept + _RESULT)
    )


def strip_reference(
    docs: DataFrame,
    reference: DataFrame,
    min_words: int = 20,
    reference_words: int = REFERENCE_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept`` after removing every maximal run of
    at least ``min_words`` words that occurs in a text of ``reference``.

    The reference is counted first; one of more than ``reference_words`` words is refused,
    since its automata are broadcast. Unite it with the documents and use ``strip_repeats``.
    """
    spark = docs.sparkSession
    texts = reference.select("text").filter("text is not null")
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    if size > 16 * reference_words:
        raise ValueError(f"a reference of {size} characters is too large to broadcast")
    shards, filled = [SuffixAutomaton()], 0
    for row in texts.toLocalIterator():
        words = row.text.encode().split()
        if filled and filled + len(words) > shard_words:
            shards.append(SuffixAutomaton())
            filled = 0
        shards[-1].add(words)
        filled += len(words)
    sent = [spark.sparkContext.broadcast((s.next, s.link, s.length)) for s in shards]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = []
        for one in sent:
            automaton = SuffixAutomaton()
            automaton.next, automaton.link, automaton.length = one.value
            automata.append(automaton)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = split(batch.column(at), hashed=False)
            sizes, removed, kept = [], [], []
            for i in range(len(texts)):
                words = texts.words(i, 0, len(texts.start))
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                for automaton in automata:
                    for end, matched in enumerate(automaton.match(words), 1):
                        if matched >= min_words:
                            edge[end - matched] += 1
                            edge[end] -= 1
                gone = np.cumsum(edge)[:-1] > 0
                sizes.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(joined(texts, i, ~gone).decode())
            yield _with(batch, batch.schema.names, sizes, removed, kept)

    rest = docs.drop(*(f.name for f in _RESULT))
    return rest.mapInArrow(lean(run), StructType(rest.schema.fields + _RESULT))
