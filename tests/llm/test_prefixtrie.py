"""The prefix trie against one built in memory, and its defined cases."""

import hashlib
import random
from collections import defaultdict

import pytest

from vigil.llm import prefixtrie
from vigil.llm.common import Scratch

SCHEMA = "conv_id long, turn int, role string, text string"


def sequences(rows):
    grouped = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            grouped[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in grouped.items()}


def brute(said):
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in sorted(said.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(str(c))
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, ids in members.items():
        words = len(node[-1][1].split()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(ids) - 1) * words
    return {
        (min(ids), len(node)): (
            min(members[node[:-1]]) if node else None, len(ids), children[node], leaves[node],
            saved[node], hashlib.sha256(",".join(ends[node]).encode()).hexdigest(),
        )
        for node, ids in list(members.items())
    }


def table_of(df):
    got = df.collect()
    out = {(r.conv_id, r.depth): tuple(r)[2:] for r in got}
    assert len(out) == len(got)
    return out


def found(spark, rows):
    made = spark.createDataFrame(rows, SCHEMA)
    return table_of(prefixtrie.prefix_trie(made, Scratch(spark)))


@pytest.mark.parametrize("longest", [1, 8, 23])
def test_random_tries(spark, longest):
    draw = random.Random(longest)
    rows = []
    for c in draw.sample(range(-9000, 90_000), 40):
        for turn in range(draw.randint(1, longest)):
            text = draw.choice(["yes", "no thank you"]) if turn < 6 else f"turn {turn} {c % 3}"
            rows.append((c, turn, "user" if turn % 2 == 0 else "bot", text))
    draw.shuffle(rows)
    assert found(spark, rows) == brute(sequences(rows))


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [
        (1, None, "user", "b"), (1, 0, None, "a b"), (1, 0, None, "a b"), (1, 5, "user", None),
        (2, 0, "user", "b"), (2, 1, "", "a b"), (2, 1, "", "a b"), (2, 2, "user", ""),
        (3, 0, "us", "erb"), (None, 0, "user", "b"), (4, 0, "user", "w " * 200_000),
        (5, 0, "user", "w " * 200_000), (5, 1, "x", "y"),
    ]
    got = found(spark, rows)
    assert got == brute(sequences(rows))
    assert got[(1, 4)][1] == 2  # conversations 1 and 2 are the same
    assert got[(4, 1)][4] == 200_000


def test_many_members_of_one_node(spark):
    """Ids of one node come from several chunks, also below zero."""
    rows = [(c, 0, "user", "hello") for c in range(-9000, 9000, 2)]
    got = found(spark, rows)
    assert got == brute(sequences(rows))


def test_empty_table_and_extra_columns(spark):
    assert found(spark, []) == {}
    assert found(spark, [(None, 0, "user", "b")]) == {}
    made = spark.createDataFrame(
        [(7, 0, "u", "t", "x", 3)], SCHEMA + ", name string, depth long"
    )
    got = prefixtrie.prefix_trie(made, Scratch(spark))
    assert "name" not in got.columns and table_of(got) == brute({7: [("u", "t")]})


def test_rebuilt_on_another_conversation(spark):
    import zlib

    rows = [(c, t, "user", f"{c}:{t}") for c in [0, 3, 5, 19, 20, 21, 47, 61, 65] for t in range(c % 5)]
    rows += [(c, 0, "user", "own") for c in (0, 20, 22, 63)]
    said = sequences(rows)
    want = {}
    for c, turns in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        want[c] = said.get(c - c % 20, [])[:h] + turns[h:]
    turns = prefixtrie.numbered(spark.createDataFrame(rows, SCHEMA))
    rebuilt, ids = prefixtrie.borrowed(turns)
    assert any(not t for t in want.values())  # a conversation without turns
    assert table_of(prefixtrie.trie(rebuilt, ids, Scratch(spark))) == brute(want)


def test_rounds_follow_the_logarithm_of_the_depth(spark):
    rows = [(1, t, "u", f"{t}") for t in range(100)] + [(2, t, "u", f"{t}") for t in range(99)]
    scratch = Scratch(spark)
    made = spark.createDataFrame(rows, SCHEMA)
    got = table_of(prefixtrie.prefix_trie(made, scratch))
    assert got == brute(sequences(rows))
    assert len(scratch.paths) <= 3 * 7 + 4
