"""Graph operators against brute force on small random graphs."""

import random
from datetime import datetime

import pytest

from vigil.operators import lineage


def _lineage(spark, pairs):
    return spark.createDataFrame(
        pairs, f"{lineage.SRC} string, {lineage.DST} string"
    )


def _random(seed, nodes=14, edges=22):
    rng = random.Random(seed)
    return [(f"c.s.t{rng.randrange(nodes)}", f"c.s.t{rng.randrange(nodes)}") for _ in range(edges)]


def _reach(pairs, root, depth=None):
    found, frontier, level = {}, {root}, 0
    while frontier and (depth is None or level < depth):
        level += 1
        frontier = {d for s, d in pairs if s in frontier} - set(found) - {root}
        found.update({n: level for n in frontier})
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_reach_is_shortest_distance_without_root(spark, seed):
    pairs = _random(seed)
    df = _lineage(spark, pairs)
    got = {r.table_name: r.depth for r in lineage.downstream(df, "c.s.t1", 3).collect()}
    assert got == _reach(pairs, "c.s.t1", 3)
    up = {r.table_name: r.depth for r in lineage.upstream(df, "c.s.t1", 3).collect()}
    assert up == _reach([(d, s) for s, d in pairs], "c.s.t1", 3)


def test_shortest_path_equals_reach_depth(spark):
    df = _lineage(spark, _random(7))
    paths = lineage.upstream_paths(df, "c.s.t2", 4).collect()
    best = {}
    for r in paths:
        assert len(r.path) == r.depth == len(set(r.path))
        best[r.table_name] = min(best.get(r.table_name, 99), r.depth)
    best.pop("c.s.t2", None)
    reached = {r.table_name: r.depth for r in lineage.upstream(df, "c.s.t2", 4).collect()}
    assert best == reached


@pytest.mark.parametrize("seed", [1, 4])
def test_cycles_are_strong_components(spark, seed):
    pairs = _random(seed)
    closure = {n: set() for p in pairs for n in p}
    for n in closure:
        todo = [d for s, d in pairs if s == n]
        while todo:
            x = todo.pop()
            if x not in closure[n]:
                closure[n].add(x)
                todo += [d for s, d in pairs if s == x]
    want = {}
    for n in closure:
        if n in closure[n]:
            mates = {m for m in closure[n] if n in closure[m]}
            want[n] = (min(mates), len(mates))
    got = {
        r.table_name: (r.cycle_id, r.cycle_size)
        for r in lineage.cycles(_lineage(spark, pairs)).collect()
    }
    assert got == want


def _subdivided(seed):
    """A random graph whose edges are paths of tables with one edge in and one out; rings and
    chains that lead nowhere beside it."""
    rng = random.Random(seed)
    out = []
    for k, (s, d) in enumerate(_random(seed, nodes=7, edges=9)):
        path = [s, *(f"c.s.p{k}_{i}" for i in range(rng.randrange(6))), d]
        out += zip(path, path[1:])
    for size in (1, 2, 3, 7):
        ring = [f"c.r{size}.{i}" for i in range(size)]
        out += zip(ring, [*ring[1:], ring[0]])
    tail = ["c.s.t1", *(f"c.tail.{i}" for i in range(9))]
    return out + list(zip(tail, tail[1:])) + [("c.r7.3", "c.r7.3")]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_cycles_over_long_paths(spark, seed):
    pairs = sorted(set(_subdivided(seed)))
    follows = {}
    for s, d in pairs:
        follows.setdefault(s, []).append(d)

    def closure(n):
        seen, todo = set(), list(follows.get(n, []))
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += follows.get(x, [])
        return seen

    reach = {n: closure(n) for n in {x for p in pairs for x in p}}
    want = {}
    for n, far in reach.items():
        if n in far:
            mates = {m for m in far if n in reach[m]}
            want[n] = (min(mates), len(mates))
    got = lineage.cycles(_lineage(spark, pairs)).collect()
    assert {r.table_name: (r.cycle_id, r.cycle_size) for r in got} == want
    assert len(got) == len(want)


def test_a_long_ring_takes_few_jobs(spark):
    size = 10_000
    ring = spark.range(size).selectExpr(
        "concat('c.s.t', id) AS source_table_full_name",
        f"concat('c.s.t', (id + 1) % {size}) AS target_table_full_name",
    )
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    before = jobs()
    got = lineage.cycles(ring).groupBy("cycle_id", "cycle_size").count().collect()
    assert [tuple(r) for r in got] == [("c.s.t0", size, size)]
    assert jobs() - before < 200


def test_acyclic_graph_has_no_cycles(spark):
    df = _lineage(spark, [("a", "b"), ("b", "c"), ("a", "c")])
    assert lineage.cycles(df).collect() == []


def test_adjacency_has_one_shape(spark):
    pairs = [("hub", f"leaf{i}") for i in range(500)] + [("leaf1", "hub")]
    rows = lineage.adjacency(_lineage(spark, pairs), datetime(2024, 1, 1)).collect()
    got = {(r.node_id, r.side, r.neighbour) for r in rows}
    assert got == {(s, "downstream", d) for s, d in pairs} | {(d, "upstream", s) for s, d in pairs}
    assert len(rows) == 2 * len(pairs)


def test_export_writes_nodes_and_edges(spark, tmp_path):
    df = _lineage(spark, [("a.b.c", "a.b.d"), ("a.b.d", "a.b.e")])
    lineage.export_graph(df, "a.b.d", str(tmp_path / "g"))
    nodes = spark.read.json(str(tmp_path / "g/nodes"))
    assert {(r.node, r.depth) for r in nodes.collect()} == {
        ("a.b.c", -1), ("a.b.d", 0), ("a.b.e", 1)
    }
    assert spark.read.json(str(tmp_path / "g/edges")).count() == 2


def test_paths_are_no_tables(spark):
    df = _lineage(spark, [("a", "b"), ("b", None), (None, "c"), ("c", "d")])
    assert [r[0] for r in lineage.source_tables(df).collect()] == ["a", "c"]
    assert [r[0] for r in lineage.end_consumers(df).collect()] == ["b", "d"]
    assert {r.table_name for r in lineage.most_connected(df).collect()} == {"a", "b", "c", "d"}


def test_column_names_may_hold_any_sign(spark):
    rows = [("t#1", "x", "u", "y#1"), ("u", "y#1", "v", "z"), ("u", None, "v", "q"), ("u", "y", "w", "r")]
    df = spark.createDataFrame(
        rows,
        f"{lineage.SRC} string, source_column_name string, "
        f"{lineage.DST} string, target_column_name string",
    )
    got = {tuple(r) for r in lineage.column_impact(df, "t#1", "x").collect()}
    assert got == {("u", "y#1", 1), ("v", "z", 2)}
