"""Table and column lineage: reach, impact, cycles, degree reports.

Edges are reduced to distinct pairs before any traversal, so that the traversal works
on the graph, not on the log. Traversals run level by level; each level is a join of
the frontier with the edges, checkpointed in the shared folder.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.exprs import name_part, ts_lit
from vigil.plans.scratch import cut, stored, stored_counting

SRC = "source_table_full_name"
DST = "target_table_full_name"

# Node sets of up to this many counted rows (a few MB of names) may be broadcast.
BROADCAST_ROWS = 50_000


def edges(lineage: DataFrame) -> DataFrame:
    """Distinct table-to-table edges. Path-based ends have no table name and are no nodes."""
    named = lineage.select(F.col(SRC).alias("src"), F.col(DST).alias("dst"))
    return named.dropna().distinct()


def _column_node(table: Column, column: Column) -> Column:
    return F.struct(table.alias("table_name"), column.alias("column_name"))


def column_edges(lineage: DataFrame) -> DataFrame:
    """Distinct column-to-column edges; a node is a pair of table and column, both named."""
    ends = lineage.dropna(subset=[SRC, "source_column_name", DST, "target_column_name"])
    return ends.select(
        _column_node(F.col(SRC), F.col("source_column_name")).alias("src"),
        _column_node(F.col(DST), F.col("target_column_name")).alias("dst"),
    ).distinct()


def reversed_edges(graph: DataFrame) -> DataFrame:
    return graph.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """Offer a side for broadcasting when its counted rows are few, else leave it to a shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def reach(graph: DataFrame, root: str | Column, max_depth: int) -> DataFrame:
    """Nodes reachable from ``root`` (column ``node``) with the first level they occur on.

    The root itself is not part of the result. Frontier and visited nodes stay distributed;
    the driver learns their counts only. While they are few, the edges are not shuffled.
    """
    start = root if isinstance(root, Column) else F.lit(root)
    frontier = graph.sparkSession.range(1).select(start.alias("node"))
    seen = frontier.withColumn("depth", F.lit(0))
    new = known = 1
    for depth in range(1, max_depth + 1):
        step = (
            graph.join(bounded(frontier, new), F.col("src") == F.col("node"), "left_semi")
            .select(F.col("dst").alias("node"))
            .distinct()
            .join(bounded(seen.select("node"), known), "node", "left_anti")
        )
        frontier, new = stored_counting(step)
        if not new:
            break
        known += new
        seen = seen.unionByName(frontier.withColumn("depth", F.lit(depth)))
    return seen.filter("depth > 0")


def downstream(lineage: DataFrame, table: str, max_depth: int = 3) -> DataFrame:
    graph = stored(edges(lineage), "edges")
    found = reach(graph, table, max_depth)
    return found.select(F.col("node").alias("table_name"), "depth")


def upstream(lineage: DataFrame, table: str, max_depth: int = 3) -> DataFrame:
    graph = stored(reversed_edges(edges(lineage)), "edges")
    found = reach(graph, table, max_depth)
    return found.select(F.col("node").alias("table_name"), "depth")


def upstream_paths(lineage: DataFrame, table: str, max_depth: int = 3) -> DataFrame:
    """Every cycle-free upstream path up to ``max_depth``, one row per path."""
    graph = stored(edges(lineage), "edges")
    level = graph.filter(F.col("dst") == table).select(
        F.col("src").alias("table_name"),
        F.col("dst").alias("reference_table"),
        F.lit(1).alias("depth"),
        F.array("src").alias("path"),
    )
    found = level = cut(level)
    for depth in range(2, max_depth + 1):
        step = (
            level.select(F.col("table_name").alias("_at"), "path")
            .join(graph, F.col("_at") == F.col("dst"))
            .filter(~F.array_contains("path", F.col("src")))
            .select(
                F.col("src").alias("table_name"),
                F.col("dst").alias("reference_table"),
                F.lit(depth).alias("depth"),
                F.array_union("path", F.array("src")).alias("path"),
            )
        )
        level, more = stored_counting(step)
        if not more:
            break
        found = found.unionByName(level)
    return found


def column_sources(lineage: DataFrame, table: str, column: str | None = None) -> DataFrame:
    """Column edges into a table, or into one of its columns."""
    chosen = lineage.filter(F.col(DST) == table)
    if column is not None:
        chosen = chosen.filter(F.col("target_column_name") == column)
    return chosen.select(
        SRC, "source_column_name", DST, "target_column_name", "source_type"
    ).orderBy("target_column_name", SRC, "source_column_name")


def critical_endpoints(lineage: DataFrame, table: str, max_depth: int = 5) -> DataFrame:
    """Tables just beyond the downstream horizon: fed by a reached table, not reached."""
    graph = stored(edges(lineage), "edges")
    found = cut(reach(graph, table, max_depth))
    return _endpoints(graph, found)


def _endpoints(graph: DataFrame, found: DataFrame) -> DataFrame:
    nodes = found.select("node")
    return (
        graph.join(nodes, F.col("src") == F.col("node"), "left_semi")
        .select(F.col("dst").alias("node"))
        .distinct()
        .join(nodes, "node", "left_anti")
        .select(F.col("node").alias("endpoint"))
    )


def affected_schemas(lineage: DataFrame, table: str, max_depth: int = 5) -> DataFrame:
    found = downstream(lineage, table, max_depth).filter(
        F.size(F.split("table_name", r"\.")) == 3
    )
    return found.groupBy(
        name_part("table_name", 0).alias("catalog"),
        F.concat_ws(".", name_part("table_name", 0), name_part("table_name", 1)).alias("schema"),
    ).agg(F.count("*").alias("tables"))


def impact_summary(lineage: DataFrame, table: str, max_depth: int = 5) -> DataFrame:
    """Size of the downstream closure of a table in one row."""
    graph = stored(edges(lineage), "edges")
    found = cut(reach(graph, table, max_depth))
    three = F.size(F.split("node", r"\.")) == 3
    schema = F.concat_ws(".", name_part("node", 0), name_part("node", 1))
    figures = found.agg(
        F.count("*").alias("total_downstream"),
        F.countDistinct(F.when(three, name_part("node", 0))).alias("affected_catalogs"),
        F.countDistinct(F.when(three, schema)).alias("affected_schemas"),
        F.lit(None).cast("bigint").alias("critical_endpoints"),
    )
    ends = _endpoints(graph, found).agg(F.count("*").alias("critical_endpoints"))
    both = figures.unionByName(ends, allowMissingColumns=True)
    names = ("total_downstream", "affected_catalogs", "affected_schemas", "critical_endpoints")
    return both.agg(*[F.max(n).alias(n) for n in names]).select(F.lit(table).alias("table"), *names)


def graph_nodes(lineage: DataFrame, table: str, max_depth: int = 3) -> DataFrame:
    """Centre, upstream (negative depth) and downstream nodes around a table.

    A table on both sides is listed as downstream.
    """
    graph = stored(edges(lineage), "edges")
    down = reach(graph, table, max_depth)
    up = reach(reversed_edges(graph), table, max_depth)
    sides = down.select("node", "depth", F.lit("downstream").alias("node_type")).unionByName(
        up.select("node", (-F.col("depth")).alias("depth"), F.lit("upstream").alias("node_type"))
    )
    # Positive depths sort above negative ones, so the maximum prefers downstream.
    merged = sides.groupBy("node").agg(
        F.max_by("node_type", "depth").alias("node_type"), F.max("depth").alias("depth")
    )
    centre = graph.sparkSession.range(1).select(
        F.lit(table).alias("node"), F.lit("center").alias("node_type"), F.lit(0).alias("depth")
    )
    return merged.unionByName(centre)


def graph_edges(lineage: DataFrame, table: str, max_depth: int = 3) -> DataFrame:
    """Edges with both ends among the nodes around a table."""
    nodes = cut(graph_nodes(lineage, table, max_depth).select("node"))
    return (
        edges(lineage)
        .join(nodes, F.col("src") == F.col("node"), "left_semi")
        .join(nodes, F.col("dst") == F.col("node"), "left_semi")
    )


def export_graph(lineage: DataFrame, table: str, path: str, max_depth: int = 3) -> None:
    """Write nodes and edges around a table as JSON for documentation."""
    graph_nodes(lineage, table, max_depth).write.mode("overwrite").json(f"{path}/nodes")
    graph_edges(lineage, table, max_depth).write.mode("overwrite").json(f"{path}/edges")


def adjacency(lineage: DataFrame, as_of: datetime) -> DataFrame:
    """Neighbours of every table, one row per table, side and neighbour."""
    side = F.struct(
        F.col("src").alias("node_id"), F.lit("downstream").alias("side"), F.col("dst").alias("other")
    )
    other = F.struct(
        F.col("dst").alias("node_id"), F.lit("upstream").alias("side"), F.col("src").alias("other")
    )
    ends = edges(lineage).select(F.inline(F.array(side, other)))
    return ends.select(
        "node_id",
        F.lit("table").alias("node_type"),
        name_part("node_id", 2).alias("node_name"),
        "side",
        F.col("other").alias("neighbour"),
        ts_lit(as_of).alias("last_updated"),
    )


def most_connected(lineage: DataFrame, limit: int = 25) -> DataFrame:
    """Tables with the most distinct neighbours."""
    one, none = F.lit(1), F.lit(0)
    ends = edges(lineage).select(
        F.inline(
            F.array(
                F.struct(
                    F.col("src").alias("table_name"), none.alias("up"), one.alias("down")
                ),
                F.struct(
                    F.col("dst").alias("table_name"), one.alias("up"), none.alias("down")
                ),
            )
        )
    )
    return (
        ends.groupBy("table_name")
        .agg(
            F.sum("up").alias("upstream_count"),
            F.sum("down").alias("downstream_count"),
            F.count("*").alias("total_connections"),
        )
        .orderBy(F.desc("total_connections"), "table_name")
        .limit(limit)
    )


def source_tables(lineage: DataFrame) -> DataFrame:
    """Tables that feed something and that no table feeds. A path as source does not count."""
    graph = edges(lineage)
    fed = graph.select(F.col("dst").alias("source_table")).distinct()
    return (
        lineage.select(F.col(SRC).alias("source_table"))
        .dropna()
        .distinct()
        .join(fed, "source_table", "left_anti")
        .orderBy("source_table")
    )


def end_consumers(lineage: DataFrame) -> DataFrame:
    """Tables that are fed and feed no table."""
    return source_tables(
        lineage.select(F.col(DST).alias(SRC), F.col(SRC).alias(DST))
    ).withColumnRenamed("source_table", "end_consumer_table")


def by_source_type(lineage: DataFrame) -> DataFrame:
    return (
        lineage.groupBy("source_type")
        .agg(
            F.countDistinct(SRC).alias("unique_source_tables"),
            F.countDistinct(DST).alias("unique_target_tables"),
            F.count("*").alias("total_lineage_records"),
        )
        .orderBy(F.desc("total_lineage_records"), "source_type")
    )


def cross_catalog(lineage: DataFrame) -> DataFrame:
    return (
        lineage.filter(F.col("source_table_catalog") != F.col("target_table_catalog"))
        .groupBy("source_table_catalog", "target_table_catalog")
        .agg(F.count("*").alias("lineage_count"))
        .orderBy(F.desc("lineage_count"), "source_table_catalog", "target_table_catalog")
    )


def column_impact(
    lineage: DataFrame, table: str, column: str, max_depth: int = 5
) -> DataFrame:
    """Columns that depend on one column, with their distance."""
    graph = stored(column_edges(lineage), "column-edges")
    found = reach(graph, _column_node(F.lit(table), F.lit(column)), max_depth)
    return found.select("node.table_name", "node.column_name", "depth")


# Steps of an iteration planned together before their result is stored.
STEPS = 3


def _trim_once(graph: DataFrame, size: int) -> DataFrame:
    fed = bounded(graph.select(F.col("dst").alias("n")).distinct(), size)
    feeding = bounded(graph.select(F.col("src").alias("n")).distinct(), size)
    return graph.join(fed, F.col("src") == F.col("n"), "left_semi").join(
        feeding, F.col("dst") == F.col("n"), "left_semi"
    )


def _passes(graph: DataFrame) -> DataFrame:
    """(node, before, after) of nodes with exactly one edge in and one edge out."""
    one_in = graph.groupBy(F.col("dst").alias("node")).agg(
        F.count("*").alias("_n"), F.min("src").alias("before")
    )
    one_out = graph.groupBy(F.col("src").alias("node")).agg(
        F.count("*").alias("_n"), F.min("dst").alias("after")
    )
    return one_in.filter("_n = 1").drop("_n").join(one_out.filter("_n = 1").drop("_n"), "node")


def _climb_once(running: DataFrame, steps: DataFrame) -> DataFrame:
    """Runs of twice the length: every node that has not met its first takes over the pointer,
    and the least name, of the node it points to."""
    there = steps.select(
        F.col("node").alias("_at"),
        F.col("up").alias("_up"),
        F.col("least").alias("_least"),
        F.col("met").alias("_met"),
    )
    return running.join(there, F.col("up") == F.col("_at")).select(
        "node",
        F.col("_up").alias("up"),
        F.least("least", "_least").alias("least"),
        F.col("_met").alias("met"),
    )


def _chains(passing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The chains that nodes of ``_passes`` form, by pointer doubling: (node, first) of open
    chains, and (node, cycle_id) of closed rings.

    A node points to the one before it, the first of a chain to itself. After k rounds pointers
    reach back 2^k nodes. Lengths up to the longest all occur in an open chain, so when a round
    ends none, only rings are left; a round more than their doubled length needs, every node of
    a ring knows the least name in it.
    """
    before = passing.select(F.col("node").alias("_p"))
    linked = passing.join(before, F.col("before") == F.col("_p"), "left")
    steps, waiting = stored_counting(
        linked.select(
            "node",
            F.coalesce("_p", "node").alias("up"),
            F.coalesce(F.least("node", "_p"), "node").alias("least"),
            F.col("_p").isNull().alias("met"),
        ),
        F.when(F.col("met"), 0).otherwise(1),
    )
    reach, only_rings = 1, False
    while waiting and not (only_rings and reach >= waiting):
        running = _climb_once(steps.filter("not met"), steps)
        steps, left = stored_counting(
            steps.filter("met").unionByName(running), F.when(F.col("met"), 0).otherwise(1)
        )
        only_rings, waiting, reach = left == waiting, left, 2 * reach
    chains = steps.filter("met").select("node", F.col("up").alias("first"))
    return chains, steps.filter("not met").select("node", F.col("least").alias("cycle_id"))


def _contracted(graph: DataFrame, passing: DataFrame):
    """The graph with every open chain replaced by one edge from the node before it to the node
    behind it. Returns the new distinct edges, the chains' nodes with those two ends, and the
    nodes of rings, which are cycles of their own."""
    chains, rings = _chains(passing)
    placed = chains.join(passing, "node")
    ends = placed.groupBy("first").agg(
        F.max(F.when(F.col("node") == F.col("first"), F.col("before"))).alias("start"),
    )
    inner = placed.select(F.col("before").alias("_b"))
    last = placed.join(inner, F.col("node") == F.col("_b"), "left_anti")
    ends = ends.join(last.select("first", F.col("after").alias("end")), "first")
    members = stored(chains.join(ends, "first").select("node", "start", "end"), "chain")
    inside = passing.select(F.col("node").alias("_p"))
    rest = graph.join(inside, F.col("src") == F.col("_p"), "left_anti").join(
        inside, F.col("dst") == F.col("_p"), "left_anti"
    )
    shortcuts = members.filter("start <> end").select(
        F.col("start").alias("src"), F.col("end").alias("dst")
    )
    return rest.unionByName(shortcuts).distinct(), members, rings


def _reduced(graph: DataFrame) -> tuple[DataFrame, int, list[tuple[DataFrame, DataFrame]]]:
    """Contract chains and drop edges that cannot lie on a cycle, in turns, until neither helps.

    A path costs rounds by the logarithm of its length, not by its length. Also returns, for
    every contraction, the nodes of its chains and of its rings.
    """
    layers = []
    graph, size = stored_counting(graph)
    while size:
        passing, count = stored_counting(_passes(graph))
        smaller = graph
        if count:
            smaller, members, rings = _contracted(graph, passing)
            layers.append((members, rings))
        smaller, left = stored_counting(_trim_once(_trim_once(smaller, size), size))
        if left == size:
            break
        graph, size = smaller, left
    return graph, size, layers


def _trimmed(graph: DataFrame) -> tuple[DataFrame, int]:
    """Drop edges that cannot lie on a cycle: their source is never fed, or their target feeds nothing.

    Returns the remaining edges, stored, and their number. Stops when a round removes nothing.
    """
    graph, size = stored_counting(graph)
    while size:
        smaller, left = stored_counting(_trim_once(_trim_once(graph, size), size))
        if left == size:
            break
        graph, size = smaller, left
    return graph, size


def _unfolded(found: DataFrame, members: DataFrame) -> DataFrame:
    """Components with the nodes of contracted chains: those between two nodes of a component, and
    those of a chain that returns to its start, which then is a component, too."""
    from_, to = (
        found.select(F.col("node").alias(f"_{end}"), F.col("cycle_id").alias(f"_of_{end}"))
        for end in ("start", "end")
    )
    placed = members.join(from_, F.col("start") == F.col("_start"), "left").join(
        to, F.col("end") == F.col("_end"), "left"
    )
    component = F.when(
        F.col("start") == F.col("end"), F.coalesce("_of_start", "start")
    ).when(F.col("_of_start") == F.col("_of_end"), F.col("_of_start"))
    added = placed.select("node", component.alias("cycle_id")).filter("cycle_id is not null")
    bases = placed.filter("start = end and _of_start is null").select(
        F.col("start").alias("node"), F.col("start").alias("cycle_id")
    )
    return stored(found.unionByName(added).unionByName(bases.distinct()), "members")


def _spread_once(graph: DataFrame, labels: DataFrame, nodes: int) -> DataFrame:
    """Every node takes the smallest label offered over an incoming edge."""
    offered = (
        graph.join(bounded(labels.select("node", "label"), nodes), F.col("src") == F.col("node"))
        .groupBy(F.col("dst").alias("_n"))
        .agg(F.min("label").alias("_offer"))
    )
    return labels.join(bounded(offered, nodes), F.col("node") == F.col("_n"), "left").select(
        "node", F.least("label", "_offer").alias("label"), "_start"
    )


def _min_label(graph: DataFrame, labels: DataFrame, nodes: int) -> DataFrame:
    """Smallest label among a node and everything that reaches it, for at most ``nodes`` nodes."""
    while True:
        spread = labels.withColumn("_start", F.col("label"))
        for _ in range(STEPS):
            spread = _spread_once(graph, spread, nodes)
        moved = F.when(F.col("label") < F.col("_start"), 1).otherwise(0)
        spread, changes = stored_counting(spread, moved)
        labels = spread.select("node", "label")
        if not changes:
            return labels


def cycles(lineage: DataFrame) -> DataFrame:
    """Tables on a circular dependency: one row per table, grouped by cycle.

    Chains of tables with one edge in and one edge out are contracted first, by pointer
    doubling, and put back last. Between, strongly connected components by forward and backward
    colouring. Work per step is linear in the edges; pairs of nodes are never formed.
    """
    graph = stored(edges(lineage), "edges")
    loops = graph.filter("src = dst").select(F.col("src").alias("node"))
    members = graph.sparkSession.createDataFrame([], "node string, cycle_id string")
    rest, size, layers = _reduced(graph.filter("src <> dst"))
    while size:
        # After trimming every node has an incoming edge, so there are at most ``size`` nodes.
        nodes = rest.select(F.col("dst").alias("node")).distinct()
        colour = _min_label(rest, nodes.withColumn("label", F.col("node")), size)
        # Edges inside one colour, turned round: whatever the colour's own node reaches
        # over them also reaches it, and so shares its component.
        of_src = colour.select(F.col("node").alias("src"), F.col("label").alias("_cs"))
        of_dst = colour.select(F.col("node").alias("dst"), F.col("label").alias("_cd"))
        ends = rest.join(bounded(of_src, size), "src").join(bounded(of_dst, size), "dst")
        back = stored(
            ends.filter("_cs = _cd").select(F.col("dst").alias("src"), F.col("src").alias("dst")),
            "back",
        )
        own = F.when(F.col("node") == F.col("label"), 0).otherwise(1)
        marked = _min_label(back, colour.select("node", own.alias("label")), size).filter("label = 0")
        component = stored(
            colour.join(bounded(marked.select("node"), size), "node").select(
                "node", F.col("label").alias("cycle_id")
            ),
            "component",
        )
        members = members.unionByName(component)
        done = bounded(component.select("node"), size)
        rest, size = _trimmed(
            rest.join(done, F.col("src") == F.col("node"), "left_anti").join(
                done, F.col("dst") == F.col("node"), "left_anti"
            )
        )
    # A chain's ends may lie on chains or rings of later contractions, so those come back first.
    for chains, rings in reversed(layers):
        members = _unfolded(members.unionByName(rings), chains)
    # Components were named by a node of the contracted graph; the least of all nodes names them.
    names = members.groupBy("cycle_id").agg(F.min("node").alias("_least"))
    members = members.join(names, "cycle_id").select("node", F.col("_least").alias("cycle_id"))
    alone = loops.join(members.select("node"), "node", "left_anti").withColumn(
        "cycle_id", F.col("node")
    )
    # A component of one node is a cycle only when the node feeds itself.
    every = members.unionByName(alone).join(
        loops.withColumn("_self", F.lit(1)), "node", "left"
    )
    sizes = every.groupBy("cycle_id").agg(
        F.count("*").alias("cycle_size"), F.max("_self").alias("_self")
    )
    kept = sizes.filter("cycle_size > 1 OR _self = 1").drop("_self")
    return every.join(kept, "cycle_id").select(
        F.col("node").alias("table_name"), "cycle_id", "cycle_size"
    )
