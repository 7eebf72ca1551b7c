"""Pairwise matches consolidated into groups: connected components by graph reduction.

Repeatedly compress chains of degree-two vertices by list ranking (pointer
doubling over directed darts) and strip degree-one vertices, remembering for
each removed vertex the neighbour it hangs on; solve the reduced core by
alternating star contraction; then give the labels back to the removed
vertices in reverse order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.text import id_key
from folioflow.operators.common import HOT_SHARE, hot_keys, removed, spread_join, table, written

#: What stands for "no identifier" once lower-cased and stripped.
STAND_INS = ("", "none", "null", "n/a", "unknown", "0", "-")


def _canonical(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("w")))


def _hubs(counted: DataFrame, key: str, total: int) -> DataFrame | None:
    """The keys of counted (key, n) that hold more than one row in HOT_SHARE of total; None where there are none.

    By counting there are fewer than HOT_SHARE of them, so they may go through the driver.
    """
    rows = counted.where(F.col("n") > max(1000, total // HOT_SHARE)).select(key).collect()
    return counted.sparkSession.createDataFrame(rows, counted.select(key).schema) if rows else None


def _without(edges: DataFrame, gone: DataFrame, hubs: DataFrame | None) -> DataFrame:
    """Edges of which neither end is gone (v); those of hubs are spread."""
    for end in ("a", "b"):
        edges = spread_join(edges, gone.select(F.col("v").alias(end)), end, None if hubs is None else hubs.select(F.col("v").alias(end)), "left_anti")
    return edges.select("a", "b")


def _compress(edges: DataFrame, hubs: DataFrame | None = None) -> tuple[DataFrame, DataFrame] | None:
    """Chains of degree-two vertices replaced by one edge each: (edges, hung), or None where there is none.

    hung has (v, onto): the removed vertices and the vertex whose label they take.
    A cycle of degree-two vertices is a whole component; its vertices hang on its smallest.
    """
    arcs = _both_ways(edges)
    degree = arcs.groupBy("v").agg(F.count("*").alias("d"), F.min("w").alias("w1"), F.max("w").alias("w2"))
    inner = written(degree.where("d = 2").select("v", "w1", "w2"), "chain")
    if inner.isEmpty():
        return None
    # A dart goes out of v over its first or second side; it walks on while the vertex it reaches is inner.
    darts = inner.select("v", F.explode(F.array("w1", "w2")).alias("to"))
    # (v, to): the dart; (at, then): the dart it has got to, then null once `at` is an end; least: smallest vertex passed; rank: steps taken.
    nxt = inner.select(F.col("v").alias("to"), "w1", "w2")
    state = spread_join(darts, nxt, "to", None if hubs is None else hubs.select(F.col("v").alias("to")), "left").select("v", "to", F.col("to").alias("at"), F.when(F.col("w1").isNotNull(), F.when(F.col("w1") == F.col("v"), F.col("w2")).otherwise(F.col("w1"))).alias("then"), F.least("v", "to").alias("least"), F.lit(1).cast("bigint").alias("rank"))
    state = written(state, "darts")
    ended = -1
    while True:
        other = state.select(F.col("v").alias("at"), F.col("to").alias("then"), F.col("at").alias("at2"), F.col("then").alias("then2"), F.col("least").alias("least2"), F.col("rank").alias("rank2"))
        walking = state.where("then is not null")
        moved = walking.join(other, ["at", "then"]).select("v", "to", F.col("at2").alias("at"), F.col("then2").alias("then"), F.least("least", "least2").alias("least"), (F.col("rank") + F.col("rank2")).alias("rank"), (F.least("least", "least2") < F.col("least")).alias("moved"))
        new = written(moved.unionByName(state.where("then is null").withColumn("moved", F.lit(False))), "darts")
        now = new.agg(F.count_if("moved").alias("moved"), F.count_if(F.col("then").isNull()).alias("ended")).first()
        removed(state)
        state = new.drop("moved")
        if now["ended"] == ended and not now["moved"]:
            break
        ended = now["ended"]
    # An ended dart: `at` is the end (not inner). Both darts of a chain vertex are ended, or both go round a cycle.
    ends = state.where("then is null").groupBy("v").agg(F.min("at").alias("e1"), F.max("at").alias("e2"))
    cycles = state.where("then is not null").groupBy("v").agg(F.min("least").alias("onto"))
    hung = ends.select("v", F.col("e1").alias("onto")).unionByName(cycles.where("v <> onto"))
    bridged = ends.select(F.col("e1").alias("a"), F.col("e2").alias("b")).where("a < b")
    left = written(_canonical(_without(edges, inner, hubs).unionByName(bridged)), "edges"), written(hung, "hung")
    removed(state)
    return left


def _strip(edges: DataFrame, hubs: DataFrame | None = None) -> tuple[DataFrame, DataFrame] | None:
    """Degree-one vertices removed: (edges, hung), or None where there is none. Of a lone pair the larger goes."""
    degree = _both_ways(edges).groupBy("v").agg(F.count("*").alias("d"), F.min("w").alias("onto"))
    leaves = degree.where("d = 1").select("v", "onto")
    twin = leaves.select(F.col("v").alias("onto"), F.col("onto").alias("v"), F.lit(True).alias("pair"))
    leaves = written(leaves.join(twin, ["v", "onto"], "left").where("pair is null or v > onto").select("v", "onto"), "hung")
    if leaves.isEmpty():
        return None
    return written(_without(edges, leaves, hubs), "edges"), leaves


def _stars(edges: DataFrame) -> DataFrame:
    """(v, label) of the core by alternating large-star and small-star steps; label is the smallest of the component."""
    arcs = written(edges.select(F.col("b").alias("v"), F.col("a").alias("w")), "star")  # w < v
    total = arcs.count()
    while True:
        both = arcs.unionByName(arcs.select(F.col("w").alias("v"), F.col("v").alias("w")))
        least = written(both.groupBy("v").agg(F.min("w").alias("m"), F.count("*").alias("n")).select("v", F.least("v", "m").alias("m"), "n"), "least")
        large = written(spread_join(both, least.select("v", "m"), "v", _hubs(least, "v", total)).where("w > v").select(F.col("w").alias("v"), F.col("m").alias("w")).where("v > w").distinct(), "large")
        small_least = written(large.groupBy("v").agg(F.min("w").alias("m"), F.count("*").alias("n")), "least")
        small = spread_join(large, small_least.select("v", "m"), "v", _hubs(small_least, "v", total)).select(F.col("w").alias("v"), F.col("m").alias("w")).where("v > w").unionByName(small_least.select("v", F.col("m").alias("w"))).distinct()
        new = written(small, "star")
        same = arcs.exceptAll(new).isEmpty() and new.exceptAll(arcs).isEmpty()
        for t in (arcs, least, large, small_least):
            removed(t)
        arcs = new
        if same:
            break
    roots = arcs.select(F.col("w").alias("v")).distinct().join(arcs.select("v"), "v", "left_anti")
    return arcs.select("v", F.col("w").alias("label")).unionByName(roots.select("v", F.col("v").alias("label")))


def connected_components(edges: DataFrame, core_rounds: int = 64) -> DataFrame:
    """(v, group_id) for each vertex of the undirected edges (a, b); group_id is the smallest vertex of its group.

    Self-loops, repeated edges, edges given in both directions and edges with a null
    end add nothing; a vertex that has only such edges is in no row. No edges give
    no rows. core_rounds bounds the reductions before the core is solved, not the
    result: whatever is left then is solved by star contraction. The edges of a hub (a
    vertex with more than one in HOT_SHARE of all) are never joined in one task.
    """
    edges = written(_canonical(edges.where("a is not null and b is not null")), "edges")
    total = edges.count()
    # Reductions only take edges from a vertex, so these are the hubs of every round.
    hubs = _hubs(_both_ways(edges).groupBy("v").agg(F.count("*").alias("n")), "v", total)
    hung_of: list[DataFrame] = []
    for _ in range(core_rounds):
        if edges.isEmpty():
            break
        changed = False
        for step in (_strip, _compress):
            done = step(edges, hubs)
            if done:
                removed(edges)
                edges, hung = done
                hung_of.append(hung)
                changed = True
        if not changed:
            break
    nothing = hung_of[0].select("v", F.col("v").alias("label")).limit(0) if hung_of else edges.select(F.col("a").alias("v"), F.col("b").alias("label"))
    labels = nothing if edges.isEmpty() else written(_stars(edges), "labels")
    for hung in reversed(hung_of):  # what a vertex hangs on has its label by now, or is a root of its own
        onto = hung.select(F.col("onto").alias("v")).distinct().join(labels, "v", "left_anti").select("v", F.col("v").alias("label"))
        labels = labels.unionByName(onto)
        labels = written(labels.unionByName(spread_join(hung, labels.select(F.col("v").alias("onto"), "label"), "onto", None if hubs is None else hubs.select(F.col("v").alias("onto"))).select("v", "label")), "labels")
    least = written(labels.groupBy("label").agg(F.min("v").alias("group_id"), F.count("*").alias("n")), "groups")
    return spread_join(labels, least.select("label", "group_id"), "label", _hubs(least, "label", total)).select("v", "group_id")


def shared_value_edges(rows: DataFrame, keys: list[str], member: str, total: int) -> DataFrame:
    """Edges (a, b) that join all members with equal keys: each member with the smallest one, a star per value.

    Members are made distinct per key first. Keys held by more than one in HOT_SHARE
    of all rows are joined by broadcast (their number is bounded by counting), the
    others by shuffle, so no task gets a hot key whole.
    """
    distinct = rows.select(F.struct(*keys).alias("k"), F.col(member).alias("v")).distinct()
    centre = distinct.groupBy("k").agg(F.min("v").alias("c"), F.count("*").alias("n")).where("n > 1")
    hot = F.broadcast(hot_keys(distinct, "k", total))
    by_broadcast = distinct.join(F.broadcast(centre.join(hot, "k", "left_semi")), "k")
    by_shuffle = distinct.join(centre.join(hot, "k", "left_anti"), "k")
    return by_broadcast.unionByName(by_shuffle).where("v <> c").select(F.col("c").alias("a"), F.col("v").alias("b"))


def work_groups(identifiers: DataFrame) -> DataFrame:
    """(canonical_work_id, group_id) of every work that shares an identifier with another, directly or through others.

    Letter case and surrounding blanks of types, values and ids are ignored. Rows with
    a null type, value or id and values of STAND_INS link nothing. Repeated rows add
    nothing, extra columns are not read, an empty table gives no row.
    """
    kind, value, work = (id_key(F.col(c)) for c in ("identifier_type", "normalized_value", "canonical_work_id"))
    rows = identifiers.select(kind.alias("kind"), value.alias("value"), work.alias("work")).where(F.col("kind").isNotNull() & F.col("work").isNotNull() & F.col("value").isNotNull() & ~F.col("value").isin(*STAND_INS))
    edges = shared_value_edges(rows, ["kind", "value"], "work", identifiers.count())
    return connected_components(edges).select(F.col("v").alias("canonical_work_id"), "group_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(canonical_work_id, group_id) of every linked work; see work_groups()."""
    return work_groups(table(spark, sf_dir, "canonical_work_identifiers", "identifier_type", "normalized_value", "canonical_work_id"))


def p4_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_works, n_groups): how many groups have how many works."""
    return p4_found(spark, sf_dir).groupBy("group_id").agg(F.count("*").alias("n_works")).groupBy("n_works").agg(F.count("*").alias("n_groups"))


_GROUPS_SQL = """
with recursive k as (
  select distinct lower(trim(identifier_type)) t, lower(trim(normalized_value)) v, lower(trim(canonical_work_id)) w from canonical_work_identifiers
  where trim(canonical_work_id) <> '' and trim(identifier_type) <> '' and lower(trim(normalized_value)) not in ('', 'none', 'null', 'n/a', 'unknown', '0', '-')
), e as (select distinct x.w a, y.w b from k x join k y using (t, v) where x.w <> y.w),
r as (select a, a as b from e union select r.a, e.b from r join e on r.b = e.a)
"""
P4_FOUND_SQL = _GROUPS_SQL + "select a canonical_work_id, min(b) group_id from r group by a"
P4_SIZES_SQL = _GROUPS_SQL + "select n_works, count(*) n_groups from (select g, count(*) n_works from (select a, min(b) g from r group by a) group by g) group by n_works"
