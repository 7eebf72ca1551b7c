"""Connected components against union-find, and groups of works."""

import random

import pytest

from folioflow.llm import components as C


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in parent}


def run(spark, edges):
    got = C.connected_components(spark.createDataFrame(edges, "a string, b string")).collect()
    assert len(got) == len({r.v for r in got})
    return {r.v: r.group_id for r in got}


def shapes():
    n = lambda k, i: f"{k}{i:03d}"
    path = [(n("p", i), n("p", i + 1)) for i in range(37)]
    cycle = [(n("c", i), n("c", (i + 1) % 23)) for i in range(23)]
    clique = [(n("k", i), n("k", j)) for i in range(7) for j in range(i)]
    star = [("s000", n("s", i)) for i in range(1, 30)]
    theta = [("t000", "t001"), ("t001", "t002"), ("t002", "t010"), ("t000", "t003"), ("t003", "t010"), ("t000", "t004"), ("t004", "t005"), ("t005", "t006"), ("t006", "t010")]
    lasso = [(n("l", i), n("l", i + 1)) for i in range(9)] + [("l009", "l004")]
    dirt = [("x", "x"), (None, "y"), ("z", None), ("p003", "p002"), ("p003", "p002"), ("two", "one")]
    return path + cycle + clique + star + theta + lasso + dirt


def test_shapes(spark):
    edges = shapes()
    assert run(spark, edges) == union_find(edges)


@pytest.mark.parametrize("seed", range(2))
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(f"v{rng.randint(0, 90):02d}", f"v{rng.randint(0, 90):02d}") for _ in range(70 + 20 * seed)]
    assert run(spark, edges) == union_find(edges)


def test_no_edges(spark):
    assert run(spark, []) == {} and run(spark, [("a", "a"), (None, None)]) == {}


def test_groups_of_works(spark):
    rows = [("DOI", "10.1/A ", "W2"), ("doi", " 10.1/a", "w1"), ("PMID", "5", "w1 "), ("PMID", "5", "w3"), ("MAG", "5", "w9"), ("DOI", "none", "w4"), ("DOI", "NONE", "w5"), ("MAG", "0", "w6"), ("MAG", "0", "w7"), (None, "q", "w8"), (None, "q", "w7"), ("DOI", None, "w8"), ("DOI", "x", None), ("DOI", "10.1/A ", "W2")]
    df = spark.createDataFrame([(*r, "v", 1) for r in rows], "identifier_type string, normalized_value string, canonical_work_id string, v string, a int")
    assert {tuple(r) for r in C.work_groups(df).collect()} == {("w1", "w1"), ("w2", "w1"), ("w3", "w1")}
    assert C.work_groups(df.limit(0)).count() == 0


def test_a_hot_value_is_one_star(spark):
    rows = [("DOI", "hot", f"w{i:05d}") for i in range(3000)] + [("DOI", f"v{i}", f"x{i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "identifier_type string, normalized_value string, canonical_work_id string")
    got = C.work_groups(df).collect()
    assert len(got) == 3000 and {r.group_id for r in got} == {"w00000"}


def test_a_hub_with_a_third_of_the_edges(spark):
    edges = [("hub", f"l{i:04d}") for i in range(1500)] + [(f"l{i:04d}", f"l{i + 1:04d}") for i in range(0, 600, 2)] + [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(0, 2800) if i % 7] + [("hub", "c0001"), ("m1", "m2"), ("m2", "hub")]
    assert C._hubs(spark.createDataFrame([("hub", 1502), ("x", 3)], "v string, n bigint"), "v", len(edges)).count() == 1
    assert run(spark, edges) == union_find(edges)
    core = [(f"h{i % 2}", f"v{i:04d}") for i in range(2400)] + [(f"v{i:04d}", f"v{i + 3:04d}") for i in range(0, 2390)]
    assert run(spark, core) == union_find(core)
