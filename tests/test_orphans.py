"""Orphan references: against a plain computation, with a hot key, nulls, blanks and empty tables."""

import datetime as dt

from pyspark.sql import functions as F

from folioflow.operators.orphans import Reference, dated_by_work, orphans

D = dt.datetime


def table(spark, refs, targets):
    r = spark.createDataFrame(refs, "ref_id string, period string, kind string")  # kind: a clashing name that is not read
    t = spark.createDataFrame(targets, "target_id string, since timestamp, _n string")
    return orphans([Reference("t", r, t)])


def test_kinds_counts_and_dirt(spark):
    refs = [("A ", "2020-01", ""), ("a", "2020-01", ""), ("b", "2020-02", ""), (" ", "2020-01", ""), (None, "2020-01", ""), ("c", "2020-01", ""), ("c", "2021-06", ""), ("d", None, "")]
    targets = [("B", D(2020, 2, 28), ""), ("c", D(2021, 5, 1), ""), ("c", D(2021, 7, 1), ""), (None, D(2020, 1, 1), "")]
    got = {tuple(r) for r in table(spark, refs, targets).collect()}
    assert got == {("t", "2020-01", "a", "missing", 2), ("t", "2020-01", "c", "late", 1), ("t", None, "d", "missing", 1)}


def test_a_hot_key_takes_the_broadcast_side_and_counts_whole(spark):
    hot = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("ref_id"), F.lit("2020-01").alias("period"))
    targets = spark.range(0, 6000, 2).select(F.concat(F.lit("k"), F.col("id")).alias("target_id"), F.lit("2019-01-01").cast("timestamp").alias("since"))
    got = orphans([Reference("t", hot, targets)])
    n = {r.missing_id: r.n_rows for r in got.collect()}
    assert n["hot"] == 2000 and len(n) == 1 + sum(1 for i in range(6000) if i % 3 and i % 2)


def test_empty(spark):
    assert table(spark, [], []).count() == 0
    assert table(spark, [("a", "2020-01", "")], []).count() == 1


def test_author_links_are_dated_by_their_work(spark):
    links = spark.createDataFrame([("W1", "a"), ("w1 ", "a"), ("w2", "b"), (None, "c"), ("w3", "d")], "canonical_work_id string, canonical_author_id string")
    works = spark.createDataFrame([("w1", D(2020, 3, 1)), ("w2", None)], "canonical_work_id string, created_at timestamp")
    assert {tuple(r) for r in dated_by_work(links, works).collect()} == {("a", "2020-03", 2), ("b", None, 1), ("c", None, 1), ("d", None, 1)}
