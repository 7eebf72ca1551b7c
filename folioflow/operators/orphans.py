"""References to records that do not exist, per table and period.

Skew-aware split. References are pre-aggregated per key and period before any
shuffle of single rows, so one key holding a third of all rows becomes one row
per period. Keys that stay heavy (fewer than HOT_SHARE of them, by counting)
are checked against a broadcast of just those targets; the remaining keys go
through a shuffle anti join; both orphan counts are united.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.text import id_key
from folioflow.operators.common import hot_keys, table, written


@dataclass(frozen=True)
class Reference:
    """A foreign key: refs has (ref_id, period) and may have n_refs, the rows that one stands for; targets has (target_id, since)."""

    table_name: str
    refs: DataFrame
    targets: DataFrame


def orphans(references: list[Reference]) -> DataFrame:
    """(table_name, period, missing_id, kind, n_rows), one row for each combination that occurs.

    kind is ``missing`` when no target has the id, ``late`` when the earliest target
    came in a later month than the period. Ids are compared without letter case and
    surrounding blanks. Null and blank ids refer to nothing and give no row; rows
    without a period are reported with period null only if they are missing.
    Repeated rows add to n_rows only. Empty tables give no row.
    """
    pre = None
    for r in references:
        stands_for = F.col("n_refs") if "n_refs" in r.refs.columns else F.lit(1)
        one = r.refs.select(id_key(F.col("ref_id")).alias("_id"), F.col("period").alias("_period"), stands_for.cast("bigint").alias("_n")).where("_id is not null").groupBy("_id", "_period").agg(F.sum("_n").alias("_n")).select(F.lit(r.table_name).alias("_table"), "*")
        pre = one if pre is None else pre.unionByName(one)
    # Written once: heavy keys, both joins and the totals read the pre-aggregated rows, not the tables.
    pre = written(pre, "references")
    totals = {r["_table"]: r["n"] for r in pre.groupBy("_table").agg(F.sum("_n").alias("n")).collect()}
    out, targets = None, {}
    every = pre
    for r in references:
        pre = every.where(F.col("_table") == r.table_name).drop("_table")
        if id(r.targets) not in targets:
            targets[id(r.targets)] = written(_known(r.targets), "targets")
        known = targets[id(r.targets)]
        heavy = F.broadcast(hot_keys(pre, "_id", totals.get(r.table_name, 0), F.col("_n")))
        by_broadcast = pre.join(heavy, "_id", "left_semi").join(F.broadcast(known.join(heavy, "_id", "left_semi")), "_id", "left")
        by_shuffle = pre.join(heavy, "_id", "left_anti").join(known, "_id", "left")
        kind = F.when(F.col("_there").isNull(), "missing").when(F.col("_since") > F.col("_period"), "late")
        one = by_broadcast.unionByName(by_shuffle).select(F.lit(r.table_name).alias("table_name"), F.col("_period").alias("period"), F.col("_id").alias("missing_id"), kind.alias("kind"), F.col("_n").alias("n_rows")).where("kind is not null")
        out = one if out is None else out.unionByName(one)
    return out


def _known(targets: DataFrame) -> DataFrame:
    """(_id, _since, _there): each target once with the month it first came in."""
    return targets.select(id_key(F.col("target_id")).alias("_id"), F.col("since").alias("_since")).where("_id is not null").groupBy("_id").agg(F.min(F.date_format("_since", "yyyy-MM")).alias("_since"), F.lit(True).alias("_there"))


def dated_by_work(work_authors: DataFrame, works: DataFrame) -> DataFrame:
    """(ref_id, period, n_refs) of author references, dated by the month of their work.

    The link table is pre-aggregated to one row for each work and author first; a work
    that is absent or undated gives no month, so the period of these is null.
    """
    pairs = work_authors.select(id_key(F.col("canonical_work_id")).alias("_work"), id_key(F.col("canonical_author_id")).alias("ref_id")).where("ref_id is not null").groupBy("_work", "ref_id").agg(F.count("*").alias("n_refs"))
    dated = works.select(id_key(F.col("canonical_work_id")).alias("_work"), "created_at").where("_work is not null and created_at is not null").groupBy("_work").agg(F.min("created_at").alias("created_at"))
    return pairs.join(dated, "_work", "left").select("ref_id", F.date_format("created_at", "yyyy-MM").alias("period"), "n_refs")


def catalogue_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three references of the catalogue; see orphans()."""
    works = table(spark, sf_dir, "canonical_works", "canonical_work_id", "created_at")
    authors = table(spark, sf_dir, "canonical_authors", "canonical_author_id", "created_at")
    month = F.date_format("created_at", "yyyy-MM").alias("period")
    cites = table(spark, sf_dir, "canonical_citations", "cited_work_id", "created_at")
    links = table(spark, sf_dir, "canonical_work_authors", "canonical_work_id", "canonical_author_id")
    idents = table(spark, sf_dir, "canonical_work_identifiers", "canonical_work_id", "created_at")
    as_target = works.select(F.col("canonical_work_id").alias("target_id"), F.col("created_at").alias("since"))
    return orphans(
        [
            Reference("canonical_citations", cites.select(F.col("cited_work_id").alias("ref_id"), month), as_target),
            Reference("canonical_work_authors", dated_by_work(links, works), authors.select(F.col("canonical_author_id").alias("target_id"), F.col("created_at").alias("since"))),
            Reference("canonical_work_identifiers", idents.select(F.col("canonical_work_id").alias("ref_id"), month), as_target),
        ],
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_name, period, missing_id, kind) of every orphan reference that has a period."""
    return catalogue_orphans(spark, sf_dir).where("period is not null").select("table_name", "period", "missing_id", "kind")


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references counted per table, period and kind; period is null for those of no known month."""
    return catalogue_orphans(spark, sf_dir).groupBy("table_name", "period", "kind").agg(F.count("*").alias("n_ids"), F.sum("n_rows").alias("n_rows"))


_ORPHANS_SQL = r"""
with w as (select lower(trim(canonical_work_id)) id, strftime(min(created_at), '%Y-%m') since, min(created_at) c from canonical_works where trim(canonical_work_id) <> '' group by 1),
a as (select lower(trim(canonical_author_id)) id, strftime(min(created_at), '%Y-%m') since from canonical_authors where trim(canonical_author_id) <> '' group by 1),
r as (
  select 'canonical_citations' table_name, strftime(created_at, '%Y-%m') period, lower(trim(cited_work_id)) id, count(*) n from canonical_citations group by all
  union all select 'canonical_work_identifiers', strftime(created_at, '%Y-%m'), lower(trim(canonical_work_id)), count(*) from canonical_work_identifiers group by all
  union all select 'canonical_work_authors', w.since, lower(trim(x.canonical_author_id)), count(*) from canonical_work_authors x left join w on w.id = lower(trim(x.canonical_work_id)) group by all
), j as (
  select r.table_name, r.period, r.id missing_id, r.n, case when t.id is null then 'missing' when t.since > r.period then 'late' end kind
  from r left join (select 'w' s, id, since from w union all select 'a', id, since from a) t on t.id = r.id and t.s = case when r.table_name = 'canonical_work_authors' then 'a' else 'w' end
  where r.id <> ''
)
"""
P5_FOUND_SQL = _ORPHANS_SQL + "select table_name, period, missing_id, kind from j where kind is not null and period is not null"
P5_REPORT_SQL = _ORPHANS_SQL + "select table_name, period, kind, count(*) n_ids, cast(sum(n) as bigint) n_rows from j where kind is not null group by all"
