"""The four reports over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import rounded
from folioflow.operators.common import join_small


def citation_velocity(works: DataFrame, venues: DataFrame, citations: DataFrame, as_of_year: int, min_year: int = 2015, limit: int = 50) -> DataFrame:
    """Works that are no stubs, from min_year or without a year, by influential citations and citations a year.

    Edges are counted per cited work before the join, which turns a hot cited work into
    one row. A null year divides by 1. Works alike in both orders come by id.
    """
    inbound = citations.where("citing_work_id is not null and cited_work_id is not null").groupBy("cited_work_id").agg(F.count("*").alias("inbound_citation_edges"))
    w = works.where(~F.col("is_stub") & ((F.col("publication_year") >= min_year) | F.col("publication_year").isNull()))
    names = venues.select("canonical_venue_id", F.col("name").alias("venue_name"))
    joined = join_small(w.join(inbound, w.canonical_work_id == inbound.cited_work_id, "left"), names, "canonical_venue_id", "left", venues)
    years = F.greatest(F.lit(1), F.lit(as_of_year) - F.col("publication_year") + 1)
    shown = joined.select("canonical_work_id", "title", "publication_year", "venue_name", "citation_count", "influential_citation_count", F.coalesce("inbound_citation_edges", F.lit(0)).alias("inbound_citation_edges"), rounded(F.col("citation_count") / years).alias("citation_velocity"))
    # Rows alike in all columns of the group are one row of the report, with their edges added up.
    keys = ["canonical_work_id", "title", "publication_year", "venue_name", "citation_count", "influential_citation_count"]
    grouped = shown.groupBy(*keys).agg(F.sum("inbound_citation_edges").alias("inbound_citation_edges"), F.first("citation_velocity").alias("citation_velocity"))
    return grouped.orderBy(F.desc_nulls_last("influential_citation_count"), F.desc_nulls_last("citation_velocity"), "canonical_work_id").limit(limit)


def coauthorship_network(work_authors: DataFrame, authors: DataFrame, min_collaborations: int = 1, limit: int = 50) -> DataFrame:
    """Pairs of author names with the works they share, most first; different authors of one name pair as any others do.

    Links are made distinct before they meet. Ties come by the names.
    """
    links = work_authors.select("canonical_work_id", "canonical_author_id").where("canonical_work_id is not null and canonical_author_id is not null").distinct()
    names = authors.select("canonical_author_id", "display_name").distinct()
    left = links.toDF("w", "a1")
    pairs = left.join(links.toDF("w", "a2"), "w").where("a1 < a2")
    named = pairs.join(names.toDF("a1", "author_1"), "a1").join(names.toDF("a2", "author_2"), "a2")
    return named.groupBy("author_1", "author_2").agg(F.countDistinct("w").alias("shared_works")).where(F.col("shared_works") >= min_collaborations).orderBy(F.desc("shared_works"), F.asc_nulls_last("author_1"), F.asc_nulls_last("author_2")).limit(limit)


def venue_impact(works: DataFrame, venues: DataFrame, limit: int = 20) -> DataFrame:
    """Works and citations of each venue, most cited first, then by name; venues without works are left out."""
    named = venues.select("canonical_venue_id", F.col("name").alias("venue_name"), "venue_type")
    w = works.where(~F.col("is_stub")).select("canonical_venue_id", "canonical_work_id", "citation_count")
    # Sums per venue id first: the join then meets one row for each venue.
    per = w.where("canonical_venue_id is not null").groupBy("canonical_venue_id").agg(F.count("canonical_work_id").alias("n"), F.sum("citation_count").alias("s"), F.count("citation_count").alias("c"))
    return join_small(per, named, "canonical_venue_id", "inner", venues).groupBy("venue_name", "venue_type").agg(F.sum("n").alias("total_works"), F.sum("s").alias("total_citations"), rounded(F.sum("s") / F.nullif(F.sum("c"), F.lit(0))).alias("avg_citations_per_work")).orderBy(F.desc_nulls_last("total_citations"), F.asc_nulls_last("venue_name"), F.asc_nulls_last("venue_type")).limit(limit)


def work_provenance_audit(provenance: DataFrame, observations: DataFrame, canonical_work_id: str) -> DataFrame:
    """Where each attribute of a work comes from, by attribute."""
    p = provenance.where(F.col("canonical_work_id") == F.lit(canonical_work_id))
    o = observations.select(F.col("observation_id").alias("source_observation_id"), "source_work_id")
    return p.join(o, "source_observation_id").select("attribute_name", "winning_source", "source_observation_id", "resolution_rule", "selected_at", "source_work_id").orderBy(F.asc_nulls_last("attribute_name"), "source_observation_id", "source_work_id")
