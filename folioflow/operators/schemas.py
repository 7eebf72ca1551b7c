"""The fifteen tables with their keys, as Spark schemas, and the versioned schema registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TS = "timestamp"
#: name: (columns, primary key, unique columns, foreign keys {column: (table, column)})
TABLES: dict[str, tuple[str, tuple[str, ...], tuple[str, ...], dict[str, tuple[str, str]]]] = {
    "schema_migrations": (f"version int, description string, applied_at {_TS}", ("version",), (), {}),
    "ingestion_runs": (f"run_id string, source_name string, input_uri string, input_hash string, record_count int, accepted_count int, rejected_count int, error_count int, pipeline_version string, parser_version string, schema_version string, started_at {_TS}, completed_at {_TS}, status string", ("run_id",), (), {}),
    "raw_source_manifest": (f"raw_record_id string, run_id string, source_name string, source_record_id string, payload_hash string, payload string, ingested_at {_TS}", ("raw_record_id",), (), {"run_id": ("ingestion_runs", "run_id")}),
    "ingestion_quarantine": (f"quarantine_id string, run_id string, source_name string, raw_payload string, error_type string, error_message string, quarantined_at {_TS}", ("quarantine_id",), (), {"run_id": ("ingestion_runs", "run_id")}),
    "source_work_observations": (f"observation_id string, run_id string, raw_record_id string, source_name string, source_work_id string, normalized_doi string, normalized_arxiv_id string, title string, abstract string, publication_date date, publication_year int, raw_venue_name string, citation_count int, influential_citation_count int, raw_authors string, raw_citations string, observed_at {_TS}, created_at {_TS}", ("observation_id",), (), {"run_id": ("ingestion_runs", "run_id"), "raw_record_id": ("raw_source_manifest", "raw_record_id")}),
    "canonical_venues": (f"canonical_venue_id string, name string, normalized_name string, venue_type string, tier string, issn string, created_at {_TS}", ("canonical_venue_id",), (), {}),
    "canonical_institutions": (f"canonical_inst_id string, name string, ror_id string, country_code string, homepage_url string, created_at {_TS}", ("canonical_inst_id",), ("ror_id",), {}),
    "canonical_authors": (f"canonical_author_id string, display_name string, orcid string, aliases array<string>, created_at {_TS}, updated_at {_TS}", ("canonical_author_id",), ("orcid",), {}),
    "canonical_works": (f"canonical_work_id string, title string, abstract string, publication_year int, publication_date date, canonical_doi string, canonical_arxiv_id string, canonical_venue_id string, is_stub boolean, stub_reason string, created_from_source string, citation_count int, influential_citation_count int, created_at {_TS}, updated_at {_TS}", ("canonical_work_id",), ("canonical_doi", "canonical_arxiv_id"), {}),
    "canonical_work_identifiers": (f"identifier_type string, normalized_value string, canonical_work_id string, raw_value string, created_at {_TS}", ("identifier_type", "normalized_value"), (), {}),
    "canonical_work_authors": ("canonical_work_id string, canonical_author_id string, author_position int, canonical_inst_id string, raw_author_name string, raw_affiliation_string string, is_corresponding boolean", ("canonical_work_id", "canonical_author_id", "author_position"), (), {}),
    "canonical_citations": (f"citing_work_id string, cited_work_id string, is_influential boolean, citation_intents array<string>, source_provider string, created_at {_TS}", ("citing_work_id", "cited_work_id"), (), {}),
    "canonical_work_provenance": (f"canonical_work_id string, attribute_name string, winning_source string, source_observation_id string, resolution_rule string, selected_at {_TS}", ("canonical_work_id", "attribute_name"), (), {"source_observation_id": ("source_work_observations", "observation_id")}),
    "metrics_provenance": (f"canonical_work_id string, metric_name string, metric_value double, source_provider string, source_observation_id string, run_id string, observed_at {_TS}", (), (), {"source_observation_id": ("source_work_observations", "observation_id"), "run_id": ("ingestion_runs", "run_id")}),
    "canonical_work_aliases": (f"alias_work_id string, resolved_canonical_id string, reason string, merged_at {_TS}", ("alias_work_id",), (), {}),
}
#: (version, description, tables it brings), in order.
MIGRATIONS = ((1, "Bronze, silver and gold tables", tuple(TABLES)),)


def schema(name: str) -> T.StructType:
    return T._parse_datatype_string(TABLES[name][0])


def conformed(df: DataFrame, name: str) -> DataFrame:
    """df with exactly the columns of a table, in order and type; columns it lacks are null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(name)])


def violations(tables: dict[str, DataFrame]) -> DataFrame | None:
    """(table_name, rule, n): broken primary keys, unique columns and foreign keys of the tables given; nulls are not unique-checked.

    A foreign key is checked where the table it points to is among those given.
    """
    out = None
    for name, df in tables.items():
        _, key, unique, foreign = TABLES[name]
        checks = [(("primary key",), key)] if key else []
        checks += [(("unique", c), (c,)) for c in unique]
        for rule, columns in checks:
            rows = df if rule[0] == "primary key" else df.where(F.col(columns[0]).isNotNull())
            one = rows.groupBy(*columns).agg(F.count("*").alias("c")).where("c > 1").agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), F.lit(" ".join(rule)).alias("rule"), "n")
            out = one if out is None else out.unionByName(one)
        for c, (other, target) in foreign.items():
            if other in tables:
                there = tables[other].select(F.col(target).alias(c)).distinct()
                one = df.where(F.col(c).isNotNull()).select(c).join(there, c, "left_anti").agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), F.lit(f"foreign key {c}").alias("rule"), "n")
                out = one if out is None else out.unionByName(one)
    return None if out is None else out.where("n > 0")
