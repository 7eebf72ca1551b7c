"""Ingestion of a batch of JSON lines: parse, check, keep, quarantine, and rebuild the gold tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.identifiers import payload_hash
from folioflow.operators import quality
from folioflow.operators.common import written
from folioflow.operators.resolve import gold
from folioflow.sources import providers, records  # noqa: F401  (providers registers the sources)
from folioflow.sources.store import Store

#: The parsed works of accepted records, kept beside the tables: gold is a function of this log.
LOG = "accepted_log"


def fresh(lines: DataFrame, seen: DataFrame | None) -> DataFrame:
    """The readable lines whose payload is neither in seen (payload_hash) nor earlier in the batch; first one wins."""
    first = lines.groupBy("payload_hash").agg(F.min("line_idx").alias("line_idx"))
    once = lines.join(first, ["payload_hash", "line_idx"], "left_semi")
    return once if seen is None else once.join(seen.select("payload_hash").distinct(), "payload_hash", "left_anti")


def prepared(lines: DataFrame, source: str, seen: DataFrame | None, as_of_year: int) -> DataFrame:
    """(line_idx, line, payload_hash, work, error_type, error_message, warnings, outcome) of every line.

    outcome is accepted, rejected or repeated (a payload that was accepted before, in
    this batch or an earlier one). Payloads rejected before are checked and rejected again.
    """
    parsed = records.parse(lines.withColumn("payload_hash", payload_hash(F.col("line"))), source)
    checked = written(quality.check(parsed, as_of_year), "checked")
    good = checked.where("error_type is null")
    new = fresh(good.select("payload_hash", "line_idx"), seen).select("line_idx", F.lit(True).alias("new"))
    outcome = F.when(F.col("error_type").isNotNull(), "rejected").when(F.col("new"), "accepted").otherwise("repeated")
    return checked.join(new, "line_idx", "left").withColumn("outcome", outcome).drop("new")


def counters(lines: DataFrame) -> DataFrame:
    """(record_count, accepted_count, rejected_count) of prepared lines."""
    return lines.agg(F.count("*").cast("int").alias("record_count"), F.count_if(F.col("outcome") == "accepted").cast("int").alias("accepted_count"), F.count_if(F.col("outcome") == "rejected").cast("int").alias("rejected_count"))


def ingest(spark: SparkSession, store: Store, lines: DataFrame, source: str, run_id: str | None = None, run_ts: dt.datetime | None = None, as_of_year: int | None = None, input_uri: str | None = None) -> dict:
    """Ingest lines (line_idx, line) of a source as one run, all or nothing; returns the run row as a dict.

    An unknown source raises ValueError before anything is written. Bronze and silver
    keep the caller's letter case of the source.
    """
    records.parser_of(source)
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    as_of_year = as_of_year or run_ts.year
    run_id = run_id or f"run_{source}_{uuid.uuid4().hex[:12]}"
    at = F.lit(run_ts).cast("timestamp")
    manifest = store.read("raw_source_manifest")
    rows = written(prepared(lines, source, manifest, as_of_year), "prepared")
    counted = counters(rows).first()
    # Sums of four parts of each line's hash: they add up in any order, so every size of input has one formula and no task all lines.
    own = F.sha2(F.concat_ws(" ", F.col("line_idx").cast("string"), "payload_hash"), 256)
    sums = [F.sum(F.conv(F.substring(own, 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")).cast("string") for k in range(4)]
    whole = rows.agg(F.sha2(F.concat_ws(" ", *sums, F.count("*").cast("string")), 256).alias("h")).first()["h"]
    accepted = rows.where("outcome = 'accepted'")
    w = F.col("work")
    raw_id = F.concat(F.lit("raw_"), F.substring("payload_hash", 1, 16))
    obs_id = F.concat(F.lit(f"obs_{run_id}_"), F.col("line_idx").cast("string"))
    quarantine = rows.where("outcome = 'rejected'").select(F.concat(F.lit("quar_"), F.substring(F.sha2(F.concat(F.lit(run_id + ":"), F.col("line_idx").cast("string")), 256), 1, 16)).alias("quarantine_id"), F.lit(run_id).alias("run_id"), F.lit(source).alias("source_name"), F.when(F.col("error_type") == "MALFORMED_JSON", F.to_json(F.struct(F.col("line").alias("raw_line")))).otherwise(F.col("line")).alias("raw_payload"), "error_type", "error_message", at.alias("quarantined_at"))
    bronze = accepted.select(raw_id.alias("raw_record_id"), F.lit(run_id).alias("run_id"), F.lit(source).alias("source_name"), w["source_work_id"].alias("source_record_id"), "payload_hash", F.col("line").alias("payload"), at.alias("ingested_at"))
    keep_nulls = {"ignoreNullFields": "false"}
    silver = accepted.select(obs_id.alias("observation_id"), F.lit(run_id).alias("run_id"), raw_id.alias("raw_record_id"), F.lit(source).alias("source_name"), *[w[c].alias(c) for c in ("source_work_id", "normalized_doi", "normalized_arxiv_id", "title", "abstract", "publication_date", "publication_year", "raw_venue_name", "citation_count", "influential_citation_count")], F.to_json(w["authors"], keep_nulls).alias("raw_authors"), F.to_json(w["citations"], keep_nulls).alias("raw_citations"), at.alias("observed_at"), at.alias("created_at"))
    run_no = store.read("ingestion_runs").count()
    log_part = accepted.select(F.lit(run_no).cast("bigint").alias("run_no"), F.lit(run_id).alias("run_id"), "line_idx", obs_id.alias("observation_id"), "work")
    before = store.read(LOG)
    log = log_part if before is None else before.unionByName(log_part)
    run = {"run_id": run_id, "source_name": source, "input_uri": input_uri, "input_hash": whole or "", "record_count": counted["record_count"], "accepted_count": counted["accepted_count"], "rejected_count": counted["rejected_count"], "error_count": 0, "pipeline_version": "0.1.0", "parser_version": "0.1.0", "schema_version": "1.0.0", "started_at": run_ts, "completed_at": run_ts, "status": "COMPLETED"}
    from folioflow.operators.schemas import schema

    run_row = spark.createDataFrame([tuple(run[f.name] for f in schema("ingestion_runs"))], schema("ingestion_runs"))
    store.commit(gold(log, at), {"ingestion_runs": run_row, "raw_source_manifest": bronze, "ingestion_quarantine": quarantine, "source_work_observations": silver, LOG: log_part})
    return run


def ingest_file(spark: SparkSession, store: Store, path: str, source: str, **more) -> dict:
    """ingest() of a text file or folder; FileNotFoundError if there is none."""
    return ingest(spark, store, records.read_lines(spark, path), source, input_uri=path, **more)
