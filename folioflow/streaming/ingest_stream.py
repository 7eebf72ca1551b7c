"""Ingestion from a folder that fills up: each micro-batch is one run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioflow.functions.text import strip
from folioflow.plans.ingest import ingest
from folioflow.sources.store import Store


def numbered(batch: DataFrame) -> DataFrame:
    """(line_idx, line) of a batch of text rows, in the order of files and rows; blank lines are dropped."""
    rows = batch.select(strip(F.col("value")).alias("line"), F.monotonically_increasing_id().alias("line_idx"))
    return rows.where("line <> ''").select("line_idx", "line")


def ingest_stream(spark: SparkSession, store: Store, folder: str, source: str, checkpoint: str, as_of_year: int | None = None) -> StreamingQuery:
    """Start ingesting the text files that appear in folder. A batch that is tried again finds its payloads there and adds nothing."""

    def one(batch: DataFrame, number: int) -> None:
        run_id = f"run_{source}_{number:012d}"
        if store.read("ingestion_runs").where(F.col("run_id") == run_id).isEmpty():
            ingest(spark, store, numbered(batch), source, run_id=run_id, as_of_year=as_of_year, input_uri=folder)

    return spark.readStream.text(folder).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
