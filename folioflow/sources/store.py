"""Versioned Parquet tables with one pointer: all changes of a run appear at once or not at all."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators.schemas import MIGRATIONS, TABLES, conformed, schema, violations


class ConstraintError(ValueError):
    """A primary key, unique column or foreign key would be broken."""


class Store:
    """A folder with one sub-folder per table version and a pointer file that names the current ones. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.migrate()

    def _p(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def pointer(self) -> dict[str, list[str]]:
        """table: the folders that make up its current version."""
        if not self._fs.exists(self._p("CURRENT")):
            return {}
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.path}/CURRENT").collect()))

    def read(self, name: str) -> DataFrame:
        """The current version of a table; empty if nothing was written yet."""
        folders = self.pointer().get(name, [])
        if not folders:
            return self.spark.createDataFrame([], schema(name)) if name in TABLES else None
        reader = self.spark.read.schema(schema(name)) if name in TABLES else self.spark.read
        return reader.parquet(*[f"{self.path}/{f}" for f in folders])

    def commit(self, replaced: dict[str, DataFrame], appended: dict[str, DataFrame], checked: bool = True) -> None:
        """Write tables as new versions or added parts, check their keys, then swap the pointer.

        If anything fails the pointer stays and only files that nothing refers to are left.
        """
        new = dict(self.pointer())
        for name, df in {**replaced, **appended}.items():
            folder = f"{name}/{uuid.uuid4().hex}"
            (conformed(df, name) if name in TABLES else df).write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
            new[name] = [*new.get(name, []), folder] if name in appended else [folder]
        if checked:
            after = {n: self.spark.read.schema(schema(n)).parquet(*[f"{self.path}/{f}" for f in fs]) for n, fs in new.items() if n in TABLES and fs}
            broken = violations(after)
            said = broken.collect() if broken is not None else []
            if said:
                raise ConstraintError("; ".join(f"{r.table_name}: {r.rule} broken {r.n} times" for r in said))
        staged, current = self._p(f"CURRENT.{uuid.uuid4().hex}"), self._p("CURRENT")
        out = self._fs.create(staged, True)
        out.write(bytearray(json.dumps(new).encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(current.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        option = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = option
        context.rename(staged, current, options)

    def migrate(self) -> int:
        """Apply the schema versions above the highest one recorded; returns how many."""
        self._fs.mkdirs(self._p("."))
        done = self.read("schema_migrations").agg(F.coalesce(F.max("version"), F.lit(0)).alias("v")).first()["v"] if self.pointer() else 0
        rows = [(v, d) for v, d, _ in MIGRATIONS if v > done]
        if rows:
            df = self.spark.createDataFrame(rows, "version int, description string").withColumn("applied_at", F.current_timestamp())
            self.commit({}, {"schema_migrations": df}, checked=False)
        return len(rows)
