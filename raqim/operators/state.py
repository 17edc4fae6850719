"""State tables as versioned snapshots: inserts, upserts, deletes and checks as joins."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def insert_or_ignore(table: DataFrame, rows: DataFrame, key: str = "url") -> DataFrame:
    """Rows whose key the table doesn't hold yet; of several with one key the one with the least id, or any where there is no id."""
    new = rows.join(table.select(key), key, "left_anti")
    if "id" in rows.columns:
        return new.withColumn("r__", F.row_number().over(Window.partitionBy(key).orderBy("id"))).filter("r__ = 1").drop("r__")
    return new.dropDuplicates([key])


def upsert(table: DataFrame, rows: DataFrame, key: str = "url", order: str = "updated_at", keep: tuple[str, ...] = ("id", "created_at")) -> DataFrame:
    """The table with the rows merged in by key: the last row of a key (by ``order``, then id) overwrites all columns but ``keep``."""
    ranked = rows.withColumn("r__", F.row_number().over(Window.partitionBy(key).orderBy(F.desc_nulls_last(order), F.desc("id") if "id" in rows.columns else F.lit(0)))).filter("r__ = 1").drop("r__")
    old, new = table.alias("o"), ranked.alias("n")
    joined = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    is_new = F.col(f"n.{key}").isNotNull()
    out = []
    for c in table.columns:
        if c in keep or c not in ranked.columns:
            out.append((F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")) if c in ranked.columns else F.col(f"o.{c}")).alias(c))
        else:
            out.append(F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    return joined.select(*out)


def delete(table: DataFrame, rows: DataFrame, key: str = "id") -> DataFrame:
    """The table without the rows' keys."""
    return table.join(rows.select(key), key, "left_anti")


def delete_shipped(table: DataFrame, shipped: DataFrame, key: str = "id") -> DataFrame:
    """The table without the shipped rows; fails if the table doesn't hold each of them once."""
    wanted = shipped.select(key).distinct()
    there, n = table.join(wanted, key, "left_semi").count(), wanted.count()
    if there != n:
        raise ValueError(f"{n} rows were shipped, but {there} are there to delete")
    return delete(table, wanted, key)


def append_events(events: DataFrame, path: str) -> None:
    """Page events as lines of JSON, added to those that are there."""
    events.write.mode("append").json(path)


def with_cursor(sites: DataFrame, cursors: DataFrame, key: str = "id") -> DataFrame:
    """Sites with the discovery cursor replaced by ``cursors`` (key and the cursor's own columns) as JSON, where there is one."""
    own = [c for c in cursors.columns if c != key]
    written = cursors.select(key, F.to_json(F.struct(*own)).alias("new__"))
    return sites.join(written, key, "left").withColumn("discovery_cursor", F.coalesce("new__", "discovery_cursor")).drop("new__")


def split_columns(table: DataFrame, key: str, *groups: list[str]) -> tuple[DataFrame, ...]:
    """One projection per group of columns, each with the key: a table split without its rows going apart."""
    return tuple(table.select(key, *g).filter(F.col(key).isNotNull()) for g in groups)


def stale(remote: DataFrame, local: DataFrame, key: str = "id") -> DataFrame:
    """Keys that the remote table holds and the local one doesn't any more."""
    return remote.select(key).join(local.select(key), key, "left_anti")


def backfill(keys: DataFrame, store: DataFrame, key: str = "url") -> DataFrame:
    """Rows of ``keys`` missing in the store."""
    return keys.join(store.select(key), key, "left_anti")


def integrity(tables: dict[str, DataFrame], unique: dict[str, list[str]], references: list[tuple[str, str, str, str]] = ()) -> DataFrame:
    """(check, subject, violations) of unique keys, and of references (table, column, target, column)."""
    checks = None
    for name, keys in unique.items():
        for k in keys:
            twice = tables[name].filter(F.col(k).isNotNull()).groupBy(k).count().filter("count > 1")
            one = twice.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations")).select(F.lit("unique").alias("check"), F.lit(f"{name}.{k}").alias("subject"), "violations")
            checks = one if checks is None else checks.union(one)
    for name, c, target, t in references:
        lost = tables[name].filter(F.col(c).isNotNull()).join(tables[target].select(F.col(t).alias(c)), c, "left_anti")
        one = lost.agg(F.count("*").alias("violations")).select(F.lit("reference").alias("check"), F.lit(f"{name}.{c}").alias("subject"), "violations")
        checks = one if checks is None else checks.union(one)
    return checks


class Snapshots:
    """A table kept as Parquet versions under one folder of any file system that Spark writes to; a pointer file names the current one.
    One writer at a time."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._rename = jvm.org.apache.hadoop.fs.Options.Rename
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.folder).toUri(), spark.sparkContext._jsc.hadoopConfiguration())

    def read(self) -> DataFrame:
        pointer = self.spark.read.text(f"{self.folder}/CURRENT", wholetext=True).first()[0]
        return self.spark.read.parquet(f"{self.folder}/{json.loads(pointer)['version']}")

    def replace(self, df: DataFrame) -> DataFrame:
        """Write a new version, then move the pointer in one step; readers of the old version aren't disturbed."""
        version = uuid.uuid4().hex
        df.write.parquet(f"{self.folder}/{version}")
        temporary = self._path(f"{self.folder}/_{version}")
        out = temporary.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(temporary, True)
        out.write(bytearray(json.dumps({"version": version}), "utf-8"))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self._rename, 1)
        options[0] = self._rename.OVERWRITE
        self._context.rename(temporary, self._path(f"{self.folder}/CURRENT"), options)
        return self.read()


def write_manifest(rows: DataFrame, path: str, key: str = "id") -> None:
    """A manifest of what was shipped or is to be deleted: one id a line."""
    rows.select(F.col(key).cast("string").alias("value")).filter("value is not null").distinct().write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str, key: str = "id", kind: str = "long") -> DataFrame:
    """(key) of a manifest's lines, once each; blank lines and such that are no value of ``kind`` are passed over."""
    return spark.read.text(path).select(F.expr(f"try_cast(trim(value) as {kind})").alias(key)).filter(F.col(key).isNotNull()).distinct()


def shipped_in_chunks(rows: DataFrame, send, size: int, key: str = "id", retries: int = 5, wait=lambda attempt: None) -> DataFrame:
    """(key) of the rows that ``send(rows of a chunk) -> number accepted`` took, chunk by chunk of at most ``size`` rows on the executors.  A chunk
    that fails is sent again up to ``retries`` times, after ``wait(attempt)``; one that is not accepted whole is an error."""
    columns = rows.columns

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for at in range(0, len(pdf), size):
                part = pdf.iloc[at : at + size]
                for attempt in range(retries + 1):
                    try:
                        taken = send(part[columns].to_dict("records"))
                        break
                    except OSError:
                        if attempt == retries:
                            raise
                        wait(attempt)
                if taken != len(part):
                    raise ValueError(f"{len(part)} rows were sent, {taken} accepted")
                yield pd.DataFrame({key: part[key]})

    return rows.mapInPandas(run, f"`{key}` {rows.schema[key].dataType.simpleString()}")
