"""Finished stages of a run, kept by a fingerprint of what they were made from.

A stage is a table below the state folder, named by its key. The manifest gets a line once
the table is complete, so a run that was killed finds the stages it finished and makes the
others anew; rows of an unfinished stage lie in a folder that no manifest line names. A
stage's key covers its parameters and the keys of what it reads: if an input changes,
everything after it is made again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE = "stage string, key string, path string, rows bigint, parts string"


def fingerprint(df: DataFrame | None) -> str:
    """Digest of the rows and the schema, whatever their order. One scan, one row a task."""
    if df is None:
        return "none"
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    sums = [F.sum(F.xxhash64(F.lit(k), row).cast("decimal(38,0)")) for k in range(2)]
    kinds = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return digest(kinds, *[str(x) for x in df.agg(F.count("*"), *sums).first()])


def digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


class Manifest:
    """Stages below a folder that all executors and later runs reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        spark.createDataFrame([], LINE).write.mode("ignore").json(f"{self.path}/manifest")

    def lines(self) -> DataFrame:
        return self.spark.read.schema(LINE).json(f"{self.path}/manifest")

    def stage(self, name: str, key: str, build: Callable[[], DataFrame], **parts) -> DataFrame:
        """The stage's table: read if the manifest has it, else built, written and noted.

        ``parts`` are noted beside the key, to tell later what it covers.
        """
        found = self.lines().filter((F.col("stage") == name) & (F.col("key") == key)).orderBy("path").first()
        if found:
            return self.spark.read.parquet(found["path"])
        folder = f"{self.path}/{name}-{key[:16]}-{uuid.uuid4().hex[:8]}"
        build().write.option("compression", "zstd").parquet(folder)
        table = self.spark.read.parquet(folder)
        line = (name, key, folder, table.count(), json.dumps(parts, sort_keys=True, default=str))
        self.spark.createDataFrame([line], LINE).coalesce(1).write.mode("append").json(f"{self.path}/manifest")
        return table
