"""Versions kept as data: one Parquet folder per version and a small list of which folders make it up.

The list has a row per version: its number, whether it adds to the rows before
or replaces them, and its schema. Reading a version takes the folders from the
last replacement on, each under the schema it was written with, and conforms
them; no other folder is listed. One writer at a time, as for any list that is
appended to.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from lakewarden.operators.schemas import conform_to, union_versions

LIST = "version int, kind string, schema string"
ADD, REPLACE = "add", "replace"


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, root: str) -> VersionedTable:
        """A table without versions."""
        table = cls(spark, root)
        spark.createDataFrame([], LIST).write.parquet(f"{table.root}/versions")
        return table

    def folder(self, version: int) -> str:
        return f"{self.root}/data/version={version}"

    def versions(self) -> DataFrame:
        return self.spark.read.schema(LIST).parquet(f"{self.root}/versions")

    def latest(self) -> int:
        """Highest version, -1 when there is none."""
        return self.versions().agg(F.coalesce(F.max("version"), F.lit(-1))).first()[0]

    def commit(
        self, df: DataFrame, replace: bool = False, version: int | None = None, gate: Callable[[], None] | None = None
    ) -> int:
        """Rows as the next version, added to those before or in their place.

        A given ``version`` that the list already has is left alone, so a
        repeated attempt changes nothing. ``gate`` runs between writing the rows
        and listing them: what it raises leaves the rows in no version, and the
        next attempt writes over them. Returns the version.
        """
        latest = self.latest()
        if version is not None and version <= latest:
            return version
        new = latest + 1 if version is None else version
        df.write.mode("overwrite").option("compression", "snappy").parquet(self.folder(new))
        if gate:
            gate()
        kind = REPLACE if replace or latest < 0 else ADD
        row = self.spark.createDataFrame([(new, kind, df.schema.json())], LIST)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/versions")
        return new

    def parts(self, version: int | None = None) -> list[tuple[int, StructType]]:
        """Version and schema of each folder that makes up a version; a row each, as many as commits."""
        listed = self.versions() if version is None else self.versions().where(F.col("version") <= version)
        rows = sorted(listed.collect(), key=lambda r: r["version"])
        first = max((i for i, r in enumerate(rows) if r["kind"] == REPLACE), default=0)
        return [(r["version"], StructType.fromJson(json.loads(r["schema"]))) for r in rows[first:]]

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version, the newest by default; a column has the type that it was last written with."""
        parts = self.parts(version)
        if not parts:
            raise ValueError(f"no version {'yet' if version is None else version}")
        fields: dict[str, StructField] = {}
        for _, schema in parts:
            fields |= {f.name: f for f in schema.fields}
        whole = StructType(list(fields.values()))
        same: dict[str, list[int]] = {}
        for number, schema in parts:
            same.setdefault(schema.json(), []).append(number)
        return union_versions([
            conform_to(self.spark.read.schema(StructType.fromJson(json.loads(text))).parquet(*map(self.folder, numbers)), whole)
            for text, numbers in same.items()
        ])
