"""The given tables of one scale, read lazily by attribute."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakewarden.plans.views import VIEWS, tables_in
from lakewarden.session import prepare

NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        prepare(spark)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def stream_path(self, name: str) -> str:
        """The same table for a file stream, which takes a lone file only by a pattern."""
        return f"{self.sf_dir}/{name}.parque[t]"

    def __getattr__(self, name: str) -> DataFrame:
        if name in NAMES:
            return self.spark.read.parquet(self.path(name))
        if name in VIEWS:
            text = VIEWS[name]
            return self.spark.sql(text, **{dep: getattr(self, dep) for dep in tables_in(text)})
        raise AttributeError(name)
