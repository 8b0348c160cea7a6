"""Reading the tables, and other formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Tables:
    """The tables of a folder, read when named: ``Tables(spark, sf_dir).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


class Numbers(DataSource):
    """A source of the whole numbers below ``rows``, in ``parts`` partitions."""

    @classmethod
    def name(cls) -> str:
        return "numbers"

    def schema(self) -> str:
        return "n long"

    def reader(self, schema) -> DataSourceReader:
        return NumbersReader(int(self.options.get("rows", 10)), int(self.options.get("parts", 2)))


class NumbersReader(DataSourceReader):
    def __init__(self, rows: int, parts: int) -> None:
        self.rows, self.parts = rows, parts

    def partitions(self):
        return [InputPartition(k) for k in range(self.parts)]

    def read(self, partition):
        for n in range(partition.value, self.rows, self.parts):
            yield (n,)
