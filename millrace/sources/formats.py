"""Tables written in other formats and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Tables


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share, named in ``spark.checkpoint.dir``. Deleted when the JVM ends.

    Where that is unset, a local master gets a temporary folder, and any other an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/millrace-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def rewritten(df: DataFrame, kind: str, by: str | None = None, **options: str) -> DataFrame:
    """``df`` written in a format, in folders by a column where one is named, and read back with its schema."""
    path = scratch(df.sparkSession)
    writer = df.write.format(kind).options(**options)
    (writer.partitionBy(by) if by else writer).save(path)
    return df.sparkSession.read.format(kind).options(**options).schema(df.schema).load(path)


def csv(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return rewritten(rows, "csv", header="true", escape='"').where("o_totalprice > 1000")


def json(t: Tables) -> DataFrame:
    return rewritten(t.events.select("event_id", "user_id", "event_type", "props"), "json").where("event_type <> 'view'")


def orc(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_shipdate").cast("date").alias("l_shipdate"))
    return rewritten(rows, "orc").where("l_quantity < 5")


def text(t: Tables) -> DataFrame:
    return rewritten(t.nation.select(F.col("n_name").alias("value")), "text")


def parquet_by_folder(t: Tables) -> DataFrame:
    """The filter prunes folders, so that only one status is read."""
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    return rewritten(rows, "parquet", by="o_orderstatus").where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", "o_orderstatus")


QUERIES = {"scan_csv": csv, "scan_json": json, "scan_orc": orc, "scan_text": text, "scan_folders": parquet_by_folder}
SQL = {
    "scan_csv": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders WHERE o_totalprice > 1000",
    "scan_json": "SELECT event_id, user_id, event_type, props FROM events WHERE event_type <> 'view'",
    "scan_orc": "SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem WHERE l_quantity < 5",
    "scan_text": "SELECT n_name AS value FROM nation",
    "scan_folders": "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
}
