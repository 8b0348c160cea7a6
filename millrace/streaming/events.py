"""Streams over the event table: each runs over what is there, then stops."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.formats import scratch


#: Times are compared as text, which has no session's zone.
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a stream; its times without zone are taken as UTC, for watermarks."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    # A folder is watched; a table that is one file is picked out of its folder.
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def run(df: DataFrame, mode: str) -> DataFrame:
    """Runs a stream to its present end, from a checkpoint of its own, and returns what it wrote to files.

    In complete mode, where files can't be appended to, each batch writes the
    whole result anew, in a folder by its number.
    """
    spark, sink = df.sparkSession, scratch(df.sparkSession)
    writer = df.writeStream.option("checkpointLocation", scratch(spark)).outputMode(mode).trigger(availableNow=True)
    if mode != "complete":
        writer.format("parquet").option("path", sink).start().awaitTermination()
        return spark.read.schema(df.schema).parquet(sink)
    last = [-1]

    def whole(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/{number}")
        last[0] = number

    writer.foreachBatch(whole).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{sink}/{last[0]}") if last[0] >= 0 else spark.createDataFrame([], df.schema)


def tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed days alone: append mode emits a window when the watermark has passed it."""
    days = stream(spark, sf_dir).withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return run(days.select(F.col("w.start").cast("date").alias("day"), "event_type", "n"), "append")


def sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = stream(spark, sf_dir).withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 day", "12 hours").alias("w")).agg(F.count("*").alias("n"))
    return run(days.select(F.date_format("w.start", MICROS).alias("start"), "n"), "append")


def session(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stream(spark, sf_dir).withWatermark("ts", "1 hour").groupBy(F.session_window("ts", "30 minutes").alias("w"), "user_id").agg(F.count("*").alias("n"))
    return run(found.select(F.date_format("w.start", MICROS).alias("start"), "user_id", "n"), "append")


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stream(spark, sf_dir).withWatermark("ts", "1 hour").dropDuplicatesWithinWatermark(["event_id"])
    return run(found.select("event_id", "user_id"), "append")


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stream(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))
    return run(found, "complete")


def waves(parts: list[DataFrame], build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Runs a stream in append mode over parts that arrive one after the other, each run going on from the checkpoint of the last."""
    spark, schema = parts[0].sparkSession, parts[0].schema
    source, sink, state = (scratch(spark) for _ in range(3))
    for part in parts:
        part.write.mode("append").parquet(source)
        out = build(spark.readStream.schema(schema).parquet(source))
        out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(sink)


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``events`` before and from the middle of their time on."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    low, high = rows.agg(F.min("ts"), F.max("ts")).first()
    middle = F.lit(low if low is None else low + (high - low) / 2)
    return rows.where(F.col("ts") < middle), rows.where(F.col("ts") >= middle)


def late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed days; the first half of all events arrives again when the watermark has passed it, and is dropped."""
    before, after = halves(spark, sf_dir)

    def days(rows: DataFrame) -> DataFrame:
        counts = rows.withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n"))
        return counts.select(F.col("w.start").cast("date").alias("day"), "n")

    return waves([before, after, before], days)


def led_by_click(key: tuple[int], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A user's purchases right after a click; the state is the click, if the last event was one. The rows of a user that one batch brings are sorted in memory."""
    rows = pd.concat(parts).sort_values(["ts", "event_id"])
    last = state.get[0] if state.exists else -1
    found = []
    for event_id, kind in zip(rows.event_id, rows.event_type):
        if kind == "purchase" and last >= 0:
            found.append((key[0], event_id, last))
        last = event_id if kind == "click" else -1
    state.update((last,))
    yield pd.DataFrame(found, columns=["user_id", "event_id", "click_id"])


def stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases right after a click, the state of each user carried from one run to the next."""
    out = "user_id long, event_id long, click_id long"

    def match(rows: DataFrame) -> DataFrame:
        return rows.groupBy("user_id").applyInPandasWithState(led_by_click, out, "click_id long", "append", GroupStateTimeout.NoTimeout)

    return waves(list(halves(spark, sf_dir)), match)


QUERIES = {"stream_tumbling": tumbling, "stream_sliding": sliding, "stream_session": session, "stream_dedup": deduplicated, "stream_totals": totals, "stream_late": late, "stream_state": stateful}
SQL = {
    "stream_tumbling": "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2 HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)",
    "stream_sliding": """
        WITH w AS (SELECT make_timestamp(CAST(floor(epoch(ts) / 43200) AS BIGINT) * 43200000000) - back AS start FROM events, (VALUES (INTERVAL 0 HOUR), (INTERVAL 12 HOUR)) b(back))
        SELECT strftime(start, '%Y-%m-%d %H:%M:%S.%f') AS start, count(*) AS n FROM w GROUP BY w.start HAVING w.start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    "stream_session": """
        WITH marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
        numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS nr FROM marked)
        SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS start, user_id, count(*) AS n FROM numbered GROUP BY user_id, nr
        HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    "stream_dedup": "SELECT event_id, user_id FROM events",
    "stream_totals": "SELECT event_type, count(*) AS n, max(event_id) AS last FROM events GROUP BY event_type",
    "stream_late": "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1 HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)",
    "stream_state": """
        SELECT CAST(user_id AS BIGINT) AS user_id, CAST(event_id AS BIGINT) AS event_id, CAST(click_id AS BIGINT) AS click_id
        FROM (SELECT user_id, event_id, event_type, lag(event_id) OVER w AS click_id, lag(event_type) OVER w AS kind FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        WHERE event_type = 'purchase' AND kind = 'click'""",
}
