"""Scalar, array and map functions, and Python functions, each with the SQL that it equals."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Numbers, Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT p_partkey, upper(p_name) AS u, CAST(length(p_name) AS INT) AS n, substring(p_name, 2, 4) AS s, replace(p_type, ' ', '_') AS r, lpad(p_brand, 12, '*') AS l, reverse(p_name) AS v FROM part")
def strings(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("u"), F.length("p_name").alias("n"), F.substring("p_name", 2, 4).alias("s"), F.replace("p_type", F.lit(" "), F.lit("_")).alias("r"),
        F.lpad("p_brand", 12, "*").alias("l"), F.reverse("p_name").alias("v"),
    )


@query("SELECT doc_id, regexp_replace(text, '[aeiou]', '', 'g') AS bare, regexp_extract(text, '([0-9]+)', 1) AS number FROM documents")
def regular_expressions(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.regexp_replace("text", "[aeiou]", "").alias("bare"), F.regexp_extract("text", "([0-9]+)", 1).alias("number"))


@query("SELECT doc_id, CAST(length(text) AS INT) AS n, substring(text, 2, 40) AS s, replace(text, ' ', '_') AS r FROM documents")
def document_strings(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.length("text").alias("n"), F.substring("text", 2, 40).alias("s"), F.replace("text", F.lit(" "), F.lit("_")).alias("r"))


@query("SELECT w AS word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY w")
def split_and_count(t: Tables) -> DataFrame:
    return t.documents.select(F.explode(F.split("text", " ")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(quarter(o_orderdate) AS INT) AS q, CAST(dayofweek(o_orderdate) AS INT) + 1 AS dow, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, last_day(o_orderdate) AS ld,
CAST(o_orderdate + INTERVAL 90 DAY AS DATE) AS due FROM orders""")
def dates(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.year(d).alias("y"), F.quarter(d).alias("q"), F.dayofweek(d).alias("dow"), F.date_trunc("month", d).cast("date").alias("m"), F.last_day(d).alias("ld"),
        (d + F.expr("INTERVAL 90 DAYS")).cast("date").alias("due"),
    )


@query("SELECT p_partkey, CAST(floor(p_retailprice) AS BIGINT) AS f, CAST(ceil(p_retailprice) AS BIGINT) AS c, abs(p_size - 25) AS a, p_size % 7 AS m, sqrt(p_size) AS s, round(ln(p_retailprice), 8) AS l, CAST(sign(p_size - 25) AS DOUBLE) AS g FROM part")
def arithmetic(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", F.floor("p_retailprice").alias("f"), F.ceil("p_retailprice").alias("c"), F.abs(F.col("p_size") - 25).alias("a"), (F.col("p_size") % 7).alias("m"), F.sqrt("p_size").alias("s"),
        F.round(F.ln("p_retailprice"), 8).alias("l"), F.sign(F.col("p_size") - 25).alias("g"),
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def json_fields(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("SELECT o_orderkey, CAST(len(a) AS INT) AS n, a[2] AS second, list_contains(a, 'HIGH') AS high FROM (SELECT o_orderkey, string_split(o_orderpriority, '-') AS a FROM orders)")
def arrays(t: Tables) -> DataFrame:
    a = F.split("o_orderpriority", "-")
    return t.orders.select("o_orderkey", F.size(a).alias("n"), F.get(a, F.lit(1)).alias("second"), F.array_contains(a, "HIGH").alias("high"))


@query("SELECT n AS user_id, list_sum(list_transform(range(1, n + 1), lambda x: x * x))::BIGINT AS squares, len(list_filter(range(1, n + 1), lambda x: x % 3 = 0))::INT AS thirds FROM (SELECT DISTINCT user_id AS n FROM events WHERE user_id > 0)")
def higher_order(t: Tables) -> DataFrame:
    numbers = F.sequence(F.lit(1).cast("long"), F.col("user_id"))
    squares = F.aggregate(F.transform(numbers, lambda x: x * x), F.lit(0).cast("long"), lambda a, x: a + x)
    return t.events.where("user_id > 0").select("user_id").distinct().select("user_id", squares.alias("squares"), F.size(F.filter(numbers, lambda x: x % 3 == 0)).alias("thirds"))


@query("SELECT vec_id, CAST(len(embedding) AS INT) AS n, CAST(embedding[3] AS DOUBLE) AS third, CAST(list_sum(list_transform(embedding[1:8], lambda x: CAST(x * 1000 AS INTEGER))) AS BIGINT) AS head, label FROM embeddings")
def vector_slices(t: Tables) -> DataFrame:
    head = F.aggregate(F.slice("embedding", 1, 8), F.lit(0).cast("long"), lambda a, x: a + F.rint((x * F.lit(1000).cast("float")).cast("double")).cast("long"))
    return t.embeddings.select("vec_id", F.size("embedding").alias("n"), F.get("embedding", F.lit(2)).cast("double").alias("third"), head.alias("head"), "label")


@query("SELECT vec_id, len(list_filter(list_zip(embedding, list_reverse(embedding)), lambda p: p[1] > p[2]))::INT AS larger FROM embeddings")
def vector_pairs(t: Tables) -> DataFrame:
    larger = F.zip_with("embedding", F.reverse("embedding"), lambda x, y: (x > y).cast("int"))
    return t.embeddings.select("vec_id", F.aggregate(larger, F.lit(0), lambda a, x: a + x).alias("larger"))


@query("SELECT p_partkey, map_extract_value(m, 'brand') AS brand, list_aggregate(list_sort(map_keys(m)), 'string_agg', ',') AS keys, CAST(cardinality(m) AS INT) AS n_keys FROM (SELECT p_partkey, MAP {'brand': p_brand, 'type': p_type} AS m FROM part)")
def maps(t: Tables) -> DataFrame:
    entries = F.array(F.struct(F.lit("brand").alias("k"), F.col("p_brand").alias("v")), F.struct(F.lit("type").alias("k"), F.col("p_type").alias("v")))
    m = F.map_from_entries(entries)
    return t.part.select("p_partkey", m["brand"].alias("brand"), F.array_join(F.array_sort(F.map_keys(m)), ",").alias("keys"), F.size(m).alias("n_keys"))


@query("SELECT doc_id, md5(text) AS m, sha256(text) AS s FROM documents")
def hashes(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5("text").alias("m"), F.sha2("text", 256).alias("s"))


@query("SELECT n_name, length(n_name) * 2 AS code FROM nation")
def registered_function(t: Tables) -> DataFrame:
    """A Python function by name in SQL, fed in Arrow batches."""

    @F.pandas_udf("long")
    def twice_the_length(names: pd.Series) -> pd.Series:
        return names.str.len() * 2

    t.spark.udf.register("twice_the_length", twice_the_length)
    return t.nation.select("n_name", F.expr("twice_the_length(n_name)").alias("code"))


@query("SELECT event_id, value * 2 AS doubled FROM events")
def pandas_function(t: Tables) -> DataFrame:
    @F.pandas_udf("double")
    def doubled(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part * 2

    return t.events.select("event_id", doubled("value").alias("doubled"))


@query("SELECT event_type, max(value) - min(value) AS spread FROM events GROUP BY event_type")
def pandas_aggregate(t: Tables) -> DataFrame:
    """A grouped Python aggregate over partial extremes, so that no group is gathered whole."""

    @F.pandas_udf("double")
    def spread(low: pd.Series, high: pd.Series) -> float:
        return float(high.max() - low.min())

    partial = t.events.groupBy("event_type", F.spark_partition_id().alias("p")).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return partial.groupBy("event_type").agg(spread("low", "high").alias("spread"))


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1")
def grouped_map(t: Tables) -> DataFrame:
    def first(group: pd.DataFrame) -> pd.DataFrame:
        return group.sort_values(["value", "event_id"], ascending=[False, True]).head(1)[["user_id", "event_id"]]

    return t.events.select("user_id", "event_id", "value").groupBy("user_id").applyInPandas(first, "user_id long, event_id long")


@query("SELECT n, n * n AS square FROM range(0, 10) r(n)")
def table_function(t: Tables) -> DataFrame:
    @F.udtf(returnType="n: bigint, square: bigint")
    class Squares:
        def eval(self, stop: int):
            for n in range(stop):
                yield n, n * n

    return Squares(F.lit(10))


@query("SELECT n_name, n_nationkey * 10 + 1 AS code FROM nation")
def sql_function(t: Tables) -> DataFrame:
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION nation_code(k INT) RETURNS INT RETURN k * 10 + 1")
    return t.nation.select("n_name", F.expr("nation_code(n_nationkey)").alias("code"))


@query("SELECT count(*) AS n, CAST(sum(n) AS BIGINT) AS total FROM range(0, 1000) r(n)")
def custom_source(t: Tables) -> DataFrame:
    t.spark.dataSource.register(Numbers)
    return t.spark.read.format("numbers").options(rows=1000, parts=4).load().agg(F.count("*").alias("n"), F.sum("n").alias("total"))


@query()
def approximate_distinct(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("parts"))
