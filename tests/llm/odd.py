"""Rows that every operator must survive."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = "lorem ipsum dolor sit amet " * 40_000


def odd_docs(spark):
    rows = [
        (1, "plain words of a small text\nin two lines", "en", "a", 1),
        (1, "plain words of a small text\nin two lines", "en", "a", 1),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (None, "no id here, only text", "en", None, 3),
        (None, None, None, None, None),
        (4, " \n\t ", "en", "a", 4),
        (5, "ÄÖ ß é 日本語   x́ 😀 idiot", "de", "b", 5),
        (6, LONG, "la", "b", len(LONG)),
        (7, "x" * 300_000, "la", "b", 1),
        (8, "\n\n\n", "la", "b", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def real(spark, name, sf="0.001"):
    return spark.read.parquet(f"/root/testdata/sf{sf}/{name}.parquet")


def clashing(df):
    """With columns of the names that operators use inside."""
    from pyspark.sql import functions as F

    for name in ("row_id", "fp", "h", "id", "n", "raw", "toxic", "spans", "rank", "first", "part", "node", "root", "digest", "size"):
        df = df.withColumn(name, F.lit("clash"))
    return df
