"""Small tables with the awkward cases every operator has to handle."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.IntegerType()),
    ]
)

WORDS = "the of and stone river holds a quiet ledger while seven engines count every bright leaf".split()


def prose(n: int, seed: int = 0) -> str:
    """``n`` words, different for each seed."""
    return " ".join(f"{WORDS[(i * 7 + seed * 3 + i * i) % len(WORDS)]}{(i * seed) % 11}" for i in range(n))


def awkward(spark, extra: tuple[str, ...] = ()):
    """Nulls, empty, blank and very long texts, repeated rows, ids with ties, all kinds of blanks."""
    rows = [
        (1, prose(40, 1), "en", "a", 1),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \n\t ", "fr", "b", 4),
        (5, prose(6000, 5), "en", "a", 9),
        (6, "Élan vital, naïve\u2003\U0001f600 x  y\n \nz", "fr", "b", 3),
        (7, "w" * 5000, "xx", "b", 5000),
        (8, prose(40, 1), "en", "a", 1),
        (8, prose(40, 1), "en", "a", 1),
        (None, prose(12, 4), "en", "a", 1),
        (None, None, None, None, None),
        (-3, "one", "de", "c", 3),
        (9, "a\rb\vc d\fe\r\n\r\v\nf\x00g\n\v\r\n\r\v", "en", "c", 7),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for i, name in enumerate(extra):
        df = df.selectExpr("*", f"{i} AS `{name}`")
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def save(df, path, name="documents"):
    """Write a table the way the test tables lie and return the folder."""
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)
