"""Small documents with what real tables hold: nulls, empty and very long
texts, repeated rows, and extra columns named like internal ones."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ["score", "fp", "ids", "offsets", "decoded", "words", "n_words", "n_hit", "found", "text_key",
            "runs", "doc", "left", "simhash", "toxicity", "root", "bucket", "tie", "hits", "range"]


def words(rng, n, vocabulary=2000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows():
    rng = random.Random(5)
    long = words(rng, 30_000)
    same = words(rng, 80)
    return [
        (1, None, "en", "a", None), (2, "", None, None, 0), (3, "   \n\t", "en", "a", 5),
        (4, long, "en", "b", len(long)), (5, same, "en", "a", len(same)), (6, same, "fr", None, len(same)),
        (6, same, "fr", None, len(same)), (None, "lonely text without an id", None, None, None),
        (None, None, None, None, None), (7, "é" * 300_000, "fr", "a", 300_000),
        (8, "one", "en", "a", 3), (8, "two other words", "en", "a", 15), (-9, "日本語 \U0001F600 '", "xx", "a", 7),
    ]


def odd_docs(spark, extra=True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    for c in CLASHING if extra else []:
        df = df.withColumn(c, F.lit("x"))
    return df


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def tables(tmp_path, spark, **frames):
    """Write frames as <name>.parquet; returns the folder."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
