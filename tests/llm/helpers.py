"""Small fixtures with the awkward cases every operator must stand."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

LONG = "word " * 30000 + "x" * 5000 + " end"


def docs_of(spark, rows):
    """rows: (doc_id, text, lang, source)."""
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], DOCS)


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    return [
        (1, "a b c d e f", "en", "s1"), (2, "a b c d e f", "en", "s2"), (2, "a b c d e f", "en", "s2"),
        (3, None, "de", "s1"), (4, "", None, "s2"), (5, "  \t\n ", "fr", None), (None, "a b c d e f", "en", "s1"),
        (None, None, None, None), (6, LONG, "en", "s3"), (7, "é日本 \x0b x\x85y z", "es", "s3"),
        (8, "one two\nthree four\n\nfive", "en", "s1"), (9, "A B C d e f", "en", "s4"),
    ]


def with_extra(df):
    """Extra columns whose names clash with results of the operators."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("extra") for c in (
        "keep_id", "fp", "size", "score", "text_sha256", "digest", "component_id", "hilbert", "shard", "ordinal", "site",
        "pos", "line", "block", "lead", "target", "repeats", "host", "node", "root", "which", "bits")})


def collect(df, *keys):
    rows = [r.asDict() for r in df.collect()]
    return sorted(rows, key=lambda r: tuple((r[k] is not None, r[k]) for k in keys)) if keys else rows
