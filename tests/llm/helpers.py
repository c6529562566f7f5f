"""Small tables for the operators' odd cases."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_docs(spark):
    """Nulls in every column, empty and blank texts, ties, repeated rows and a long text."""
    long = "word " * 30_000
    plain = "A plain sentence stands here, and it has more than ten words in it. Another one follows it at once."
    rows = [
        (1, plain, "en", "s", 3), (2, plain, "en", "s", 3), (2, plain, "en", "s", 3), (3, None, None, None, None), (4, "", "en", "s", 0), (5, " \n\t ", "en", "s", 4),
        (6, "Größe und Übermut, 12 ½ Äpfel 😀", "de", None, 30), (7, long, "en", "s", len(long)), (None, plain + " More.", "en", "s", 9), (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df):
    """Extra columns under names that the operators use inside."""
    from pyspark.sql import functions as F

    for name in ("id", "body", "fp", "mark", "key", "bucket", "hash", "media", "page", "label", "score", "kept", "copy", "component_id", "row mark"):
        df = df.withColumn(name, F.lit("x"))
    return df


def empty(df):
    return df.filter("false")


def signature(rows):
    return sorted(map(repr, rows))
