"""Small tables for the operator tests, and brute-force pieces."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                          T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
SF = "/root/testdata/sf0.001"


def documents(spark, texts, extra=False):
    """texts: (doc_id, text) or (doc_id, text, lang). ``extra`` adds columns whose names clash with the operators' own."""
    rows = [(t[0], t[1], t[2] if len(t) > 2 else "en", "src", len(t[1] or "")) for t in texts]
    df = spark.createDataFrame(rows, DOCUMENTS)
    if extra:
        for name in ("score", "fp", "start", "rank", "removed", "component_id", "path", "bucket", "findings", "matches"):
            df = df.withColumn(name, df.doc_id)
    return df


#: null id, null, empty and blank texts, a repeated row, equal texts, one word, no letters, a long text
ODD = [(1, None), (2, ""), (3, "  \t\n "), (4, "same words in this text here"), (5, "same words in this text here"),
       (5, "same words in this text here"), (6, "word"), (7, "12 34 !!"), (None, "a row without an id"), (8, "é" * 3 + " ünïcode ß"),
       (9, "x" * 50_000), (10, "long text of many words " * 4000)]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")
