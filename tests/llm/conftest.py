import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def docs(spark):
    """docs(("text", ...)) or docs([(id, text)]) with the columns of documents."""

    def make(rows, extra=()):
        full = [(i, t, "en" if (i or 0) % 3 else None, f"s{(i or 0) % 2}", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, SCHEMA)
        for name in extra:
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit(f"own {name}"))
        return df

    return make


LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
ODD = [(None, "no id at all but five words"), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d e f g"),
       (5, "a b c d e f g"), (6, "a b c d e f g"), (7, LONG), (8, "é日本 \U0001F600 x y z"), (8, "same id other text here"),
       (9, "x" * 50_000), (-4, "negative id with a few words in it")]
CLASH = ("row", "k", "th", "slice", "shard", "slot", "part", "h", "size", "node", "n", "bands", "kept", "score", "trusted",
         "piece", "g", "ids", "tokens", "topic", "probability", "w", "range", "body", "word", "s", "next")
