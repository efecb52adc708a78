import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(docs):
    """Nulls, empty and very long texts, repeated rows, ties and columns whose names clash."""
    from pyspark.sql import functions as F

    long = " ".join(f"w{i % 997}x{i // 997}" for i in range(30_000))
    rows = docs(
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "same words here again and again my friend"),
        (5, "same words here again and again my friend"), (6, "same words here again and again my friend"),
        (None, "a text without any id at all in it"), (7, long), (8, "É à ß \x85 \u3000 中文 \U0001f600 x"), (9, "x", None),
    )
    for name in ("id", "ids", "size", "n", "a", "b", "u", "v", "band", "hub", "component", "score", "kept", "label", "mix", "part", "place", "h", "w", "host", "rule", "demand", "knots", "bucket_from", "mix_size", "mix_row", "mix_from", "one", "parts", "ask"):
        rows = rows.withColumn(name, F.lit("clash"))
    return rows


@pytest.fixture(scope="session")
def texts():
    """Whole texts of the smallest driver table."""
    import os

    import pyarrow.parquet as pq

    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("driver tables not present")
    return pq.read_table(path).to_pylist()
