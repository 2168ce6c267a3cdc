import re

import pytest

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def plain_words():
    return lambda text: WORDS.findall((text or "").translate(LOWER))


@pytest.fixture
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), in several partitions."""
    def build(rows, **extra):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS).repartition(3)
        for name, value in extra.items():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(value))
        return df

    return build


@pytest.fixture
def odd(make):
    """Null and empty texts, a null id, repeated rows, one very long text, and columns called like results."""
    long = " ".join(f"wort{i % 997} Und{i % 13}," for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (5, long), (None, "some text without id"), (6, "ÀÉ ſK 日本語 x"), (7, "!!! ...")]
    return make(rows, score=1.5, row=3, size=7, fingerprint="x", body="y", secrets="z", k0=1, id=9, node="n", copies=2)
