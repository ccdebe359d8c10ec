import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()), T.StructField("id", T.StringType()), T.StructField("fp", T.StringType()), T.StructField("words", T.StringType())])


def odd_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    r = random.Random(5)
    vocabulary = [*"abcdefgh", "Der", "die", "straße", "naïve", "x1", "12", "a@b.co", "#", "***", "中文", "😀", "é", " ", "<|x", "don't"]
    text = lambda n: "".join(r.choice(vocabulary) + r.choice([" ", " ", "\n", "\t", "  ", "\x0b"]) for _ in range(n))
    texts = [None, "", " \n\t ", "one", "one two", "One TWO three", " ", "mail x.y@z.org, +1 (578) 555-6437 4918187128635271 from 10.0.0.255 or 1.2.3.256.7", "4111 1111 1111 1111 4111-1111-1111-1112", "aa@b.c_d@e.f a@b @c.d x@y..z 1.2.3.4.5.6.7.8.9", "+1((((2 ++44 20 7946 0958. +123456789012345678", "IBAN DE89 3704 0044 0532 0130 00 ssn 123-45-6789 call (555) 123-4567", "123-45-6789", "0" * 3000, "a" * 20000, "a@" * 3000, "1.2." * 3000, "😀 x@y.zz 中 +12345678901"]
    texts += [text(r.randint(1, 300)) for _ in range(60)] + [text(9000)]
    texts += [texts[-2]] * 3 + [texts[-3] + " end"] * 2 + ["the same line again here\n" * 40] * 2
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["s1", "s1", "s1", "s2", "ü", "", None]), len(t or ""), "x", "y", "z", "w") for i, t in enumerate(texts)]
    rows += [rows[30], rows[30], (None, texts[40], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None), (-7, texts[41], "en", "s2", 3, None, "", "", "")]
    return rows


#: Names that operators use for columns of their own, or used to.
CLASHING = ["_id", "_hash", "_text_hash", "_place", "_size", "_source", "_words", "_n", "_copy", "_pii", "_m0", "_base", "_text", "_clean", "_row", "row", "text_hash", "rank", "class", "copies", "clean", "spans", "own_0", "lo", "fp_", "n_words", "kept", "measure", "bin", "no_source", "source_key", "take", "kept_id", "place", "a.b", "_docweave_measured"]


@pytest.fixture(scope="session")
def clashing(spark, odd):
    """odd with more columns, of names that operators might use themselves; each holds the row's own number."""
    from pyspark.sql import functions as F

    return odd.select("*", *[F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
