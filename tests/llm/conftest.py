import pytest
from pyspark.sql import types as T

from tests.conftest import sf_dir, spark  # noqa: F401

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):  # noqa: F811
    """Documents from (id, text) or (id, text, source), with columns that clash with the operators' own names."""

    def make(rows, **extra):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        for name in ("row", "score", "part", "cls", "n", "size", "rate", "target", "shard", "digest", "kind", "own", "copies", "norm", "a", "b"):
            df = df.withColumn(name, extra_value(name))
        return df

    def extra_value(name):
        from pyspark.sql import functions as F
        return F.lit(f"clash {name}")

    return make
