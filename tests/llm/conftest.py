import pytest
from pyspark.sql import types as T

from tests.conftest import spark, tmp_dir  # noqa: F401


@pytest.fixture(scope="session")
def make(spark):  # noqa: F811
    """A frame of documents, or of other (id, text) rows; extra columns may clash with own names."""
    from tillroll.llm.scratch import prepare
    prepare(spark)

    def build(rows, id_name="doc_id", text_name="text", extra=(), partitions=3):
        schema = T.StructType([T.StructField(id_name, T.LongType()), T.StructField(text_name, T.StringType())]
                              + [T.StructField(c, T.StringType()) for c in extra])
        rows = [tuple(r) + ("x",) * len(extra) for r in rows]
        return spark.createDataFrame(rows, schema).repartition(partitions)
    return build


CLASHES = ["node", "band", "u", "v", "sig", "part", "slot", "deal", "extra", "hits", "spans", "row_key", "position", "bitmap", "label"]


@pytest.fixture()
def clashes():
    return CLASHES
