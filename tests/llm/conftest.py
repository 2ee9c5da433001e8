import pytest
from pyspark.sql import types as T

from edge import EXTRA, ROWS, SF_DIR


@pytest.fixture(scope="session")
def edge_docs(spark, tmp_path_factory):
    """Odd documents as a file, with columns of clashing names."""
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    fields += [T.StructField(name, T.StringType()) for name in EXTRA]
    rows = [(*row, *(f"x{i}" for i in range(len(EXTRA)))) for row in ROWS]
    path = str(tmp_path_factory.mktemp("edge") / "documents")
    spark.createDataFrame(rows, T.StructType(fields)).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("doc_id = -1")
