import pytest
from llm_helpers import SCHEMA, SF001, odd_rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture()
def scratch(spark):
    from rambler.session import scratch_path
    return scratch_path(spark, "test")
