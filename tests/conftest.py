import os

import pytest

from fieldloom.session import local_session

ROOT = os.environ.get("FIELDLOOM_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "fieldloom-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def root():
    return ROOT


@pytest.fixture
def items(spark):
    """Build raw items from short rows of keyword values."""
    from fieldloom.operators.harmonize import RAW_SCHEMA

    schema = ", ".join(f"{c} {t}" for c, t in RAW_SCHEMA.items())

    def make(*rows):
        full = [{"ord": i, "category": "C", **row} for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r.get(c) for c in RAW_SCHEMA) for r in full], schema)

    return make
