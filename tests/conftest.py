import os
import tempfile

import pytest

from ledgerlens.session import local_session


@pytest.fixture(scope="session")
def spark():
    os.chdir(tempfile.mkdtemp(prefix="ledgerlens-tests-"))  # workers must not find the package by accident
    session = local_session(8, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def feature_rows(spark, rows):
    """Rows of the feature table from (tx_id, label, {feature: value}); other features are 0."""
    from ledgerlens import schema
    data = [(i, *[float(v.get(f, 0.0)) if v.get(f, 0.0) is not None else None for f in schema.FEATURES], y) for i, y, v in rows]
    return spark.createDataFrame(data, schema.feature_table_schema())
