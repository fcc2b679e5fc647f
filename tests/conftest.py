from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from railyard.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="railyard-wh-")
    s = build_session("local[4]", app="railyard-tests", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": warehouse})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from railyard.session import scratch_path
    return scratch_path(spark, "test")


def rows_df(spark, schema, rows):
    """DataFrame of ``schema`` from dicts; absent keys are NULL."""
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def types(schema):
    """(name, type) pairs: schema equality without nullability."""
    return [(f.name, f.dataType) for f in schema.fields]
