"""Every registered query against its SQL, and the driver's contract."""

import pytest
from compare import connect, spark_rows, sql_rows

from waymark.plans.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    got = spark_rows(QUERIES[name](spark, sf_dir))
    assert got == sql_rows(con, SQL[name])


def test_entry(spark):
    import __spark_entry__

    frames = __spark_entry__.entry(spark)
    assert frames.columns == ["src_idx", "task_idx", "episode_id", "frame", "subtask", "objects"]
    assert frames.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
