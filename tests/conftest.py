import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from figcurate.session import local_session

    session = local_session(4, 4, **{"spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate a Column over rows: values(column, schema, rows) -> list."""

    def run(column, schema, rows):
        return [r[0] for r in spark.createDataFrame(rows, schema).select(column.alias("v")).collect()]

    return run
