import os

import pytest

from portfolio_ops import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session("tests", os.environ.get("TEST_MASTER", "local[4]"), **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(shared), "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(shared / "warehouse")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Rows given as dicts; columns left out are NULL. Input order is shuffled."""
    import random

    def build(schema, rows):
        names = schema.fieldNames()
        unknown = {k for r in rows for k in r} - set(names)
        assert not unknown, unknown
        data = [tuple(r.get(n) for n in names) for r in rows]
        random.Random(7).shuffle(data)
        return spark.createDataFrame(data, schema)
    return build
