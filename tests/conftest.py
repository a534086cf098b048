import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_spark, ship_package

    s = get_spark("local[4]", shuffle_partitions=4, app_name="tessera-tests", extra={"spark.driver.memory": "4g"})
    # Tests own their checkpoint folder (a cluster names a shared one in spark.checkpoint.dir).
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
    ship_package(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from tessera.sources.tables import TABLE_NAMES, table_path

    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con
