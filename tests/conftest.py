import pytest
from pyspark.sql import SparkSession

from slotledger.session import configure

SF_TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("slotledger-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted by the given columns or by everything."""
    out = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return out if order else sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])
