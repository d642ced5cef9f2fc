import os
import sys

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from acuity import contracts  # noqa: E402
from acuity.session import tune  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def table(spark):
    """Build an input table from rows given as dicts; columns left out are NULL."""

    def build(name: str, rows: list[dict]) -> DataFrame:
        schema = contracts.schema(name)
        data = [tuple(row.get(f.name) for f in schema) for row in rows]
        return spark.createDataFrame(data, schema)

    return build


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows in a stable order, NULLs first."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda r: tuple((v is not None, v) for v in r),
    )
