"""Where intermediate tables go, and that nothing of them stays."""

import os
import subprocess
import sys
import textwrap
import time

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def gone(path: str) -> bool:
    """The file system may still be at it when Python has ended."""
    for _ in range(100):
        if not os.path.exists(path):
            return True
        time.sleep(0.2)
    return False


def session(empty, body: str, **conf: str) -> str:
    """The last line that a session without any configuration of the machine prints."""
    settings = "".join(f".config({k!r}, {v!r})" for k, v in conf.items())
    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2"){settings}.getOrCreate()
from acuity import session
{textwrap.dedent(body)}
spark.stop()
"""
    env = os.environ | {"PYTHONPATH": ROOT, "SPARK_CONF_DIR": str(empty)}
    run = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    return run.stdout.strip().splitlines()[-1]


@pytest.fixture
def empty(tmp_path_factory):
    return tmp_path_factory.mktemp("conf")


def test_without_a_named_folder_a_temporary_one_is_used_and_removed(empty):
    path = session(
        empty,
        """
        assert spark.conf.get("spark.checkpoint.dir", None) is None
        df = session.stored(spark.range(5), "five")
        assert df.count() == 5 and spark.conf.get("spark.checkpoint.dir", None) is None
        print(session.shared_folder(spark))
        """,
    )
    assert path and gone(path)


def test_the_named_folder_is_used_and_stays_without_the_tables(empty, tmp_path):
    path = session(
        empty,
        """
        df = session.stored(spark.range(5), "five")
        print(df.inputFiles()[0])
        """,
        **{"spark.checkpoint.dir": str(tmp_path)},
    )
    assert str(tmp_path) in path
    assert gone(path.removeprefix("file://").rsplit("/", 2)[0]) and os.path.exists(tmp_path)


def test_the_callers_folder_comes_first(empty, tmp_path):
    path = session(empty, f"""print(session.stored(spark.range(5), "five", {str(tmp_path)!r}).inputFiles()[0])""")
    assert str(tmp_path) in path and gone(path.removeprefix("file://").rsplit("/", 2)[0])


def test_the_written_tables_need_no_named_folder(empty):
    count = session(
        empty,
        """
        import __spark_entry__ as job
        print(job.queries()["written_tables"](spark, "/root/testdata/sf0.001").count())
        """,
    )
    assert int(count) > 0
