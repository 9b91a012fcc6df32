import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyfield.operators import scale  # noqa: E402
from tallyfield.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            # Tables are tiny here: compiling a plan takes longer than running it.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def many_slices(spark, monkeypatch):
    """Treat every group as large and keep small shuffles in 8 partitions."""
    monkeypatch.setattr(scale, "WINDOW_ROWS", 0)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    yield
    spark.conf.set(setting, "true")


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
