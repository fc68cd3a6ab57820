from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

from millrace.session import build_session  # noqa: E402


def new_session():
    scratch = tempfile.mkdtemp(prefix="millrace-tests-")
    spark = build_session("tests", f"local[{os.environ.get('TEST_CPUS', '8')}]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.checkpoint.dir": f"{scratch}/shared",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = new_session()
    yield session
    session.stop()
