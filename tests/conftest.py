import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tellerscope.session import build_session

    base = tempfile.mkdtemp(prefix="tellerscope-tests-")
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=f"{base}/warehouse",
        spark__checkpoint__dir=f"{base}/work",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A new folder per test."""
    return str(tmp_path)


@pytest.fixture(scope="session")
def bank(spark):
    from tellerscope.plans.bank_tables import Bank

    return Bank(spark, SF)
