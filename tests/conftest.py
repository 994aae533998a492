import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))
sys.path.insert(0, str(ROOT / "tests"))

from freightlens.session import Workspace, get_session  # noqa: E402
from small_tables import FOLDER  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false")
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ws(spark):
    return Workspace(spark)


@pytest.fixture(scope="session")
def at():
    return datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def warehouse(spark):
    from freightlens import registry

    return registry.warehouse(spark, FOLDER)
