import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from punctual.session import build_session

    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__driver__host="127.0.0.1",
        spark__ui__showConsoleProgress="false", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    from punctual.sources.lake import Lake

    return Lake(spark, f"file://{tmp_path}/lake")
