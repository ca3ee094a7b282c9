import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from textweir.session import build_session
    from textweir.shipping import ship

    session = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g", "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4"})
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return str(DATA / "sf0.001")
