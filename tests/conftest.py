import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import build_session

    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.enabled": "false",
            "spark.checkpoint.dir": f"file://{base}/ckpt", "spark.sql.warehouse.dir": f"{base}/wh",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
