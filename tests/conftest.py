import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    import os

    from rollcall.session import session

    os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
    return session("tests", "4", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g"})
