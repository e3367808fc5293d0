import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lodestrand.session import local_session, ship

    conf = {"spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    session = local_session(8, 8, **conf)
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
