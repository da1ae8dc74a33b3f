import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tenderlake.session import session

    made = session("tests", cores=4, partitions=4)
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
