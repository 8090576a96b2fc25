import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
# Python workers import the package too, whatever folder the tests are started from.
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def sf001():
    """The smallest test tables."""
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from flowml.session import get_session
    s = get_session("local[4]", app="flowml-tests", shuffle_partitions=8)
    yield s
    s.stop()
