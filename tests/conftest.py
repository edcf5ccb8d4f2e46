import os
import sys

import pytest

_REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, _REPO)
# Python workers must import the package and the test doubles pickled into tasks
os.environ["PYTHONPATH"] = os.pathsep.join([_REPO, _TESTS] + [p for p in [os.environ.get("PYTHONPATH")] if p])

from asrprep.session import get_spark  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="asrprep-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
