import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from panelcast.session import local_session
    return local_session(cores="*", shuffle_partitions=8)


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
