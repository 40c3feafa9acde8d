import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tslake.session import local_session

    s = local_session("*", 8)
    yield s


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path / "lake")
