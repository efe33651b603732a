import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from martloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        "6g",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(home / "warehouse"),
        spark__checkpoint__dir=str(home / "shared"),
    )
    yield session
    session.stop()


def rows(frame, *order):
    """Rows as dicts in the order of some columns (or of all)."""
    found = [row.asDict(recursive=True) for row in frame.collect()]
    return sorted(found, key=lambda r: tuple(str(r[name]) for name in (order or r)))
