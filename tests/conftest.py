import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from daylog.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, "daylog-tests", **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture
def put(tmp_path):
    """Write a landed file of a user and return the folder it lies in."""

    def write(kind: str, user: int, name: str, content) -> str:
        folder = tmp_path / kind / f"user_id={user}"
        folder.mkdir(parents=True, exist_ok=True)
        text = content if isinstance(content, str) else json.dumps(content, indent=2)
        (folder / name).write_text(text)
        return str(tmp_path / kind)

    return write


def rows(frame, *order):
    return [tuple(r) for r in (frame.orderBy(*order) if order else frame).collect()]
