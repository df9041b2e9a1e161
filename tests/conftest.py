import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from marquee.session import ensure_checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", shuffle_partitions=4)
    ensure_checkpoint_dir(session)
    yield session
    session.stop()
