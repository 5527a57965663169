from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session(
        "local[4]",
        app_name="tidemark-tests",
        shuffle_partitions=8,
        conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-test-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidemark-test-")
