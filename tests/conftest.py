import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cartwheel.session import build_session
    s = build_session("local[4]", app="cartwheel-tests", shuffle_partitions=4)
    yield s
    s.stop()


os.environ.setdefault("TZ", "UTC")


def ts(text):
    """Naive datetime (UTC wall clock, as collected from a UTC session)."""
    from datetime import datetime
    fmt = "%Y-%m-%d %H:%M:%S.%f" if "." in text else "%Y-%m-%d %H:%M:%S"
    return datetime.strptime(text, fmt)
