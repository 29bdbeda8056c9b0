import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterlark.session import local_session  # noqa: E402
from trip_rows import RAW  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def trip():
    """One plausible trip as a tuple; keyword arguments replace fields."""
    from datetime import datetime, timedelta

    names = [c.split()[0] for c in RAW.split(", ")]

    def make(row_seq, **changed):
        at = datetime(2024, 1, 1, 8, 30)
        values = dict(
            row_seq=row_seq, id=f"t{row_seq}", vendor_id="1", pickup_datetime=at, dropoff_datetime=at + timedelta(seconds=600),
            passenger_count=1, pickup_longitude=-73.98, pickup_latitude=40.75, dropoff_longitude=-73.95,
            dropoff_latitude=40.78, store_and_fwd_flag="N", trip_duration=600,
        )
        values.update(changed)
        return tuple(values[n] for n in names)

    return make
