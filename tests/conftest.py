import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from codays.session import local_session  # noqa: E402

DATA = Path("/root/testdata")

# Three cells: A (-12.3, 44.1), B (5.6, -7.9) and C (48.3, 0.2). A comes twice on
# one day; A and B share two days, and so do A and C, so the tie goes to B; the
# last two days have one cell each. Halves round away from zero.
GOLDEN = [
    ("-12.25", "44.05", "2021-07-02 23:59:59"),
    ("5.55", "-7.94", "2021-07-02 00:00:00"),
    ("-12.341", "44.149", "2021-07-02 11:00:00"),
    ("48.30", "0.15", "2021-07-09 08:15:30"),
    ("-12.3", "44.1", "2021-07-09 08:15:31"),
    ("48.349", "0.2", "2021-08-15 12:00:00"),
    ("5.6", "-7.85", "2021-08-15 12:00:00"),
    ("-12.26", "44.12", "2021-08-15 12:00:00"),
    ("-12.30", "44.10", "2021-09-20 05:05:05"),
    ("5.649", "-7.9", "2021-09-27 06:06:06"),
]
RAW_SCHEMA = "latitude string, longitude string, date string"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def golden(spark):
    return spark.createDataFrame(GOLDEN, RAW_SCHEMA)


@pytest.fixture(scope="session")
def sf_small():
    return str(DATA / "sf0.001")
