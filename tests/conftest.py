import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tempolake import build_session

    session = build_session(
        "tests",
        master="local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    # Python workers import the package from here, whatever folder the tests start in.
    session.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    yield session
    session.stop()


@pytest.fixture
def listens(spark):
    """Build silver listens from (event_date, user, session, artist, song, seconds, paid)."""
    import datetime

    def build(rows):
        schema = (
            "event_date date, user_id bigint, session_id bigint, artist string, song string, "
            "duration_seconds double, is_paid boolean, level string, first_name string, "
            "last_name string, gender string, day_of_week int, hour_of_day int"
        )
        full = []
        for row in rows:
            date, user, session, artist, song, seconds, paid = row
            day = datetime.date.fromisoformat(date)
            level = None if paid is None else ("paid" if paid else "free")
            full.append(
                (day, user, session, artist, song, seconds, paid, level, f"n{user}", None, "F", 1, 0)
            )
        return spark.createDataFrame(full, schema)

    return build
