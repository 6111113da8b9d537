"""Stored sets of listeners, date ranges and early top-n, against brute force."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SMALL
from tempolake.operators import gold, ranking, sets
from tempolake.operators.intervals import join_ranges

JAN = datetime.date(2024, 1, 1)


def day(n):
    return JAN + datetime.timedelta(days=n)


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


USERS = [None, 0, 1, -1, 32767, 32768, 32769, -32768, -32767, 2**40, -(2**40), 65536, 7]


@pytest.fixture(scope="module")
def plays():
    draw = random.Random(4)
    return [
        (draw.choice([None, *map(day, (0, 1, 95, 400))]), draw.randrange(3), draw.choice(USERS))
        for _ in range(400)
    ]


def counted(plays, key):
    found = {}
    for date, hour, user in plays:
        if user is not None:
            found.setdefault(key(date, hour), set()).add(user)
    return {k: len(v) for k, v in found.items()}


def test_sets_count_exactly(spark, plays, tmp_path):
    listens = spark.createDataFrame(plays, "event_date date, hour_of_day int, user_id long")
    sets.listener_sets(listens).write.parquet(f"{tmp_path}/sets")
    stored = spark.read.parquet(f"{tmp_path}/sets")
    keys = {
        ("event_date",): lambda d, h: (d,),
        ("hour_of_day",): lambda d, h: (h,),
        ("event_date", "hour_of_day"): lambda d, h: (d, h),
        (): lambda d, h: (),
    }
    for names, key in keys.items():
        got = sets.count_members(stored, list(names), "n").collect()
        assert {tuple(r)[:-1]: r.n for r in got} == counted(plays, key)
    year = sets.count_members(stored, [F.year("event_date").alias("year")], "n").collect()
    assert {r.year: r.n for r in year} == counted(plays, lambda d, h: d and d.year)


def test_new_days_add_their_sets(spark, plays, tmp_path):
    listens = spark.createDataFrame(plays, "event_date date, hour_of_day int, user_id long")
    for part in ("event_date < '2024-02-01'", "NOT coalesce(event_date < '2024-02-01', false)"):
        sets.listener_sets(listens.filter(part)).write.mode("append").parquet(f"{tmp_path}/sets")
    stored = spark.read.parquet(f"{tmp_path}/sets")
    growth = gold.qoq_growth_of_sets(stored)
    assert sorted(map(str, growth.collect())) == sorted(
        map(str, gold.qoq_listener_growth(listens).collect())
    )
    # Only the stored sets are read.
    read = growth._jdf.queryExecution().optimizedPlan().toString()
    assert read.count("Relation [") == 1 and "LocalRelation" not in read


def test_sets_take_no_more_than_their_users(spark, tmp_path):
    ids = [-(2**63), 2**63 - 1, *range(-129, 130), *(n * 40_000 for n in range(2_000))]
    plays = [(JAN, 3, i) for i in ids] * 2
    listens = spark.createDataFrame(plays, "event_date date, hour_of_day int, user_id long")
    made = sets.listener_sets(listens)
    made.write.parquet(f"{tmp_path}/sets")
    stored = spark.read.parquet(f"{tmp_path}/sets")
    # A row of fixed, small size per user at most, and nothing is sorted to build or unite sets.
    assert dict(stored.dtypes)["users"] == "bigint"
    assert stored.count() <= len(set(ids))
    united = sets.count_members(stored, ["event_date"], "n")
    assert united.collect() == [(JAN, len(set(ids)))]
    assert "SortAggregate" not in plan_of(made) + plan_of(united)


def test_sets_are_made_in_tasks_of_bounded_size(spark, monkeypatch):
    """However many plays there are: a task holds nearly one set per play."""
    monkeypatch.setattr(entry, "SET_ROWS", 100, raising=False)
    seen, make = [], sets.listener_sets
    monkeypatch.setattr(sets, "listener_sets", lambda plays: seen.append(plays) or make(plays))
    entry.queries()["listeners_from_sets"](spark, SMALL)
    [plays] = seen
    per_task = plays.groupBy(F.spark_partition_id()).count()
    assert per_task.agg(F.max("count")).first()[0] <= 300


def test_no_plays_have_no_sets(spark):
    empty = spark.createDataFrame([], "event_date date, hour_of_day int, user_id long")
    assert sets.listener_sets(empty).count() == 0
    assert gold.qoq_growth_of_sets(sets.listener_sets(empty)).count() == 0


@pytest.fixture(scope="module")
def ranges():
    draw = random.Random(9)
    out = []
    for i in range(40):
        low = draw.randrange(-40, 90)
        out.append((i, draw.randrange(4), day(low), day(low + draw.choice([-3, 0, 1, 10, 35, 400]))))
    return out + [(50, 1, None, day(3)), (51, 1, day(3), None), (52, None, day(0), day(90))]


def test_ranges_equal_brute_force(spark, ranges):
    draw = random.Random(3)
    points = [(i, draw.choice([None, *range(4)]), day(draw.randrange(-60, 120))) for i in range(150)]
    points += [(900, 1, None)]
    left = spark.createDataFrame(points, "point int, user int, date date")
    right = spark.createDataFrame(ranges, "range int, user int, low date, high date")

    def holds(date, low, high):
        return None not in (date, low, high) and low <= date <= high

    expected = {(p, r) for p, _, d in points for r, _, a, b in ranges if holds(d, a, b)}
    joined = join_ranges(left, right.drop("user"), "date", "low", "high")
    got = [tuple(r) for r in joined.select("point", "range").collect()]
    assert set(got) == expected and len(got) == len(expected)
    expected = {
        (p, r) for p, u, d in points for r, v, a, b in ranges
        if u is not None and u == v and holds(d, a, b)
    }
    joined = join_ranges(left, right, "date", "low", "high", ["user"])
    got = [tuple(r) for r in joined.select("point", "range").collect()]
    assert set(got) == expected and len(got) == len(expected)


def test_ranges_meet_their_months_only(spark, ranges):
    left = spark.createDataFrame([(1, day(0))], "point int, date date")
    right = spark.createDataFrame(ranges, "range int, user int, low date, high date")
    plan = plan_of(join_ranges(left, right, "date", "low", "high"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" in plan


def named_plays(spark, listens):
    draw = random.Random(8)
    rows = []
    for _ in range(600):
        name = f"a{min(int(draw.expovariate(0.3)), 12)}"
        artist = draw.choice([name, name, name, None])
        rows.append(
            (str(day(draw.randrange(3))), draw.randrange(40), 1, artist, f"s{draw.randrange(5)}", 60.0, True)
        )
    dated = listens(rows)
    undated = F.when(F.col("user_id") % 7 != 0, F.col("event_date")).alias("event_date")
    return dated.select(undated, *[c for c in dated.columns if c != "event_date"])


@pytest.mark.parametrize("n", [1, 3, 50])
@pytest.mark.parametrize("model", [gold.top_artists_daily, gold.top_songs_daily])
def test_early_top_n_changes_nothing(spark, listens, model, n):
    silver = named_plays(spark, listens)
    everything = ranking.top_n(model(silver), n).collect()
    assert sorted(map(str, ranking.top_n(model(silver, n), n).collect())) == sorted(
        map(str, everything)
    )


def test_distinct_counts_see_survivors_only(spark, listens, tmp_path):
    named_plays(spark, listens).write.parquet(f"{tmp_path}/plays")
    stored = spark.read.parquet(f"{tmp_path}/plays")
    text = gold.top_artists_daily(stored, 3)._jdf.queryExecution().optimizedPlan().toString()

    def reads(column):
        """Whether every scan of this column stands below a semi-join with the survivors."""
        lines = text.split("\n")
        for i, line in enumerate(lines):
            if "Relation [" in line and f"{column}#" in line.split("Relation")[1]:
                depth = line.index("Relation")
                above = [k for k in lines[:i] if "Join LeftSemi" in k and k.index("Join") < depth]
                if not above:
                    return False
        return True

    assert text.count("Join LeftSemi") >= 2 and reads("user_id") and reads("song")
