"""Events that come twice, lasting counts and paced replay."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tempolake.schemas import AUTH
from tempolake.sources.bronze import BatchTable, FileSinkTable
from tempolake.sources.files import stream_lines
from tempolake.streaming import replay
from tempolake.streaming.decode import decode, to_bronze
from tempolake.streaming.ingest import start_counted_ingest, start_ingest

BACKFILL = {"availableNow": True}
SECOND = 1000
START = 1_700_000_000_000


def deliver(folder, name, events):
    folder.mkdir(exist_ok=True)
    text = "\n".join(json.dumps(e) if isinstance(e, dict) else e for e in events)
    (folder / f"{name}.txt").write_text(text + "\n")


def event(user, second):
    return {"userId": user, "sessionId": user, "ts": START + second * SECOND, "success": True}


class Ingest:
    def __init__(self, spark, folder, once):
        self.spark, self.folder, self.once = spark, folder, once
        self.table = FileSinkTable(spark, f"{folder}/bronze", AUTH)
        self.deliveries = 0

    def run(self, *events):
        deliver(self.folder / "lines", str(self.deliveries), events)
        self.deliveries += 1
        query = start_ingest(
            stream_lines(self.spark, f"{self.folder}/lines"), self.table,
            f"{self.folder}/checkpoint", BACKFILL, once=self.once, state_partitions=2,
        )
        query.awaitTermination()
        rows = self.table.read().select("userId", "ts").collect()
        got = sorted((r.userId, None if r.ts is None else (r.ts - START) // SECOND) for r in rows)
        late = sum(
            state.numRowsDroppedByWatermark
            for progress in query.recentProgress
            for state in progress.stateOperators
        )
        return got, late


def test_without_state_events_come_twice(spark, tmp_path):
    ingest = Ingest(spark, tmp_path, None)
    assert ingest.run(event(1, 0), event(1, 0)) == ([(1, 0), (1, 0)], 0)


def test_state_survives_restarts_and_forgets(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    ingest = Ingest(spark, tmp_path, "30 seconds")
    assert ingest.run(event(1, 0), event(1, 0), event(2, 5)) == ([(1, 0), (2, 5)], 0)
    # A new query each time: what it knows comes from the checkpoint.
    assert ingest.run(event(1, 0), event(3, 20)) == ([(1, 0), (2, 5), (3, 20)], 0)
    rows = [(1, 0), (2, 5), (3, 20), (4, 100)]
    assert ingest.run(event(4, 100)) == (rows, 0)
    # The watermark is at 70 now: older events are late, whether they came before or not.
    assert ingest.run(event(1, 0), event(5, 10), event(4, 100), event(6, 75)) == (
        sorted([*rows, (6, 75)]), 2,
    )
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


def test_events_without_time_all_stay(spark, tmp_path):
    ingest = Ingest(spark, tmp_path, "30 seconds")
    untimed = {"userId": 9, "sessionId": 9}
    assert ingest.run(untimed, untimed, event(1, 0), "no object", "")[0] == [
        (1, 0), (9, None), (9, None),
    ]
    assert len(ingest.run(untimed)[0]) == 4


def test_equal_times_of_different_events(spark, tmp_path):
    ingest = Ingest(spark, tmp_path, "30 seconds")
    near = [event(1, 0), event(2, 0), event(1, 0) | {"success": False}, event(1, 0) | {"level": "x"}]
    assert ingest.run(*near, *near)[0] == [(1, 0), (1, 0), (1, 0), (2, 0)]


def counted(spark, folder):
    table = BatchTable(spark, f"{folder}/bronze", AUTH)
    source = stream_lines(spark, f"{folder}/lines")
    start_counted_ingest(source, table, f"{folder}/checkpoint", BACKFILL).awaitTermination()
    return BatchTable(spark, f"{folder}/bronze", AUTH)


def test_counts_last_over_runs(spark, tmp_path):
    empty = BatchTable(spark, f"{tmp_path}/bronze", AUTH)
    assert tuple(empty.totals().first()) == (0, 0, 0, 0, 0)
    assert empty.last_batch() == -1 and empty.read().count() == 0
    day = 86_400
    deliver(tmp_path / "lines", "0", [event(1, 0), "broken", {"userId": 2}, event(3, day)])
    table = counted(spark, tmp_path)
    assert tuple(table.totals().first()) == (1, 4, 1, 1, 3)
    deliver(tmp_path / "lines", "1", [event(4, 0)])
    table = counted(spark, tmp_path)
    assert tuple(table.totals().first()) == (2, 5, 1, 1, 4)
    assert table.read().columns == list(AUTH.bronze_columns)
    days = [str(r[0]) for r in table.days_after(-1).orderBy("event_date").collect()]
    assert days == ["None", "2023-11-14", "2023-11-15"]
    assert [str(r[0]) for r in table.days_after(0).collect()] == ["2023-11-14"]
    assert table.days_after(1).count() == 0
    assert table.read(upto=0).count() == 3


def test_a_repeated_batch_counts_once(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path), AUTH)

    def write(batch_id, *events):
        lines = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
        counts = Observation()
        table.write_batch(to_bronze(decode(lines, AUTH, counts), AUTH), batch_id, counts)

    write(0, event(1, 0), event(2, 86_400))
    write(0, event(1, 0), event(2, 86_400))
    assert tuple(table.totals().first()) == (1, 2, 0, 0, 2)
    # Rows of a batch that failed before its ledger entry are not read.
    rows = table.read()
    rows.write.partitionBy("event_date").parquet(f"{table.path}/rows/batch_id=1")
    assert table.read().count() == 2
    write(1, event(3, 0))
    assert table.read().count() == 3 and table.last_batch() == 1


def messages(spark, times):
    rows = [(f"k{i}", f"v{i}", "auth-events", t) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "key string, value string, topic string, ts long")


def test_slices_hold_their_times(spark, tmp_path):
    times = [START + s * SECOND for s in (0, 59, 60, 61, 300, 301)] + [0, None]
    replay.stage_slices(messages(spark, times), f"{tmp_path}/staged", 60 * SECOND)
    sent = {}

    def send(rows, number):
        assert rows.columns == ["key", "value", "topic", "ts"]
        sent[number] = sorted(r.value for r in rows.collect())

    assert replay.replay(spark, f"{tmp_path}/staged", send, 60 * SECOND) == [0, 1, 5]
    assert sent == {0: ["v0", "v1", "v6", "v7"], 1: ["v2", "v3"], 5: ["v4", "v5"]}
    assert list(sent) == [0, 1, 5]


@pytest.mark.parametrize("speed, waits", [(0, []), (60, [1.0, 4.0]), (120, [0.5, 2.0])])
def test_slices_are_sent_when_they_are_due(spark, tmp_path, speed, waits):
    times = [START + s * SECOND for s in (0, 60, 300)]
    replay.stage_slices(messages(spark, times), f"{tmp_path}/staged", 60 * SECOND)
    now, waited = [0.0], []

    def sleep(seconds):
        waited.append(seconds)
        now[0] += seconds

    replay.replay(
        spark, f"{tmp_path}/staged", lambda rows, n: None, 60 * SECOND, speed, lambda: now[0], sleep
    )
    assert waited == pytest.approx(waits)


def test_a_slice_is_read_alone(spark, tmp_path):
    times = [START + s * SECOND for s in (0, 60, 300)]
    replay.stage_slices(messages(spark, times), f"{tmp_path}/staged", 60 * SECOND)
    part = replay.read_slice(spark, f"{tmp_path}/staged", 1)
    assert part.select(F.input_file_name()).distinct().count() == 1
    assert "PartitionFilters: [isnotnull(slice" in part._jdf.queryExecution().toString()
