"""Write - audit - publish: what becomes visible when, and what a failure leaves behind."""

import pytest
from pyspark.sql import functions as F

from tempolake import MODELS, NotPublished, Pipeline, Warehouse, layer_for, run_wap, select_models
from tempolake.operators.quality import AuditFailed
from tempolake.sources.testdata import event_tables

SF = "/root/testdata/sf0.001"


def known(rows):
    return rows.filter("userId is not null")


@pytest.fixture(scope="module")
def good(spark):
    return event_tables(spark, SF, blank_artist="Indie")


@pytest.fixture(scope="module")
def bad(spark):
    return event_tables(spark, SF)  # blank artists fail the silver audit


def test_run_publishes_everything(spark, tmp_path, good):
    warehouse = Warehouse(spark, str(tmp_path))
    report = run_wap(warehouse, good)
    assert len(report.silver_audit) == 13 and len(report.gold_audit) == 15
    status = warehouse.read("status", "gold_pipeline_status")
    loaded = {r.table_name: r.rows_loaded for r in status.collect()}
    assert len(loaded) == 6
    for table, rows in loaded.items():
        assert warehouse.read("gold", table).count() == rows > 0


def test_stored_tables_keep_columns_and_order_on_read(spark, tmp_path, good):
    warehouse = Warehouse(spark, str(tmp_path))
    pipeline = Pipeline(warehouse, good)
    pipeline.write_silver("silver_auth_events")
    stored = warehouse.read_run("silver_staging", pipeline.run_id, "silver_auth_events")
    built = MODELS["silver_auth_events"].build(good["auth_events"])
    assert sorted(stored.columns) == sorted(built.columns)
    assert stored.select(*built.columns).exceptAll(built).count() == 0


def test_failed_silver_audit_leaves_published_tables_alone(spark, tmp_path, good, bad):
    warehouse = Warehouse(spark, str(tmp_path))
    first = run_wap(warehouse, good)
    before = {layer: warehouse.published(layer) for layer in ("silver", "gold", "status")}
    failing = Pipeline(warehouse, bad)
    with pytest.raises(AuditFailed) as error:
        failing.run()
    assert [(r["column"], r["test"]) for r in error.value.failed] == [("artist", "not_null")]
    after = {layer: warehouse.published(layer) for layer in ("silver", "gold", "status")}
    assert after == before and failing.run_id > first.run_id


def test_status_waits_for_the_gold_audit(spark, tmp_path, good):
    warehouse = Warehouse(spark, str(tmp_path))
    broken = Pipeline(warehouse, good)
    broken.write_silver()
    broken.audit_silver()
    broken.publish_silver()
    broken.build_gold()
    # Damage a built table before its audit.
    table = "gold_hourly_listening_heatmap"
    rows = warehouse.read_run("gold", broken.run_id, table).withColumn(
        "hour_of_day", F.lit(None).cast("int")
    )
    data = [tuple(r) for r in rows.collect()]
    spark.createDataFrame(data, rows.schema).write.mode("overwrite").parquet(
        warehouse.path("gold", broken.run_id, table)
    )
    with pytest.raises(AuditFailed):
        broken.audit_gold()
    with pytest.raises(NotPublished):
        warehouse.read("status", "gold_pipeline_status")
    # Without staging, gold itself is already current, as in the documented default.
    assert len(warehouse.published("gold")) == 6


def test_staged_gold_is_published_after_its_audit(spark, tmp_path, good):
    warehouse = Warehouse(spark, str(tmp_path))
    pipeline = Pipeline(warehouse, good, stage_gold=True)
    pipeline.write_silver()
    pipeline.audit_silver()
    pipeline.publish_silver()
    pipeline.build_gold()
    assert warehouse.published("gold") == {}
    pipeline.audit_gold()
    assert len(warehouse.published("gold")) == 6


def test_gold_needs_published_silver(spark, tmp_path, good):
    warehouse = Warehouse(spark, str(tmp_path))
    pipeline = Pipeline(warehouse, good)
    pipeline.write_silver()
    with pytest.raises(NotPublished):
        pipeline.build_gold()


def test_rebuild_of_a_run_replaces_it(spark, tmp_path, good):
    warehouse = Warehouse(spark, str(tmp_path))
    for _ in range(2):
        Pipeline(warehouse, good, run_id=7).write_silver("silver_auth_events")
    rows = warehouse.read_run("silver_staging", 7, "silver_auth_events")
    assert rows.count() == known(good["auth_events"]).count()


def test_dedup_option(spark, tmp_path, good):
    warehouse = Warehouse(spark, str(tmp_path))
    twice = good | {"auth_events": good["auth_events"].unionByName(good["auth_events"])}
    keys = {"silver_auth_events": ["userId", "ts"]}
    pipeline = Pipeline(warehouse, twice, dedup_keys=keys)
    pipeline.write_silver("silver_auth_events")
    rows = warehouse.read_run("silver_staging", pipeline.run_id, "silver_auth_events")
    assert rows.count() == known(good["auth_events"]).select("userId", "ts").distinct().count()


def test_selection():
    assert [m.name for m in select_models("silver")] == [
        "silver_listen_events",
        "silver_auth_events",
        "silver_page_view_events",
        "silver_status_change_events",
    ]
    assert len(select_models("gold")) == 6
    assert "gold_pipeline_status" not in [m.name for m in select_models("gold")]
    assert [m.name for m in select_models("gold_pipeline_status")] == ["gold_pipeline_status"]
    with pytest.raises(KeyError):
        select_models("platinum")


def test_lineage():
    users_of_auth = [m.name for m in MODELS.values() if "silver_auth_events" in m.inputs]
    assert users_of_auth == []
    assert len([m for m in MODELS.values() if "silver_listen_events" in m.inputs]) == 6


def test_routing():
    assert layer_for("silver", "staging") == "silver_staging"
    assert layer_for("silver", "dev") == "silver"
    assert layer_for("gold", "staging") == "gold"
    assert layer_for(" gold ", "dev") == "gold"
    assert layer_for(None, "dev", default="scratch") == "scratch"


def test_layers_views_and_copy(spark, tmp_path, good):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.create_layers()
    warehouse.create_layers()  # existing layers are skipped
    assert {"bronze", "silver", "gold"} <= {d.name for d in spark.catalog.listDatabases()}
    pipeline = Pipeline(warehouse, good)
    pipeline.write_silver("silver_auth_events")
    pipeline.publish_silver()
    assert warehouse.create_views("silver") == ["silver_auth_events"]
    expected = known(good["auth_events"]).count()
    assert spark.sql("select count(*) from silver.silver_auth_events").first()[0] == expected
    source = ("silver_staging", pipeline.run_id, "silver_auth_events")
    for _ in range(2):  # forced: replaces an existing target
        warehouse.copy(source, ("silver", 1, "silver_auth_events"))
    assert warehouse.read_run("silver", 1, "silver_auth_events").count() == expected


def test_empty_topic_does_not_stop_a_run(spark, tmp_path, good):
    warehouse = Warehouse(spark, str(tmp_path))
    quiet = good | {"status_change_events": good["status_change_events"].limit(0)}
    Pipeline(warehouse, quiet).run()
    changes = warehouse.read("silver", "silver_status_change_events")
    assert changes.count() == 0 and changes.columns[:2] == ["user_id", "session_id"]
    assert warehouse.read("gold", "gold_top_songs_daily").columns[0] == "event_date"


def test_undated_rows_stop_the_publish(spark, tmp_path):
    from tempolake.operators.quality import AuditFailed

    warehouse = Warehouse(spark, str(tmp_path))
    raw = event_tables(spark, "/root/testdata/sf0.001", blank_artist="Indie", undated=True)
    with pytest.raises(AuditFailed, match="event_date"):
        Pipeline(warehouse, raw).run()
    assert warehouse.published("silver") == {}


@pytest.mark.parametrize(
    "master, checkpoints, warehouse, expected",
    [
        ("local[4]", None, "/tmp/wh", "/tmp/wh"),
        ("local[4]", None, "file:/tmp/wh/", "file:/tmp/wh"),
        ("spark://host:7077", "s3a://bucket/c/", "/tmp/wh", "s3a://bucket/c"),
        ("spark://host:7077", None, "hdfs://name/wh", "hdfs://name/wh"),
        ("spark://host:7077", None, "/tmp/wh", None),
        ("spark://host:7077", None, "file:///tmp/wh", None),
        ("yarn", None, "spark-warehouse", None),
    ],
)
def test_runs_write_to_a_shared_folder_only(master, checkpoints, warehouse, expected):
    from types import SimpleNamespace

    from tempolake.session import shared_dir

    settings = {"spark.checkpoint.dir": checkpoints, "spark.sql.warehouse.dir": warehouse}
    spark = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings[key] or default),
        sparkContext=SimpleNamespace(master=master),
    )
    if expected is None:
        with pytest.raises(RuntimeError, match="executors do not share"):
            shared_dir(spark)
    else:
        assert shared_dir(spark) == expected
