from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from sluiceway.operators.quality import Checks, failing_rows, quality_report
from sluiceway.plans import build, incremental
from sluiceway.registry import adapters
from sluiceway.sinks import partitions
from sluiceway.sinks.writers import AS_READ, spread, write_model
from sluiceway.sources.tables import register_table


@pytest.fixture
def workspace(tmp_path):
    return build.Workspace(f"{tmp_path}/processed", f"{tmp_path}/surface")


def test_every_model_comes_after_its_inputs():
    for models in build.WORKFLOWS.values():
        seen = {build.RAW}
        for name, model in models.items():
            assert set(model.inputs) <= seen
            seen.add(name)


def test_declared_checks_number():
    checks = [m.checks for models in build.WORKFLOWS.values() for m in models.values()]
    assert sum(len(c.not_null) for c in checks) == 32
    assert sum(len(c.unique) for c in checks) == 11


def test_selection():
    models = build.EVENT_MODELS
    choose = lambda *a, **k: build.select_models(models, *a, **k)
    assert choose() == list(models)
    assert choose(["int_sensor_events"]) == ["int_sensor_events"]
    assert choose(["+int_sensor_events"]) == ["stg_sensor_events", "int_sensor_events"]
    assert choose(["staging", "management"]) == [
        "stg_sensor_events",
        "management_stream_health_summary",
    ]
    assert choose(["int_sensor_events+"], exclude=["analytics"]) == [
        "int_sensor_events",
        "management_stream_health_summary",
    ]
    with pytest.raises(ValueError, match="nothing is called"):
        choose(["nope"])


def test_build_then_test_then_partial_rebuild(spark, sf_dir, workspace):
    raw = adapters.raw_events(spark, sf_dir)
    assert build.build_models(spark, "events", raw, workspace) is None
    for name, model in build.EVENT_MODELS.items():
        root = "surface" if model.is_mart else "processed"
        path = Path(workspace.path(name, model))
        assert path.parts[-3] == root and any(path.glob("event_date=*"))
    report = build.build_models(spark, "events", None, workspace, mode="test")
    rows = report.collect()
    assert len(rows) == 13 and all(row.failures == 0 for row in rows)
    before = workspace.read(spark, "events", "analytics_sensor_events")
    count = before.count()
    assert "analytics_sensor_events" in build.publish_marts(spark, "events", workspace)
    after = workspace.read(spark, "events", "analytics_sensor_events")
    assert after.count() == count


def test_unknown_mode(spark, workspace):
    with pytest.raises(ValueError, match="mode must be"):
        build.build_models(spark, "events", None, workspace, mode="dry")


def test_quality_report_counts_failures(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, 3)], "k STRING, v INT")
    report = quality_report({"t": df}, {"t": Checks(["k", "v"], ["k"])})
    found = {(r.column_name, r.check_name): r.failures for r in report.collect()}
    assert found == {("k", "not_null"): 2, ("v", "not_null"): 1, ("k", "unique"): 1}
    with pytest.raises(ValueError, match="no check"):
        quality_report({"t": df}, {})


def files_of(path, day):
    return list(Path(path, f"event_date={day}").glob("*.parquet"))


def test_a_large_date_is_split_between_tasks(spark, tmp_path):
    df = spark.range(400_000).selectExpr(
        "id",
        "uuid() as text",
        "case when id % 3 > 0 then date'2026-03-01' else date_add(date'2026-03-02', cast(id % 9 as int)) end as event_date",
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        write_model(df, f"{tmp_path}/t", "event_date")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(files_of(f"{tmp_path}/t", "2026-03-01")) > 1
    assert len(files_of(f"{tmp_path}/t", "2026-03-02")) <= 2
    assert spark.read.parquet(f"{tmp_path}/t").select("id").distinct().count() == 400_000


def test_projections_are_written_without_a_shuffle(spark, tmp_path):
    days = spark.range(2000).selectExpr("id", "date_add(date'2026-01-01', cast(id % 40 as int)) as event_date")
    write_model(days, f"{tmp_path}/a", "event_date")
    source = spark.read.parquet(f"{tmp_path}/a")
    assert "Exchange" not in spread(source, "event_date", arrange=AS_READ)._jdf.queryExecution().toString()
    write_model(source, f"{tmp_path}/b", "event_date", arrange=AS_READ)
    assert len(list(Path(tmp_path, "b").glob("event_date=*"))) == 40
    assert spark.read.parquet(f"{tmp_path}/b").exceptAll(source).isEmpty()


def test_arrangements_fit_the_models():
    """Only projections of one table stored by the same column may skip the shuffle."""
    for models in build.WORKFLOWS.values():
        for name, model in models.items():
            if model.arrange == AS_READ:
                (source,) = model.inputs
                assert models[source].partition == model.partition, name


def test_a_model_without_rows_or_dates_keeps_its_columns(spark, tmp_path):
    path = f"{tmp_path}/m"
    none = spark.createDataFrame([], "k STRING, event_date DATE")

    def read():
        return partitions.read_table(spark, path, none.schema)

    write_model(none, path, "event_date")
    assert read().dtypes == none.dtypes and read().isEmpty()
    some = spark.sql("SELECT 'a' AS k, DATE'2025-01-02' AS event_date")
    write_model(some, path, "event_date")
    assert read().count() == 1
    write_model(spark.createDataFrame([("b", None)], none.schema), path, "event_date")
    assert read().dtypes == none.dtypes and [tuple(r) for r in read().collect()] == [("b", None)]
    write_model(none, path, "event_date")
    assert read().isEmpty()


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    path = f"{tmp_path}/m"
    good = spark.range(20).selectExpr("id", "date_add(date'2026-01-01', cast(id as int)) as event_date")
    for partition in ("event_date", None):
        write_model(good, path, partition)
        files = partitions.table_files(spark, path)
        bad = good.withColumn("id", F.expr("if(id = 13, raise_error('no'), id)").cast("bigint"))
        with pytest.raises(Exception, match="no"):
            write_model(bad, path, partition)
        assert partitions.table_files(spark, path) == files
        write_model(good.limit(5), path, partition)
        assert partitions.read_table(spark, path, good.schema).count() == 5
        path += "-plain"


def test_only_the_given_dates_are_replaced(spark, tmp_path):
    path = f"{tmp_path}/m"
    days = spark.range(40).selectExpr(
        "id", "nullif(date_add(date'2026-01-01', cast(id % 5 as int)), date'2026-01-05') as event_date"
    )
    write_model(days, path, "event_date")
    before = partitions.table_files(spark, path)
    kept = {name for name in before if "01-01" in name or "01-04" in name}
    gone = [date(2026, 1, 2), date(2026, 1, 3), None]
    # The table is among its own inputs; one of the dates, and the NULL date, have no rows left.
    rows = partitions.read_table(spark, path, days.schema).where("event_date = '2026-01-02'")
    write_model(rows.limit(3), path, "event_date", dates=gone)
    assert kept <= partitions.table_files(spark, path)
    found = partitions.read_table(spark, path, days.schema).groupBy("event_date").count().collect()
    assert {str(r[0]): r[1] for r in found} == {"2026-01-01": 8, "2026-01-02": 3, "2026-01-04": 8}


def event_rows(spark, rows):
    names = ["emitter_event_id", "emitted_at", "emission_index", "device_id"]
    made = spark.createDataFrame(rows, "a STRING, b STRING, c INT, d STRING").toDF(*names)
    schema = T.StructType.fromDDL(build.RAW_SCHEMAS["events"])
    absent = [f for f in schema.fields if f.name not in names]
    return made.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])


def test_added_rows_rewrite_the_dates_they_change(spark, workspace, tmp_path):
    first = [("a", "2026-03-01T01:00:00Z", 1, "d1"), ("b", "2026-03-02T01:00:00Z", 1, "d1")]
    first += [("c", "2026-03-05T01:00:00Z", 1, "d2"), ("e", "2026-03-06T01:00:00Z", 1, "d3")]
    late = [("a", "2026-03-03T00:00:00Z", 2, "d2"), ("e", "2026-03-06T00:30:00Z", 0, "d3")]
    raw = event_rows(spark, first + late)
    other = build.Workspace(f"{tmp_path}/whole/processed", f"{tmp_path}/whole/surface")
    build.build_models(spark, "events", event_rows(spark, first), workspace)
    paths = {n: workspace.path(n, m) for n, m in build.EVENT_MODELS.items()}
    before = {name: partitions.table_files(spark, path) for name, path in paths.items()}
    build.build_models(spark, "events", raw, workspace, added=event_rows(spark, late))
    build.build_models(spark, "events", raw, other)
    for name, path in paths.items():
        found = workspace.read(spark, "events", name)
        whole = other.read(spark, "events", name)
        assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty(), name
        after = partitions.table_files(spark, path)
        for day in ("2026-03-02", "2026-03-05"):
            old = {file for file in before[name] if f"={day}/" in file}
            if name != "analytics_device_latest_status":
                assert old and old <= after, (name, day)
    days = {str(r[0]) for r in workspace.read(spark, "events", "int_sensor_events").select("event_date").collect()}
    assert days == {"2026-03-02", "2026-03-03", "2026-03-05", "2026-03-06"}


def test_a_build_is_full_where_it_must_be(spark, workspace, monkeypatch):
    rows = event_rows(spark, [("a", "2026-03-01T01:00:00Z", 1, "d1")])
    used = []
    monkeypatch.setattr(
        build, "refresh", lambda name, *rest: used.append(name) or incremental.refresh(name, *rest)
    )
    run = lambda **more: build.build_models(spark, "events", rows, workspace, **more)
    run(added=rows)
    assert not used  # the first one
    run(added=rows, full_refresh=True)
    assert not used
    run(added=rows)
    assert used == list(build.EVENT_MODELS)
    used.clear()
    with pytest.raises(Exception):
        run(options={"int_sensor_events": {"tiebreak": ["nothing"]}})
    run(added=rows)
    assert not used  # the one before did not come to its end
    used.clear()
    run(added=rows, select=["+int_sensor_events"])
    assert used == ["stg_sensor_events", "int_sensor_events"]
    used.clear()
    run(added=rows)
    assert not used  # what depends on those has missed a change
    with pytest.raises(ValueError, match="not chosen"):
        run(added=rows, select=["intermediate"])


def test_what_a_refresh_takes_for_granted():
    """A date of a BY_DATE model depends on the same date of its inputs, stored by that column."""
    for models in build.WORKFLOWS.values():
        for name, model in models.items():
            if model.refresh == incremental.BY_DATE:
                assert all(models[up].partition == model.partition for up in model.inputs), name
            if model.refresh == incremental.BY_KEY:
                assert [models[up].refresh for up in model.inputs] == [incremental.BY_ROW]
            if model.refresh == incremental.BY_BUNDLE:
                assert models[model.inputs[1]].refresh == incremental.BY_DIFFERENCE
            assert (model.keyed is not None) == (
                model.refresh in (incremental.BY_KEY, incremental.BY_BUNDLE)
            )


def test_declared_columns_are_those_that_builds_write(spark, sf_dir, workspace):
    build.build_models(spark, "events", adapters.raw_events(spark, sf_dir), workspace)
    for name, model in build.EVENT_MODELS.items():
        stored = spark.read.parquet(workspace.path(name, model))
        assert stored.dtypes == workspace.read(spark, "events", name).dtypes


def test_checks_are_taken_while_writing(spark, sf_dir, workspace, tmp_path):
    raw = adapters.raw_events(spark, sf_dir).withColumn(
        "device_id", F.when(F.col("emission_index") > 0, F.col("device_id"))
    )
    report = build.build_models(
        spark, "events", raw, workspace, mode="build", failures=f"{tmp_path}/failures"
    )
    again = build.build_models(spark, "events", None, workspace, mode="test")
    found = sorted(map(tuple, report.collect()))
    assert found == sorted(map(tuple, again.collect()))
    failed = {(r[0], r[1]): r[3] for r in found}
    assert failed["int_sensor_events", "device_id"] > 0
    kept = spark.read.json(f"{tmp_path}/failures/int_sensor_events")
    assert kept.where("column_name = 'device_id'").count() == failed["int_sensor_events", "device_id"]
    # Only unique checks scan a table for the report, each its own column.
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == sum(len(m.checks.unique) for m in build.EVENT_MODELS.values())


def test_failing_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "k STRING, v INT")
    rows = failing_rows(df, Checks(["k", "v"], ["k"])).collect()
    found = sorted((r.column_name, r.check_name, r.row) for r in rows)
    assert found == [
        ("k", "not_null", '{"v":2}'),
        ("k", "unique", '{"k":"a","v":1}'),
        ("k", "unique", '{"k":"a"}'),
        ("v", "not_null", '{"k":"a"}'),
    ]


def test_tables_by_name_follow_their_partitions(spark, tmp_path):
    path, name = f"{tmp_path}/t", f"db_{tmp_path.name}.t"
    days = spark.range(6).selectExpr("id", "date_add(date'2026-01-01', cast(id as int)) as event_date")
    write_model(days.where("id < 3"), path, "event_date")
    assert register_table(spark, name, path, days.schema, "event_date").count() == 3
    write_model(days.where("id >= 2"), path, "event_date")
    assert register_table(spark, name, path, days.schema, "event_date").count() == 4
    plan = spark.table(name).where("event_date = '2026-01-04'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    # Other columns, another place.
    wider = days.withColumn("more", F.lit("x")).select("id", "more", "event_date")
    write_model(wider, f"{path}2", "event_date")
    assert register_table(spark, name, f"{path}2", wider.schema, "event_date").count() == 6


def test_selection_on_both_sides_leaves_siblings_out():
    chosen = build.select_models(build.TRANSACTION_MODELS, ["+gold_transactions+"])
    assert "gold_transactions" in chosen and "gold_answer_keys" not in chosen
