import pytest
from pyspark.sql import functions as F

from sluiceway.plans import events as evt
from sluiceway.streaming import intake, marts

COLUMNS = "emitter_event_id STRING, emitted_at STRING, emission_index INT, device_id STRING, pressure_kpa DOUBLE"


def staged(spark, rows):
    raw = spark.createDataFrame(rows, COLUMNS)
    others = {
        "workflow_name": "w",
        "source_preset_id": "p",
        "source_schema_version": "v1",
        "source_scenario_name": "s",
        "source_seed": 1,
        "emission_batch_started_at": "2026-03-15T12:00:00Z",
        "site_id": "site-1",
        "device_type": "combo_sensor",
        "temperature_c": 21.5,
        "device_status": "normal",
    }
    return evt.stg_sensor_events(raw.withColumns({k: F.lit(v) for k, v in others.items()}))


def live(table, spark):
    df = table.read(spark).select("emitter_event_id", "emission_index", "event_date")
    return sorted((r[0], r[1], str(r[2])) for r in df.collect())


BATCHES = [
    [("a", "2026-03-15T12:00:05Z", 1, "d1", 100.0), ("b", "2026-03-15T12:00:06Z", 1, "d2", None)],
    # The newer version of "a" belongs to the next day; "b" arrives late and older.
    [("a", "2026-03-16T00:00:01Z", 2, "d1", 101.0), ("b", "2026-03-15T11:00:00Z", 0, "d2", 99.0)],
    # The only event of the 15th moves away as well; an exact repeat changes nothing.
    [("b", "2026-03-17T00:00:00Z", 3, "d2", 98.0), ("a", "2026-03-16T00:00:01Z", 2, "d1", 101.0)],
]


class Feed:
    """A folder of event files, and the marts that a stream over it keeps."""

    def __init__(self, spark, root):
        self.spark, self.drop, self.checkpoint = spark, f"{root}/drop", f"{root}/checkpoint"
        self.marts = marts.EventMarts(f"{root}/marts")
        self.schema = staged(spark, []).schema
        staged(spark, []).write.parquet(self.drop)

    def add(self, rows):
        staged(self.spark, rows).coalesce(1).write.mode("append").parquet(self.drop)

    def run(self):
        stream = self.spark.readStream.schema(self.schema).parquet(self.drop)
        self.marts.writer(stream, self.checkpoint, {"availableNow": True}).start().awaitTermination()
        return self.marts


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


def test_versions_move_between_dates(spark, feed):
    expected = [
        [("a", 1, "2026-03-15"), ("b", 1, "2026-03-15")],
        [("a", 2, "2026-03-16"), ("b", 1, "2026-03-15")],
        [("a", 2, "2026-03-16"), ("b", 3, "2026-03-17")],
    ]
    for number, rows in enumerate(BATCHES):
        feed.add(rows)
        built = feed.run()
        assert live(built.events, spark) == expected[number]
        want = evt.management_stream_health_summary(built.events.read(spark))
        got = built.health.read(spark)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_batch_that_failed_midway_is_done_again(spark, feed, monkeypatch):
    """The event table has the batch, its marts have not: the next run mends them."""
    feed.add(BATCHES[0])
    feed.run()
    feed.add(BATCHES[1])
    feed.add(BATCHES[2])

    def fails(self, changed):
        marts.upsert_latest_events(self.events, changed)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(marts.EventMarts, "process_batch", fails)
        with pytest.raises(Exception, match="lost"):
            feed.run()
    assert live(feed.marts.events, spark) == [("a", 2, "2026-03-16"), ("b", 3, "2026-03-17")]
    assert feed.marts.health.read(spark).count() == 1
    built = feed.run()
    assert live(built.events, spark) == [("a", 2, "2026-03-16"), ("b", 3, "2026-03-17")]
    days = {str(r.event_date): r.event_count for r in built.health.read(spark).collect()}
    assert days == {"2026-03-16": 1, "2026-03-17": 1}


def test_redoing_a_batch_changes_nothing(spark, tmp_path):
    built = marts.EventMarts(str(tmp_path))
    changed = marts.newest_versions(staged(spark, [row for rows in BATCHES for row in rows]))
    for _ in range(2):
        built.process_batch(changed)
        assert live(built.events, spark) == [("a", 2, "2026-03-16"), ("b", 3, "2026-03-17")]
        assert built.health.read(spark).count() == 2


def test_untouched_dates_keep_their_files(spark, feed):
    feed.add(BATCHES[0] + [("c", "2026-01-01T00:00:00Z", 1, "d1", 1.0)])
    built = feed.run()
    old = [name for name in built.events.read(spark).inputFiles() if "=2026-01-01/" in name]
    feed.add(BATCHES[1])
    feed.run()
    assert old and set(old) <= set(built.events.read(spark).inputFiles())


def test_tables_belong_to_one_checkpoint(spark, feed):
    feed.add(BATCHES[0])
    feed.run()
    feed.checkpoint += "-new"
    with pytest.raises(ValueError, match="another checkpoint"):
        feed.run()


def test_device_status_follows_an_event_to_another_device(spark, feed):
    feed.add([("a", "2026-03-15T12:00:05Z", 1, "d1", 1.0)])
    feed.run()
    feed.add([("a", "2026-03-15T12:00:06Z", 2, "d2", 1.0)])
    built = feed.run()
    assert [r.device_id for r in built.device_status(spark).collect()] == ["d2"]
    assert [r.device_id for r in built.sensor_events.read(spark).collect()] == ["d2"]


def drain(feed):
    stream = feed.spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1)
    feed.marts.drain(stream.parquet(feed.drop), feed.checkpoint)


def test_batches_of_a_drain_rewrite_the_tables_seldom(spark, feed, monkeypatch):
    """Ten batches that all touch one date: the table is not written ten times."""
    for number in range(10):
        feed.add([(f"e{number}", f"2026-03-15T12:00:{number:02}Z", 1, "d1", 1.0)])
    feed.add([("e0", "2026-03-16T00:00:00Z", 2, "d1", 1.0)])
    written, process = [], marts.EventMarts.process_batch

    def counted(self, changed):
        written.append(changed.count())
        process(self, changed)

    with monkeypatch.context() as patch:
        patch.setattr(marts.EventMarts, "process_batch", counted)
        drain(feed)
    assert len(written) < 8 and sum(written) >= 10, written
    built = feed.marts
    days = {str(r.event_date): r.event_count for r in built.health.read(spark).collect()}
    assert days == {"2026-03-15": 9, "2026-03-16": 1}
    assert len(live(built.events, spark)) == 10


def test_waiting_batches_outlast_a_failure(spark, feed, monkeypatch):
    """Batches that wait when a drain fails get into the tables, newest versions only, and once
    more if they were not all removed."""
    for rows in BATCHES:
        feed.add(rows)
    kept = []

    def waits(self, changed, batch):
        changed.write.mode("overwrite").parquet(f"{self.waiting}/batch={batch}")
        kept.append(batch)

    def fails(self, spark):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(marts.EventMarts, "keep_batch", waits)
        patch.setattr(marts.EventMarts, "apply_waiting", fails)
        with pytest.raises(RuntimeError, match="lost"):
            drain(feed)
    assert len(kept) >= 3 and feed.marts.events.read(spark).isEmpty()
    last = f"batch={max(kept)}"
    spark.read.parquet(f"{feed.marts.waiting}/{last}").write.parquet(f"{feed.drop}-{last}")
    built = feed.run()
    expected = [("a", 2, "2026-03-16"), ("b", 3, "2026-03-17")]
    assert live(built.events, spark) == expected
    again = spark.read.schema(marts.CHANGED).parquet(f"{feed.drop}-{last}")
    again.write.parquet(f"{built.waiting}/{last}")
    drain(feed)
    assert live(built.events, spark) == expected
    assert not marts.exists(spark, built.waiting)


def test_empty_batches_and_tables(spark, feed):
    assert feed.marts.events.read(spark).count() == 0
    assert feed.run().events.read(spark).count() == 0
    feed.add(BATCHES[0])
    assert len(live(feed.run().events, spark)) == 2


def test_null_dates_are_replaced_like_any_other(spark, tmp_path):
    table = marts.DatedTable(str(tmp_path / "t"), "k STRING, event_date DATE")
    for key in ("a", "b"):
        table.replace(spark.createDataFrame([(key, None)], table.schema), [None])
    assert [tuple(r) for r in table.read(spark).collect()] == [("b", None)]


def test_incoming_files_to_marts_and_again(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    event = (
        '{{"emitter_event_id":"{}","emitted_at":"2026-03-1{}T10:00:00Z","emission_index":1,'
        '"emission_batch_started_at":"2026-03-15T00:00:00Z","device_id":"d","site_id":"s",'
        '"temperature_c":1.5}}'
    )
    (incoming / "1.txt").write_text(event.format("a", 5) + "\nbroken\n" + event.format("b", 5) + "\n")
    run = lambda: marts.stream_build(
        spark, str(incoming), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    )
    assert live(run().events, spark) == [("a", 1, "2026-03-15"), ("b", 1, "2026-03-15")]
    bad = spark.read.text(f"{tmp_path}/out/errors").collect()
    assert [(r.value, r.type) for r in bad] == [("broken", "malformed")]
    (incoming / "2.txt").write_text(event.format("a", 6) + "\n")
    assert live(run().events, spark) == [("a", 1, "2026-03-16"), ("b", 1, "2026-03-15")]
    assert live(run().events, spark) == [("a", 1, "2026-03-16"), ("b", 1, "2026-03-15")]
    delivered = list((tmp_path / "out" / "events").glob("year=*/month=*/day=*/*.txt.gz"))
    assert delivered


TEXTS = [
    '{"a": 1}', ' \t{"a": [{}]} ', "{}", '{"a": 1} x', "[1]", '"{"', "1", "null", "{", '{"a": 1',
    '{"a": 1, "a": 2}', '{"broken": {"a": 1}', "", " ", "x{}", None,
]


def test_deliverable_texts_are_those_that_parse_as_objects(spark):
    df = spark.createDataFrame([(text,) for text in TEXTS], "value STRING")
    written = F.coalesce(F.to_json(F.try_parse_json("value")).startswith("{"), F.lit(False))
    found = df.select("value", intake._is_deliverable().alias("now"), written.alias("told")).collect()
    assert [row.now for row in found] == [row.told for row in found]
    assert [row.value for row in found if row.now] == TEXTS[:4]
    plan = df.where(intake._is_deliverable())._jdf.queryExecution().analyzed().toString()
    assert "to_json(" not in plan


def test_repeats_in_later_batches_are_left_out_by_state_on_disk(spark, tmp_path):
    """The default store would copy all state for every batch."""
    drop, out, checkpoint = [str(tmp_path / name) for name in ("drop", "out", "checkpoint")]

    def deliver(texts):
        spark.createDataFrame([(t,) for t in texts], "value STRING").coalesce(1).write.mode(
            "append"
        ).text(drop)
        source = intake.text_event_source(spark, drop, 1)
        query = intake.deliver_events(
            source, out, checkpoint, {"availableNow": True}, repeats_within="2 hours"
        ).start()
        query.awaitTermination()
        return query.recentProgress

    deliver(['{"a": 1}', '{"a": 2}', '{"a": 1}', "broken"])
    progress = deliver(['{"a": 2}', '{"a": 3}', "broken", '{"a":2}'])
    found = [row.value for row in spark.read.text(out).collect()]
    assert sorted(found) == ['{"a": 1}', '{"a": 2}', '{"a": 3}', '{"a":2}']
    metrics = [op["customMetrics"] for batch in progress for op in batch["stateOperators"]]
    assert metrics and all("rocksdbGetCount" in one for one in metrics)
