import random

from hypothesis import given, settings, strategies as st

from sluiceway import contracts
from sluiceway.operators import bundles
from sluiceway.operators.latest import latest_by
from sluiceway.session import materialize

NAMES = [name for name in contracts.names(contracts.BUNDLE_LINEAGE)]
SCHEMA = f"{contracts.BUNDLE_LINEAGE}, delivery_date STRING"


def row(bundle, standardized, logical="2026-03-12T00:00:00+00:00", grain="day", key=None, count=10, date=None):
    return (
        bundle,
        key or f"raw/{bundle}.parquet",
        f"raw/_{bundle}",
        standardized,
        logical,
        grain,
        1,
        count,
        date,
    )


def winners(spark, data, row_date=None):
    raw = spark.createDataFrame(data, SCHEMA)
    return {r.raw_bundle_id: r for r in bundles.canonical_bundles(raw, row_date).collect()}


def test_newest_bundle_of_a_slice_wins(spark):
    data = [row("a", "2026-03-13T01:00:00Z"), row("b", "2026-03-13T02:00:00Z")] * 3
    assert set(winners(spark, data)) == {"b"}


def test_equal_stamps_fall_to_the_higher_id_and_bad_stamps_come_last(spark):
    data = [row("a", "2026-03-13T01:00:00Z"), row("b", "2026-03-13T01:00:00Z"), row("c", "bad")]
    assert set(winners(spark, data)) == {"b"}


def test_granularities_do_not_compete(spark):
    data = [row("a", "2026-03-13T01:00:00Z"), row("b", "2026-03-14T01:00:00Z", grain="month")]
    assert set(winners(spark, data)) == {"a", "b"}


def test_manual_bundles_are_their_own_winners(spark):
    data = [row(i, "2026-03-13T01:00:00Z", logical=None, grain="manual") for i in ("m1", "m2")]
    found = winners(spark, data)
    assert set(found) == {"m1", "m2"}
    assert str(found["m1"].bundle_event_date) == "2026-03-13"


def test_a_bundle_spanning_two_dates_counts_twice(spark):
    data = [row("a", "2026-03-13T01:00:00Z", date=d) for d in ("2026-03-11", "2026-03-12", "2026-03")]
    found = winners(spark, data, "delivery_date")["a"]
    # The partial date falls back to the bundle's own date, which is one of the two.
    assert (found.raw_bundle_row_count, found.raw_bundle_file_count) == (20, 2)
    assert str(found.bundle_event_date) == "2026-03-12"


def test_files_of_a_bundle_add_up(spark):
    data = [row("a", "2026-03-13T01:00:00Z", key=f"raw/{i}", count=i) for i in (3, 4)] * 2
    found = winners(spark, data)["a"]
    assert (found.raw_bundle_row_count, found.raw_bundle_file_count) == (7, 2)


def test_keep_canonical_rows_keeps_columns_and_multiplicity(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None)], "n INT, raw_bundle_id STRING")
    ids = materialize(spark.createDataFrame([("a",), ("c",)], "raw_bundle_id STRING"), "ids")
    kept = bundles.keep_canonical_rows(rows, ids)
    assert kept.columns == ["n", "raw_bundle_id"]
    assert [tuple(r) for r in kept.collect()] == [(1, "a"), (1, "a")]


def test_small_written_bundles_are_broadcast_and_large_ones_are_not(spark):
    rows = spark.range(1000).selectExpr("id", "cast(id as string) as raw_bundle_id")
    ids = materialize(rows.select("raw_bundle_id"), "ids")
    plan = bundles.keep_canonical_rows(rows, ids)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1KB")
    try:
        plan = bundles.keep_canonical_rows(rows, ids)._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" not in plan


def test_latest_by_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = latest_by(df, ["k"], ["v"])._jdf.queryExecution().toString()
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("Exchange hashpartitioning") < partial


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.none() | st.integers(0, 5)), min_size=1, max_size=60))
def test_latest_by_against_brute_force(spark, pairs):
    data = [(k, v, i) for i, (k, v) in enumerate(pairs)]
    expected = {}
    for k, v, i in data:
        rank = (v is not None, v or 0, i)
        if k not in expected or rank > expected[k][0]:
            expected[k] = (rank, (k, v, i))
    random.shuffle(data)
    df = spark.createDataFrame(data, "k INT, v INT, i INT").repartition(3)
    found = {r.k: tuple(r) for r in latest_by(df, ["k"], ["v"], ["i"]).collect()}
    assert found == {k: r for k, (_, r) in expected.items()}


def test_one_key_with_most_rows(spark):
    df = spark.range(200_000, numPartitions=8).selectExpr(
        "case when id % 3 > 0 then 0 else id end as k", "hash(id) as v", "id as i"
    )
    found = latest_by(df, ["k"], ["v"], ["i"])
    assert found.count() == df.select("k").distinct().count()
    top = df.where("k = 0").orderBy("v", "i", ascending=False).first()
    assert found.where("k = 0").first().i == top.i
