import json
from pathlib import Path

import pytest

from sluiceway.__main__ import run

ROW = {"amount": 30.0, "channel": "online", "card_region": "r", "merchant_category": "c"}


def land(root, day, rows):
    path = Path(root, f"client=a/year=2026/month=03/day={day}/hour=01/run_id=x.json")
    path.parent.mkdir(parents=True)
    path.write_text(json.dumps({"row_count": len(rows), "rows": rows}))


@pytest.fixture
def paths(tmp_path):
    for day, declined in (("01", 1), ("02", 0)):
        land(
            tmp_path / "landing",
            day,
            [{**ROW, "__row_index": i, "is_declined": declined, "__is_anomaly": i == 0} for i in range(3)],
        )
    return [
        *("transactions", "--standardizer", "json_bundle", "--preset-id", "p"),
        *("--landing-root", f"{tmp_path}/landing", "--landing-prefix", "client=a"),
        *("--landing-granularity", "hour", "--manifest-root", f"{tmp_path}/manifests"),
        *("--processed-root", f"{tmp_path}/processed"),
    ]


def test_backfill_from_landed_files_to_summary(spark, tmp_path, paths):
    report = run(
        spark,
        [
            *("backfill", *paths, "--surface-root", f"{tmp_path}/surface", "--run", "build"),
            *("--range-start", "2026-03-01T00:00:00Z", "--range-end", "2026-03-02T23:59:59Z"),
        ],
    )
    assert all(row.failures == 0 for row in report.collect())
    summary = spark.read.parquet(f"{tmp_path}/surface/management/management_daily_summary")
    found = [tuple(r) for r in summary.orderBy("event_date").collect()]
    assert [(r[0], r[1], r[3], r[5], str(r[7])) for r in found] == [
        (3, 90.0, 3, 1, "2026-03-01"),
        (3, 90.0, 0, 1, "2026-03-02"),
    ]
    # A rerun adds bundles, and the tables stay the same.
    run(spark, ["standardize", *paths, "--pinned-at", "2026-03-01"])
    run(
        spark,
        [
            *("build", "transactions", "--processed-root", f"{tmp_path}/processed"),
            *("--surface-root", f"{tmp_path}/surface"),
        ],
    )
    again = spark.read.parquet(f"{tmp_path}/surface/management/management_daily_summary")
    assert [tuple(r) for r in again.orderBy("event_date").collect()] == found


def test_unknown_choices_are_refused(spark, capsys):
    with pytest.raises(SystemExit):
        run(spark, ["build", "nothing", "--processed-root", "x", "--surface-root", "y"])
    assert "invalid choice" in capsys.readouterr().err
