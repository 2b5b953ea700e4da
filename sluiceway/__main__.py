"""Command line for the jobs: ``spark-submit`` or ``python -m sluiceway <job> ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from sluiceway import contracts
from sluiceway.operators.calendar import DIRECTIONS, RANGE_POLICIES, SELECTOR_MODES, SliceSelector
from sluiceway.operators.calendar import slice_calendar
from sluiceway.operators.layout import Layout, place
from sluiceway.functions.slices import ALIGNMENT_POLICIES, GRANULARITIES
from sluiceway.plans.backfill import RAW_READERS, backfill
from sluiceway.plans.build import WORKFLOWS, Workspace, build_models, publish_marts
from sluiceway.plans.incremental import added_rows
from sluiceway.plans.standardize import (
    STANDARDIZERS,
    StandardizeJob,
    standardize_manual,
    standardize_slices,
)
from sluiceway.sources.tables import read_manifests, read_stream_events
from sluiceway.streaming.marts import stream_build


def _selector_arguments(parser: argparse.ArgumentParser) -> None:
    group = parser.add_argument_group("slices")
    group.add_argument("--mode", choices=SELECTOR_MODES)
    group.add_argument("--pinned-at")
    group.add_argument("--range-start")
    group.add_argument("--range-end")
    group.add_argument("--relative-count", type=int)
    group.add_argument("--relative-direction", choices=DIRECTIONS)
    group.add_argument("--relative-anchor")
    group.add_argument("--alignment", choices=ALIGNMENT_POLICIES, default="floor")
    group.add_argument("--range-policy", choices=RANGE_POLICIES, default="overlap")


def _selector(arguments) -> SliceSelector:
    names = (
        "mode pinned_at range_start range_end relative_count relative_direction "
        "relative_anchor alignment range_policy"
    ).split()
    return SliceSelector(
        arguments.output_granularity, **{name: getattr(arguments, name) for name in names}
    )


def _job_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--standardizer", required=True, choices=sorted(STANDARDIZERS))
    parser.add_argument("--preset-id", required=True)
    parser.add_argument("--landing-root", required=True)
    parser.add_argument("--processed-root", required=True)
    parser.add_argument("--manifest-root", required=True)
    parser.add_argument("--landing-manifests", help="folder of landing manifests, if there are any")
    parser.add_argument("--landing-prefix")
    parser.add_argument("--landing-input-prefix", help="where all objects lie, whatever their slice")
    parser.add_argument("--landing-granularity", choices=GRANULARITIES, default="day")
    parser.add_argument("--output-granularity", choices=GRANULARITIES, default="day")
    parser.add_argument("--landing-fields", nargs="+")
    parser.add_argument("--processed-fields", nargs="+")
    parser.add_argument("--processed-prefix", default="raw")
    parser.add_argument("--processed-suffix", nargs="+", default=(), help="segments key=value")


def _job(arguments, workflow_name: str) -> StandardizeJob:
    return StandardizeJob(
        standardizer=arguments.standardizer,
        preset_id=arguments.preset_id,
        landing_root=arguments.landing_root,
        processed_root=arguments.processed_root,
        manifest_root=arguments.manifest_root,
        workflow_name=workflow_name,
        landing_granularity=arguments.landing_granularity,
        output_granularity=arguments.output_granularity,
        landing_prefix=arguments.landing_prefix,
        landing_input_prefix=arguments.landing_input_prefix,
        processed_suffix=tuple(arguments.processed_suffix),
        landing_fields=arguments.landing_fields
        or Layout(arguments.landing_granularity).fields,
        processed_prefix=arguments.processed_prefix,
        processed_fields=arguments.processed_fields
        or Layout(arguments.output_granularity).fields,
    )


def _manifests(
    spark: SparkSession, arguments, calendar: DataFrame | None = None
) -> DataFrame | None:
    if arguments.landing_manifests is None:
        return None
    return read_manifests(
        spark, arguments.landing_manifests, contracts.LANDING_MANIFEST, calendar
    )


def _build_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--surface-root", required=True)
    parser.add_argument("--run", choices=("run", "build", "test"), default="run")
    parser.add_argument("--select", nargs="+")
    parser.add_argument("--exclude", nargs="+")
    parser.add_argument(
        "--full-refresh", action="store_true", help="rebuild all dates, whatever was added"
    )


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sluiceway")
    jobs = top.add_subparsers(dest="job", required=True)

    standardize = jobs.add_parser("standardize", help="landed objects to bundles, by slice")
    manual = jobs.add_parser("standardize-manual", help="one prefix to one bundle")
    manual.add_argument("--input-prefix", required=True)
    manual.add_argument("--object-name")
    filled = jobs.add_parser("backfill", help="standardize slices, then rebuild the models")
    for sub in (standardize, manual, filled):
        sub.add_argument("workflow", choices=sorted(RAW_READERS))
        _job_arguments(sub)
    for sub in (standardize, filled):
        _selector_arguments(sub)

    build = jobs.add_parser("build", help="rebuild or check models")
    marts = jobs.add_parser("publish", help="rebuild the marts only")
    for sub in (build, marts):
        sub.add_argument("workflow", choices=sorted(WORKFLOWS))
        sub.add_argument("--processed-root", required=True)
    build.add_argument("--raw", help="raw table; default: raw or events below the processed root")
    build.add_argument(
        "--added-since", help="redo only the dates changed by rows that came after this stamp"
    )
    build.add_argument("--database", help="also keep the models as tables of this database")
    build.add_argument("--failures", help="folder for rows that fail a check")
    filled.add_argument(
        "--incremental", action="store_true", help="redo only the dates that new bundles change"
    )
    for sub in (build, filled):
        _build_arguments(sub)
    marts.add_argument("--surface-root", required=True)

    stream = jobs.add_parser("stream", help="deliver waiting events and update their marts")
    stream.add_argument("--incoming", required=True)
    stream.add_argument("--root", required=True)
    stream.add_argument("--checkpoint", required=True)
    return top


def _raw(spark: SparkSession, arguments) -> DataFrame:
    if arguments.workflow == "events":
        return read_stream_events(spark, arguments.raw or f"{arguments.processed_root}/events")
    root = arguments.raw or place(arguments.processed_root, "raw")
    return RAW_READERS[arguments.workflow](spark, root)


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> DataFrame | None:
    """Run one job; returns what it reports: bundles, or a quality report."""
    arguments = parser().parse_args(argv)
    if arguments.job == "stream":
        stream_build(spark, arguments.incoming, arguments.root, arguments.checkpoint)
        return None
    if arguments.job in ("build", "publish", "backfill"):
        workspace = Workspace(arguments.processed_root, arguments.surface_root)
    if arguments.job == "publish":
        publish_marts(spark, arguments.workflow, workspace)
        return None
    if arguments.job == "build":
        raw = None if arguments.run == "test" else _raw(spark, arguments)
        added = None
        if raw is not None and arguments.added_since:
            added = added_rows(raw, arguments.workflow, arguments.added_since)
        return build_models(
            spark,
            arguments.workflow,
            raw,
            workspace,
            mode=arguments.run,
            select=arguments.select,
            exclude=arguments.exclude,
            added=added,
            full_refresh=arguments.full_refresh,
            database=arguments.database,
            failures=arguments.failures,
        )
    job = _job(arguments, arguments.workflow)
    if arguments.job == "standardize-manual":
        manifests = _manifests(spark, arguments)
        return standardize_manual(
            spark,
            job,
            input_prefix=arguments.input_prefix,
            object_name=arguments.object_name,
            manifests=manifests,
        )
    selector = _selector(arguments)
    manifests = _manifests(spark, arguments, slice_calendar(spark, selector))
    if arguments.job == "standardize":
        return standardize_slices(
            spark,
            job,
            slice_calendar(spark, selector),
            selector_mode=selector.resolved_mode(),
            manifests=manifests,
        )
    return backfill(
        spark,
        arguments.workflow,
        job,
        selector,
        workspace,
        manifests=manifests,
        mode=arguments.run,
        select=arguments.select,
        exclude=arguments.exclude,
        incremental=arguments.incremental,
        full_refresh=arguments.full_refresh,
    )


def main() -> None:
    report = run(SparkSession.builder.appName("sluiceway").getOrCreate())
    if report is not None:
        report.show(100, truncate=False)


if __name__ == "__main__":
    main()
