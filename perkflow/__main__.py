"""Command line: `python -m perkflow <job> ...`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from perkflow.operators.versions import current_activities
from perkflow.plans import analysis, commuting, dashboard, live, loading
from perkflow.session import build_session
from perkflow.sources.messages import file_messages, kafka_messages
from perkflow.sources.relational import EMPLOYEE_TYPES, append_relational
from perkflow.sources.scratch import drop_scratch
from perkflow.sources.tables import read_if_filled
from perkflow.sources.tabular import read_tabular, write_csv
from perkflow.streaming.reports import arrivals, on_new_data


def _messages(spark: SparkSession, args: argparse.Namespace, place: str):
    if args.servers:
        return kafka_messages(spark, args.servers, place)
    return file_messages(spark, place)


def _live(spark: SparkSession, args: argparse.Namespace) -> None:
    queries = live.start_live(
        _messages(spark, args, args.activities),
        _messages(spark, args, args.employees),
        args.root,
        args.interval,
        lambda batch_id, figures: print(f"batch {batch_id}: {figures}"),
    )
    if args.interval:
        spark.streams.awaitAnyTermination()
    for query in queries:
        query.awaitTermination()


def _employees(spark: SparkSession, args: argparse.Namespace, all_versions: bool = False):
    table = read_if_filled(spark, args.employees, args.merge_schema)
    return table if table is None or all_versions else live.current_employees(table)


def _activities(spark: SparkSession, args: argparse.Namespace):
    table = read_if_filled(spark, args.activities)
    return None if table is None else current_activities(table)


def _analyse(spark: SparkSession, args: argparse.Namespace) -> None:
    activities = _activities(spark, args)
    tables = {}
    if activities is not None:
        people = loading.read_people(spark, args.hr)
        declared = read_tabular(spark, args.declared, infer=False)
        tables |= analysis.activity_analysis(people, declared, activities)
    employees = _employees(spark, args, args.all_versions)
    if employees is not None:
        tables |= analysis.employee_analysis(employees)
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{args.out}/{name}")
        print(name)
        spark.read.parquet(f"{args.out}/{name}").show(args.rows, truncate=False)


def _commute(spark: SparkSession, args: argparse.Namespace) -> None:
    measured = spark.read.parquet(args.distances) if args.distances else None
    names = spark.read.parquet(args.places) if args.places else None
    checked = commuting.validated_commutes(loading.read_people(spark, args.hr), args.company, measured, names)
    commuting.export_commutes(checked, args.out).show(truncate=False)


def _export(spark: SparkSession, args: argparse.Namespace) -> None:
    _export_once(spark, args)
    if not args.interval:
        return
    on_new_data(
        arrivals(spark, args.activities, args.employees),
        lambda batch_id: _export_once(spark, args),
        args.checkpoint or f"{args.out.rstrip('/')}.checkpoint",
        args.interval,
    ).awaitTermination()


def _export_once(spark: SparkSession, args: argparse.Namespace) -> None:
    done = dashboard.export_dashboard(
        args.out,
        _activities(spark, args),
        _employees(spark, args),
        {kind: getattr(args, f"{kind}_name") for kind in dashboard.NAMES},
    )
    for kind, rows in done.items():
        print(kind, f"{rows} rows" if rows else "nothing to write")


def _clean(spark: SparkSession, args: argparse.Namespace) -> None:
    hr = loading.numbers_as_text(loading.clean_hr_file(spark, args.hr))
    write_csv(hr, f"{args.out}/hr", args.sep)
    write_csv(loading.clean_practice_file(spark, args.declared), f"{args.out}/declared", args.sep)


def _load(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = loading.employee_rows(loading.clean_hr_file(spark, args.hr, args.sep))
    append_relational(rows, args.url, "employee_prime", EMPLOYEE_TYPES)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="perkflow")
    jobs = top.add_subparsers(required=True)

    def job(name, run, **options):
        sub = jobs.add_parser(name)
        for option, settings in options.items():
            sub.add_argument("--" + option.replace("_", "-"), **settings)
        sub.set_defaults(run=run)

    need, may, flag = {"required": True}, {"default": None}, {"action": "store_true"}
    job("live", _live, activities=need, employees=need, root=need, servers=may, interval=may)
    job(
        "analyse", _analyse, hr=need, declared=need, activities=need, employees=need,
        out=need, all_versions=flag, merge_schema=flag, rows={"type": int, "default": 20},
    )
    job("commute", _commute, hr=need, company=need, out=need, distances=may, places=may)
    job(
        "export", _export, activities=need, employees=need, out=need,
        interval=may, checkpoint=may, merge_schema=flag,
        **{f"{kind}_name": {"default": name} for kind, name in dashboard.NAMES.items()},
    )
    job("clean", _clean, hr=need, declared=need, out=need, sep={"default": ","})
    job("load", _load, hr=need, url=need, sep={"default": ","})
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session()
    try:
        args.run(spark, args)
    finally:
        drop_scratch(spark)


if __name__ == "__main__":
    main()
