"""Jobs for spark-submit: ``python -m txn_risk.jobs <job> --help``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from txn_risk.plans import monitoring, profiling, training, warehouse
from txn_risk.session import build_session
from txn_risk.sources import csv_files, lake, models, score_store, topic
from txn_risk.streaming import pipelines, run_summary

Args = argparse.Namespace


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _messages(spark: SparkSession, a: Args, starting: str):
    messages = topic.read_topic(spark, a.servers, a.topic, starting, max_per_trigger=a.max_per_batch)
    return topic.decode(messages)


def replay(spark: SparkSession, a: Args) -> None:
    """Send transactions of CSV files to the topic, in time order per card."""
    rows = training.time_prefix(csv_files.read_transactions(spark, *a.csv), a.limit)
    topic.write_topic(rows, a.servers, a.topic)


def ingest(spark: SparkSession, a: Args) -> None:
    """Topic to lake, until stopped or a total of messages; what is no record goes to the rejects."""
    pipelines.stop_after(pipelines.ingest_to_lake(
        _messages(spark, a, "earliest"), a.lake, a.checkpoint, a.interval, a.rejects, a.max_messages
    ), a.max_messages)


def load(spark: SparkSession, a: Args) -> None:
    """Lake to raw table."""
    ledger = f"{a.raw}_loaded_files" if a.new_files else None
    print(lake.load(spark, a.lake, a.raw, _now(), a.modified_after, a.skip_unreadable, ledger))


def build(spark: SparkSession, a: Args) -> None:
    """Raw table to staging and marts, then the data tests."""
    if a.new_loads:
        warehouse.refresh(spark, a.raw, a.warehouse)
    else:
        warehouse.build(lake.read_raw(spark, a.raw), a.warehouse)
    report = warehouse.check(spark, a.warehouse)
    report.show(50, truncate=False)
    if report.where("failures > 0").count():
        raise SystemExit("data tests failed")


def export(spark: SparkSession, a: Args) -> None:
    """CSV files to the star schema as CSV."""
    csv_files.export_star(csv_files.read_transactions(spark, *a.csv), a.out)


def profile(spark: SparkSession, a: Args) -> None:
    """Print the data profile of CSV files."""
    rows = csv_files.read_transactions(spark, *a.csv)
    for table in (
        profiling.null_profile(rows), profiling.time_span(rows), profiling.class_balance(rows),
        profiling.distinct_entities(rows), profiling.amount_summary(rows),
        profiling.category_rates(rows), profiling.distance_summary(rows),
        profiling.top_states(rows), profiling.state_extremes(rows),
    ):
        table.show(50, truncate=False)


def train(spark: SparkSession, a: Args) -> None:
    """Train, evaluate on the later file, and save if the promotion gate opens."""
    trained = training.train(
        csv_files.read_transactions(spark, a.train), csv_files.read_transactions(spark, a.test),
        a.sample,
    )
    print(models.report(trained.card.first()))
    champion = models.read_card(spark, a.champion) if a.champion else None
    if not training.promotion_gate(trained.card, champion=champion):
        raise SystemExit("below the promotion gate, not saved")
    models.save_trained(trained, a.out)


def score(spark: SparkSession, a: Args) -> None:
    """Topic to score log, until stopped or a total of messages."""
    model, baseline, threshold = models.load_model(spark, a.model)
    # What is no record cannot be scored; the lake's job keeps it.
    records = pipelines.scored_stream(
        topic.well_formed(_messages(spark, a, "latest")), model, baseline, threshold
    )
    summary = run_summary.RunSummary()
    spark.streams.addListener(summary)
    query = pipelines.write_scores(run_summary.observed(records), a.scores, a.checkpoint, a.interval)
    pipelines.stop_after(query, a.max_messages)
    done = summary.totals(query)
    print(
        f"processed {done.processed}, flagged {done.flagged} ({done.flagged_pct:.2f} %), "
        f"latency {done.avg_latency_ms:.1f} ms, {done.rows_per_second:.0f} rows a second"
    )


def compact(spark: SparkSession, a: Args) -> None:
    """What the score log has got since the last time into the keyed score table."""
    print(score_store.compact(spark, a.scores, a.table))


def scores(spark: SparkSession, a: Args) -> None:
    """Print live figures and the newest scores of the log and the table."""
    rows = score_store.read_stores(
        [score_store.newest_of_log(spark, a.scores, a.rows), score_store.read_compacted(spark, a.table)], a.rows
    )
    monitoring.live_kpis(rows).show(truncate=False)
    monitoring.display_table(rows).show(a.rows, truncate=False)


def merge(spark: SparkSession, a: Args) -> None:
    """Bring the small files of each closed hour of the lake together."""
    ledger = f"{a.raw}_loaded_files" if a.raw else None
    print(lake.merge_hours(spark, a.lake, _now() - dt.timedelta(hours=a.hours), ledger))


def retain(spark: SparkSession, a: Args) -> None:
    """Delete lake files past their days; only counts them without --delete."""
    print(lake.remove_expired(spark, a.lake, _now(), a.days, dry_run=not a.delete))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="txn_risk.jobs")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(run, **options: dict) -> None:
        one = jobs.add_parser(run.__name__, help=run.__doc__)
        one.set_defaults(run=run)
        for name, option in options.items():
            one.add_argument(f"--{name.replace('_', '-')}", **option)

    need = {"required": True}
    files = {"required": True, "nargs": "+"}
    broker = {
        "servers": {"default": "localhost:9092"}, "topic": need,
    }
    stream = {
        **broker, "checkpoint": need, "interval": {"default": pipelines.FLUSH_INTERVAL},
        "max_messages": {"type": int, "help": "stop after so many"},
        "max_per_batch": {"type": int, "help": "bound of one micro-batch, not of the rate"},
    }
    time = {"type": dt.datetime.fromisoformat}
    job(replay, csv=files, limit={"type": int}, **broker)
    job(ingest, lake=need, rejects=need, **stream)
    job(load, lake=need, raw=need, modified_after=time, skip_unreadable={"action": "store_true"},
        new_files={"action": "store_true", "help": "only files that no such load has taken"})
    job(build, raw=need, warehouse=need,
        new_loads={"action": "store_true", "help": "stage only loads that no such build has staged"})
    job(export, csv=files, out=need)
    job(profile, csv=files)
    job(train, train=need, test=need, out=need, champion={}, sample={"type": int, "default": 150_000})
    job(score, model=need, scores=need, **stream)
    job(compact, scores=need, table=need)
    job(scores, scores=need, table=need, rows={"type": int, "default": 500})
    job(merge, lake=need, raw={"help": "raw table whose load by --new-files must have taken them"},
        hours={"type": int, "default": 1, "help": "since an hour ended"})
    job(retain, lake=need, days={"type": int, "default": 7}, delete={"action": "store_true"})
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(f"txn-risk-{args.job}"), args)


if __name__ == "__main__":
    main()
