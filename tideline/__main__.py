"""Command line of the jobs, for spark-submit or `python -m tideline`.

    sessions          messages -> raw session revisions and availability notices (streaming)
    dedupe            latest revision per session for the given event minutes (batch)
    dedupe-on-notice  the same, driven by notices (streaming)
    reconcile         clean rows that a newer revision made obsolete, around the given event minutes (batch)
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tideline.model import ALLOWED_LATENESS_SECONDS, GAP_SECONDS, GRAINS, MAX_SKEW_SECONDS
from tideline.operators.observe import MetricsTable, ProgressLog
from tideline.plans.dedupe_job import dedupe
from tideline.plans.notice_job import run_dedupe_on_notice
from tideline.plans.pipeline import UNTIL_DONE, run_pipeline, run_quarantine
from tideline.plans.reconcile_job import reconcile_days
from tideline.session import build_session
from tideline.sources.messages import stream_messages, stream_payloads
from tideline.sources.partitions import seconds_frame
from tideline.sources.protobuf import decode_messages


# Folders that a listener of this process writes figures to; it goes on listening between jobs.
LISTENING: set[str] = set()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tideline")
    top.add_argument("--grain", choices=GRAINS, default="minute", help="finest directory level")
    jobs = top.add_subparsers(dest="job", required=True)

    sessions = jobs.add_parser("sessions")
    source = sessions.add_mutually_exclusive_group(required=True)
    source.add_argument("--input-path", help="folder of message files")
    source.add_argument("--kafka-topic", help="topic of protobuf messages")
    sessions.add_argument("--input-format", default="parquet")
    sessions.add_argument("--max-bytes-per-batch", type=int, help="size limit of a micro-batch")
    sessions.add_argument("--kafka-servers")
    sessions.add_argument("--output-destination", required=True, help="raw dataset")
    sessions.add_argument("--output-notices", required=True, help="folder for notices")
    sessions.add_argument("--quarantine", help="folder for rejected messages")
    sessions.add_argument("--gap", type=int, default=GAP_SECONDS)
    sessions.add_argument("--allowed-lateness", type=int, default=ALLOWED_LATENESS_SECONDS)
    sessions.add_argument("--max-skew", type=int, default=MAX_SKEW_SECONDS)
    sessions.add_argument("--clock", choices=("arrival", "event"), default="arrival")
    sessions.add_argument("--early", action="store_true", help="also emit open sessions")
    sessions.add_argument(
        "--pane-delay", type=int, default=0,
        help="seconds that early and late panes gather changes; without it, each micro-batch tells of its changes")
    sessions.add_argument("--late-messages", help="folder for messages too late for their session")
    sessions.add_argument("--metrics", help="folder for the figures of each micro-batch")

    batch = jobs.add_parser("dedupe")
    batch.add_argument("--event-time-second", type=int, action="append", required=True)
    on_notice = jobs.add_parser("dedupe-on-notice")
    on_notice.add_argument("--notices", required=True)
    reconciled = jobs.add_parser("reconcile")
    reconciled.add_argument("--event-time-second", type=int, action="append", required=True)
    reconciled.add_argument("--clean-root", required=True, help="clean dataset, rewritten in place")
    reconciled.add_argument("--gap", type=int, default=GAP_SECONDS)
    reconciled.add_argument("--span-days", type=int, default=1, help="length of the longest session")
    for job in (batch, on_notice):
        job.add_argument("--input-root", required=True, help="raw dataset")
        job.add_argument("--output-root", required=True, help="clean dataset")
    for job in (sessions, on_notice):
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--until-done", action="store_true", help="stop when the input is used up")
    return top


def _run_sessions(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.kafka_topic:
        payloads = stream_payloads(
            spark, **{"kafka.bootstrap.servers": args.kafka_servers, "subscribe": args.kafka_topic}
        )
        # Undecodable payloads have no event time, so the guard sets them aside.
        arrived = decode_messages(payloads)
        messages = arrived.drop("error", "payload")
    else:
        arrived = messages = stream_messages(
            spark, args.input_path, args.input_format, args.max_bytes_per_batch
        )
    trigger = UNTIL_DONE if args.until_done else None
    queries = [run_pipeline(
        messages, args.output_destination, args.output_notices, f"{args.checkpoint}/sessions",
        trigger, args.grain, args.late_messages, gap=args.gap, lateness=args.allowed_lateness, max_skew=args.max_skew,
        clock=args.clock, early=args.early, pane_delay=args.pane_delay,
    )]
    if args.quarantine:
        queries.append(run_quarantine(
            arrived, args.quarantine, f"{args.checkpoint}/quarantine", trigger, args.max_skew
        ))
    for query in queries:
        query.awaitTermination()


def main(argv: list[str] | None = None) -> SparkSession:
    args = parser().parse_args(argv)
    spark = build_session(f"tideline-{args.job}")
    spark.streams.addListener(ProgressLog())
    if args.job == "sessions":
        if args.metrics and args.metrics not in LISTENING:
            LISTENING.add(args.metrics)
            spark.streams.addListener(MetricsTable(spark, args.metrics))
        _run_sessions(spark, args)
    elif args.job == "dedupe":
        dedupe(spark, args.input_root, args.event_time_second, args.output_root, args.grain)
    elif args.job == "reconcile":
        minutes = seconds_frame(spark, args.event_time_second)
        reconcile_days(spark, args.clean_root, minutes, args.grain, args.gap, args.span_days)
    else:
        run_dedupe_on_notice(
            spark, args.notices, args.input_root, args.output_root, args.checkpoint,
            UNTIL_DONE if args.until_done else None, args.grain,
        ).awaitTermination()
    return spark


if __name__ == "__main__":
    # Stopping the session delivers the last progress events while Python still listens.
    main().stop()
