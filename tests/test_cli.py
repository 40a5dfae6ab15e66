import time

from helpers import T0, message_frame
from pyspark.sql import functions as F

from tideline import __main__ as cli
from tideline.model import LATE_MESSAGE, clean_schema
from tideline.operators.observe import read_metrics
from tideline.sources.partitions import scan_table


def test_jobs_from_the_command_line(spark, folder, caplog):
    caplog.set_level("INFO", logger="tideline.progress")
    rows = [("1", "a", 0, 0), ("1", "b", 5, 5), ("1", "bad", None, 5), ("2", "t", 500, 500)]
    message_frame(spark, rows).write.parquet(f"{folder}/in")
    raw, clean = f"{folder}/raw", f"{folder}/clean"
    cli.main([
        "sessions", "--input-path", f"{folder}/in", "--output-destination", raw,
        "--output-notices", f"{folder}/notices", "--checkpoint", f"{folder}/c1",
        "--quarantine", f"{folder}/bad", "--until-done",
    ])
    assert spark.read.parquet(f"{folder}/bad").count() == 1
    cli.main(["dedupe", "--input-root", raw, "--output-root", clean, "--event-time-second", str(T0 + 3)])
    assert [r.sessionId for r in scan_table(spark, clean, clean_schema()).collect()] == ["1"]
    cli.main([
        "dedupe-on-notice", "--notices", f"{folder}/notices", "--input-root", raw,
        "--output-root", f"{folder}/clean2", "--checkpoint", f"{folder}/c2", "--until-done",
    ])
    assert scan_table(spark, f"{folder}/clean2", clean_schema()).count() == 1
    wait_for = time.monotonic() + 20
    while "'on_time': 1" not in caplog.text and time.monotonic() < wait_for:
        time.sleep(0.2)
    assert "session-revisions batch 0 messages {'rows': 4, 'rejected': 1" in caplog.text
    assert "'on_time': 1" in caplog.text


def test_late_messages_metrics_and_reconcile_from_the_command_line(spark, folder):
    clean, late, metrics = f"{folder}/clean", f"{folder}/late", f"{folder}/metrics"

    def run(*rows):
        message_frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        cli.main([
            "sessions", "--input-path", f"{folder}/in", "--output-destination", f"{folder}/raw",
            "--output-notices", f"{folder}/notices", "--checkpoint", f"{folder}/c1", "--until-done",
            "--allowed-lateness", "1000", "--pane-delay", "30", "--late-messages", late, "--metrics", metrics,
        ])

    run(("1", "a", 0, 0), ("1", "a", 100, 100), ("2", "t", 500, 500))
    # Joins two sessions that are out; the pane waits for the clock to pass 530.
    run(("1", "b", 50, 500))
    run(("2", "t", 1_200, 1_200))
    run(("1", "c", 10, 1_200))
    assert [(r.session_id, r.message_name, r.event_sec - T0) for r in spark.read.schema(LATE_MESSAGE).parquet(late).collect()] == [("1", "c", 10)]
    wait_for = time.monotonic() + 20
    while time.monotonic() < wait_for:
        spark.catalog.refreshByPath(metrics)
        rows = read_metrics(spark, metrics).where("metric in ('on_time', 'late', 'rows', 'dropped_messages')")
        totals = {r.metric: r.total for r in rows.groupBy("metric").agg(F.sum("value").alias("total")).collect()}
        if totals.get("dropped_messages") == 1:
            break
        time.sleep(0.2)
    assert totals == {"rows": 6, "on_time": 3, "late": 1, "dropped_messages": 1}

    cli.main([
        "dedupe-on-notice", "--notices", f"{folder}/notices", "--input-root", f"{folder}/raw",
        "--output-root", clean, "--checkpoint", f"{folder}/c2", "--until-done",
    ])
    starts = lambda: sorted((r.sessionId, r.session_start - T0) for r in scan_table(spark, clean, clean_schema()).collect())
    assert starts() == [("1", 0), ("1", 100), ("2", 500)]
    cli.main(["reconcile", "--clean-root", clean, "--event-time-second", str(T0)])
    spark.catalog.refreshByPath(clean)
    assert starts() == [("1", 0), ("2", 500)]
