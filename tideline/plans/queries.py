"""The registered queries: each runs one part of the engine over the whole input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tideline.functions.codec import counts_json, envelope, notice_json
from tideline.functions.event_time import epoch_seconds_ntz, instant, minute_of
from tideline.functions.partition_path import legacy_partition_path, partition_path, path_to_second, receipt_path
from tideline.model import LATE_MESSAGE, clean_schema, raw_schema
from tideline.operators.dedupe import latest_revision
from tideline.operators.guards import over_late, quarantined
from tideline.operators.observe import read_metrics
from tideline.operators.reconcile import reconcile
from tideline.operators.sessions import session_message_counts, session_metrics, sessions_per_minute
from tideline.plans.dedupe_job import dedupe, deduplicated
from tideline.plans.reconcile_job import reconcile_days
from tideline.plans.replay import replay_final, replay_revisions, replay_rows, replay_stream
from tideline.session import shared_dir
from tideline.sinks.clean import write_clean
from tideline.sinks.notices import notice_lines
from tideline.sinks.raw import clustered, touched_minutes, write_revisions
from tideline.sources.messages import normalise
from tideline.sources.notices import decode_notices
from tideline.sources.partitions import register_view, scan_table
from tideline.sources.protobuf import decode_messages, encode_messages
from tideline.streaming.minutes import MINUTE_TOTALS, minute_totals
from tideline.streaming.native import native_final_sessions
from tideline.streaming.revisions import final_sessions, with_receipt_time

# Most users of the test tables act hours apart; this gap gives sessions of several messages.
WIDE_GAP = 21_600
ORDER_GAP = 30 * 86_400
# Longer than the time that all orders span.
LIFE_GAP = 10_000 * 86_400
# An order comes in late when it is dearer than this.
DEAR = 450_000
# A message counts as delivered late when its value exceeds this.
LATE_VALUE = 100
DAYS = 86_400


def messages(spark: SparkSession, sf_dir: str, delay_per_value: int = 0) -> DataFrame:
    """`events` as messages; arrival is the event time plus a delay that grows with `value`."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    delay = F.floor(F.col("value") * delay_per_value)
    arrival = instant(epoch_seconds_ntz(F.col("ts")) + delay)
    return normalise(events, "user_id", "event_type", "ts", "props", arrival)


def two_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as messages of two waves: the late deliveries form the second."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    late = F.col("value") > LATE_VALUE
    stamped = events.withColumn("wave", F.when(late, 2).otherwise(1))
    seconds = epoch_seconds_ntz(F.col("ts"))
    arrival = instant(seconds + F.when(late, 31 * DAYS).otherwise(0))
    return normalise(stamped, "user_id", "event_type", "ts", "props", arrival, keep=["wave"])


def arrival_thirds(rows: DataFrame) -> DataFrame:
    """Cut the arrival range into three equal waves."""
    arrival = F.unix_seconds("arrival")
    low, high = rows.agg(F.min(arrival), F.max(arrival)).first()
    if low is None:
        return rows.withColumn("wave", F.lit(1))
    third = (high - low) // 3 + 1
    return rows.withColumn("wave", (F.floor((arrival - low) / third) + 1).cast("int"))


def as_text(sessions: DataFrame, *extra: str) -> DataFrame:
    """Session rows with the count map as key-ordered JSON, which compares by value."""
    return sessions.select(
        "sessionId", "session_start", "sessionLengthSeconds",
        counts_json(F.col("messageCount")).alias("messageCount"), *extra,
    )


def q_session_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(session_metrics(messages(spark, sf_dir), WIDE_GAP))


def q_session_metrics_60s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(session_metrics(messages(spark, sf_dir)))


def q_session_message_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = session_message_counts(messages(spark, sf_dir), WIDE_GAP)
    return counts.select("sessionId", "session_start", "message_name", "n")


def q_order_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = normalise(orders, "o_custkey", "o_orderpriority", "o_orderdate")
    return as_text(session_metrics(rows, ORDER_GAP))


def q_sessions_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions_per_minute(session_metrics(messages(spark, sf_dir), WIDE_GAP))


def q_partition_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = messages(spark, sf_dir).select(minute_of(F.col("event_sec")).alias("minute_second")).distinct()
    second = F.col("minute_second")
    paths = minutes.select(
        "minute_second",
        partition_path(second).alias("path"),
        legacy_partition_path(second).alias("legacy_path"),
        receipt_path(second, second * 1_000).alias("raw_path"),
    )
    return paths.select(
        "*",
        path_to_second(F.col("path")).alias("path_second"),
        path_to_second(F.col("legacy_path")).alias("legacy_path_second"),
    )


def _revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_revisions(two_waves(spark, sf_dir), WIDE_GAP)


def q_raw_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(_revisions(spark, sf_dir), "rt")


def _deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    revisions = _revisions(spark, sf_dir)
    return latest_revision(revisions.withColumn("minute", minute_of(F.col("session_start"))))


def q_dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(_deduplicated(spark, sf_dir), "rt")


def q_dedupe_sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_view(_revisions(spark, sf_dir), "session_revisions")
    latest = spark.sql("""
        select * from (
            select *, row_number() over (
                partition by sessionId, session_start div 60 order by rt desc) as row_number
            from session_revisions)
        where row_number = 1
    """)
    return as_text(latest.drop("row_number"), "rt")


def q_dedupe_job(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    base = shared_dir(spark, "dedupe-job")
    revisions = _revisions(spark, sf_dir).withColumn("pane", F.lit("on_time")).persist()
    write_revisions(revisions, f"{base}/raw", grain)
    revisions.unpersist()
    raw = scan_table(spark, f"{base}/raw", raw_schema(grain))
    dedupe(spark, f"{base}/raw", touched_minutes(raw), f"{base}/clean", grain)
    return as_text(scan_table(spark, f"{base}/clean", clean_schema(grain)), "rt")


def q_dedupe_job_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job in the layout of one directory for each event minute."""
    return q_dedupe_job(spark, sf_dir, "minute")


def q_reconciled_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(reconcile(_deduplicated(spark, sf_dir), WIDE_GAP))


def q_reconciled_foreign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that no run of ours wrote: `orders` as spans of their customer, ranked by a mix of key and price.

    Spans overlap in every way: newer rows that do not cover older ones, chains of them, equal ranks.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    spans = orders.select(
        F.col("o_custkey").cast("string").alias("sessionId"),
        (F.col("o_orderkey") * 7_919 % 90 * DAYS).cast("int").alias("sessionLengthSeconds"),
        F.create_map("o_orderpriority", F.lit(1).cast("bigint")).alias("messageCount"),
        epoch_seconds_ntz(F.col("o_orderdate")).alias("session_start"),
        (cents % 1_000).alias("rt"),
    )
    return as_text(reconcile(spans, ORDER_GAP), "rt")


def q_reconcile_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean dataset of two waves, rewritten where the second wave touched it."""
    root = shared_dir(spark, "reconcile-job")
    revisions = _revisions(spark, sf_dir).withColumn("minute", minute_of(F.col("session_start"))).persist()
    write_clean(clustered(deduplicated(revisions), "day"), root, "day")
    reconcile_days(spark, root, touched_minutes(revisions.where("rt = 2")), "day", WIDE_GAP, span_days=3)
    revisions.unpersist()
    return as_text(scan_table(spark, root, clean_schema("day")))


def q_availability_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notice_lines(touched_minutes(session_metrics(messages(spark, sf_dir), WIDE_GAP)))


def q_notice_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = touched_minutes(session_metrics(messages(spark, sf_dir), WIDE_GAP))
    return decode_notices(minutes.select(envelope(notice_json(F.col("minute"))).alias("value")))


def q_late_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = quarantined(messages(spark, sf_dir, delay_per_value=1_800))
    return rejected.select(
        "session_id", "message_name", "event_sec",
        F.unix_seconds("arrival").alias("arrival_sec"), "reason",
    )


def q_over_late_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages taken in daily batches by arrival; those whose window had expired by then.

    The watermark of a batch is the greatest arrival of the batches before it.
    """
    rows = messages(spark, sf_dir, delay_per_value=60).select(
        "session_id", "message_name", "event_sec", F.unix_seconds("arrival").alias("arrival_sec")
    ).withColumn("batch", F.floor(F.col("arrival_sec") / DAYS))
    earlier = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    # One row per day, whatever the input holds.
    marks = (
        rows.groupBy("batch").agg(F.max("arrival_sec").alias("top"))
        .select("batch", F.max("top").over(earlier).alias("watermark_sec"))
    )
    return (
        rows.join(marks, "batch")
        .where(over_late(F.col("watermark_sec"), lateness=3_600))
        .drop("batch")
    )


def q_decoded_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_messages(encode_messages(messages(spark, sf_dir)))
    return decoded.select(
        "session_id", "message_name", "message_value", "event_sec",
        F.unix_seconds("arrival").alias("arrival_sec"), F.col("error").isNull().alias("decoded"),
    )


def q_undecodable_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads with a stray last byte in every seventh event second, as the quarantine keeps them."""
    payloads = encode_messages(messages(spark, sf_dir))
    spoilt = F.when(
        F.unix_seconds("arrival") % 7 == 0, F.concat("payload", F.unhex(F.lit("FF")))
    ).otherwise(F.col("payload"))
    bad = quarantined(decode_messages(payloads.withColumn("payload", spoilt)))
    return bad.select(
        F.unix_seconds("arrival").alias("arrival_sec"), "reason",
        F.col("error").isNotNull().alias("explained"),
        (F.right(F.hex("payload"), F.lit(2)) == "FF").alias("payload_kept"),
    )


def q_stream_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, _ = replay_stream(
        spark, two_waves(spark, sf_dir), 2, gap=WIDE_GAP, lateness=60 * DAYS, max_skew=60 * DAYS
    )
    return as_text(scan_table(spark, raw, raw_schema("day")), "pane")


def q_stream_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = arrival_thirds(messages(spark, sf_dir, delay_per_value=60))
    _, clean = replay_stream(spark, rows, 3, gap=WIDE_GAP, early=True, dedupe_each_wave=True)
    return as_text(reconcile(scan_table(spark, clean, clean_schema("day")), WIDE_GAP))


def q_stream_final_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = arrival_thirds(messages(spark, sf_dir, delay_per_value=60))
    return as_text(replay_final(spark, rows, 3, gap=WIDE_GAP, clock="event"))


def q_native_final_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as `stream_final_sessions`, by Spark's session windows alone."""
    rows = arrival_thirds(messages(spark, sf_dir, delay_per_value=60))
    finals = replay_rows(spark, rows, 3, lambda m: native_final_sessions(m, WIDE_GAP), "append")
    return as_text(finals)


def q_stream_minute_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions per minute of their start, counted in the stream by a second state operator."""
    rows = arrival_thirds(messages(spark, sf_dir, delay_per_value=60))

    def totals(arrived: DataFrame) -> DataFrame:
        finals = final_sessions(arrived, gap=WIDE_GAP, clock="event", output_mode="Append")
        return with_receipt_time(minute_totals(finals))

    restated = replay_rows(spark, rows, 3, totals, "append")
    latest = Window.partitionBy("minute_second").orderBy(F.desc("batch_id"))
    return restated.withColumn("place", F.row_number().over(latest)).where("place = 1").select(*MINUTE_TOTALS.fieldNames())


def q_stream_early_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early panes that gather a day of changes each; the gap makes one session of each user."""
    raw, _ = replay_stream(
        spark, arrival_thirds(messages(spark, sf_dir)), 3, gap=100 * DAYS, early=True, pane_delay=DAYS
    )
    return as_text(scan_table(spark, raw, raw_schema("day")), "pane")


def three_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as messages of three waves by value; each wave comes in long after the one before."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    wave = F.when(F.col("value") > LATE_VALUE, 3).when(F.col("value") > LATE_VALUE - 10, 2).otherwise(1)
    arrival = instant(epoch_seconds_ntz(F.col("ts")) + (wave - 1) * 60 * DAYS)
    return normalise(events.withColumn("wave", wave), "user_id", "event_type", "ts", "props", arrival, keep=["wave"])


def q_stream_late_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On-time panes after the second wave, then late panes that gather a day of changes each."""
    raw, _ = replay_stream(
        spark, three_waves(spark, sf_dir), 3, gap=40 * DAYS, lateness=200 * DAYS, max_skew=200 * DAYS, pane_delay=DAYS
    )
    return as_text(scan_table(spark, raw, raw_schema("day")), "pane")


def q_stream_late_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream refused as too late, from the query that writes the sessions."""
    late = f"{shared_dir(spark, 'late-drops')}/late"
    rows = arrival_thirds(messages(spark, sf_dir, delay_per_value=600))
    replay_stream(spark, rows, 3, gap=3_600, lateness=3_600, max_skew=60 * DAYS, late_root=late)
    return spark.read.schema(LATE_MESSAGE).parquet(late).select(*LATE_MESSAGE.fieldNames())


def q_stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the micro-batches of the session job were observed to do, summed up."""
    root = f"{shared_dir(spark, 'metrics')}/metrics"
    replay_stream(
        spark, two_waves(spark, sf_dir), 2, metrics_root=root, gap=WIDE_GAP, lateness=60 * DAYS, max_skew=31 * DAYS + 60
    )
    totals = F.when(F.col("metric").startswith("first"), F.min("value")).when(
        F.col("metric").startswith("last"), F.max("value")).otherwise(F.sum("value"))
    figures = read_metrics(spark, root).where("observed = 'messages' or metric in ('on_time', 'late', 'dropped_messages')")
    return figures.groupBy("observed", "metric").agg(totals.alias("value"))


def q_stream_minute_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job with a directory for each event minute: sessions of a customer's `orders`, dear ones late.

    The gap makes one session of each customer, so the late orders restate sessions and move starts
    to other minutes; deduplication on notice and reconcile leave the true ones.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    wave = F.when(F.col("o_totalprice") > DEAR, 2).otherwise(1)
    arrival = instant(epoch_seconds_ntz(F.col("o_orderdate")) + (wave - 1) * 8_000 * DAYS)
    rows = normalise(
        orders.withColumn("wave", wave), "o_custkey", "o_orderpriority", "o_orderdate", None, arrival, keep=["wave"])
    _, clean = replay_stream(
        spark, rows, 2, "minute", dedupe_each_wave=True, gap=LIFE_GAP, early=True, lateness=LIFE_GAP, max_skew=LIFE_GAP)
    return as_text(reconcile(scan_table(spark, clean, clean_schema("minute")), LIFE_GAP))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "session_metrics": q_session_metrics,
    "session_metrics_60s": q_session_metrics_60s,
    "session_message_counts": q_session_message_counts,
    "order_sessions": q_order_sessions,
    "sessions_per_minute": q_sessions_per_minute,
    "partition_paths": q_partition_paths,
    "raw_revisions": q_raw_revisions,
    "dedupe_latest": q_dedupe_latest,
    "dedupe_sql_view": q_dedupe_sql_view,
    "dedupe_job": q_dedupe_job,
    "dedupe_job_minute": q_dedupe_job_minute,
    "reconciled_sessions": q_reconciled_sessions,
    "reconciled_foreign": q_reconciled_foreign,
    "reconcile_job": q_reconcile_job,
    "availability_notices": q_availability_notices,
    "notice_roundtrip": q_notice_roundtrip,
    "late_quarantine": q_late_quarantine,
    "over_late_messages": q_over_late_messages,
    "decoded_messages": q_decoded_messages,
    "undecodable_messages": q_undecodable_messages,
    "stream_revisions": q_stream_revisions,
    "stream_reconciled": q_stream_reconciled,
    "stream_final_sessions": q_stream_final_sessions,
    "native_final_sessions": q_native_final_sessions,
    "stream_minute_totals": q_stream_minute_totals,
    "stream_early_panes": q_stream_early_panes,
    "stream_late_panes": q_stream_late_panes,
    "stream_late_drops": q_stream_late_drops,
    "stream_metrics": q_stream_metrics,
    "stream_minute_layout": q_stream_minute_layout,
}
