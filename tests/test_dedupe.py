import glob
import random

import pytest
from pyspark.errors import AnalysisException
from helpers import T0, as_set, brute_force, message_frame
from pyspark.sql import DataFrameWriter, functions as F

from tideline.model import clean_schema, raw_schema
from tideline.operators.dedupe import latest_revision
from tideline.operators.reconcile import reconcile
from tideline.plans.dedupe_job import dedupe, dedupe_legacy, deduplicated, rewrite
from tideline.plans.reconcile_job import reconcile_days
from tideline.plans.replay import replay_revisions
from tideline.session import settings
from tideline.sinks import raw as raw_sink
from tideline.sinks.clean import write_clean
from tideline.sinks.raw import touched_minutes, write_revisions
from tideline.sources import partitions
from tideline.sources.partitions import scan_partitions, scan_table, seconds_frame

REVISION = "sessionId string, sessionLengthSeconds int, messageCount map<string,bigint>, session_start bigint, pane string, rt bigint"


def revisions(spark, rows):
    """Rows (session, start offset, length, count, rt)."""
    data = [(s, length, {"a": n}, T0 + start, "late", rt) for s, start, length, n, rt in rows]
    return spark.createDataFrame(data, REVISION)


def keys(df):
    return sorted((r.sessionId, r.session_start - T0, r.rt) for r in df.collect())


ROWS = [("1", 0, 45, 3, 100), ("1", 0, 45, 4, 200), ("2", 10, 0, 1, 100), ("1", 61, 0, 1, 100)]


def test_latest_revision(spark):
    df = revisions(spark, ROWS).withColumn("minute", F.expr("session_start div 60"))
    assert keys(latest_revision(df)) == [("1", 0, 200), ("1", 61, 100), ("2", 10, 100)]


def test_equal_receipt_times_keep_the_fuller_row(spark):
    df = revisions(spark, [("1", 0, 10, 2, 5), ("1", 0, 40, 3, 5), ("1", 0, 40, 4, 5)])
    row = latest_revision(df.withColumn("minute", F.lit(0))).collect()
    assert [(r.sessionLengthSeconds, r.messageCount) for r in row] == [(40, {"a": 4})]


def test_write_tasks_follow_the_data(spark, folder, monkeypatch):
    df = revisions(spark, ROWS).withColumn("minute", F.expr("session_start div 60 * 60"))
    assert raw_sink.clustered(df).rdd.getNumPartitions() == 1
    monkeypatch.setattr(raw_sink, "ROWS_PER_TASK", 2)
    cut = raw_sink.clustered(df)
    assert cut.rdd.getNumPartitions() == 3
    # One minute holds most rows here; they still spread over tasks by key.
    at_minute = cut.where(f"minute = {T0}").select(F.spark_partition_id().alias("p")).distinct()
    assert at_minute.count() > 1


@pytest.mark.parametrize("grain", ["minute", "hour", "day"])
def test_job_rewrites_the_asked_partitions_only(spark, folder, grain):
    raw, clean = f"{folder}/raw", f"{folder}/clean"
    write_revisions(revisions(spark, ROWS), raw, grain)
    dedupe(spark, raw, [T0 + 30], clean, grain)
    got = keys(scan_table(spark, clean, clean_schema(grain)))
    first_minute = [("1", 0, 200), ("2", 10, 100)]
    assert got == (first_minute if grain == "minute" else [("1", 0, 200), ("1", 61, 100), ("2", 10, 100)])
    # A later revision of one minute leaves the other minute's rows alone.
    dedupe(spark, raw, [T0, T0 + 60], clean, grain)
    write_revisions(revisions(spark, [("2", 10, 5, 2, 300)]), raw, grain)
    dedupe(spark, raw, [T0 + 10], clean, grain)
    assert keys(scan_table(spark, clean, clean_schema(grain))) == [("1", 0, 200), ("1", 61, 100), ("2", 10, 300)]


def test_padding_survives_and_filters_prune(spark, folder):
    write_revisions(revisions(spark, ROWS), folder)
    table = scan_table(spark, folder, raw_schema())
    assert {r.mo for r in table.select("mo").collect()} == {"01"}
    one = table.where("y = '2024' and mo = '01' and d = '01' and h = '00' and mi = '01'")
    assert keys(one) == [("1", 61, 100)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "mi#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_scan_falls_back_to_coarser_listing(spark, folder, monkeypatch):
    write_revisions(revisions(spark, ROWS + [("9", 3_600, 0, 1, 1)]), folder)
    minutes = seconds_frame(spark, [T0, T0 + 3_600])
    expected = [("1", 0, 100), ("1", 0, 200), ("2", 10, 100), ("9", 3_600, 1)]
    assert keys(scan_partitions(spark, folder, minutes)) == expected
    for limit in (1, 0):
        monkeypatch.setattr(partitions, "MAX_LISTED_PATHS", limit)
        assert keys(scan_partitions(spark, folder, minutes)) == expected


@pytest.mark.parametrize("limit", [10_000, 1])
def test_missing_directory_is_an_error_at_any_size(spark, folder, monkeypatch, limit):
    write_revisions(revisions(spark, ROWS + [("9", 3_600, 0, 1, 1)]), folder)
    monkeypatch.setattr(partitions, "MAX_LISTED_PATHS", limit)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        keys(scan_partitions(spark, folder, seconds_frame(spark, [T0, T0 + 600, T0 + 3_600])))


def test_job_drops_older_revisions_before_the_shuffle(spark, folder, monkeypatch):
    write_revisions(revisions(spark, ROWS), folder)
    rows = scan_partitions(spark, folder, seconds_frame(spark, [T0]))
    latest = deduplicated(rows.withColumn("minute", F.expr("session_start div 60 * 60")))
    text = latest._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange ") == 1 and "hashpartitioning(minute" in text
    above, below = text.split("Exchange ")
    assert "Final" in above and "WindowGroupLimit" in below and "Partial" in below
    # The ranges of the write come from what is left.
    monkeypatch.setattr(raw_sink, "ROWS_PER_TASK", 1)
    text = raw_sink.clustered(latest)._jdf.queryExecution().executedPlan().toString()
    assert text.index("rangepartitioning(minute") < text.index("WindowGroupLimit")


def test_job_reads_the_raw_rows_once(spark, folder):
    write_revisions(revisions(spark, ROWS), f"{folder}/raw")
    taken = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            taken.add(batch.num_rows)
            yield batch

    raw = scan_partitions(spark, f"{folder}/raw", seconds_frame(spark, [T0, T0 + 60]))
    raw = raw.withColumn("minute", F.expr("session_start div 60 * 60"))
    rewrite(raw.mapInArrow(count, raw.schema), f"{folder}/clean", "minute")
    assert taken.value == len(ROWS)
    assert keys(scan_table(spark, f"{folder}/clean", clean_schema())) == [("1", 0, 200), ("1", 61, 100), ("2", 10, 100)]


def test_replay_of_a_batch_adds_no_rows(spark, folder):
    df = revisions(spark, ROWS)
    write_revisions(df, folder)
    write_revisions(df, folder)
    assert scan_table(spark, folder, raw_schema()).count() == len(ROWS)


def test_new_receipt_times_add_directories_and_known_ones_replace_them(spark, folder, monkeypatch):
    modes, real = [], DataFrameWriter.mode
    monkeypatch.setattr(DataFrameWriter, "mode", lambda self, mode: (modes.extend([mode] if mode else []), real(self, mode))[1])
    write_revisions(revisions(spark, ROWS), folder)
    write_revisions(revisions(spark, [("2", 10, 5, 2, 300)]), folder)
    assert modes == ["append", "append"]
    # A run that was lost halfway has left some of its rows.
    write_revisions(revisions(spark, [("2", 10, 5, 2, 300), ("3", 70, 5, 2, 300)]), folder)
    write_revisions(revisions(spark, ROWS), folder)
    assert modes[2:] == ["overwrite", "overwrite"]
    assert scan_table(spark, folder, raw_schema()).count() == len(ROWS) + 2
    monkeypatch.setattr(raw_sink, "RECEIPTS_LOOKED_UP", 1)
    write_revisions(revisions(spark, ROWS), f"{folder}/many")
    assert modes[4:] == ["overwrite"]


def test_missing_directories_are_found_without_opening_files(spark, folder, monkeypatch):
    write_revisions(revisions(spark, ROWS + [("9", 3_600, 0, 1, 1)]), folder)
    for file in glob.glob(f"{folder}/**/.part-*.crc", recursive=True) + glob.glob(f"{folder}/**/part-*", recursive=True):
        with open(file, "wb") as out:
            out.write(b"none of Spark's")
    monkeypatch.setattr(partitions, "MAX_LISTED_PATHS", 1)
    scan_partitions(spark, folder, seconds_frame(spark, [T0, T0 + 3_600]))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        scan_partitions(spark, folder, seconds_frame(spark, [T0, T0 + 600, T0 + 3_600]))


def older_layout(spark, root):
    # Written leaf by leaf: Spark itself cannot write one partition name twice. Counts are INT there.
    for minute, rt, rows in (("00", 100, ROWS[:1]), ("00", 200, ROWS[1:3]), ("01", 100, ROWS[3:]), ("02", 100, ROWS[3:])):
        df = revisions(spark, rows).select(
            "sessionId", "sessionLengthSeconds", F.col("messageCount").cast("map<string,int>").alias("messageCount")
        )
        df.write.parquet(f"{root}/y=2024/m=01/d=01/h=00/m={minute}/rt={rt}")


@pytest.mark.parametrize("limit", [10_000, 1, 0])
def test_older_layout(spark, folder, monkeypatch, limit):
    # With a limit of 1 the hour is listed, with 0 the day; the third minute is there but not asked for.
    raw, clean = f"{folder}/raw", f"{folder}/clean"
    older_layout(spark, raw)
    monkeypatch.setattr(partitions, "MAX_LISTED_PATHS", limit)
    dedupe_legacy(spark, raw, [T0, T0 + 60], clean)
    got = scan_table(spark, clean, clean_schema()).collect()
    assert sorted((r.sessionId, r.mi, r.rt, r.messageCount["a"]) for r in got) == [
        ("1", "00", 200, 4), ("1", "01", 100, 1), ("2", "00", 200, 1),
    ]


@pytest.mark.parametrize("limit", [10_000, 1])
def test_missing_minute_of_the_older_layout_is_an_error(spark, folder, monkeypatch, limit):
    older_layout(spark, folder)
    monkeypatch.setattr(partitions, "MAX_LISTED_PATHS", limit)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        partitions.scan_legacy_minutes(spark, folder, seconds_frame(spark, [T0, T0 + 600])).collect()


def test_reconcile_drops_rows_a_merge_made_obsolete(spark):
    bridged = revisions(spark, [("7", 0, 100, 3, 2), ("7", 100, 0, 1, 1), ("8", 100, 0, 1, 1)])
    assert keys(reconcile(bridged)) == [("7", 0, 2), ("8", 100, 1)]
    moved = revisions(spark, [("9", 65, 0, 1, 1), ("9", 50, 15, 2, 2)])
    assert keys(reconcile(moved)) == [("9", 50, 2)]


def test_reconcile_keeps_sessions_one_gap_apart(spark):
    df = revisions(spark, [("1", 0, 10, 1, 1), ("1", 70, 0, 1, 2), ("1", 130, 0, 1, 3)])
    assert len(keys(reconcile(df))) == 3


def test_reconcile_keeps_what_the_newest_row_does_not_touch(spark):
    # 0..50 and 140 both come close to the old 40..100, but not to each other.
    df = revisions(spark, [("1", 0, 20, 1, 5), ("1", 40, 60, 1, 1), ("1", 140, 0, 1, 3)])
    assert keys(reconcile(df)) == [("1", 0, 5), ("1", 140, 3)]


@pytest.mark.parametrize("seed", range(3))
def test_two_waves_reconcile_to_the_true_sessions(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("abcd"), rng.choice("xy"), rng.randrange(6_000), rng.choice((1, 1, 1, 2))) for _ in range(250)]
    df = message_frame(spark, [(*r[:3], r[3]) for r in rows])
    waves = df.withColumn("wave", (F.unix_seconds("arrival") - T0).cast("int"))
    revs = replay_revisions(waves)
    latest = latest_revision(revs.withColumn("minute", F.expr("session_start div 60")))
    assert latest.count() > len(brute_force(rows, 60))
    assert as_set(reconcile(latest)) == brute_force(rows, 60)


def test_touched_minutes(spark):
    got = {r.minute - T0 for r in touched_minutes(revisions(spark, ROWS)).collect()}
    assert got == {0, 60}


EXAMPLE = [("1", 0, 100, 1, 1), ("1", 60, 90, 1, 2), ("1", 200, 60, 1, 3)]


def test_reconcile_drops_what_any_newer_row_comes_near(spark):
    # 0..100 loses to 60..150, which loses to 200..260 in turn.
    assert keys(reconcile(revisions(spark, EXAMPLE))) == [("1", 200, 3)]


def anti_join(rows, gap=60):
    return sorted(
        a[0:2] + (a[4],) for a in rows
        if not any(b[0] == a[0] and b[4] > a[4] and b[1] < a[1] + a[2] + gap and a[1] < b[1] + b[2] + gap for b in rows)
    )


@pytest.mark.parametrize("seed, batch", [(s, b) for s in range(6) for b in (1, 3, 10_000)])
def test_reconcile_equals_an_anti_join_of_random_spans(spark, seed, batch):
    rng = random.Random(seed)
    spread, longest = rng.choice(((3_000, 50), (20_000, 400), (800, 300)))
    rows = [
        (rng.choice("abcdef"), rng.randrange(spread), rng.choice((0, rng.randrange(longest))), 1, rng.randrange(rng.choice((3, 40))))
        for _ in range(200)
    ]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        assert keys(reconcile(revisions(spark, rows))) == anti_join(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("grain", ["minute", "day"])
def test_reconcile_job_rewrites_touched_days_only(spark, folder, grain):
    day = 86_400
    rows = [
        ("1", 100, 0, 1, 1), ("1", 50, 60, 2, 2),  # moved back within the day
        ("2", day + 10, 0, 1, 1), ("2", day - 20, 40, 2, 2),  # moved back over midnight, its minute is left empty
        ("3", 5 * day, 100, 1, 1), ("3", 5 * day + 30, 0, 1, 2),  # days that nobody asked for
    ]
    clean = revisions(spark, rows).withColumn("minute", F.expr("session_start div 60 * 60"))
    write_clean(clean, folder, grain)
    reconcile_days(spark, folder, seconds_frame(spark, [T0 + 50, T0 + day - 20]), grain)
    table = scan_table(spark, folder, clean_schema(grain))
    assert keys(table) == [("1", 50, 2), ("2", day - 20, 2), ("3", 5 * day, 1), ("3", 5 * day + 30, 2)]
    reconcile_days(spark, folder, seconds_frame(spark, [T0 + 50 * day]), grain)
    reconcile_days(spark, folder, seconds_frame(spark, [T0 + 5 * day]), grain)
    spark.catalog.refreshByPath(folder)
    assert len(keys(scan_table(spark, folder, clean_schema(grain)))) == 3


def test_minutes_come_from_the_directories_alone(spark, folder):
    write_revisions(revisions(spark, ROWS + [("9", 3_600, 0, 1, 1)]), folder)
    minutes = touched_minutes(scan_table(spark, folder, raw_schema()))
    for path in glob.glob(f"{folder}/y=*/**/*.parquet", recursive=True):
        open(path, "wb").close()
    with settings(spark, partitions.FROM_THE_LISTING):
        minutes = minutes.persist()
    assert sorted(r.minute for r in minutes.collect()) == [T0, T0 + 60, T0 + 3_600]
    minutes.unpersist()


def test_all_hours_of_a_table_are_listed_by_one_job(spark, folder):
    spread = [("1", hour * 3_600 + minute * 60, 0, 1, 1) for hour in range(3) for minute in range(40)]
    write_revisions(revisions(spark, spread), folder)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        rows = scan_table(spark, folder, raw_schema())
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(tracker.getJobIdsForGroup("listing")) <= 1
    assert keys(rows) == sorted((s, start, rt) for s, start, _, _, rt in spread)
    assert keys(rows.where("h = '01'")) == sorted((s, start, rt) for s, start, _, _, rt in spread if start // 3_600 == 1)


def test_an_empty_dataset_of_minutes_is_read_as_empty(spark, folder):
    assert scan_table(spark, folder, raw_schema()).count() == 0


def test_many_directories_are_dealt_over_more_tasks(spark, monkeypatch):
    df = revisions(spark, [("1", 60 * k, 0, 1, 1) for k in range(100)]).withColumn("minute", F.col("session_start"))
    assert raw_sink.clustered(df).rdd.getNumPartitions() == 5
    monkeypatch.setattr(raw_sink, "MOST_DIRECTORIES_PER_TASK", 10)
    assert raw_sink.clustered(df).rdd.getNumPartitions() >= 9
