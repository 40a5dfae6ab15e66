"""Known results on the test tables, and where intermediate tables go."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tideline.functions.event_time import minute_of
from tideline.operators.dedupe import latest_revision
from tideline.operators.reconcile import reconcile
from tideline.operators.sessions import session_metrics
from tideline.plans.queries import WIDE_GAP, messages
from tideline.plans.replay import replay_revisions
from tideline.session import settings, shared_dir
from tideline.sources.messages import normalise

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("gap, expected", [(60, 9_985), (1_800, 9_549), (WIDE_GAP, 5_725)])
def test_sessions_of_the_events(spark, gap, expected):
    assert session_metrics(messages(spark, SF), gap).count() == expected


def test_two_waves_over_the_events(spark):
    # Every tenth message is delivered in a second wave; both waves together are the table.
    events = spark.read.parquet(f"{SF}/events.parquet")
    events = events.withColumn("wave", F.when(F.col("event_id") % 10 == 0, 2).otherwise(1))
    rows = normalise(events, "user_id", "event_type", "ts", keep=["wave"])
    revisions = replay_revisions(rows, WIDE_GAP)
    latest = latest_revision(revisions.withColumn("minute", minute_of(F.col("session_start"))))
    assert revisions.count() == 6_402
    assert latest.count() == 6_032
    assert reconcile(latest, WIDE_GAP).count() == 5_725


def fake_session(master, conf=None, checkpoint=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf or default), sparkContext=context
    )


def test_shared_folder():
    assert shared_dir(fake_session("spark://x", "hdfs://a/b/"), "p").startswith("hdfs://a/b/p-")
    assert shared_dir(fake_session("spark://x", None, "hdfs://c"), "p").startswith("hdfs://c/p-")
    assert "/tideline-" in shared_dir(fake_session("local[2]"), "p")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake_session("spark://x"), "p")


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with settings(spark, {"spark.sql.shuffle.partitions": "3", "tideline.test": "x"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("tideline.test", None) is None
