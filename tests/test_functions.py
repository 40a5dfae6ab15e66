import pytest
from helpers import T0
from pyspark.sql import functions as F

from tideline.functions.codec import counts_json, envelope, notice_json, notice_second, total_messages
from tideline.functions.event_time import epoch_seconds, epoch_seconds_ntz, floor_to, wall_clock_millis
from tideline.functions.partition_path import (
    legacy_partition_path,
    partition_path,
    partition_values,
    path_to_second,
    receipt_of_path,
    receipt_path,
    try_path_to_second,
)

SECONDS = [0, 60, T0, T0 + 5 * 86_400 + 3_600 * 23 + 59 * 60, 951_782_400, 4_102_444_740]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("path", [partition_path, legacy_partition_path])
def test_path_round_trip(spark, path):
    df = spark.createDataFrame([(s,) for s in SECONDS], "s bigint")
    for row in df.select("s", path_to_second(path(F.col("s"))).alias("back")).collect():
        assert row.back == row.s // 60 * 60


def test_path_text(spark):
    second = F.lit(1_709_211_845)  # 2024-02-29 13:04:05
    assert one(spark, partition_path(second)) == "y=2024/mo=02/d=29/h=13/mi=04"
    assert one(spark, partition_path(second, "day")) == "y=2024/mo=02/d=29"
    assert one(spark, legacy_partition_path(second)) == "y=2024/m=02/d=29/h=13/m=04"
    assert one(spark, receipt_path(second, F.lit(17))) == "y=2024/mo=02/d=29/h=13/mi=04/rt=17"
    row = spark.range(1).select(*partition_values(second)).first()
    assert tuple(row) == ("2024", "02", "29", "13", "04")


def test_month_and_minute_are_not_mixed_up(spark):
    path = F.lit("gs/raw/y=2024/m=02/d=01/h=00/m=11/rt=5/part.parquet")
    assert one(spark, path_to_second(path)) == 1_706_745_600 + 11 * 60
    assert one(spark, receipt_of_path(path)) == 5
    nested = F.concat(F.lit("y=1999/m=12/d=31/h=23/m=59/"), path)
    assert one(spark, path_to_second(nested)) == 1_706_745_600 + 11 * 60
    assert one(spark, receipt_of_path(F.lit("y=2024"))) is None


def test_path_without_a_minute(spark):
    for path in ("foo/bar", "y=2024/m=13/d=01/h=00/m=00", "y=2024/mo=01/d=01/h=24/mi=00"):
        assert one(spark, try_path_to_second(F.lit(path))) is None
    with pytest.raises(Exception, match="names no event minute: foo/bar"):
        one(spark, path_to_second(F.lit("foo/bar")))


def test_paths_are_utc_under_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert one(spark, partition_path(F.lit(T0))) == "y=2024/mo=01/d=01/h=00/mi=00"
        ntz = F.lit("2024-01-01 00:00:07.9").cast("timestamp_ntz")
        assert one(spark, epoch_seconds_ntz(ntz)) == T0 + 7
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_epoch_conversions(spark):
    assert one(spark, epoch_seconds(F.lit("2024-01-01 00:00:00.999").cast("timestamp"))) == T0
    assert one(spark, epoch_seconds_ntz(F.lit("1969-12-31 23:59:58.5").cast("timestamp_ntz"))) == -2
    assert one(spark, floor_to(F.lit(-1), 60)) == -60
    assert one(spark, wall_clock_millis()) > 1_600_000_000_000


def test_notice_text(spark):
    assert one(spark, notice_json(F.lit(T0))) == '{"event_time_second":%d}' % T0
    assert one(spark, notice_second(F.lit('{"event_time_second":5}'))) == 5
    assert one(spark, notice_second(envelope(notice_json(F.lit(T0))))) == T0
    assert one(spark, notice_second(F.lit("%%%"))) is None
    assert one(spark, notice_second(F.lit("{broken"))) is None


def test_count_maps(spark):
    counts = F.create_map(F.lit("b"), F.lit(2).cast("bigint"), F.lit("a"), F.lit(1).cast("bigint"))
    assert one(spark, counts_json(counts)) == '{"a":1,"b":2}'
    assert one(spark, total_messages(counts)) == 3
