"""Known values of the column functions."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.functions import geo, records, text, times


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_geohash(spark):
    lat, lon = F.lit(-73.96974759), F.lit(40.75890919)
    row = one(spark, geo.geohash(lat, lon), geo.geohash(lat, lon, 7))
    assert tuple(row) == ("hfugpqpwzrtk", "hfugpqp")


def test_geohash_borders(spark):
    row = one(spark, geo.geohash(F.lit(90.0), F.lit(180.0)), geo.geohash(F.lit(-90.0), F.lit(-180.0)))
    assert tuple(row) == ("z" * 12, "0" * 12)


@pytest.mark.parametrize("precision", [0, 13])
def test_geohash_precision_is_checked(spark, precision):
    with pytest.raises(ValueError):
        geo.geohash(F.lit(0.0), F.lit(0.0), precision)


def test_md5(spark):
    assert one(spark, text.md5_key(F.lit("abc")))[0] == "900150983CD24FB0D6963F7D28E17F72"


def test_null_part_gives_null_key(spark):
    assert one(spark, text.profile_row_key(F.lit(1), F.lit(1595506395000), F.lit(None).cast("string")))[0] is None


def test_instant_parts(spark):
    ts = times.parse_timestamp(F.lit("2020-07-16 13:39:06.454"))
    row = one(
        spark, F.date_format(ts, "HH:mm"), times.ten_minute_label(ts, with_date=False), times.ten_minute_label(ts),
        times.epoch_seconds(F.lit("2020-07-16 13:39:06.454")), times.clock_parts(ts)["hour"], times.timestamp_text(ts),
    )
    assert tuple(row) == ("13:39", "13:30", "2020-07-16 13:30", 1594906746, 13, "2020-07-16 13:39:06.454")


def test_text_keeps_trailing_zeros(spark):
    assert one(spark, times.timestamp_text(F.lit("2020-07-16 13:39:06").cast("timestamp")))[0].endswith("06.000")


def test_iso_text_is_no_timestamp(spark):
    assert one(spark, times.parse_timestamp(F.lit("2020-07-23T19:53:15.509Z")))[0] is None


def test_calendar_parts(spark):
    parts = times.calendar_parts(F.lit("2015-10-11").cast("date"))
    row = one(spark, *[c.alias(n) for n, c in parts.items()]).asDict()
    assert row == {"year": 2015, "quarter": 4, "month": 10, "week": 41, "day_of_year": 284, "day_of_month": 11}


def test_zone_of_epoch_text(spark):
    row = one(spark, times.format_millis(F.lit(1594906746454)), times.format_millis(F.lit(1594906746454), zone="Asia/Shanghai"))
    assert tuple(row) == ("20200716133906", "20200716213906")


LOG = '{"message": "85517,20200429,1000,384,3,700", "log": {"offset": 874}}'


def test_json_paths_and_fields(spark):
    message = records.json_path(F.lit(LOG), "$.message")
    row = one(
        spark, message, records.json_path(F.lit(LOG), "$.log.offset"), records.csv_field(message, 1, "bigint"),
        records.csv_field(message, 9), records.csv_field(F.lit("a,b"), 1, "bigint"),
    )
    assert tuple(row) == ("85517,20200429,1000,384,3,700", "874", 85517, None, None)


def test_documents(spark):
    rows = spark.createDataFrame([("a", 10), ("b", 20)], "name string, num int")
    docs = [r[0] for r in rows.orderBy("name").select(records.encode_json("name", "num")).collect()]
    assert docs == ['{"name":"a","num":10}', '{"name":"b","num":20}']


SCHEMA = T.StructType([T.StructField("uid", T.LongType()), T.StructField("sex", T.StringType())])
LINES = ['{"uid": 1, "sex": "f"}', '{"uid": "x", "sex": "m"}', '{"uid": 3}', "{}", "no json", "", None, "[1]", '{"uid": "x"}', '{"uid": 4']


def decoded(spark, **how):
    lines = spark.createDataFrame([(v,) for v in LINES], "value string")
    rows = [tuple(r) for r in records.decode_json(lines, SCHEMA, **how).collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


def test_skip_policy(spark):
    assert decoded(spark) == [(None, None), (None, None), (None, "m"), (1, "f"), (3, None)]


def test_sentinel_policy(spark):
    rows = decoded(spark, policy="sentinel", sentinel={"uid": 0, "sex": ""})
    assert rows.count((0, "")) == 5 and len(rows) == 10


def test_fail_policy(spark):
    with pytest.raises(Exception, match="(?i)malformed"):
        decoded(spark, policy="fail")


def test_decode_keeps_columns(spark):
    lines = spark.createDataFrame([(7, LINES[0])], "offset bigint, value string")
    assert tuple(records.decode_json(lines, SCHEMA, keep=("offset",)).first()) == (7, 1, "f")
