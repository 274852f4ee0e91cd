import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from opslake.functions import moments, numeric, text


def one(spark, *cols, df=None):
    return tuple((df if df is not None else spark.range(1)).select(*cols).first())


def test_half_even_decides_money(spark):
    df = spark.createDataFrame([(19000, 0.15), (73000, 0.05), (39000, 0.05), (17000, 0.15)], "yen long, share double")
    got = [r[0] for r in df.select(numeric.half_even(F.col("yen") * F.col("share"), 100)).collect()]
    assert got == [2800, 3600, 2000, 2600]  # 28.5 -> 28, 36.5 -> 36, 19.5 -> 20, 25.5 -> 26


def test_exact_avg_does_not_depend_on_order(spark):
    rng = random.Random(3)
    values = [round(rng.uniform(0, 500), 2) for _ in range(5000)]
    want = float((sum(Decimal(str(v)) for v in values) / len(values)).quantize(Decimal("0.001"), ROUND_HALF_UP))
    for seed in range(3):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(seed + 1)
        assert df.agg(numeric.exact_avg(F.col("v"), 3)).first()[0] == want
    empty = spark.createDataFrame([(None,)], "v double")
    assert empty.agg(numeric.exact_avg(F.col("v"), 3)).first()[0] is None


def test_percent_ties_and_zero(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (0, 0)], "a long, b long")
    got = [r[0] for r in df.select(numeric.percent(F.col("a"), F.col("b"))).collect()]
    assert got == [12.5, 37.5, None]
    assert one(spark, numeric.gap_percent(F.lit(690), F.lit(420)))[0] == 39.1


def test_blank_null_and_concat(spark):
    df = spark.createDataFrame([("",), (None,), (" ",), ("x",)], "s string")
    assert [r[0] for r in df.select(text.blank_to_null(F.col("s"))).collect()] == [None, None, " ", "x"]
    assert one(spark, text.edge_id(F.lit("A"), "LOT", F.lit(None)))[0] is None
    assert one(spark, text.edge_id(F.lit(1), "LOT", F.lit("B")))[0] == "1|LOT|B"


def test_lists_paths_json(spark):
    df = spark.createDataFrame([("a|b|c",), ("",), (None,), ("x",)], "s string")
    assert [r[0] for r in df.select(text.pipe_list(F.col("s"))).collect()] == [["a", "b", "c"], [], [], ["x"]]
    assert one(spark, text.base_name(F.lit("a/b/c.pdf")), text.base_name(F.lit("c.pdf"))) == ("c.pdf", "c.pdf")
    obj = text.json_object([F.lit(1).alias("a"), F.lit(None).cast("string").alias("b")])
    assert one(spark, obj)[0] == '{"a":1,"b":null}'


def test_rank_of_unknown_is_last(spark):
    df = spark.createDataFrame([("CRITICAL",), ("LOW",), ("odd",), (None,)], "p string")
    assert [r[0] for r in df.select(text.priority_rank(F.col("p"))).collect()] == [1, 4, 5, 5]


def test_times_ignore_the_session_zone(spark):
    a, b = dt.datetime(2026, 3, 8, 1, 30), dt.datetime(2026, 3, 8, 3, 30, 0, 500000)
    df = spark.createDataFrame([(a, b), (b, a)], "a timestamp_ntz, b timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):  # the clock skips 02:00 on that day
            spark.conf.set("spark.sql.session.timeZone", z)
            got = df.select(
                moments.seconds_between(F.col("a"), F.col("b")), moments.minutes_between(F.col("a"), F.col("b"))
            ).collect()
            assert [tuple(r) for r in got] == [(7200, 120), (-7200, -120)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert one(spark, moments.days_between(F.lit("2026-07-25").cast("date"), F.lit("2026-08-08").cast("date")))[0] == 14
    ts = moments.parse_ts(F.lit("2026-08-08 10:18:00"))
    assert one(spark, moments.format_ts(ts))[0] == "2026-08-08 10:18:00"
