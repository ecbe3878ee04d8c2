from datetime import date, datetime

from pyspark.sql import functions as F

from rollcall import Settings
from rollcall.functions import dates, predicates
from rollcall.operators.aggregates import (
    count_distinct_where,
    counted_list,
    distinct_list,
    label_of_rank,
    rank_of_label,
    text_list,
)
from rollcall.operators.picks import keep_first


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_week_start_moves_days_before_the_anchor_forward(spark):
    anchor = date(2024, 1, 1)
    got = {
        day: one(spark, dates.week_start(F.lit(day), anchor))
        for day in (date(2023, 12, 29), date(2024, 1, 1), date(2024, 1, 7), date(2024, 12, 30))
    }
    assert got == {
        date(2023, 12, 29): date(2024, 1, 1),
        date(2024, 1, 1): date(2024, 1, 1),
        date(2024, 1, 7): date(2024, 1, 1),
        date(2024, 12, 30): date(2024, 12, 30),
    }
    floored = dates.week_start(F.lit(date(2023, 12, 29)), anchor, floor=True)
    assert one(spark, floored) == date(2023, 12, 25)


def test_week_columns_around_new_year(spark, settings):
    weeks = dates.week_columns(F.lit(date(2024, 12, 31)), settings)
    row = spark.range(1).select([c.alias(n) for n, c in weeks.items()]).first()
    # The calendar year of the Monday with the ISO week of the Monday.
    assert (row.week_start_date, row.week_year, row.week_number) == (date(2024, 12, 30), 2024, 1)
    assert row.week_offset == 50


def test_week_labels(spark):
    df = spark.createDataFrame([(n,) for n in (0, -1, 1, -2, 3, None)], "n int")
    got = [r["v"] for r in df.select(dates.week_label(F.col("n")).alias("v")).collect()]
    assert got == [
        "This Week", "Last Week", "Next Week", "2 Weeks Ago", "3 Weeks Ahead", " Weeks Ahead",
    ]


def test_local_time_does_not_depend_on_the_session_zone(spark):
    utc = F.lit("2024-07-01 03:00:00").cast("timestamp_ntz")
    assert one(spark, dates.to_local(utc, "America/Phoenix")) == datetime(2024, 6, 30, 20)
    now = Settings(as_of=datetime(2024, 1, 20, 15, 30)).now
    assert one(spark, now) == datetime(2024, 1, 20, 15, 30)


def test_later_of_ignores_null(spark):
    early, late, none = F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 5)), F.lit(None).cast("date")
    assert one(spark, dates.later_of(early, late)) == date(2024, 1, 5)
    assert one(spark, dates.later_of(none, early)) == date(2024, 1, 1)
    assert one(spark, dates.days_between(dates.later_of(none, none), late)) is None
    midnight = dates.days_between(
        F.lit("2024-01-01 23:59:00").cast("timestamp_ntz"), F.lit(date(2024, 1, 2))
    )
    assert one(spark, midnight) == 1


def test_clock_text(spark):
    at = F.lit("2024-09-03 00:05:00").cast("timestamp_ntz")
    assert one(spark, dates.clock_text(at)) == "Sep 3 at 12:05 AM"


def test_percent(spark):
    assert one(spark, predicates.percent(F.lit(1), F.lit(3))) == 33.3
    assert one(spark, predicates.percent(F.lit(1), F.lit(0))) is None
    assert one(spark, predicates.percent(F.lit(1), F.lit(None).cast("int"))) is None
    assert one(spark, predicates.percent(F.lit(1), F.lit(16))) == 6.3


def test_fallback_takes_the_other_value_even_if_it_is_junk(spark):
    junk = ("ImportJob", "")
    df = spark.createDataFrame(
        [("a", "b"), ("", "b"), (None, "b"), ("ImportJob", ""), ("", None)], "x string, y string"
    )
    got = df.select(predicates.or_fallback(F.col("x"), F.col("y"), junk).alias("v")).collect()
    assert [r["v"] for r in got] == ["a", "b", "b", "", None]


def test_none_of_drops_null(spark):
    df = spark.createDataFrame([("System",), ("ann",), (None,)], "x string")
    kept = df.filter(predicates.none_of(F.col("x"), ["System"])).collect()
    assert [r.x for r in kept] == ["ann"]


def test_text_lists(spark, rows):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "b"), (2, None), (3, "z"), (3, None)], "k int, v string"
    )
    assert rows(counted_list(df, ["k"], "v", "t")) == [(1, "a x1, b x2"), (2, None), (3, "z x1")]
    assert rows(distinct_list(df, ["k"], "v", "t")) == [(1, "a, b"), (2, None), (3, "z")]
    assert rows(df.groupBy("k").agg(text_list("v", "|"))) == [(1, "a|b|b"), (2, None), (3, "z")]


def test_severity_collapse(spark, rows):
    worst = ["Do Not Contact", "Do Not Blast", "Do Not Call"]
    df = spark.createDataFrame(
        [(1, "Do Not Call"), (1, "Do Not Contact"), (2, "Do Not Call"), (2, "Do Not Blast"),
         (3, ""), (3, None)],
        "k int, v string",
    )
    collapsed = label_of_rank(F.max(rank_of_label(F.col("v"), worst)), worst)
    assert rows(df.groupBy("k").agg(collapsed)) == [
        (1, "Do Not Contact"), (2, "Do Not Blast"), (3, None),
    ]


def test_conditional_distinct_counts(spark, rows):
    df = spark.createDataFrame(
        [("g", "t1", 1), ("g", "t1", 0), ("g", "t2", 0), ("g", None, 1), ("h", None, 1)],
        "k string, id string, x int",
    )
    tests = {"n": F.lit(True), "hits": F.col("x") == 1}
    assert rows(count_distinct_where(df, ["k"], "id", tests)) == [("g", 2, 1), ("h", 0, 0)]
    assert rows(count_distinct_where(df, [], "id", tests)) == [(2, 1)]
    per_id = count_distinct_where(df.filter("k = 'g'"), ["id"], "id", tests)
    assert rows(per_id) == [("t1", 1, 1), ("t2", 1, 0), (None, 0, 0)]

    unique = df.filter("x = 0")
    assert rows(count_distinct_where(unique, ["k"], "id", tests, id_is_unique=True)) == rows(
        count_distinct_where(unique, ["k"], "id", tests)
    )


def test_keep_first_limits_groups_before_the_shuffle(spark, rows):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    first = keep_first(df, ["k"], [F.desc("v")])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(first) == [(0, 999), (1, 997), (2, 998)]
