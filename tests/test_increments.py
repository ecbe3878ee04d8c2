"""The table of touches kept between runs, and the order of rows in files."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from compare import SMALL
from rollcall import sinks
from rollcall.plans import actions, increments
from rollcall.sources.sample import SETTINGS, sample_tables
from rollcall.sources.schemas import BASE_TABLES
from test_facts import DATE, STATUS, change


@pytest.fixture
def history(spark):
    def build(*rows):
        schema = BASE_TABLES["history"]
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)

    return build


def noon(day, hour=20):
    return datetime(2024, 1, day, hour)


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        found.update({os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.startswith("part-")})
    return found


def test_a_day_added_gives_what_a_full_run_gives(spark, rows, tmp_path):
    tables = sample_tables(spark, SMALL)
    history, path = tables["history"], str(tmp_path / "touches")
    last = F.col("changed_at") >= F.lit("2024-01-30 07:00:00").cast("timestamp_ntz")
    increments.record(history.filter(~last), SETTINGS, path)
    kept = increments.record(history.filter(last), SETTINGS, path)
    whole = actions.recorded_actions(tables, SETTINGS)
    assert kept.columns == whole.columns and rows(kept) == rows(whole)
    log = actions.confirmation_actions(tables, SETTINGS, kept)
    assert rows(log) == rows(actions.confirmation_actions(tables, SETTINGS))


def test_only_days_with_news_are_written(spark, history, tmp_path):
    path = str(tmp_path / "touches")
    first = [change(str(i), "ann", STATUS, "Confirmed", noon(3 + i % 5)) for i in range(40)]
    increments.record(history(*first), SETTINGS, path)
    before = files(path)
    kept = increments.record(history(change("1", "bob", DATE, None, noon(4))), SETTINGS, path)
    after = files(path)
    changed = {name for name in before.keys() | after.keys() if before.get(name) != after.get(name)}
    assert changed and all("action_date_az=2024-01-04" in name for name in changed)
    assert kept.count() == 41
    plan = kept.filter(F.col("action_date_az") == F.lit(date(2024, 1, 5)))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(action_date_az" in plan


def test_late_repeated_and_missing_times(spark, history, rows, tmp_path):
    path = str(tmp_path / "touches")
    a = change("1", "ann", STATUS, "Confirmed", noon(4, 22))
    earlier = change("1", "ann", DATE, None, noon(4, 19))
    timeless = change("1", "ann", STATUS, "Confirmed", None)
    other = change("2", None, STATUS, "double confirmed", noon(9))
    increments.record(history(a, timeless), SETTINGS, path)
    increments.record(history(earlier, other), SETTINGS, path)
    once = rows(increments.record(history(a), SETTINGS, path))
    assert once == rows(increments.record(history(a, earlier, other, timeless), SETTINGS, path))
    assert once == rows(actions.reduced_touches(history(a, earlier, other, timeless), SETTINGS))
    assert len(once) == 3
    # Nothing new changes nothing, and an empty table can be kept too.
    assert once == rows(increments.record(history(), SETTINGS, path))
    assert increments.record(history(), SETTINGS, str(tmp_path / "empty")).count() == 0


def test_positions_run_through_all_files(spark, tmp_path):
    path = str(tmp_path / "report")
    report = spark.range(1000).selectExpr("id % 7 AS k", "id").orderBy("k", F.desc("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        report.write.option("maxRecordsPerFile", 90).parquet(path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files(path)) > 8
    got = sorted((r.position, r.k, r.id) for r in sinks.in_file_order(spark, path).collect())
    expected = sorted(((i % 7, -i) for i in range(1000)))
    assert got == [(n + 1, k, -i) for n, (k, i) in enumerate(expected)]
