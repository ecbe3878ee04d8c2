"""Kept versions of the lists, and facts in buckets."""

import pytest
from pyspark.sql import functions as F

from compare import SMALL
from rollcall.plans import actions, checks, contexts, versions
from rollcall.plans.checks import CV
from rollcall.plans.tickets import tickets_all
from rollcall.sinks import staged, write_bucketed
from rollcall.sources.sample import SETTINGS, sample_tables


@pytest.fixture
def ids(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), f"list string, `{CV}` string")

    return build


def test_only_buckets_that_differ_are_read(spark, ids, rows, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    many = [(name, f"CV{i}") for name in ("a", "b") for i in range(500)]
    versions.keep(ids(*many, ("a", None)), old, buckets=32)
    versions.keep(ids(*many[3:][::-1], ("b", "CV9999"), ("b", "CV1")), new, buckets=32)
    changed = versions.differing(spark, old, new)
    assert 0 < len(changed) <= 6
    got = versions.changes(spark, old, new)
    gone = [("a", f"CV{i}", "removed") for i in range(3)]
    assert rows(got) == sorted([*gone, ("a", None, "removed"), ("b", "CV9999", "added")], key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("PartitionFilters: [bucket") == 2
    assert versions.differing(spark, old, old) == [] and versions.changes(spark, old, old).count() == 0


def test_a_version_against_an_empty_one(spark, ids, rows, tmp_path):
    some, none = str(tmp_path / "some"), str(tmp_path / "none")
    versions.keep(ids(("a", "CV1"), ("b", "CV1")).drop("list"), some, buckets=4)
    versions.keep(ids().drop("list"), none, buckets=4)
    assert rows(versions.changes(spark, some, none)) == [("CV1", "removed")]
    assert rows(versions.changes(spark, none, some)) == [("CV1", "added")]


def test_kept_versions_tell_what_the_whole_lists_tell(spark, rows, tmp_path):
    old = spark.range(0, 3000, 2).selectExpr(f"concat('CV', id) AS `{CV}`", "'x' AS list")
    new = spark.range(0, 3000, 3).selectExpr(f"concat('CV', id) AS `{CV}`", "'x' AS list")
    for name, df in (("old", old), ("new", new)):
        versions.keep(df, str(tmp_path / name))
    kept = versions.changes(spark, str(tmp_path / "old"), str(tmp_path / "new"))
    assert rows(kept) == rows(checks.snapshot_diff(old, new))


def test_facts_in_buckets_are_not_shuffled(spark, rows, tmp_path):
    tables = sample_tables(spark, SMALL)
    log, tickets = staged(actions.confirmation_actions(tables, SETTINGS)), staged(tickets_all(tables))
    dims = (tables["dim_event"], tables["customers"], tables["dim_employee"])
    plain = contexts.Model(log, tickets, *dims)
    bucketed = contexts.Model(
        write_bucketed(log, "log_in_buckets", str(tmp_path / "log"), "ticket_id", 4),
        write_bucketed(tickets, "tickets_in_buckets", str(tmp_path / "tickets"), "ticket_id", 4),
        *dims,
    )
    context = contexts.Context(tickets={"product_name": F.col("product_name").contains("VIP")})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("confirmations", "outcomes", "depth"):
            for groups in ([], ["user_email"]):
                df = contexts.measured(name, bucketed, context, groups, SETTINGS)
                plan = df._jdf.queryExecution().executedPlan().toString()
                shuffles = [line for line in plan.splitlines() if "Exchange" in line]
                # What is counted per ticket is all that is shuffled.
                assert len(shuffles) == 1 and "ticket_id" not in shuffles[0], name
                assert rows(df) == rows(contexts.measured(name, plain, context, groups, SETTINGS))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for table in ("log_in_buckets", "tickets_in_buckets"):
            spark.sql(f"DROP TABLE {table}")
