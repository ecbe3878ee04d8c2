from datetime import date

import pytest
from pyspark.sql import functions as F

from compare import SMALL
from rollcall.plans import checks, lists
from rollcall.sinks import write_change_file, write_report
from rollcall.sources.sample import SETTINGS, sample_tables
from rollcall.sources.schemas import BASE_TABLES
from rollcall.sources.tables import Tables, register_views

SPEC = lists.ListSpec("Alpha", "Alpha")


@pytest.fixture(scope="module")
def tables(spark):
    return sample_tables(spark, SMALL)


@pytest.fixture(scope="module")
def listed(spark, tables, tmp_path_factory):
    """The list, written once and read back."""
    path = str(tmp_path_factory.mktemp("list"))
    write_report(lists.customer_list(tables, SPEC, SETTINGS), path)
    return spark.read.parquet(path)


def verdict(df) -> dict:
    return {r["check"]: (r["passed"], r["failing_count"], r["sample"]) for r in df.collect()}


def failed(df) -> set:
    return {name for name, (passed, _, _) in verdict(df).items() if not passed}


def damaged(listed, **columns):
    """The list with one business changed."""
    hit = F.col(checks.CV) == "CV11"
    for name, value in columns.items():
        shown = name.replace("_", " ")
        listed = listed.withColumn(shown, F.when(hit, value).otherwise(F.col(shown)))
    return listed


def test_written_report_keeps_its_columns(listed):
    assert listed.columns == SPEC.columns
    assert listed.filter(f"`{checks.CV}` = 'CV11'").count() == 1


def test_layout(listed):
    assert failed(checks.layout_checks(listed, SPEC)) == set()
    missing = checks.layout_checks(listed.drop("Vertical").limit(0), SPEC)
    assert verdict(missing)["columns_match_layout"] == (False, 1, "Vertical")
    assert failed(missing) == {"columns_match_layout", "returns_rows"}
    swapped = listed.select(*reversed(listed.columns))
    assert failed(checks.layout_checks(swapped, SPEC)) == {"columns_match_layout"}
    assert failed(checks.same_layout_check({"a": listed, "b": listed}, "Alpha")) == set()
    different = checks.same_layout_check({"a": listed, "b": swapped}, "Alpha")
    assert verdict(different)["lists_share_layout"] == (False, 1, "b")


def test_layout_is_agreed_apart_from_the_list(spark, monkeypatch):
    made = lists._display

    def swapped(flagship):
        names = made(flagship)
        return names | {"elite_status": names["vertical"], "vertical": names["elite_status"]}

    monkeypatch.setattr(lists, "_display", swapped)
    worse = lists.customer_list(sample_tables(spark, SMALL), SPEC, SETTINGS)
    assert worse.columns == SPEC.columns  # the list agrees with its own code
    assert failed(checks.layout_checks(worse, SPEC)) == {"columns_match_layout"}


def test_keys(listed):
    twice = listed.union(listed.limit(3)).union(
        listed.limit(1).withColumn(checks.CV, F.lit(None).cast("string"))
    )
    got = verdict(checks.key_checks(twice))
    assert got["one_row_per_business"][:2] == (False, 3)
    assert got["key_is_present"] == (False, 1, None)
    assert failed(checks.key_checks(listed)) == set()


def test_rows(listed):
    assert failed(checks.row_checks(listed)) == set()
    bad = damaged(listed, Total_Tickets=F.lit(999))
    assert failed(checks.row_checks(bad)) == {"status_counts_sum_to_total", "summary_adds_up"}
    assert verdict(checks.row_checks(bad))["summary_adds_up"] == (False, 1, "CV11")
    label = damaged(listed, Unscheduled_Ticket_Group=F.lit(None))
    assert failed(checks.row_checks(label)) == {"group_label_matches"}
    all_bad = checks.row_checks(listed.withColumn("Unscheduled Tickets", F.lit(-1)))
    sample = verdict(all_bad)["unscheduled_is_sum"][2]
    assert sample.endswith(" ...") and sample.count(",") == 4


def test_population(listed, tables):
    assert failed(checks.population_checks(listed, tables, SPEC, SETTINGS)) == set()
    extra = listed.filter(F.col(checks.CV) != "CV11").union(
        listed.limit(1).withColumn(checks.CV, F.lit("CVx"))
    )
    assert verdict(checks.population_checks(extra, tables, SPEC, SETTINGS)) == {
        "every_expected_is_listed": (False, 1, "CV11"),
        "every_listed_is_expected": (False, 1, "CVx"),
    }


def test_recounts(listed, tables):
    assert failed(checks.recount_checks(listed, tables, SPEC, SETTINGS)) == set()
    bad = damaged(
        listed,
        Open_Tickets=F.lit(99),
        Next_Event_Date=F.lit(date(2030, 1, 1)),
        Alpha_Customer=F.lit("Maybe"),
        Elite_Status=F.lit("E999"),
        Vertical=F.lit("?"),
        **{"Last_Blast_(This_Product)": F.lit(date(2030, 1, 1))},
    )
    assert failed(checks.recount_checks(bad, tables, SPEC, SETTINGS)) == {
        "status_counts_match", "dates_match", "first_flagship_purchase_matches",
        "elite_label_matches", "verticals_match", "touch_dates_match",
    }


def test_rerun(listed):
    assert failed(checks.rerun_check(listed, listed)) == set()
    other = damaged(listed, Contact_Name=F.lit("Someone"))
    assert verdict(checks.rerun_check(listed, other))["same_contacts_on_rerun"] == (
        False, 1, "CV11",
    )


def test_profile(listed):
    shares = {r["column"]: r["blank_share"] for r in checks.blank_shares(listed).collect()}
    assert list(shares) and 0 < shares["Contact Email"] < 1 and shares["First Purchase Date"] == 0
    assert checks.group_histogram(listed).agg(F.sum("businesses")).first()[0] == listed.count()


def test_snapshots(spark, listed, tables, tmp_path, rows):
    old = listed.filter(~F.col(checks.CV).isin("CV11", "CV13")).union(
        listed.limit(1).withColumn(checks.CV, F.lit("CV999"))
    )
    changes = checks.snapshot_diff(old, listed)
    assert rows(changes) == [("CV11", "added"), ("CV13", "added"), ("CV999", "removed")]
    n = listed.count()
    assert rows(checks.snapshot_summary(old, listed)) == [(n - 1, n, 2, 1)]

    path = str(tmp_path / "changes")
    write_change_file(changes, path)
    files = sorted((tmp_path / "changes").glob("*.csv"))
    lines = [line for f in files for line in f.read_text().splitlines()]
    assert [line for line in lines if not line.startswith("cv_")] == [
        "CV999,removed", "CV11,added", "CV13,added",
    ]

    assert failed(checks.removal_check(changes, tables, SPEC, SETTINGS)) == set()
    dropped = checks.snapshot_diff(listed, listed.filter(F.col(checks.CV) != "CV11"))
    assert verdict(checks.removal_check(dropped, tables, SPEC, SETTINGS)) == {
        "every_removal_is_explained": (False, 1, "CV11"),
    }


# --- sources -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    for name in BASE_TABLES:
        tables[name].write.parquet(str(root / name))
    return Tables.from_parquet(spark, str(root))


def test_stored_tables_give_the_same_list(stored, listed, rows):
    assert rows(lists.customer_list(stored, SPEC, SETTINGS)) == rows(listed)


def test_filters_and_columns_reach_the_scan(stored):
    summary = lists.status_summary(stored, "Alpha")
    plan = summary._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1
    assert "EqualTo(is_deleted,0)" in scans[0]
    assert "ReadSchema: struct<customer_id:bigint,product_name:string,status:string,is_deleted:int>" in scans[0]

    counted = lists.ticket_ids(lists.product_tickets(stored, "Alpha"))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(product_name,Alpha)" in plan


def test_keys_are_cast_once_when_loaded(spark):
    raw = spark.range(3).select(F.col("id").alias("Customer"), F.col("id").alias("Person"))
    with pytest.raises(ValueError, match="StaffTitleName, IsActiveName"):
        Tables.of({"dim_customer_contact": raw})["dim_customer_contact"]
    whole = raw.withColumns({"StaffTitleName": F.lit("x"), "IsActiveName": F.lit("y")})
    loaded = Tables.of({"dim_customer_contact": whole})
    assert loaded["dim_customer_contact"].dtypes[:2] == [
        ("Customer", "string"), ("Person", "bigint"),
    ]
    with pytest.raises(KeyError):
        loaded["nothing"]


def test_views_and_catalog_tables(spark, tables):
    register_views({"customers_now": tables["customers"]})
    named = Tables.from_catalog(spark, {"customers": "customers_now"})
    assert named["customers"].count() == tables["customers"].count()


def test_a_rerun_has_no_fixed_number_of_tasks(spark, monkeypatch):
    """The second run of the lists gets its rows dealt otherwise, to as many tasks as any shuffle."""
    import __spark_entry__ as entry
    from compare import SMALL

    made = []

    def noted(tables, specs, settings):
        made.append(tables)
        return {name: spark.createDataFrame([], "x int") for name in specs}

    monkeypatch.setattr(entry.lists, "customer_lists", noted)
    monkeypatch.setattr(entry.checks, "rerun_check", lambda first, second, lists: second)
    entry.queries()["checks_rerun"](spark, SMALL)
    for name in ("tickets", "attendees"):
        plan = made[1][name]._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression [xxhash64(" in plan
        assert sorted(made[1][name].collect(), key=repr) == sorted(made[0][name].collect(), key=repr)
