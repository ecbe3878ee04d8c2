from compare import SMALL
from rollcall.plans import actions, increments, lists, reports
from rollcall.plans.publish import publish
from rollcall.plans.tickets import tickets_all
from rollcall.sources.sample import SETTINGS, sample_tables


def test_publish_writes_what_the_pipelines_compute(spark, rows, tmp_path):
    tables = sample_tables(spark, SMALL)
    specs = {"alpha": lists.ListSpec("Alpha", "Alpha")}
    before = spark.createDataFrame([("CV1",), ("gone",)], ["CV Customer ID"])
    written = publish(tables, specs, SETTINGS, str(tmp_path), {"alpha": before})
    assert len(written) == 25

    def stored(name):
        return spark.read.parquet(written[name])

    log = actions.confirmation_actions(tables, SETTINGS)
    assert rows(stored("confirmation_actions")) == rows(log)
    done = actions.ticket_actions(tables, SETTINGS)
    depth = reports.depth_per_ticket(done, tables["dim_event"])
    assert rows(stored("depth_per_ticket")) == rows(depth)
    assert stored("list_alpha").columns == specs["alpha"].columns
    assert stored("measures_confirmations").columns[0] == "Confirmations"
    verdicts = stored("checks_alpha").collect()
    assert len({r["check"] for r in verdicts}) == 16 and all(r["passed"] for r in verdicts)
    changes = spark.read.option("header", True).csv(written["changes_alpha"])
    summary = stored("summary_alpha").first()
    assert changes.filter("change = 'removed'").collect()[0][0] == "gone"
    assert changes.filter("change = 'added'").count() == summary["added"]
    assert (summary["old_businesses"], summary["removed"]) == (2, summary["removed"])
    assert summary["new_businesses"] == stored("list_alpha").count()


def test_publish_with_buckets_and_kept_touches(spark, rows, tmp_path):
    tables = sample_tables(spark, SMALL)
    kept = increments.record(tables["history"], SETTINGS, str(tmp_path / "touches"))
    no_history = tables.replaced(history=tables["history"].limit(0))
    written = publish(no_history, {}, SETTINGS, str(tmp_path / "out"), buckets=4, recorded=kept)
    log = actions.confirmation_actions(tables, SETTINGS)
    assert rows(spark.table("rollcall_confirmation_actions")) == rows(log)
    overview = reports.event_overview(tickets_all(tables), tables["dim_event"], SETTINGS)
    assert rows(spark.read.parquet(written["event_overview"])) == rows(overview)
    for name in ("tickets_all", "confirmation_actions"):
        spark.sql(f"DROP TABLE rollcall_{name}")
