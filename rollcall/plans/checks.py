"""Reconciliation of a customer list against independent recounts.

Every check yields (check, passed, failing_count, sample). Failing businesses
are found by joins and grouping on the business id; ``sample`` names the first
few. The recounts are keyed by CRM id and share no code with the lists.

All checks take one list, or several at once: rows of several lists (``together``)
have a column ``list``, and so have their verdicts. A recount then reads each table
once: a ticket is tagged with all lists that it belongs to, rows are reduced by
business and tags, and only what is left is dealt to the lists.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.operators.aggregates import text_list
from rollcall.plans.lists import PLACEHOLDER_EMAIL, ListSpec, with_sale
from rollcall.settings import Settings
from rollcall.sources.tables import Tables

CV = "CV Customer ID"
SAMPLE_SIZE = 5

# Fixed values.
ELITE_LABELS = {"3": "E125", "4": "E250"}
COUNT_COLUMNS = {
    "open": "Open Tickets",
    "undecided": "Undecided Tickets",
    "undecided_at_sale": "Undecided at Sale Tickets",
    "expired": "Expired Tickets",
    "assigned": "Assigned Tickets",
    "scheduled": "Scheduled Tickets",
    "reserved": "Reserved Tickets",
    "attended": "Attended Tickets",
    "no show": "No Show Tickets",
    "cancelled": "Cancelled Tickets",
}
# The agreed columns of a list, in order.
LAYOUT = """
Business Name
CV Customer ID
Contact Name
Contact Email
Contact Phone
Contact Source
Unscheduled Ticket Group
Total Tickets
Unscheduled Tickets
Open Tickets
Undecided Tickets
Undecided at Sale Tickets
Expired Tickets
Assigned Tickets
Scheduled Tickets
Reserved Tickets
Attended Tickets
No Show Tickets
Cancelled Tickets
First Purchase Date
Latest Purchase Date
Days Since Latest Purchase
Next Event Date
Last Attended Event Date
Outreach Restriction
Last Blast (This Product)
Last Call (This Product)
Days Since Last Contact (This Product)
Last Blast (All Products)
Last Call (All Products)
Days Since Last Contact (All Products)
Elite Status
PR Client Status
SBU Client Status
Annual Business Revenue
Vertical
Sub-Vertical
{flagship} Customer
First {flagship} Purchase Date
Queue Start Date
Days in Queue
Ticket Types
Ticket IDs
Sales Order Numbers
Ticket Summary (This Product)
Ticket Summary (All Products)
Generated At
"""
CONTACT_COLUMNS = ["Contact Source", "Contact Email", "Contact Name", "Contact Phone"]
PROFILED_COLUMNS = [
    "Contact Email", "Annual Business Revenue", "Vertical", "Elite Status",
    "First Purchase Date", "Last Blast (This Product)",
]


Specs = Mapping[str, ListSpec]
BUYER, BOUGHT_ON = "Flagship Customer", "First Flagship Purchase Date"


def together(lists: Mapping[str, DataFrame], specs: Specs) -> DataFrame:
    """The rows of several lists, told apart by column ``list``; the two columns that are named
    after a list's flagship product have common names."""
    parts = [
        _common(df, specs[name].flagship).withColumn("list", F.lit(name)) for name, df in lists.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _common(listed: DataFrame, flagship: str) -> DataFrame:
    names = {f"{flagship} Customer": BUYER, f"First {flagship} Purchase Date": BOUGHT_ON}
    return listed.withColumnsRenamed(names)


def _prepared(listed: DataFrame, spec: ListSpec | Specs) -> tuple[DataFrame, Specs]:
    """Rows with a column ``list`` and the lists' parameters, of one list or of several."""
    if isinstance(spec, ListSpec):
        return _common(listed, spec.flagship).withColumn("list", F.lit("")), {"": spec}
    return listed, spec


def _as_given(verdicts: DataFrame, spec: ListSpec | Specs) -> DataFrame:
    return verdicts.drop("list") if isinstance(spec, ListSpec) else verdicts


def _by_list(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c == "list"]


def _verdict(check: str | Column, failing: Column, sample: Column) -> list[Column]:
    name = F.lit(check) if isinstance(check, str) else check
    return [
        name.alias("check"),
        (failing == 0).alias("passed"),
        failing.cast("bigint").alias("failing_count"),
        sample.cast("string").alias("sample"),
    ]


def verdicts(
    rows: DataFrame, id_col: str, tests: Mapping[str, Column], lists: Collection[str] = ()
) -> DataFrame:
    """One verdict per test over the rows (and per list, of rows that have one); a NULL test fails.

    Counts and samples read the same columns of the same failing rows, so they
    share the shuffles beneath. The samples keep the first few ids per test on
    the map side, before anything is shuffled.
    """
    keys = [*_by_list(rows), "check"]
    outcomes = F.array(
        *[
            F.struct(F.lit(name).alias("check"), F.coalesce(test, F.lit(False)).alias("ok"))
            for name, test in tests.items()
        ]
    )
    failing = rows.select(*keys[:-1], F.col(id_col).alias("id"), F.inline(outcomes)).filter(~F.col("ok"))
    counted = failing.groupBy(*keys).agg(
        (F.count("id") + F.count_if(F.col("id").isNull())).alias("failing")
    )
    in_order = Window.partitionBy(*keys).orderBy("id")
    first = (
        failing.filter(F.col("id").isNotNull())
        .withColumn("place", F.row_number().over(in_order))
        .filter(F.col("place") <= SAMPLE_SIZE + 1)
        .withColumn("shown", F.when(F.col("place") <= SAMPLE_SIZE, F.col("id")))
    )
    samples = first.groupBy(*keys).agg(
        F.concat(
            text_list("shown", order="place"),
            F.when(F.max("place") > SAMPLE_SIZE, " ...").otherwise(""),
        ).alias("sample")
    )
    named = [(*one, name) for one in ([(x,) for x in lists] if lists else [()]) for name in tests]
    names = rows.sparkSession.createDataFrame(named, ", ".join(f"{k} string" for k in keys))
    return (
        names.join(counted, keys, "left")
        .join(samples, keys, "left")
        .select(
            *keys[:-1],
            *_verdict(F.col("check"), F.coalesce("failing", F.lit(0)), F.col("sample")),
        )
    )


# --- independent recounts, keyed by CRM id -------------------------------------


def _tags(column: str, texts: Mapping[str, str]) -> Column:
    """Names of the lists whose text the column contains."""
    return F.array_compact(
        F.array(*[F.when(F.col(column).contains(text), name) for name, text in texts.items()])
    )


def _of_some(column: str, texts: Mapping[str, str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(column).contains(t) for t in set(texts.values())])


def _tagged_tickets(tables: Tables, specs: Specs) -> DataFrame:
    """Live tickets of a business, with the ``lists`` whose product they are for."""
    products = {name: spec.product for name, spec in specs.items()}
    return (
        tables["tickets"]
        .filter(
            _of_some("product_name", products)
            & (F.col("is_deleted") == 0)
            & F.col("customer_id").isNotNull()
        )
        .withColumn("lists", _tags("product_name", products))
    )


def _with_cv(per_business: DataFrame, tables: Tables) -> DataFrame:
    """Adds the CRM id to rows that are already reduced to one per business and tags."""
    customers = tables["customers"].select(
        F.col("id").alias("customer_id"), F.col("cv_customer_id").alias("cv")
    )
    return per_business.join(customers, "customer_id").drop("customer_id")


def _dealt(tagged: DataFrame) -> DataFrame:
    """A row for each list that a row is tagged with."""
    return tagged.withColumn("list", F.explode("lists")).drop("lists")


def recount(tables: Tables, specs: Specs, settings: Settings) -> DataFrame:
    """Status counts and purchase and event dates per list and business."""
    sales = tables["transactions"].select(
        F.col("cv_transaction_id").alias("transaction_id"),
        F.to_date("transaction_date").alias("bought"),
    )
    status, event = F.lower("status"), F.col("event_date")
    booked = status.isin("scheduled", "reserved") & (event >= settings.today)
    counts = [f"n_{s}" for s in COUNT_COLUMNS]
    per_business = (
        with_sale(_tagged_tickets(tables, specs), sales)
        .groupBy("customer_id", "lists")
        .agg(
            *[F.count_if(status == s).alias(f"n_{s}") for s in COUNT_COLUMNS],
            F.min("bought").alias("first_bought"),
            F.max("bought").alias("last_bought"),
            F.min(F.when(booked, event)).alias("next_event"),
            F.max(F.when(status == "attended", event)).alias("last_attended"),
        )
    )
    return (
        _dealt(_with_cv(per_business, tables))
        .groupBy("list", "cv")
        .agg(
            *[F.sum(n).alias(n) for n in counts],
            *[F.min(d).alias(d) for d in ("first_bought", "next_event")],
            *[F.max(d).alias(d) for d in ("last_bought", "last_attended")],
        )
    )


def flagship_dates(tables: Tables, specs: Specs, listed: DataFrame) -> DataFrame:
    """First paid flagship line per list and business; the ledger is cut to the businesses listed."""
    flagships = {name: spec.flagship for name, spec in specs.items()}
    products = tables["dim_product"].filter(_of_some("ProductName", flagships))
    tagged = products.select("CVProductID", _tags("ProductName", flagships).alias("lists"))
    per_business = (
        tables["fact_gl"]
        .filter((F.col("GLLineID") != 0) & (F.col("SalesOrderCashCollected") > 0))
        .join(tagged, "CVProductID")
        .withColumnRenamed("CVCustomerID", "cv")
        .join(listed.select("cv"), "cv", "left_semi")
        .groupBy("cv", "lists")
        .agg(F.min("GLDate").alias("flagship_date"))
    )
    return _dealt(per_business).groupBy("list", "cv").agg(F.min("flagship_date").alias("flagship_date"))


def master_data(tables: Tables) -> DataFrame:
    code = F.col("EliteStatus")
    label = F.lit(None).cast("string")
    for value, text in ELITE_LABELS.items():
        label = F.when(code == value, text).otherwise(label)
    return tables["dim_customer"].select(
        F.col("CVCustomerID").alias("cv"),
        label.alias("elite_label"),
        F.col("VerticalName").alias("dim_vertical"),
        F.col("SubVerticalName").alias("dim_sub_vertical"),
    )


def touch_dates(tables: Tables, specs: Specs, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Latest blast and call per list and business, and per business for all products.

    The contact log is cut to tickets of the businesses listed before it is aggregated.
    """
    products = {name: spec.product for name, spec in specs.items()}
    customers = tables["customers"].select(
        F.col("id").alias("customer_id"), F.col("cv_customer_id").alias("cv")
    )
    # An id that stands for several CRM ids stands for each of them.
    tickets = (
        tables["tickets"]
        .select("ticket_id", "customer_id", _tags("product_name", products).alias("lists"))
        .join(customers.join(listed.select("cv"), "cv", "left_semi"), "customer_id")
    )
    log = tables["attendee_tickets"].join(tickets.select("ticket_id"), "ticket_id", "left_semi")
    per_ticket = log.groupBy("ticket_id").agg(
        F.max("blast_date").alias("blast"), F.max("last_called_date").alias("call")
    )
    per_business = (
        tickets.withColumn("lists", F.coalesce("lists", F.array().cast("array<string>")))
        .join(per_ticket, "ticket_id")
        .groupBy("cv", "lists")
        .agg(F.max("blast").alias("blast"), F.max("call").alias("call"))
    )
    of_product = _dealt(per_business).groupBy("list", "cv").agg(
        F.max("blast").alias("blast_product"), F.max("call").alias("call_product")
    )
    of_all = per_business.groupBy("cv").agg(
        F.max("blast").alias("blast_all"), F.max("call").alias("call_all")
    )
    return of_product, of_all


def buyers(tables: Tables, specs: Specs, settings: Settings) -> DataFrame:
    """list, cv: businesses with a ticket for the product whose buyer can be reached."""

    def usable(email: str) -> Column:
        blank = [marker.rstrip(" ") for marker in settings.junk]
        return F.col(email).isNotNull() & ~F.rtrim(email).isin(blank)

    sales = tables["transactions"].select(
        F.col("cv_transaction_id").alias("transaction_id"),
        F.col("purchaser_email").alias("sale_email"),
    )
    found = with_sale(_tagged_tickets(tables, specs), sales).filter(
        usable("purchaser_email") | usable("sale_email")
    )
    return _dealt(_with_cv(found.select("customer_id", "lists").distinct(), tables))


def reachable(tables: Tables) -> DataFrame:
    """Ids of the businesses with a contact that does not come from a ticket."""
    attendees = tables["attendees"].filter(~F.col("attendee_email").contains(PLACEHOLDER_EMAIL))
    entities = (
        tables["dim_customer"]
        .select(F.col("CVCustomerID").alias("cv"), F.col("NetSuiteID").alias("EntityID"))
        .join(tables["silver_entity"].filter(F.rtrim("Email") != ""), "EntityID")
    )
    owners = (
        tables["dim_customer_contact"]
        .filter((F.col("StaffTitleName") == "Owner") & (F.col("IsActiveName") == "Yes"))
        .select(F.col("Customer").alias("cv"), F.col("Person").alias("CVPersonID"))
        .join(tables["dim_person"].filter(F.rtrim("Email") != ""), "CVPersonID")
    )
    people = _with_cv(attendees.select("customer_id").distinct(), tables)
    return reduce(DataFrame.union, [df.select("cv") for df in (people, entities, owners)])


def expected_businesses(tables: Tables, specs: Specs, settings: Settings) -> DataFrame:
    """list, cv: businesses that have both a ticket for the product and a contact."""
    holders = _dealt(
        _with_cv(_tagged_tickets(tables, specs).select("customer_id", "lists").distinct(), tables)
    )
    with_contact = holders.join(reachable(tables), "cv", "left_semi").select("list", "cv")
    bought = buyers(tables, specs, settings).select("list", "cv")
    return with_contact.union(bought).filter(F.col("cv").isNotNull()).distinct()


# --- checks ---------------------------------------------------------------------


def _total(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


def _same(shown: str, recounted: str) -> Column:
    return F.col(shown).eqNullSafe(F.col(recounted))


def _blank_as_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def agreed_layout(flagship: str) -> list[str]:
    return LAYOUT.strip().format(flagship=flagship).splitlines()


def layout_checks(listed: DataFrame, spec: ListSpec) -> DataFrame:
    """The agreed columns in the agreed order, and at least one row."""
    agreed = agreed_layout(spec.flagship)
    misplaced = [c for c in agreed if c not in listed.columns]
    misplaced += [c for c in listed.columns if c not in agreed]
    wrong_layout = listed.columns != agreed
    rows = listed.limit(1).agg(F.count("*").alias("rows"))
    sample = F.lit(", ".join(misplaced) or None)
    failing = max(len(misplaced), int(wrong_layout))
    return rows.select(*_verdict("columns_match_layout", F.lit(failing), sample)).unionByName(
        rows.select(*_verdict("returns_rows", 1 - F.col("rows"), F.lit(None)))
    )


def key_checks(listed: DataFrame, lists: Collection[str] = ()) -> DataFrame:
    keys = listed.groupBy(*_by_list(listed), CV).agg(F.count("*").alias("rows"))
    return verdicts(
        keys,
        CV,
        {"key_is_present": F.col(CV).isNotNull(), "one_row_per_business": F.col("rows") == 1},
        lists,
    )


def row_checks(listed: DataFrame, lists: Collection[str] = ()) -> DataFrame:
    """Agreement between the columns of a row."""
    c = COUNT_COLUMNS
    active = _total([c["open"], c["undecided"], c["undecided_at_sale"]])
    expired = _total([c["expired"]])
    label = (
        F.when(active + expired == 0, "Nothing to Schedule")
        .when(active == 0, "Expired Only")
        .when(expired == 0, "Open/Undecided Only")
        .otherwise("Open/Undecided + Expired")
    )
    numbers = F.regexp_extract_all("Ticket Summary (This Product)", F.lit(r" x(\d+)"), F.lit(1))
    in_summary = F.aggregate(
        F.coalesce(numbers, F.array().cast("array<string>")),
        F.lit(0).cast("bigint"),
        lambda total, n: total + n.cast("bigint"),
    )
    return verdicts(
        listed,
        CV,
        {
            "status_counts_sum_to_total": F.col("Total Tickets") == _total(list(c.values())),
            "unscheduled_is_sum": F.col("Unscheduled Tickets") == active + expired,
            "group_label_matches": F.col("Unscheduled Ticket Group") == label,
            "summary_adds_up": in_summary == F.col("Total Tickets"),
        },
        lists,
    )


def population_checks(
    listed: DataFrame, tables: Tables, spec: ListSpec | Specs, settings: Settings
) -> DataFrame:
    """The listed businesses are the expected ones, no more and no fewer."""
    rows, specs = _prepared(listed, spec)
    both = (
        rows.select("list", F.col(CV).alias("cv"), F.lit(1).alias("listed"), F.lit(0).alias("expected"))
        .filter(F.col("cv").isNotNull())
        .unionByName(
            expected_businesses(tables, specs, settings).select(
                "list", "cv", F.lit(0).alias("listed"), F.lit(1).alias("expected")
            )
        )
        .groupBy("list", "cv")
        .agg(F.max("listed").alias("listed"), F.max("expected").alias("expected"))
    )
    found = verdicts(
        both,
        "cv",
        {
            "every_expected_is_listed": F.col("listed") >= F.col("expected"),
            "every_listed_is_expected": F.col("expected") >= F.col("listed"),
        },
        specs,
    )
    return _as_given(found, spec)


def recount_checks(
    listed: DataFrame, tables: Tables, spec: ListSpec | Specs, settings: Settings
) -> DataFrame:
    """Counts, dates and master data equal their recounts on every row."""
    rows, specs = _prepared(listed, spec)
    rows = rows.withColumnRenamed(CV, "cv")
    touched, touched_at_all = touch_dates(tables, specs, rows)
    rows = (
        rows.join(recount(tables, specs, settings), ["list", "cv"])
        .join(flagship_dates(tables, specs, rows), ["list", "cv"], "left")
        .join(touched, ["list", "cv"], "left")
        .join(touched_at_all, "cv", "left")
        .join(master_data(tables), "cv", "left")
    )

    counts = [
        F.coalesce(F.col(shown), F.lit(0)) == F.col(f"n_{s}") for s, shown in COUNT_COLUMNS.items()
    ]
    dates = [
        _same("First Purchase Date", "first_bought"),
        _same("Latest Purchase Date", "last_bought"),
        _same("Next Event Date", "next_event"),
        _same("Last Attended Event Date", "last_attended"),
    ]
    bought = F.when(F.col("flagship_date").isNotNull(), "Yes").otherwise("No")
    touches = [
        _same("Last Blast (This Product)", "blast_product"),
        _same("Last Call (This Product)", "call_product"),
        _same("Last Blast (All Products)", "blast_all"),
        _same("Last Call (All Products)", "call_all"),
    ]
    verticals = [
        _blank_as_null(F.col(shown)).eqNullSafe(_blank_as_null(F.col(dim)))
        for shown, dim in [("Vertical", "dim_vertical"), ("Sub-Vertical", "dim_sub_vertical")]
    ]

    def every(tests: Sequence[Column]) -> Column:
        return reduce(lambda a, b: a & b, tests)

    found = verdicts(
        rows,
        "cv",
        {
            "status_counts_match": every(counts),
            "dates_match": every(dates),
            "first_flagship_purchase_matches": every(
                [_same(BOUGHT_ON, "flagship_date"), F.col(BUYER) == bought]
            ),
            "elite_label_matches": _blank_as_null(F.col("Elite Status")).eqNullSafe(
                F.col("elite_label")
            ),
            "verticals_match": every(verticals),
            "touch_dates_match": every(touches),
        },
        specs,
    )
    return _as_given(found, spec)


def rerun_check(first: DataFrame, second: DataFrame, lists: Collection[str] = ()) -> DataFrame:
    """The same contact for every business in two runs of the lists."""
    keys = [*_by_list(first), CV]
    fields = [*keys, *CONTACT_COLUMNS]
    balance = (
        first.select(*fields, F.lit(1).alias("side"))
        .unionByName(second.select(*fields, F.lit(-1).alias("side")))
        .groupBy(*fields)
        .agg(F.sum("side").alias("balance"))
        .groupBy(*keys)
        .agg(F.max(F.abs("balance")).alias("difference"))
    )
    return verdicts(balance, CV, {"same_contacts_on_rerun": F.col("difference") == 0}, lists)


def same_layout_check(lists: Mapping[str, DataFrame], flagship: str) -> DataFrame:
    """All lists have the agreed columns in the same order; names the lists that do not."""
    agreed = agreed_layout(flagship)
    different = [name for name, df in lists.items() if df.columns != agreed]
    any_list = next(iter(lists.values()))
    one_row = any_list.limit(1).agg(F.count("*").alias("rows"))
    sample = F.lit(", ".join(different) or None)
    return one_row.select(*_verdict("lists_share_layout", F.lit(len(different)), sample))


# --- profile --------------------------------------------------------------------


def blank_shares(listed: DataFrame) -> DataFrame:
    """Share of blank (NULL, empty, zero) values of selected columns."""

    def blank(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.coalesce(value.isin("", "0"), F.lit(True))

    keys = _by_list(listed)
    counted = listed.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        *[F.count_if(blank(name)).alias(name) for name in PROFILED_COLUMNS],
    )
    share = F.try_divide(F.col("blank").cast("double"), F.col("rows").cast("double"))
    return counted.unpivot([*keys, "rows"], PROFILED_COLUMNS, "column", "blank").select(
        *keys, "column", "blank", "rows", share.alias("blank_share")
    )


def group_histogram(listed: DataFrame) -> DataFrame:
    label = F.col("Unscheduled Ticket Group").alias("label")
    return listed.groupBy(*_by_list(listed), label).agg(F.count("*").alias("businesses"))


def flagship_share(listed: DataFrame, spec: ListSpec | Specs) -> DataFrame:
    name = f"{spec.flagship} Customer" if isinstance(spec, ListSpec) else BUYER
    customers = F.count_if(F.col(name) == "Yes")
    return listed.groupBy(*_by_list(listed)).agg(
        customers.alias("flagship_customers"), F.count("*").alias("businesses")
    )


# --- two versions ---------------------------------------------------------------


def _sides(old_ids: DataFrame, new_ids: DataFrame) -> DataFrame:
    """One row per business of either version (in each list), with a flag for each."""
    keys = _by_list(old_ids)
    sides = {"old": (old_ids, 1, 0), "new": (new_ids, 0, 1)}
    marked = [
        ids.select(
            *keys, F.col(CV).alias("cv_customer_id"), F.lit(old).alias("old"), F.lit(new).alias("new")
        )
        for ids, old, new in sides.values()
    ]
    return (
        reduce(DataFrame.unionByName, marked)
        .groupBy(*keys, "cv_customer_id")
        .agg(F.max("old").alias("old"), F.max("new").alias("new"))
    )


def snapshot_diff(old_ids: DataFrame, new_ids: DataFrame) -> DataFrame:
    """(cv_customer_id, change) for businesses in one version only."""
    change = F.when(F.col("old") == 1, "removed").otherwise("added")
    return (
        _sides(old_ids, new_ids)
        .filter(F.col("old") != F.col("new"))
        .select(*_by_list(old_ids), "cv_customer_id", change.alias("change"))
    )


def snapshot_summary(old_ids: DataFrame, new_ids: DataFrame) -> DataFrame:
    """How many businesses each version has, and how many came and went, from one pass."""
    known, old, new = F.col("cv_customer_id").isNotNull(), F.col("old") == 1, F.col("new") == 1
    return _sides(old_ids, new_ids).groupBy(*_by_list(old_ids)).agg(
        F.count_if(known & old).alias("old_businesses"),
        F.count_if(known & new).alias("new_businesses"),
        F.count_if(new & ~old).alias("added"),
        F.count_if(old & ~new).alias("removed"),
    )


def list_checks(listed: DataFrame, tables: Tables, spec: ListSpec, settings: Settings) -> DataFrame:
    """All checks of one stored list."""
    parts = [
        layout_checks(listed, spec),
        key_checks(listed),
        row_checks(listed),
        population_checks(listed, tables, spec, settings),
        recount_checks(listed, tables, spec, settings),
    ]
    return reduce(DataFrame.unionByName, parts)


def checks_of_lists(
    lists: Mapping[str, DataFrame], tables: Tables, specs: Specs, settings: Settings
) -> DataFrame:
    """All checks of several stored lists, with one recount for all of them."""
    rows = together(lists, specs)
    parts = [
        *[layout_checks(df, specs[name]).withColumn("list", F.lit(name)) for name, df in lists.items()],
        key_checks(rows, specs),
        row_checks(rows, specs),
        population_checks(rows, tables, specs, settings),
        recount_checks(rows, tables, specs, settings),
    ]
    return reduce(DataFrame.unionByName, parts)


def removal_check(
    changes: DataFrame, tables: Tables, spec: ListSpec | Specs, settings: Settings
) -> DataFrame:
    """Every removed business has lost its live tickets or its contacts."""
    specs = {"": spec} if isinstance(spec, ListSpec) else spec
    removed = changes.filter(F.col("change") == "removed")
    if isinstance(spec, ListSpec):
        removed = removed.withColumn("list", F.lit(""))
    still_expected = expected_businesses(tables, specs, settings).select(
        "list", F.col("cv").alias("cv_customer_id"), F.lit(True).alias("still_expected")
    )
    found = verdicts(
        removed.join(still_expected, ["list", "cv_customer_id"], "left"),
        "cv_customer_id",
        {"every_removal_is_explained": F.col("still_expected").isNull()},
        specs,
    )
    return _as_given(found, spec)
