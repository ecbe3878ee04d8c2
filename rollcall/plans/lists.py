"""Customer outreach lists: one row per business, with one chosen contact.

A list is a parameter set over one template. Every branch is reduced to one
row per business before the branches meet, so the joins are all one to one on
customer_id and reuse the partitioning of the aggregates.

Several lists are made at once: a ticket is in each list whose product it is for,
and what a branch reduces is then a business in a list. What is the same for all
lists is reduced once per business and told apart by list afterwards.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.dates import days_between, later_of
from rollcall.functions.predicates import flag, has_text, none_of, or_fallback
from rollcall.operators.aggregates import (
    counted_list,
    distinct_list,
    label_of_rank,
    rank_of_label,
    text_list,
)
from rollcall.operators.picks import keep_first
from rollcall.settings import Settings
from rollcall.sinks import staged
from rollcall.sources.tables import Tables

# Statuses (lower case) in display order, and their count columns.
STATUS_COUNTS = {
    "open": "open_tickets",
    "undecided": "undecided_tickets",
    "undecided_at_sale": "undecided_at_sale_tickets",
    "expired": "expired_tickets",
    "assigned": "assigned_tickets",
    "scheduled": "scheduled_tickets",
    "reserved": "reserved_tickets",
    "attended": "attended_tickets",
    "no show": "no_show_tickets",
    "cancelled": "cancelled_tickets",
}
# The order of statuses in a ticket summary; others come last.
SUMMARY_ORDER = [
    "undecided", "undecided_at_sale", "open", "reserved", "scheduled",
    "assigned", "attended", "no show", "expired", "cancelled",
]
UNSCHEDULED = ["open", "undecided", "undecided_at_sale", "expired"]
BOOKED = ["scheduled", "reserved"]
# Fixed values, worst first.
RESTRICTIONS = ["Do Not Contact", "Do Not Blast", "Do Not Call"]
# Fixed values, preferred first.
CONTACT_SOURCES = ["business_owner", "attendee", "purchaser", "netsuite"]
PLACEHOLDER_EMAIL = "+placeholder@"
# What a list reads of a ticket.
TICKET_COLUMNS = [
    "ticket_id", "customer_id", "product_name", "ticket_type", "status", "event_date",
    "outreach_restriction", "sales_order_id", "purchaser_name", "purchaser_email",
    "purchaser_phone", "undecided_timestamp", "registration_date", "transaction_id", "is_deleted",
]
# What the ids on a list need of a ticket.
ID_COLUMNS = [
    "customer_id", "product_name", "status", "purchaser_name", "purchaser_email", "purchaser_phone",
    "transaction_id", "is_deleted",
]


@dataclass(frozen=True)
class ListSpec:
    """What tells one list from another."""

    product: str  # text the product name must contain
    flagship: str  # text the flagship product's name contains; also its label
    counted_types: bool = True  # "product xN" types, or distinct ticket types

    @property
    def columns(self) -> list[str]:
        return list(_display(self.flagship).values())


def _display(flagship: str) -> dict[str, str]:
    """Display names of the 47 list columns, in order (fixed values)."""
    return {
        "business_name": "Business Name",
        "cv_customer_id": "CV Customer ID",
        "contact_name": "Contact Name",
        "contact_email": "Contact Email",
        "contact_phone": "Contact Phone",
        "contact_source": "Contact Source",
        "unscheduled_group": "Unscheduled Ticket Group",
        "ticket_count": "Total Tickets",
        "unscheduled_tickets": "Unscheduled Tickets",
        "open_tickets": "Open Tickets",
        "undecided_tickets": "Undecided Tickets",
        "undecided_at_sale_tickets": "Undecided at Sale Tickets",
        "expired_tickets": "Expired Tickets",
        "assigned_tickets": "Assigned Tickets",
        "scheduled_tickets": "Scheduled Tickets",
        "reserved_tickets": "Reserved Tickets",
        "attended_tickets": "Attended Tickets",
        "no_show_tickets": "No Show Tickets",
        "cancelled_tickets": "Cancelled Tickets",
        "first_purchase_date": "First Purchase Date",
        "latest_purchase_date": "Latest Purchase Date",
        "days_since_purchase": "Days Since Latest Purchase",
        "next_event_date": "Next Event Date",
        "last_attended_date": "Last Attended Event Date",
        "outreach_restriction": "Outreach Restriction",
        "last_blast_product": "Last Blast (This Product)",
        "last_call_product": "Last Call (This Product)",
        "days_since_contact_product": "Days Since Last Contact (This Product)",
        "last_blast_all": "Last Blast (All Products)",
        "last_call_all": "Last Call (All Products)",
        "days_since_contact_all": "Days Since Last Contact (All Products)",
        "elite_status": "Elite Status",
        "pr_status": "PR Client Status",
        "sbu_status": "SBU Client Status",
        "abr": "Annual Business Revenue",
        "vertical": "Vertical",
        "sub_vertical": "Sub-Vertical",
        "is_flagship_customer": f"{flagship} Customer",
        "first_flagship_date": f"First {flagship} Purchase Date",
        "priority_date": "Queue Start Date",
        "days_in_queue": "Days in Queue",
        "ticket_types": "Ticket Types",
        "ticket_ids": "Ticket IDs",
        "sales_orders": "Sales Order Numbers",
        "summary_product": "Ticket Summary (This Product)",
        "summary_all": "Ticket Summary (All Products)",
        "generated_at": "Generated At",
    }


Specs = Mapping[str, ListSpec]


def _one(product: str = "", flagship: str = "") -> Specs:
    return {"": ListSpec(product, flagship)}


def keys_of(*frames: DataFrame) -> list[str]:
    """A business, and the list where all of these tell lists apart."""
    return [k for k in ("list", "customer_id") if all(k in df.columns for df in frames)]


def _of_any(column: str, texts: Collection[str]) -> Column:
    tests = [F.col(column).contains(text) for text in dict.fromkeys(texts)]
    return reduce(lambda a, b: a | b, tests)


def of_lists(rows: DataFrame, specs: Specs) -> DataFrame:
    """The rows on a list's product; several lists are told apart by column ``list``, and a row
    is there for each of its lists."""
    rows = rows.filter(_of_any("product_name", [spec.product for spec in specs.values()]))
    if len(specs) == 1:
        return rows
    names = [F.when(F.col("product_name").contains(s.product), name) for name, s in specs.items()]
    return rows.withColumn("list", F.explode(F.array_compact(F.array(*names))))


def told_apart(rows: DataFrame, specs: Specs, fields: Collection[str]) -> DataFrame:
    """Rows whose columns ``field_0, field_1, ...`` are a field's values for each list, with the
    field itself and, of several lists, a row for each."""
    of_each = {f"{field}_{i}" for field in fields for i in range(len(specs))}
    rest = [c for c in rows.columns if c not in of_each]
    if len(specs) == 1:
        return rows.select(*rest, *[F.col(f"{field}_0").alias(field) for field in fields])
    values = [
        F.struct(F.lit(name).alias("list"), *[F.col(f"{field}_{i}").alias(field) for field in fields])
        for i, name in enumerate(specs)
    ]
    return rows.select(*rest, F.inline(F.array(*values)))


def listed_tickets(tables: Tables, specs: Specs) -> DataFrame:
    """The lists' tickets that are not deleted and have a business, status in lower case."""
    return of_lists(tables["tickets"].filter(_on_some_list(specs)), specs).withColumn("status", F.lower("status"))


def product_tickets(tables: Tables, product: str) -> DataFrame:
    """The tickets of one list."""
    return listed_tickets(tables, _one(product))


def with_sale(tickets: DataFrame, sales: DataFrame) -> DataFrame:
    """Tickets with their sales; those without one have nothing to match and are not shuffled."""
    sold = F.col("transaction_id").isNotNull()
    return (
        tickets.filter(sold)
        .join(sales, "transaction_id", "left")
        .unionByName(tickets.filter(~sold), allowMissingColumns=True)
    )


def scope(tables: Tables, product: str) -> DataFrame:
    """The product's tickets, each with its sale."""
    return with_their_sale(product_tickets(tables, product), tables)


def with_their_sale(tickets: DataFrame, tables: Tables) -> DataFrame:
    """A sale that is recorded more than once repeats the ticket."""
    sales = tables["transactions"].select(
        F.col("cv_transaction_id").alias("transaction_id"),
        "transaction_date",
        F.col("purchaser_name").alias("sale_name"),
        F.col("purchaser_email").alias("sale_email"),
        F.col("purchaser_phone").alias("sale_phone"),
    )
    return with_sale(tickets, sales)


def ticket_rollup(scoped: DataFrame, settings: Settings) -> DataFrame:
    """Counts, dates, restriction and ticket ids per business.

    Unless each row is known to be another ticket, rows are reduced to one per
    business and ticket first: ticket counts are then exact without a distinct
    aggregate, and a large business is spread over all tasks. Status counts
    count rows, ticket counts count tickets.
    """
    keys = keys_of(scoped)
    status, event_date = F.col("status"), F.col("event_date")
    upcoming = status.isin(BOOKED) & (event_date >= settings.today)
    severity = rank_of_label(F.col("outreach_restriction"), RESTRICTIONS)
    # name -> (value of a row, how rows combine, first per ticket, then per business)
    parts = {
        "first_sale": (F.col("transaction_date"), F.min),
        "last_sale": (F.col("transaction_date"), F.max),
        "next_event_date": (F.when(upcoming, event_date), F.min),
        "last_attended_date": (F.when(status == "attended", event_date), F.max),
        "priority_date": (F.coalesce("undecided_timestamp", "registration_date"), F.min),
        "severity": (severity, F.max),
        "unscheduled": (flag(status.isin(UNSCHEDULED)), F.max),
        **{name: (flag(status == s), F.sum) for s, name in STATUS_COUNTS.items()},
    }
    if settings.tickets_are_unique and settings.sales_are_unique:
        per_ticket = scoped.select(
            *keys, "ticket_id", *[value.alias(name) for name, (value, _) in parts.items()]
        )
    else:
        per_ticket = scoped.groupBy(*keys, "ticket_id").agg(
            *[combine(value).alias(name) for name, (value, combine) in parts.items()]
        )
    known = F.col("ticket_id").isNotNull()
    combined = {
        name: combine(name)
        for name, (_, combine) in parts.items()
        if name not in ("unscheduled", "severity")
    }
    return (
        per_ticket.groupBy(*keys)
        .agg(
            F.count("ticket_id").alias("ticket_count"),
            F.count_if(known & (F.col("unscheduled") == 1)).alias("unscheduled_tickets"),
            label_of_rank(F.max("severity"), RESTRICTIONS).alias("outreach_restriction"),
            text_list("ticket_id").alias("ticket_ids"),
            *[column.alias(name) for name, column in combined.items()],
        )
        .withColumns(
            {
                "first_purchase_date": F.to_date("first_sale"),
                "latest_purchase_date": F.to_date("last_sale"),
            }
        )
        .drop("first_sale", "last_sale")
    )


def ticket_summary(scoped: DataFrame, settings: Settings) -> DataFrame:
    return ticket_rollup(scoped, settings).drop("ticket_ids", *STATUS_COUNTS.values())


def status_counts(scoped: DataFrame) -> DataFrame:
    status = F.col("status")
    return scoped.groupBy("customer_id").agg(
        *[F.count_if(status == s).alias(name) for s, name in STATUS_COUNTS.items()]
    )


def types_counted(scoped: DataFrame) -> DataFrame:
    return counted_list(scoped, keys_of(scoped), "product_name", "ticket_types")


def types_distinct(scoped: DataFrame) -> DataFrame:
    named = scoped.filter(F.col("ticket_type").isNotNull())
    return distinct_list(named, keys_of(named), "ticket_type", "ticket_types")


def ticket_ids(scoped: DataFrame) -> DataFrame:
    return distinct_list(scoped, ["customer_id"], "ticket_id", "ticket_ids")


def sales_orders(scoped: DataFrame) -> DataFrame:
    numbered = scoped.filter(has_text(F.col("sales_order_id")))
    return distinct_list(numbered, keys_of(numbered), "sales_order_id", "sales_orders")


def last_activity(tables: Tables, product: str) -> DataFrame:
    """Last blast and call per business, for the product and for all."""
    return last_activities(tables, _one(product))


def last_activities(tables: Tables, specs: Specs) -> DataFrame:
    """Last blast and call per business, for each list's product and for all.

    Deleted tickets count. The contact log is cut to the tickets given here, by a
    semi join before anything is aggregated, and to one row per ticket before it
    meets them. The stored ids take far less room in files than in a hash table, so
    Spark's size check would broadcast millions of them; they are merged.
    """
    tickets = tables["tickets"].select("ticket_id", "customer_id", "product_name")
    contacted = (
        tables["attendee_tickets"]
        .join(tickets.select("ticket_id").hint("merge"), "ticket_id", "left_semi")
        .groupBy("ticket_id")
        .agg(F.max("blast_date").alias("blast"), F.max("last_called_date").alias("call"))
    )
    of_product = [F.col("product_name").contains(spec.product) for spec in specs.values()]
    per_business = (
        tickets.join(contacted, "ticket_id")
        .groupBy("customer_id")
        .agg(
            *[F.max(F.when(t, F.col("blast"))).alias(f"last_blast_product_{i}") for i, t in enumerate(of_product)],
            *[F.max(F.when(t, F.col("call"))).alias(f"last_call_product_{i}") for i, t in enumerate(of_product)],
            F.max("blast").alias("last_blast_all"),
            F.max("call").alias("last_call_all"),
        )
    )
    return told_apart(per_business, specs, ["last_blast_product", "last_call_product"])


def first_purchase(tables: Tables, flagship: str) -> DataFrame:
    """First paid ledger line of the flagship product per business."""
    return first_purchases(tables, _one(flagship=flagship))


def first_purchases(tables: Tables, specs: Specs) -> DataFrame:
    """First paid ledger line of each list's flagship product per business.

    The ledger is cut to the products and then to the businesses given here,
    before anything is aggregated.
    """
    flagships = [spec.flagship for spec in specs.values()]
    paid = tables["fact_gl"].filter(
        (F.col("GLLineID") != 0) & (F.col("SalesOrderCashCollected") > 0)
    )
    products = tables["dim_product"].filter(_of_any("ProductName", flagships))
    customers = tables["customers"].select(
        F.col("id").alias("customer_id"), F.col("cv_customer_id").alias("CVCustomerID")
    )
    dates = [F.when(F.col("ProductName").contains(f), F.col("GLDate")) for f in flagships]
    names = [f"first_flagship_date_{i}" for i in range(len(flagships))]
    per_business = (
        paid.join(products.select("CVProductID", "ProductName"), "CVProductID")
        .join(customers.select("CVCustomerID"), "CVCustomerID", "left_semi")
        .groupBy("CVCustomerID")
        .agg(*[F.min(date).alias(name) for date, name in zip(dates, names)])
        .join(customers, "CVCustomerID")
        .groupBy("customer_id")
        .agg(*[F.min(name).alias(name) for name in names])
    )
    return told_apart(per_business, specs, ["first_flagship_date"])


def profile(tables: Tables) -> DataFrame:
    dimension = tables["dim_customer"].select(
        F.col("CVCustomerID").alias("cv_customer_id"),
        F.col("EliteStatusName").alias("elite_status"),
        F.col("PRClientStatusName").alias("pr_status"),
        F.col("SBUClientStatusName").alias("sbu_status"),
        F.col("AnnualBusinessRevenueName").alias("abr"),
        F.col("VerticalName").alias("vertical"),
        F.col("SubVerticalName").alias("sub_vertical"),
    )
    customers = tables["customers"].select(
        F.col("id").alias("customer_id"), F.col("name").alias("business_name"), "cv_customer_id"
    )
    return customers.join(dimension, "cv_customer_id", "left")


def purchaser_contacts(scoped: DataFrame, settings: Settings) -> DataFrame:
    """Purchasers with a usable e-mail on the ticket or on the sale."""
    junk = settings.junk
    usable = none_of(F.col("purchaser_email"), junk) | none_of(F.col("sale_email"), junk)
    return scoped.filter(usable).select(
        *keys_of(scoped),
        or_fallback(F.col("purchaser_name"), F.col("sale_name"), junk).alias("contact_name"),
        or_fallback(F.col("purchaser_email"), F.col("sale_email"), junk).alias("contact_email"),
        or_fallback(F.col("purchaser_phone"), F.col("sale_phone"), junk).alias("contact_phone"),
        F.lit("purchaser").alias("contact_source"),
    )


def attendee_contacts(tables: Tables) -> DataFrame:
    """Attendees with an e-mail, be it empty, that is no placeholder."""
    real = ~F.col("attendee_email").contains(PLACEHOLDER_EMAIL)
    return tables["attendees"].filter(real).select(
        "customer_id",
        F.col("attendee_name").alias("contact_name"),
        F.col("attendee_email").alias("contact_email"),
        F.col("attendee_phone").alias("contact_phone"),
        F.lit("attendee").alias("contact_source"),
    )


def entity_contacts(tables: Tables) -> DataFrame:
    """The owner named on the ERP entity behind a business."""
    entities = tables["silver_entity"].filter(has_text(F.col("Email")))
    linked = tables["dim_customer"].select(
        F.col("CVCustomerID").alias("cv_customer_id"), F.col("NetSuiteID").alias("EntityID")
    )
    return (
        tables["customers"]
        .select(F.col("id").alias("customer_id"), "cv_customer_id")
        .join(linked, "cv_customer_id")
        .join(entities, "EntityID")
        .select(
            "customer_id",
            F.col("BusinessOwnerName").alias("contact_name"),
            F.col("Email").alias("contact_email"),
            F.col("Phone").alias("contact_phone"),
            F.lit("netsuite").alias("contact_source"),
        )
    )


def owner_contacts(tables: Tables) -> DataFrame:
    """Active owners of a business."""
    owners = tables["dim_customer_contact"].filter(
        (F.col("StaffTitleName") == "Owner") & (F.col("IsActiveName") == "Yes")
    )
    people = tables["dim_person"].filter(has_text(F.col("Email")))
    return (
        tables["customers"]
        .select(F.col("id").alias("customer_id"), F.col("cv_customer_id").alias("Customer"))
        .join(owners, "Customer")
        .join(people, owners["Person"] == people["CVPersonID"])
        .select(
            "customer_id",
            F.col("PersonName").alias("contact_name"),
            F.col("Email").alias("contact_email"),
            F.col("Phone").alias("contact_phone"),
            F.lit("business_owner").alias("contact_source"),
        )
    )


def contact_candidates(tables: Tables, scoped: DataFrame, settings: Settings) -> DataFrame:
    """Every contact of every business, from the four sources, repeats included."""
    return purchaser_contacts(scoped, settings).unionByName(shared_contacts(tables))


def shared_contacts(tables: Tables) -> DataFrame:
    """The contacts that do not depend on the product."""
    branches = [attendee_contacts(tables), entity_contacts(tables), owner_contacts(tables)]
    return reduce(DataFrame.unionByName, branches)


CONTACT_FIELDS = ["contact_email", "contact_name", "contact_phone"]


def _contact_order() -> list[Column]:
    """Order by the fields in any casing; the casing itself only breaks ties."""
    folded = [F.asc_nulls_first(F.lower(field)) for field in CONTACT_FIELDS]
    return folded + [F.asc_nulls_first(field) for field in CONTACT_FIELDS]


def distinct_contacts(candidates: DataFrame) -> DataFrame:
    """One row per contact and source, where casing makes no difference."""
    folded = [F.lower(field) for field in CONTACT_FIELDS]
    return keep_first(candidates, ["customer_id", "contact_source", *folded], _contact_order())


def pick_contact(candidates: DataFrame) -> DataFrame:
    """The preferred contact of each business."""
    preference = F.array_position(F.lit(CONTACT_SOURCES), F.col("contact_source"))
    return keep_first(
        candidates.filter(F.col("customer_id").isNotNull()),
        keys_of(candidates),
        [F.asc(preference), *_contact_order()],
    )


def pick_contacts(tables: Tables, tickets: DataFrame, settings: Settings) -> DataFrame:
    """The preferred contact of each business, in each of several lists.

    Of the contacts that lists share, one is picked per business. Where it is
    preferred to a purchaser it is the business's contact in all of its lists, with
    nothing more to sort; purchasers are looked up for the other businesses.
    """
    if "list" not in tickets.columns:
        scoped = with_their_sale(tickets, tables)
        return pick_contact(contact_candidates(tables, scoped, settings))
    holders = tickets.select("list", "customer_id").distinct()
    shared = pick_contact(shared_contacts(tables))
    is_served = F.col("contact_source").isin(CONTACT_SOURCES[: CONTACT_SOURCES.index("purchaser")])
    served, others = shared.filter(is_served), shared.filter(~is_served)
    unserved = tickets.join(served.select("customer_id"), "customer_id", "left_anti")
    purchasers = purchaser_contacts(with_their_sale(unserved, tables), settings)
    picked = pick_contact(purchasers.unionByName(others.join(holders, "customer_id")))
    return picked.unionByName(served.join(holders, "customer_id"))


def status_summary(tables: Tables, product: str) -> DataFrame:
    """The summaries for one product, of the businesses with a ticket for it."""
    return status_summaries(tables, _one(product)).filter(F.col("in_scope") == 1).drop("in_scope")


def status_summaries(tables: Tables, specs: Specs) -> DataFrame:
    """``status: product xN, ... | status: ...`` per business, for each list's product
    and for everything the business holds.

    All texts come from one count by business, status and product, which is shuffled
    by business once for the texts of its statuses and its own.
    """
    of_product = [F.col("product_name").contains(spec.product) for spec in specs.values()]
    counted = (
        tables["tickets"]
        .filter((F.col("is_deleted") == 0) & F.col("customer_id").isNotNull())
        .groupBy("customer_id", F.lower("status").alias("status"), "product_name")
        .agg(F.count("*").alias("n"))
        .repartition("customer_id")
        .withColumn("item", F.concat("product_name", F.lit(" x"), "n"))
        .withColumns({f"item_{i}": F.when(t, F.col("item")) for i, t in enumerate(of_product)})
    )
    each = range(len(of_product))
    by_status = counted.groupBy("customer_id", "status").agg(
        *[text_list(f"item_{i}", order="product_name").alias(f"items_{i}") for i in each],
        *[F.max(flag(t)).alias(f"in_scope_{i}") for i, t in enumerate(of_product)],
        text_list("item", order="product_name").alias("items"),
    )
    place = F.array_position(F.lit(SUMMARY_ORDER), F.col("status"))
    lines = by_status.withColumns(
        {
            "place": F.when(place > 0, place).otherwise(len(SUMMARY_ORDER) + 1),
            **{f"line_{i}": F.concat("status", F.lit(": "), f"items_{i}") for i in each},
            "line": F.concat("status", F.lit(": "), "items"),
        }
    )
    per_business = lines.groupBy("customer_id").agg(
        *[text_list(f"line_{i}", " | ", "place, status").alias(f"summary_product_{i}") for i in each],
        *[F.max(f"in_scope_{i}").alias(f"in_scope_{i}") for i in each],
        text_list("line", " | ", "place, status").alias("summary_all"),
    )
    return told_apart(per_business, specs, ["summary_product", "in_scope"])


def unscheduled_group(open_count: Column, undecided: Column, at_sale: Column, expired: Column):
    """Which kinds of unscheduled tickets a business has."""
    active = open_count + undecided + at_sale
    return (
        F.when((active == 0) & (expired == 0), "Nothing to Schedule")
        .when(active == 0, "Expired Only")
        .when(expired == 0, "Open/Undecided Only")
        .otherwise("Open/Undecided + Expired")
    )


def of_businesses_with(tables: Tables, specs: Specs) -> Tables:
    """The tables with the tickets, attendees and master data of businesses that are in a list.

    What the branches aggregate is cut to them first. Their tickets and customers
    are stored, since several branches read them, each its own columns; no other
    column of a ticket is shuffled or written.
    """
    tickets = tables["tickets"].select(*TICKET_COLUMNS)
    holders = tickets.filter(_on_some_list(specs)).select("customer_id").distinct()
    return _cut_to(tables, staged(tickets.join(holders, "customer_id", "left_semi")))


def with_listed_tickets_only(tables: Tables, specs: Specs) -> Tables:
    """The same without the businesses' other tickets, for what reads none of them.

    A ticket on a list is of a business in scope by itself, so this needs no join
    of the tickets.
    """
    return _cut_to(tables, staged(tables["tickets"].select(*ID_COLUMNS).filter(_on_some_list(specs))))


def _on_some_list(specs: Specs) -> Column:
    of_any = _of_any("product_name", [spec.product for spec in specs.values()])
    return of_any & (F.col("is_deleted") == 0) & F.col("customer_id").isNotNull()


def _cut_to(tables: Tables, tickets: DataFrame) -> Tables:
    """The tables with the attendees and customers of the businesses in some stored tickets."""
    ids = tickets.select("customer_id").distinct()
    customers = tables["customers"].select("id", "name", "cv_customer_id").join(
        ids.withColumnRenamed("customer_id", "id"), "id", "left_semi"
    )
    return tables.narrowed(
        tickets=tickets,
        attendees=tables["attendees"].join(ids, "customer_id", "left_semi"),
        customers=staged(customers),
    )


def _types(tickets: DataFrame, scoped: DataFrame, specs: Specs, settings: Settings) -> DataFrame:
    """Ticket types in the way of each list."""
    ways = {
        True: (types_counted, tickets if settings.sales_are_unique else scoped),
        False: (types_distinct, tickets),
    }
    parts = []
    for counted, (types, rows) in ways.items():
        names = [name for name, spec in specs.items() if spec.counted_types == counted]
        if names and len(names) < len(specs):
            rows = rows.filter(F.col("list").isin(names))
        if names:
            parts.append(types(rows))
    return reduce(DataFrame.unionByName, parts)


def business_rows(tables: Tables, specs: Specs, settings: Settings) -> DataFrame:
    """One row per business and list, under the names of the branches."""
    tables = of_businesses_with(tables, specs)
    tickets = listed_tickets(tables, specs)
    scoped = with_their_sale(tickets, tables)
    needed = [pick_contacts(tables, tickets, settings), profile(tables)]
    optional = [
        _types(tickets, scoped, specs, settings),
        sales_orders(tickets),
        last_activities(tables, specs),
        first_purchases(tables, specs),
        status_summaries(tables, specs).drop("in_scope"),
    ]

    def met(how: str):
        return lambda left, right: left.join(right, keys_of(left, right), how)

    return reduce(met("left"), optional, reduce(met("inner"), needed, ticket_rollup(scoped, settings)))


def listed_ids(tables: Tables, specs: Specs, settings: Settings) -> DataFrame:
    """CRM ids of the businesses on the lists, without making the rest of their rows.

    These are the businesses with a ticket for the product and any contact.
    """
    tables = with_listed_tickets_only(tables, specs)
    tickets = listed_tickets(tables, specs)
    scoped = with_their_sale(tickets, tables)
    keys = keys_of(tickets)
    holders = tickets.select(*keys).distinct()
    with_contact = holders.join(shared_contacts(tables), "customer_id", "left_semi").select(*keys)
    buyers = purchaser_contacts(scoped, settings).select(*keys)
    customers = tables["customers"].select(F.col("id").alias("customer_id"), "cv_customer_id")
    listed = with_contact.unionByName(buyers).distinct().join(customers, "customer_id")
    return listed.drop("customer_id")


def customer_list(tables: Tables, spec: ListSpec, settings: Settings) -> DataFrame:
    """The list of one product, longest in queue first."""
    return _shown(business_rows(tables, {"": spec}, settings), spec, settings)


def customer_lists(tables: Tables, specs: Specs, settings: Settings) -> dict[str, DataFrame]:
    """Several lists, made in one pass over the tables and stored together."""
    if len(specs) == 1:
        return {name: staged(customer_list(tables, spec, settings)) for name, spec in specs.items()}
    rows = staged(business_rows(tables, specs, settings))
    return {
        name: _shown(rows.filter(F.col("list") == name), spec, settings)
        for name, spec in specs.items()
    }


def _shown(rows: DataFrame, spec: ListSpec, settings: Settings) -> DataFrame:
    """A list with its computed columns, as it is shown."""

    def days_since(day: Column) -> Column:
        return days_between(day, settings.today)

    computed = {
        "unscheduled_group": unscheduled_group(
            *[F.col(STATUS_COUNTS[s]) for s in ("open", "undecided", "undecided_at_sale", "expired")]
        ),
        "days_since_purchase": days_since(F.col("latest_purchase_date")),
        "days_since_contact_product": days_since(
            later_of(F.col("last_blast_product"), F.col("last_call_product"))
        ),
        "days_since_contact_all": days_since(
            later_of(F.col("last_blast_all"), F.col("last_call_all"))
        ),
        "is_flagship_customer": F.when(
            F.col("first_flagship_date").isNotNull(), "Yes"
        ).otherwise("No"),
        "days_in_queue": days_since(F.col("priority_date")),
        "generated_at": settings.now,
    }
    display = _display(spec.flagship)
    return (
        rows.withColumns(computed)
        .orderBy(F.asc_nulls_first("priority_date"), "cv_customer_id")
        .select(*[F.col(name).alias(shown) for name, shown in display.items()])
    )
