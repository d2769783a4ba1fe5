"""Source tables in model names, and the parts the order and transaction reports share.

``tables`` maps table names (see ``sources.schema.SNAPSHOT_COLUMNS``) to frames. ``Id`` is unique in
every table that has one.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import decimal_amounts
from ..functions.scalar import full_name
from ..operators.aggregates import coupon_codes, payment_refunds
from ..operators.controls import apart, attribute_map, cleaned_names, expand_maps, exported_options, listed, map_names, override_maps, resolve, scope_names, scoped_rows, with_map
from ..operators.filters import LOCATION_SCOPE, PRODUCT_SCOPE, live
from ..operators.joins import attach_payment, enrich, join_agg
from ..operators.projection import rename_project
from ..sources.snapshot import checkpoint_stage

Tables = dict[str, DataFrame]

ORDER_COLUMNS = {
    "Id": "order_id",
    "ReservationId": "reservation_id",
    "PaymentTransactionId": "payment_transaction_id",
    "CreatedBy": "created_by",
    "Total": "order_total",
    "OrderNumber": "order_number",
}
ITEM_COLUMNS = {
    "Id": "order_item_id",
    "OrderId": "order_id",
    "ProductId": "product_id",
    "LocationId": "location_id",
    "SiteId": "site_id",
    "RentalTypeId": "rental_type_id",
    "PartnerId": "partner_id",
    "ParentOrderItemId": "parent_order_item_id",
    "IsALaCarte": "is_a_la_carte",
    "IsRefunded": "is_refunded_source",
    "CouponDiscount": "coupon_discount",
    "Discount": "discount",
    "Tip": "tip",
    "BookingFee": "booking_fee",
    "DeliveryFee": "delivery_fee",
    "SalesTax": "sales_tax",
    "Total": "total_items",
    "TotalAmount": "total_amount",
    "CreatedOn": "created_on",
    "StartDate": "start_date",
    "EndDate": "end_date",
}
PAYMENT_COLUMNS = {
    "Id": "payment_id",
    "OrderId": "order_id",
    "Amount": "paid_amount",
    "ProcessingFee": "processing_fee",
    "Source": "payment_source",
    "PaymentType": "payment_type",
    "PaymentProviderName": "payment_provider_name",
}


def model(tables: Tables, name: str, mapping: dict[str, str]) -> DataFrame:
    """Table under model names, money as decimals."""
    return decimal_amounts(rename_project(tables[name], mapping))


# Tables that hang on an order, in the order in which the restriction reaches them: key, table it refers to, key there.
REFERENCES = {
    "OrderItems": ("OrderId", "Orders", "Id"),
    "OrderHistory": ("OrderId", "Orders", "Id"),
    "OrderCoupons": ("OrderId", "Orders", "Id"),
    "OrderItemsHistory": ("OrderId", "Orders", "Id"),
    "OrderDynamicControlValues": ("OrderId", "Orders", "Id"),
    "Reservations": ("Id", "Orders", "ReservationId"),
    "Users": ("Id", "Orders", "CreatedBy"),
    "PaymentTransactions": ("Id", "Orders", "PaymentTransactionId"),
    "PaymentRefund": ("PaymentTransactionId", "PaymentTransactions", "Id"),
    "OrderItemDynamicControls": ("OrderItemId", "OrderItems", "Id"),
}


class Restricted(dict):
    """Tables of some orders only, each restricted when it is asked for."""

    def __init__(self, tables: Tables, orders: DataFrame, references: dict[str, tuple[str, str, str]]):
        super().__init__({"Orders": orders})
        self.tables, self.references = tables, references

    def __missing__(self, name: str) -> DataFrame:
        if name not in self.references:
            return self.tables[name]
        key, table, there = self.references[name]
        wanted = self[table].select(F.col(there).alias(key)).where(F.col(key).isNotNull())
        self[name] = self.tables[name].join(wanted, key, "left_semi")
        return self[name]


def restricted(tables: Tables, ids: DataFrame, id_col: str = "order_number", payment_link: str = "id", stage: str | None = None) -> Tables:
    """Tables for a report of the listed order numbers only; listing a number twice changes nothing.

    The numbers meet the orders first. The orders found are written, so that Spark knows how few they are: every other table
    is semi-joined to them, by a broadcast or behind a Bloom filter on its scan, before anything of it is shuffled. ``payment_link``
    as in the reports.
    """
    wanted = ids.select(F.col(id_col).cast("bigint").alias("OrderNumber"))
    orders = checkpoint_stage(tables["Orders"].join(wanted, "OrderNumber", "left_semi").select(*tables["Orders"].columns), stage, "orders")
    references = dict(REFERENCES)
    if payment_link == "order":
        references["PaymentTransactions"] = ("OrderId", "Orders", "Id")
    return Restricted(tables, orders, references)


@dataclass(frozen=True)
class Attributes:
    """User-defined attributes as columns of entries: by order, by overriding item, and by product and location."""

    order: DataFrame
    own: DataFrame
    inherited: dict[str, DataFrame]
    dimensions: dict[str, DataFrame] | None = None  # products and locations with their attributes beside them, if written


# Attribute columns of lines, per scope, in the order in which reports show them.
ATTRIBUTE_COLUMNS = {"order": "_attrs_order", "product": "_attrs_product", "location": "_attrs_location"}


def items_of(tables: Tables, attrs: Attributes | None = None) -> DataFrame:
    """Items; with ``attrs`` what single items override stands beside them (joined by item, like coupons and refunds)."""
    items = model(tables, "OrderItems", ITEM_COLUMNS)
    return items if attrs is None else items.join(apart(attrs.own), "order_item_id", "left")


def order_header(tables: Tables, *, link: str = "id", round_refund_sums: bool = False, attrs: Attributes | None = None) -> DataFrame:
    """Orders with reservation, payment, refund sums and user: everything known per order.

    Joined at order level, before the much larger items come in. With ``link="order"`` an order has one
    row per payment.
    """
    orders = model(tables, "Orders", ORDER_COLUMNS)
    if attrs is not None:
        orders = join_agg(orders, attrs.order, "order_id")
    refunds = payment_refunds(decimal_amounts(tables["PaymentRefund"]), round_to_cents=round_refund_sums)
    payments = model(tables, "PaymentTransactions", PAYMENT_COLUMNS)
    payments = payments.withColumnRenamed("payment_id", "payment_transaction_id")
    paid = join_agg(payments, refunds, "payment_transaction_id")
    header = orders.withColumn("order_payment_id", F.col("payment_transaction_id"))
    header = attach_payment(header, paid, link)
    if link == "order":
        header = header.withColumn("order_payment_id", F.col("payment_transaction_id"))
    header = enrich(header, tables["Reservations"], "reservation_id", "Id", {"reservation_code": "ReservationCode"})
    names = {"user_name": full_name(F.col("FirstName"), F.col("LastName"))}
    header = enrich(header, tables["Users"], "created_by", "Id", names)
    # A missing user has a one-blank name, as an empty first and last name have.
    return header.withColumn("user_name", F.coalesce("user_name", F.lit(" "))).drop("payment_transaction_id")


def of_part(attrs: Attributes | None, part: Tables, live_only: bool) -> Attributes | None:
    """The attributes with what the items of a part override in place of all overrides."""
    return attrs and replace(attrs, own=attributes(part, live_only).own)


def written(attrs: Attributes, tables: Tables, stage: str | None = None) -> Attributes:
    """The same attributes, with those of products and locations written to folders beside ``stage`` or below ``spark.checkpoint.dir``.

    The aggregates that make them have no size that Spark could know before it plans the joins, and it would shuffle all lines by
    location only to find that there are a few. Files have a size. Products and locations come along, see ``with_map``.
    """
    known = {}
    for scope, rule in SCOPES.items():
        dimension = tables[f"{scope.capitalize()}s"]
        maps = with_map(dimension, "Id", attrs.inherited[scope], rule["entity"])
        known[scope] = checkpoint_stage(maps, None if stage is None else f"{stage.rstrip('/')}-{scope}", scope)
    return replace(attrs, dimensions=known)


def with_dimensions(lines: DataFrame, tables: Tables, rental_type: bool = False, attrs: Attributes | None = None) -> DataFrame:
    """Product, location, site, partner and tax rate of each line; the locations play two roles.

    With ``attrs`` products and locations bring their attributes along; a line whose item overrides a scope takes all of it from there.
    """
    locations = decimal_amounts(tables["Locations"], ["TaxRate"])
    products, places = tables["Products"], locations
    with_product, with_location = {}, {}
    if attrs is not None:
        if attrs.dimensions is None:
            products = with_map(products, "Id", attrs.inherited["product"], "product_id")
            places = with_map(places, "Id", attrs.inherited["location"], "location_id")
        else:
            products, places = attrs.dimensions["product"], decimal_amounts(attrs.dimensions["location"], ["TaxRate"])
        with_product, with_location = {"_inh_product": "_inh_product"}, {"_inh_location": "_inh_location"}
    out = enrich(lines, products, "product_id", "Id", {"product_name": "Name", **with_product})
    out = enrich(out, places, "location_id", "Id", {"location_name": "Name", "_location_tax": "TaxRate", **with_location})
    out = enrich(out, locations, "site_id", "Id", {"site_name": "Name", "_site_tax": "TaxRate"})
    out = enrich(out, tables["Partners"], "partner_id", "Id", {"partner_name": "Name"})
    if rental_type:
        out = enrich(out, tables["RentalTypes"], "rental_type_id", "Id", {"rental_type": "Name"})
    tax: Column = F.coalesce("_site_tax", "_location_tax")
    out = out.withColumn("tax_percentage", tax).drop("_site_tax", "_location_tax")
    return out if attrs is None else resolved(out)


def resolved(lines: DataFrame) -> DataFrame:
    """Lines with one attribute column per scope in place of the own and the inherited one."""
    for scope in SCOPES:
        own, inherited = f"_own_{scope}", f"_inh_{scope}"
        lines = lines.withColumn(ATTRIBUTE_COLUMNS[scope], F.coalesce(own, inherited)).drop(own, inherited)
    return lines


def coupons_of(tables: Tables) -> DataFrame:
    return coupon_codes(tables["OrderCoupons"], tables["Coupons"])


def order_attributes(tables: Tables) -> DataFrame:
    rows = resolve(
        tables["OrderDynamicControlValues"],
        tables["OrderDynamicControlOptions"],
        tables["OrderDynamicControls"],
        "OrderId",
        "order_id",
    )
    return cleaned_names(rows)


SCOPES = {
    "product": {"type_code": PRODUCT_SCOPE, "entity": "product_id", "entity_key": "ProductId"},
    "location": {"type_code": LOCATION_SCOPE, "entity": "location_id", "entity_key": "LocationId"},
}


def scope_rows(tables: Tables, scope: str, live_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(own rows by item, inherited rows by product or location)`` of one scope."""
    prefix = scope.capitalize()
    return scoped_rows(
        items_of(tables),
        tables["OrderItemDynamicControls"],
        tables[f"{prefix}DynamicControlValues"],
        tables[f"{prefix}DynamicControlOptions"],
        tables[f"{prefix}DynamicControls"],
        live_only=live_only,
        **SCOPES[scope],
    )


def attributes(tables: Tables, live_only: bool = True) -> Attributes:
    """All attributes as columns of entries. The overrides are read once, whatever the number of scopes."""
    options, inherited = {}, {}
    for scope, rule in SCOPES.items():
        prefix = scope.capitalize()
        known = exported_options(tables[f"{prefix}DynamicControlOptions"], tables[f"{prefix}DynamicControls"])
        options[scope] = (rule["type_code"], known)
        values = tables[f"{prefix}DynamicControlValues"]
        values = (live(values) if live_only else values).select(F.col(rule["entity_key"]).alias(rule["entity"]), "DynamicControlOptionId")
        inherited[scope] = attribute_map(values.join(known, "DynamicControlOptionId"), rule["entity"], f"_inh_{scope}")
    own = override_maps(tables["OrderItemDynamicControls"], options)
    return Attributes(attribute_map(order_attributes(tables), "order_id", ATTRIBUTE_COLUMNS["order"]), own, inherited)


def item_attributes(tables: Tables, scopes: list[str] | None = None, live_only: bool = True, stage: str | None = None) -> DataFrame:
    """``order_item_id, order_id`` and the attribute column of each scope, for all items.

    With ``stage`` the attributes of products and locations are written beside it first, for their size to be known.
    """
    attrs = attributes(tables, live_only)
    out = items_of(tables, attrs).select("order_item_id", "order_id", "product_id", "location_id", *[f"_own_{s}" for s in SCOPES])
    for scope, rule in SCOPES.items():
        maps = apart(attrs.inherited[scope])
        if stage is not None:
            maps = checkpoint_stage(maps, f"{stage.rstrip('/')}-{scope}", scope)
        out = out.join(maps, rule["entity"], "left")
    out = resolved(out).drop("product_id", "location_id")
    if scopes is None:
        return join_agg(out, attrs.order, "order_id")
    return out.select("order_item_id", "order_id", *[ATTRIBUTE_COLUMNS[s] for s in scopes])


def widened(
    lines: DataFrame,
    tables: Tables,
    given: dict[str, list[str]] | None = None,
    stage: str | None = None,
    columns: dict[str, str] | None = None,
    shown: str | None = None,
    is_written: bool = False,
) -> DataFrame:
    """``lines`` with a column per attribute name in place of the attribute columns.

    The lines are written once, to ``stage`` or below ``spark.checkpoint.dir``, and the names are read from there; ``given`` lists them per scope
    instead, and nothing runs then. Names of orders come from their attributes, as an order without lines counts as well. Only
    lines with the flag ``shown`` stay, but all count for the names. ``is_written`` says that the lines are a written step already.
    """
    columns = columns or ATTRIBUTE_COLUMNS
    names = given
    if given is None:
        lines = lines if is_written else checkpoint_stage(lines, stage, "attributes")
        found = map_names(lines, {s: c for s, c in columns.items() if s != "order"})
        if "order" in columns:
            found = found.unionAll(order_attributes(tables).select(F.lit("order").alias("scope"), "control_name").where("control_name IS NOT NULL").distinct())
        names = listed(found)
    if shown is not None:
        lines = lines.where(F.col(shown)).drop(shown)
    return expand_maps(lines, columns, names)


def pivot_by_item(tables: Tables, scope: str, names: list[str] | None = None, stage: str | None = None, live_only: bool = True) -> DataFrame:
    """One row per item that has any attribute of the scope, one column per name."""
    column = ATTRIBUTE_COLUMNS[scope]
    maps = item_attributes(tables, [scope], live_only, stage if names is None else None).drop("order_id").where(F.col(column).isNotNull())
    return widened(maps, tables, None if names is None else {scope: names}, stage, {scope: column})


def names_in_use(tables: Tables, live_only: bool = True) -> dict[str, DataFrame]:
    """``control_name`` per scope of all names that an order or item has, as lazy frames."""
    found = {"order": order_attributes(tables).select("control_name").where("control_name IS NOT NULL").distinct()}
    for scope, rule in SCOPES.items():
        own, inherited = scope_rows(tables, scope, live_only)
        found[scope] = scope_names(items_of(tables), own, inherited, rule["entity"])
    return found
