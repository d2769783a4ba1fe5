"""User-defined attributes ("controls"): resolve, override, and pivot to columns named by the data.

An attribute is stored as value -> option -> control. Products and locations hold attributes, single
items may override them: an item with own rows in a scope takes nothing from its product or location.

Attributes are merged where they are stored, to one column of entries per product, location, order or overriding item. These
columns travel with the rows; item rows are never multiplied by attribute rows. Names become columns once, at the end, and
are read from what has been written by then.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import clean_name
from .aggregates import joined_values
from .filters import exported, live, scope
from .joins import within, without
from .projection import quoted
from .sets import stack, stack_all

NAME, VALUE = "control_name", "control_value"


def exported_options(options: DataFrame, controls: DataFrame) -> DataFrame:
    """Options of controls flagged for export: ``DynamicControlOptionId``, name, value."""
    names = exported(controls).select(F.col("Id").alias("DynamicControlId"), F.col("DisplayName").alias(NAME))
    values = options.select(F.col("Id").alias("DynamicControlOptionId"), "DynamicControlId", F.col("Option").alias(VALUE))
    return values.join(names, "DynamicControlId").select("DynamicControlOptionId", NAME, VALUE)


def resolve(values: DataFrame, options: DataFrame, controls: DataFrame, key: str, out: str) -> DataFrame:
    """Attribute rows ``(out, control_name, control_value)`` of exported controls.

    Only exported controls survive, so the outer and the inner form of the chain are the same join.
    """
    kept = values.select(quoted(key).alias(out), "DynamicControlOptionId")
    return kept.join(exported_options(options, controls), "DynamicControlOptionId").select(out, NAME, VALUE)


def expand(attrs: DataFrame, items: DataFrame, on: str) -> DataFrame:
    """Attribute rows of every item of the product or location, one row per item and attribute."""
    return items.select("order_item_id", on).join(attrs, on).select("order_item_id", NAME, VALUE)


def override(item_rows: DataFrame, inherited_rows: DataFrame, key: str) -> DataFrame:
    """Item rows, plus inherited rows of the items that have none."""
    return stack(item_rows, without(inherited_rows, item_rows.select(key), [key]))


def pivot_controls(attrs: DataFrame, key: str, names: list[str] | None = None, sep: str = ", ") -> DataFrame:
    """One row per key, one column per control, several values merged to one sorted list.

    Without attribute rows the result holds only the key.
    """
    if names is None:
        found = attrs.select(F.lit("all").alias("scope"), NAME).where(F.col(NAME).isNotNull()).distinct()
        names = listed(found).get("all", [])
    if not names:
        return attrs.select(key).distinct().limit(0)
    counted = attrs.groupBy(key, NAME, VALUE).agg(F.count(F.lit(1)).alias("n"))
    entry = F.when(F.col(VALUE).isNotNull(), F.struct(F.col(NAME).alias("name"), F.col(VALUE).alias("value"), "n"))
    bundled = counted.groupBy(key).agg(F.collect_list(entry).alias("_all"))
    return bundled.select(key, *[_column(n, sep) for n in names])


def _column(name: str, sep: str) -> Column:
    mine = F.filter("_all", lambda x: x["name"] == F.lit(name))
    pairs = F.transform(mine, lambda x: F.struct(x["value"].alias("value"), x["n"].alias("n")))
    return joined_values(pairs, sep).alias(name)


def apart(pivoted: DataFrame) -> DataFrame:
    """The same rows, no longer placed by their key, so that a join shuffles both of its sides.

    Spark splits a hot key only where both sides come from shuffles made for the join. This side has one row per
    key; moving it once more is cheap against the lines.
    """
    return pivoted.hint("rebalance")


def _merged(rows: Column, sep: str) -> Column:
    """Sorted entries ``(name, value)`` from an array of ``(name, value, n)``; the values of a name become one sorted list.

    An array of entries can be compared and grouped, which a map can't. Names without a value stay, with NULL.
    """
    names = F.array_sort(F.array_distinct(F.transform(F.filter(rows, lambda x: x["name"].isNotNull()), lambda x: x["name"])))

    def entry(name: Column) -> Column:
        mine = F.filter(rows, lambda x: (x["name"] == name) & x["value"].isNotNull())
        pairs = F.transform(mine, lambda x: F.struct(x["value"].alias("value"), x["n"].alias("n")))
        return F.struct(name.alias("name"), joined_values(pairs, sep).alias("value"))

    return F.transform(names, entry)


def attribute_map(attrs: DataFrame, key: str, out: str, sep: str = ", ") -> DataFrame:
    """One row per key: ``key`` and ``out``, its attributes as entries of name and merged value."""
    counted = attrs.groupBy(key, NAME, VALUE).agg(F.count(F.lit(1)).alias("n"))
    bundled = counted.groupBy(key).agg(F.collect_list(F.struct(F.col(NAME).alias("name"), F.col(VALUE).alias("value"), "n")).alias("_all"))
    return bundled.select(key, _merged(F.col("_all"), sep).alias(out))


def override_maps(overrides: DataFrame, options: dict[str, tuple[int, DataFrame]], sep: str = ", ") -> DataFrame:
    """One row per overriding item: ``order_item_id`` and, per scope, ``_own_<scope>``, NULL where the item has no rows in that scope.

    The overrides are read once for all scopes; ``options`` has the type code and the exported options of each.
    """
    known = stack_all([df.withColumn("DynamicControlType", F.lit(code)) for code, df in options.values()])
    rows = overrides.select(F.col("OrderItemId").alias("order_item_id"), "DynamicControlType", "DynamicControlOptionId")
    counted = rows.join(known, ["DynamicControlType", "DynamicControlOptionId"]).groupBy("order_item_id", "DynamicControlType", NAME, VALUE)
    entry = F.struct(F.col("DynamicControlType").alias("type"), F.col(NAME).alias("name"), F.col(VALUE).alias("value"), "n")
    bundled = counted.agg(F.count(F.lit(1)).alias("n")).groupBy("order_item_id").agg(F.collect_list(entry).alias("_all"))

    def one_scope(code: int) -> Column:
        mine = F.filter("_all", lambda x: x["type"] == code)
        return F.when(F.size(mine) > 0, _merged(mine, sep))

    return bundled.select("order_item_id", *[one_scope(code).alias(f"_own_{s}") for s, (code, _) in options.items()])


def with_map(dimension: DataFrame, pk: str, maps: DataFrame, key: str) -> DataFrame:
    """Dimension with the attributes of each row beside it; attributes of unknown rows stay, so that no line loses them."""
    joined = dimension.join(maps, quoted(pk) == F.col(key), "full_outer")
    return apart(joined.withColumn(pk, F.coalesce(quoted(pk), F.col(key))).drop(key))


def map_names(maps: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``scope, control_name``: distinct names in the attribute columns, given per scope."""

    def names_of(scope_name: str, column: str) -> DataFrame:
        # Many lines have equal names, so these are made distinct before they are taken apart.
        found = maps.select(F.transform(column, lambda x: x["name"]).alias("_all")).distinct()
        return found.select(F.lit(scope_name).alias("scope"), F.explode("_all").alias(NAME)).distinct()

    return stack_all([names_of(s, c) for s, c in columns.items()])


def listed(names: DataFrame) -> dict[str, list[str]]:
    """Sorted names of each scope; there is at most one for each control definition and scope."""
    found: dict[str, list[str]] = {}
    for scope_name, name in sorted(tuple(r) for r in names.collect()):
        found.setdefault(scope_name, []).append(name)
    return found


def expand_maps(report: DataFrame, columns: dict[str, str], names: dict[str, list[str]]) -> DataFrame:
    """Report with one column per name in place of the attribute columns; scopes follow each other in the order of ``columns``."""
    plain = [c for c in report.columns if c not in columns.values()]
    labels = unique_names({s: names.get(s, []) for s in columns}, plain)
    maps = {c: F.map_from_entries(F.col(c)) for s, c in columns.items() if labels[s]}
    picked = [F.element_at(F.col(c), F.lit(n)).alias(labels[s][n]) for s, c in columns.items() for n in labels[s]]
    return report.withColumns(maps).select(*map(quoted, plain), *picked) if maps else report.select(*map(quoted, plain))


def entities_in_use(items: DataFrame, own: DataFrame, entity: str) -> DataFrame:
    """Products or locations that at least one item without own rows belongs to, by counting.

    Items per entity less overriding items per entity, both combined on the map side: of the items only the overriding ones are matched by id.
    """
    every = items.groupBy(entity).agg(F.count(F.lit(1)).alias("n"))
    mine = within(items.select("order_item_id", entity), own.select("order_item_id").distinct(), ["order_item_id"])
    taken = mine.groupBy(F.col(entity).alias("_taken")).agg(F.count(F.lit(1)).alias("_n"))
    left = every.join(taken, F.col(entity) == F.col("_taken"), "left").where(F.col("n") > F.coalesce("_n", F.lit(0)))
    return left.select(entity)


def scope_names(items: DataFrame, own: DataFrame, inherited: DataFrame, entity: str) -> DataFrame:
    """``control_name``: distinct names of a scope that reach an item, without any action."""
    used = within(inherited, entities_in_use(items, own, entity), [entity])
    names = own.select(NAME).unionAll(used.select(NAME))
    return names.where(F.col(NAME).isNotNull()).distinct()


def numbered_names(names: dict[str, DataFrame]) -> DataFrame:
    """``scope, position, control_name``: the names of all scopes with their ordinal, as a lazy query."""
    rows = stack_all([df.select(F.lit(s).alias("scope"), NAME) for s, df in names.items()])
    place = F.row_number().over(Window.partitionBy("scope").orderBy(NAME))
    return rows.select("scope", place.alias("position"), NAME)


def scoped_rows(
    items: DataFrame,
    overrides: DataFrame,
    values: DataFrame,
    options: DataFrame,
    controls: DataFrame,
    *,
    type_code: int,
    entity: str,
    entity_key: str,
    live_only: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(own rows by item, inherited rows by product or location)`` of one scope."""
    own = resolve(scope(overrides, "DynamicControlType", type_code), options, controls, "OrderItemId", "order_item_id")
    own = within(own, items.select("order_item_id"), ["order_item_id"])
    kept = live(values) if live_only else values
    return own, resolve(kept, options, controls, entity_key, entity)


def unique_names(scopes: dict[str, list[str]], taken: list[str]) -> dict[str, dict[str, str]]:
    """Output name per scope and control: the control name, with its scope only where names collide.

    Names are compared without case, as columns are.
    """
    seen = Counter(n.lower() for n in chain(taken, *scopes.values()))
    return {
        scope_name: {n: f"{n} ({scope_name})" if seen[n.lower()] > 1 else n for n in names}
        for scope_name, names in scopes.items()
    }


def cleaned_names(attrs: DataFrame) -> DataFrame:
    """Attribute rows with control names freed of double quotes."""
    return attrs.withColumn(NAME, clean_name(F.col(NAME)))
