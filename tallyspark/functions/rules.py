"""Predicates and value rules on untrusted text. Nothing here throws on bad values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text patterns and domains of the event and purchase contracts.
MONEY = r"^[0-9]{1,18}(\.[0-9]{1,2})?$"
CURRENCY = "^[A-Z]{3}$"
SOURCE_NAME = "^[a-z][a-z0-9_-]{0,63}$"
EVENT_TYPE = r"^[a-z]+\.[a-z_]+$"
ZONED = r"(Z|[+-]\d{2}:?\d{2})$"
PURCHASE_STATES = ("CONFIRMED", "CANCELLED", "REFUNDED")
DOMAINS = ("order", "payment", "shipment", "inventory", "customer")
MOST_ITEMS = 10_000


def codes(rules: dict[str, Column]) -> Column:
    """Names of the rules that hold, in the order given."""
    return F.filter(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())


def bad_money_list(elements: Column) -> Column:
    """Whether any amount (text) of a list is not plain money text; null if the list could not be read.

    Decimals are parsed with rounding, so the text is judged, not the number.
    """
    return F.exists(elements, lambda x: ~F.coalesce(x["amount"].rlike(MONEY), F.lit(False)))


def content_hash(payload: Column) -> Column:
    """A digest of a string map that does not depend on the order of its keys."""
    return F.sha2(F.to_json(F.sort_array(F.map_entries(payload))), 256)


def repeated(items: Column, field: str) -> Column:
    """Whether two elements of an array of structs share a field's value."""
    values = F.transform(items, lambda x: x[field])
    return F.size(F.array_distinct(values)) < F.size(values)


def blank(c: Column) -> Column:
    return c.isNull() | (c == "")
