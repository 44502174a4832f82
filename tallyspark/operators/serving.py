"""Served queries: summaries, pages by key, drill-downs and the retention matrix, over frames pinned to one publication."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .marts import SUMMED, retention_matrix

PAGE = 50
DETAIL_DAYS = 366
MOST_ROWS = 500


class Frames(Mapping):
    """Frames by name, each made at its first use."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def also(self, **makers: Callable[[], DataFrame]) -> Frames:
        return Frames(self._makers | makers)


class Capped(NamedTuple):
    rows: DataFrame
    truncated: bool


def observation_window(as_of: date, start: date | None = None, end: date | None = None, days: int = 90) -> tuple[date, date]:
    """The asked window cut to what has been observed; by default the last ``days`` days."""
    last = min(end or as_of, as_of)
    first = start or last - timedelta(days=days - 1)
    if first > last:
        raise ValueError("the window starts after it ends")
    return first, last


def _within(daily: DataFrame, first, last, currency: str) -> DataFrame:
    return daily.where((F.col("currency") == currency) & F.col("metric_date").between(F.lit(first), F.lit(last)))


def summary(profiles: DataFrame, currency: str) -> DataFrame:
    """Customers, orders and net amount of the last 90 days, and customers with two orders or more, in one row."""
    rows = profiles.where(F.col("currency") == currency)
    return rows.agg(
        F.count(F.lit(1)).alias("customers"),
        F.coalesce(F.sum("orders_90d"), F.lit(0)).alias("orders"),
        F.coalesce(F.sum("net_amount_90d"), F.lit(0)).cast("decimal(38,2)").alias("net_amount"),
        F.count_if(F.col("orders_90d") >= 2).alias("repeat_customers"),
    )


def whole_months(first: date, last: date) -> tuple[date, date] | None:
    """First days of the first and last calendar month that lie wholly within the window, if any does."""
    begin = first if first.day == 1 else (first.replace(day=1) + timedelta(days=32)).replace(day=1)
    beyond = (last + timedelta(days=1)).replace(day=1)
    return (begin, (beyond - timedelta(days=1)).replace(day=1)) if begin < beyond else None


def window_facts(daily: DataFrame, months: DataFrame | None, key: str, first: date, last: date, currency: str) -> DataFrame:
    """Rows that add up to a window: the monthly sums of whole months, and the daily facts of the days at its edges.

    Without ``months`` all are daily. Both tables may be laid out by a column ``month`` (yyyy-MM), which is filtered
    too, so that other months are not read. The columns are the key and the measures that both have.
    """
    inner = whole_months(first, last) if months is not None else None
    keep = [key, *[c for c in SUMMED if c in daily.columns]]
    days = _within(daily, first, last, currency)
    if inner:
        after = (inner[1] + timedelta(days=32)).replace(day=1)
        days = days.where((F.col("metric_date") < F.lit(inner[0])) | (F.col("metric_date") >= F.lit(after)))
    if "month" in daily.columns:
        edges = {f"{d:%Y-%m}" for d in (first, last)} if inner else None
        days = days.where(F.col("month").isin(sorted(edges)) if edges else F.col("month").between(f"{first:%Y-%m}", f"{last:%Y-%m}"))
    if not inner:
        return days.select(*keep)
    rows = months.where((F.col("currency") == currency) & F.col("first_day").between(F.lit(inner[0]), F.lit(inner[1])))
    if "month" in months.columns:
        rows = rows.where(F.col("month").between(f"{inner[0]:%Y-%m}", f"{inner[1]:%Y-%m}"))
    rows = rows.select(*keep)
    # Where no day lies at an edge, the daily table is not looked at.
    return rows if inner[0] == first and after == last + timedelta(days=1) else rows.unionByName(days.select(*keep))


def _per_customer(facts: DataFrame) -> DataFrame:
    return facts.groupBy("customer_key").agg(F.sum("orders").alias("orders"), F.sum("net_amount").cast("decimal(38,2)").alias("net_amount"))


def window_summary(daily: DataFrame, first, last, currency: str, months: DataFrame | None = None) -> DataFrame:
    """The same figures over a window of days: first by customer, then over all. ``months`` are the monthly sums, if any."""
    each = _per_customer(window_facts(daily, months, "customer_key", first, last, currency))
    return each.agg(
        F.count(F.lit(1)).alias("customers"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        F.coalesce(F.sum("net_amount"), F.lit(0)).cast("decimal(38,2)").alias("net_amount"),
        F.count_if(F.col("orders") >= 2).alias("repeat_customers"),
    )


def segment_sizes(profiles: DataFrame, currency: str) -> DataFrame:
    return profiles.where(F.col("currency") == currency).groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))


def page(rows: DataFrame, key: str, after: str | None = None, size: int = PAGE) -> DataFrame:
    """The rows after a key in key order, one more than the page holds: that one tells that there is a next page."""
    if after is not None:
        rows = rows.where(F.col(key) > after)
    return rows.orderBy(key).limit(size + 1)


def split_page(rows: list, key: str, size: int = PAGE) -> tuple[list, str | None]:
    """A fetched page's rows, and the key after which the next one begins, if any."""
    return rows[:size], rows[size - 1][key] if len(rows) > size else None


def customer_page(profiles: DataFrame, currency: str, after: str | None = None, segment: str | None = None) -> DataFrame:
    rows = profiles.where(F.col("currency") == currency)
    if segment:
        rows = rows.where(F.col("segment") == segment)
    return page(rows, "customer_key", after)


def customer_page_window(profiles: DataFrame, daily: DataFrame, first, last, currency: str, after: str | None = None, months: DataFrame | None = None) -> DataFrame:
    """A page of customers with their figures of a window; filters reach both sides before the join."""
    keyed = profiles.where(F.col("currency") == currency).select("customer_key", "segment", "last_purchase")
    rows = window_facts(daily, months, "customer_key", first, last, currency)
    if after is not None:
        keyed, rows = (df.where(F.col("customer_key") > after) for df in (keyed, rows))
    return page(keyed.join(_per_customer(rows), "customer_key"), "customer_key")


def product_totals(products: DataFrame, first, last, currency: str, months: DataFrame | None = None) -> DataFrame:
    sums = {c: F.sum(c) for c in ("orders", "units", "returned_units")} | {c: F.sum(c).cast("decimal(38,2)") for c in ("gross_amount", "net_amount")}
    return window_facts(products, months, "product_key", first, last, currency).groupBy("product_key").agg(*[s.alias(c) for c, s in sums.items()])


def product_page(products: DataFrame, first, last, currency: str, after: str | None = None, months: DataFrame | None = None) -> DataFrame:
    if after is not None:
        products = products.where(F.col("product_key") > after)
        months = None if months is None else months.where(F.col("product_key") > after)
    return page(product_totals(products, first, last, currency, months), "product_key")


def entity_detail(daily: DataFrame, key: str, value: str, first, last, currency: str) -> DataFrame:
    """An entity's newest daily rows of a window."""
    rows = _within(daily, first, last, currency).where(F.col(key) == value).drop("month")
    return rows.orderBy(F.col("metric_date").desc()).limit(DETAIL_DAYS)


def latest_cohorts(cohorts: DataFrame, as_of: date, currency: str, cohort_months: int = 24, months: int = 12) -> DataFrame:
    """The newest cohorts and their first months."""
    oldest = F.add_months(F.trunc(F.lit(as_of), "month"), 1 - cohort_months)
    rows = cohorts.where((F.col("currency") == currency) & (F.col("cohort_month") >= oldest) & (F.col("month_number") <= months))
    return rows.orderBy("cohort_month", "month_number").limit(cohort_months * (months + 1) + 1)


def market_overview(orders: DataFrame) -> DataFrame:
    return orders.groupBy("market", "currency").agg(F.count(F.lit(1)).alias("orders"), F.sum("gross_amount").cast("decimal(38,2)").alias("gmv"))


def layer_counts(**layers: DataFrame) -> DataFrame:
    """One row with the row count of each named frame."""
    out = None
    for name, df in layers.items():
        one = df.agg(F.count(F.lit(1)).alias(name))
        out = one if out is None else out.join(one)  # one row each
    return out


def capped(rows: DataFrame, most: int = MOST_ROWS) -> Capped:
    """At most ``most`` rows, and whether there were more. The input runs once: only its first rows are fetched."""
    fetched = rows.limit(most + 1).collect()
    return Capped(rows.sparkSession.createDataFrame(fetched[:most], rows.schema), len(fetched) > most)


def certified_kpis(kpis: DataFrame, limit: int = 100) -> DataFrame:
    return kpis.orderBy(F.col("metric_date").desc(), "market", "seller_tier", "currency").limit(limit)


def newest_rejections(rejected: DataFrame, limit: int = 50) -> DataFrame:
    """A report of the newest rejections; of equal times in order of key."""
    return rejected.orderBy(F.col("known_at").desc(), "order_key", "version", "country", "rejection_id").limit(limit)


def dashboard(frames: Mapping[str, DataFrame], as_of: date, currency: str, first: date | None = None, last: date | None = None, after: str | None = None) -> Frames:
    """All frames of the dashboard for one publication (customer_daily, customer_profiles, product_daily, customer_cohorts, and the monthly sums if there are any).

    Each is made when it is asked for, so that no table is opened that it does not read.
    """
    custom = first is not None or last is not None
    begin, end = observation_window(as_of, first, last)
    of = frames.__getitem__
    cohorts = lambda: latest_cohorts(of("customer_cohorts"), as_of, currency)
    return Frames({
        "summary": lambda: window_summary(of("customer_daily"), begin, end, currency, frames.get("customer_monthly")) if custom else summary(of("customer_profiles"), currency),
        "segments": lambda: segment_sizes(of("customer_profiles"), currency),
        "customers": lambda: customer_page_window(of("customer_profiles"), of("customer_daily"), begin, end, currency, after, frames.get("customer_monthly")) if custom else customer_page(of("customer_profiles"), currency, after),
        "products": lambda: product_page(of("product_daily"), begin, end, currency, months=frames.get("product_monthly")),
        "cohorts": cohorts,
        "retention": lambda: retention_matrix(cohorts()),
    })
