"""Raw retail invoice lines to purchases: a reason for each line, and invoices of accepted lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import MOST_ITEMS

# Reasons in the order in which they are judged, and identities of the source.
REASONS = ("header", "unlinked_cancellation", "non_product_or_missing_invoice", "invalid_quantity", "non_positive_price", "invalid_value", "accepted")
SOURCE, CURRENCY, ZONE = "uci-retail", "GBP", "Europe/London"
PRODUCT = "^[0-9]{5}[A-Za-z]*$"


def classify(lines: DataFrame) -> DataFrame:
    """Spreadsheet rows (all strings) with a reason, and typed quantity and price.

    Quantity and price are both read before either is judged, so text that is no number is an invalid value.
    """
    c = F.col
    quantity, price = c("quantity").try_cast("decimal(18,0)"), c("price").try_cast("decimal(20,6)")
    not_a_number = F.upper(F.trim("price")) == "NAN"
    readable = quantity.isNotNull() & (price.isNotNull() | not_a_number)
    reason = (
        F.when(F.lower("invoice") == "invoice", "header")
        .when(F.upper("invoice").startswith("C"), "unlinked_cancellation")
        .when(F.coalesce(F.length(F.trim("invoice")), F.lit(0)) == 0, "non_product_or_missing_invoice")
        .when(~F.coalesce(c("product").rlike(PRODUCT), F.lit(False)), "non_product_or_missing_invoice")
        .when(~F.coalesce(readable, F.lit(False)), "invalid_value")
        .when(quantity <= 0, "invalid_quantity")
        .when(not_a_number | (price <= 0), "non_positive_price")
        .when(c("day_serial").try_cast("double").isNull() | (F.coalesce(F.length(F.trim("country")), F.lit(0)) == 0), "invalid_value")
        .otherwise("accepted")
    )
    return lines.withColumns({"reason": reason, "q": quantity.cast("long"), "p": price})


def typed_lines(classified: DataFrame) -> DataFrame:
    """Accepted lines: UTC time from the day serial, pseudonymous customer, amount rounded half up."""
    seconds = F.round(F.col("day_serial").try_cast("double") * 86_400).cast("long")
    local = F.timestamp_add("SECOND", seconds, F.lit("1899-12-30").cast("timestamp"))
    customer = F.when(F.length(F.trim("customer")) > 0, F.substring(F.sha2(F.trim("customer"), 256), 1, 20))
    return classified.where("reason = 'accepted'").select(
        F.col("row_id").alias("line_id"),
        "invoice",
        F.col("product").alias("product_id"),
        F.col("q").alias("quantity"),
        F.round(F.col("p") * F.col("q"), 2).cast("decimal(20,2)").alias("amount"),
        F.to_utc_timestamp(local, ZONE).alias("purchased_at"),
        customer.alias("customer_id"),
        "country",
    )


def invoices(lines: DataFrame) -> DataFrame:
    """One row per invoice with its lines in order; ``problem`` names why an invoice is left out.

    An invoice with more than one header (time, customer, country), or more lines than a purchase may
    have, is left out. Lines are gathered only for invoices within that bound.
    """
    header = F.struct("purchased_at", F.coalesce("customer_id", F.lit("")).alias("c"), "country")
    facts = lines.groupBy("invoice").agg(F.min(header).alias("low"), F.max(header).alias("high"), F.count(F.lit(1)).alias("lines"), F.sum("amount").cast("decimal(38,2)").alias("amount"))
    problem = F.when(F.col("low") != F.col("high"), "conflicting_headers").when(F.col("lines") > MOST_ITEMS, "too_many_lines")
    return facts.select("invoice", "lines", "amount", F.col("low.purchased_at").alias("purchased_at"), F.nullif("low.c", F.lit("")).alias("customer_id"), F.col("low.country").alias("country"), problem.alias("problem"))


def retail_purchases(lines: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """Invoices without a problem as full-state purchases."""
    good = (invoices(lines) if heads is None else heads).where("problem is null")
    item = F.struct("line_id", "product_id", F.lit("retail").alias("category"), "quantity", F.col("amount").alias("amount"))
    items = lines.join(good.select("invoice"), "invoice", "left_semi").groupBy("invoice").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return good.join(items, "invoice").select(
        F.lit(SOURCE).alias("source"), F.col("invoice").alias("order_id"), F.lit(1).cast("long").alias("version"), "customer_id", F.lit(CURRENCY).alias("currency"),
        "country", "purchased_at", F.lit("CONFIRMED").alias("status"), "items",
    )


def import_report(classified: DataFrame, heads: DataFrame) -> DataFrame:
    """Counts: lines by reason, invoices and lines published, invoices left out by problem."""
    lines = classified.groupBy(F.concat(F.lit("lines_"), F.col("reason")).alias("measure")).agg(F.count(F.lit(1)).alias("n"))
    orders = heads.groupBy(F.concat(F.lit("invoices_"), F.coalesce("problem", F.lit("published"))).alias("measure")).agg(F.count(F.lit(1)).alias("n"))
    published = heads.where("problem is null").agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("n")).select(F.lit("lines_published").alias("measure"), "n")
    return lines.unionByName(orders).unionByName(published)
