"""Adapters that shape the given star-schema tables as commerce events, purchases and retail lines.

Everything is derived from the tables by columns alone, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE = "shop"
STATUS_OF = {"P": "REFUNDED"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with timestamps that have no zone read as UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoned = {c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"}
    return df.withColumns(zoned) if zoned else df


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(20,2)")


def padded(number: Column, digits: int) -> Column:
    """A number as text of ``digits`` digits at least; lpad alone would cut longer ones."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(digits)), "0")


def order_name(key: str) -> Column:
    """The source-qualified key of an order, as its typed changes have it."""
    return F.concat_ws(":", F.lit(SOURCE), F.col(key).cast("string"))


def _lines(spark: SparkSession, sf_dir: str, named: bool = False) -> DataFrame:
    """Per order its lines in a total order; a line's id is its place there.

    ``named`` gathers them by the order's qualified key, without what snapshots do not tell (the last of the total order).
    """
    columns = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag", "l_linestatus", "l_discount", "l_tax")
    row = F.struct(*columns[: -2 if named else None])
    lines = table(spark, sf_dir, "lineitem")
    if named:
        lines = lines.withColumn("l_orderkey", order_name("l_orderkey"))
    lines = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(row)).alias("lines"))
    return lines.withColumn("lines", F.transform("lines", lambda x, i: x.withField("line_id", (i + 1).cast("string"))))


def orders_with_lines(spark: SparkSession, sf_dir: str, named: bool = False) -> DataFrame:
    """Orders with customer, country and status, and their lines as an array (empty where there are none).

    ``named`` brings orders and lines together by the qualified key, so that the rows of a task are those of its buckets.
    """
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"), "n_regionkey")
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    lines = _lines(spark, sf_dir, named)
    k = F.col("o_orderkey")
    orders = orders.withColumn("met", order_name("o_orderkey") if named else k)
    return (
        orders.join(customers, "o_custkey", "left")
        .join(nations, "c_nationkey", "left")
        .join(regions, "n_regionkey", "left")
        .join(lines, F.col("met") == F.col("l_orderkey"), "left")
        .select(
            k.alias("k"),
            F.col("o_custkey").alias("customer"),
            "country",
            "region",
            F.col("o_orderdate").alias("at"),
            F.col("o_orderstatus").alias("flag"),
            F.when(k % 5 == 0, "USD").otherwise("EUR").alias("currency"),
            F.when(k % 29 == 0, "CANCELLED").when(F.col("o_orderstatus") == "P", "REFUNDED").otherwise("CONFIRMED").alias("status"),
            F.coalesce("lines", F.array().cast(lines.schema["lines"].dataType)).alias("lines"),
        )
    )


def purchase_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-state purchase snapshots in envelopes, with corrections, repeats and faulty deliveries."""
    base = orders_with_lines(spark, sf_dir, named=True)
    k = F.col("k")
    # All deliveries of an order are laid out from one row, so that lines are gathered once.
    sent = lambda rule, version, variant, again: F.when(rule, F.struct(F.lit(version).alias("version"), F.lit(variant).alias("variant"), F.lit(again).alias("again")))
    kinds = ((F.lit(True), 1, 0), (k % 7 == 0, 2, 0), (k % 103 == 0, 1, 1))
    sends = F.array(*[sent(rule & more, version, variant, again) for again, more in ((0, F.lit(True)), (1, k % 11 == 0)) for rule, version, variant in kinds])
    rows = base.withColumn("sent", F.explode(F.filter(sends, lambda x: x.isNotNull()))).select(*base.columns, "sent.*")
    rows = rows.withColumns({
        "lines": F.when(F.col("version") == 2, F.filter("lines", lambda x: x["l_linenumber"] != 1)).otherwise(F.col("lines")),
        "country": F.when(F.col("variant") == 1, F.concat("country", F.lit(" (other)"))).otherwise(F.col("country")),
    })
    amount = lambda x: x["l_extendedprice"].cast("decimal(20,2)").cast("string")
    items = F.transform(
        "lines",
        lambda x, i: F.struct(
            x["line_id"].alias("line_id"),
            x["l_partkey"].cast("string").alias("product_id"),
            x["l_linestatus"].alias("category"),
            x["l_quantity"].cast("long").alias("quantity"),
            F.when((k % 101 == 0) & (i == 0), F.concat(amount(x), F.lit("9"))).otherwise(amount(x)).alias("amount"),
        ),
    )
    moment = F.date_format(F.col("at") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    returns = F.transform(
        F.filter("lines", lambda x: x["l_returnflag"] == "R"),
        lambda x: F.struct(
            F.concat(F.lit("r"), x["line_id"]).alias("return_id"),
            x["line_id"].alias("line_id"),
            F.lit(1).cast("long").alias("quantity"),
            F.when(x["l_quantity"] == 1, amount(x)).otherwise("1.00").alias("amount"),
            moment.alias("occurred_at"),
        ),
    )
    fields = {
        "source": F.lit(SOURCE),
        "order_id": k.cast("string"),
        "version": F.col("version").cast("string"),
        "customer_id": F.when(F.col("customer") % 50 != 0, F.col("customer").cast("string")),
        "currency": F.when(k % 97 == 0, "eur").otherwise(F.col("currency")),
        "country": F.col("country"),
        "purchased_at": F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "status": F.col("status"),
        "items": F.to_json(items),
        "returns": F.to_json(returns),
    }
    payload = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*fields.values())), lambda _, v: v.isNotNull())
    early = (k % 14 == 0) & (F.col("version") == 2)
    known = F.col("at") + F.expr("INTERVAL 2 DAYS") + F.when(early, F.expr("INTERVAL -1 HOUR")).otherwise(F.make_dt_interval(hours=F.col("version")))
    return rows.select(
        F.sha2(F.concat_ws(":", F.lit(SOURCE), k.cast("string"), F.col("version").cast("string"), F.when(F.col("variant") > 0, "other")), 256).alias("event_id"),
        F.lit("order.snapshot").alias("event_type"),
        F.lit(1).alias("event_version"),
        F.col("at").alias("occurred_at"),
        F.col("at").alias("produced_at"),
        F.lit("storefront").alias("producer"),
        F.lit(None).cast("string").alias("trace_id"),
        k.cast("string").alias("partition_key"),
        payload.alias("payload"),
        F.col("version").cast("long").alias("producer_sequence"),
        F.lit("purchases").alias("source_topic"),
        (k % 3).cast("int").alias("source_partition"),
        (k * 8 + F.col("version") * 2 + F.col("variant") + F.col("again") * F.lit(4_000_000_000)).alias("source_offset"),
        F.col("at").alias("source_timestamp"),
        (known + F.make_dt_interval(hours=F.col("again"))).alias("ingested_at"),
        F.lit("fixture").alias("ingestion_run_id"),
        F.array().cast("array<string>").alias("quality_flags"),
        # Batches of deliveries: most orders first, every tenth later, corrections last.
        F.when(F.col("version") == 2, 3).when(k % 10 == 9, 2).otherwise(1).alias("batch_id"),
    )


def _payload(fields: dict[str, Column]) -> Column:
    """The fields that are not null, as texts by name."""
    return F.map_filter(F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*[c.cast("string") for c in fields.values()])), lambda _, v: v.isNotNull())


def _bronze(rows: DataFrame, topic: str, at: Column, key: Column, sequence: Column, event_type: Column, fields: dict[str, Column] | Column, event_id: Column, partition: Column, offset: Column) -> DataFrame:
    payload = _payload(fields) if isinstance(fields, dict) else fields
    return rows.select(
        event_id.alias("event_id"),
        event_type.alias("event_type"),
        F.lit(1).alias("event_version"),
        at.alias("occurred_at"),
        at.alias("produced_at"),
        F.lit("fixture").alias("producer"),
        F.lit(None).cast("string").alias("trace_id"),
        key.cast("string").alias("partition_key"),
        payload.alias("payload"),
        sequence.cast("long").alias("producer_sequence"),
        F.lit(topic).alias("source_topic"),
        partition.cast("int").alias("source_partition"),
        offset.cast("long").alias("source_offset"),
        at.alias("source_timestamp"),
        at.alias("ingested_at"),
        F.lit("fixture").alias("ingestion_run_id"),
        F.array().cast("array<string>").alias("quality_flags"),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A created event for each line of an order (one where it has none), then confirmed or cancelled, and refunded events."""
    base = orders_with_lines(spark, sf_dir)
    k = F.col("k")
    total = F.aggregate("lines", F.lit(0).cast("decimal(20,2)"), lambda a, x: (a + x["l_extendedprice"].cast("decimal(20,2)")).cast("decimal(20,2)"))
    step = lambda n, kind, line, x: F.struct(
        F.lit(n).alias("n"), kind.alias("type"), line.cast("int").alias("line"), x["l_partkey"].alias("sku"), (x["l_suppkey"] % 5).alias("location"), x["l_quantity"].cast("long").alias("quantity")
    )
    # A step takes what it tells of its line along, and what the order tells is summed before: no event carries all lines.
    first = F.get("lines", F.lit(0))
    created = F.when(F.size("lines") > 0, F.transform("lines", lambda x, i: step(1, F.lit("order.created"), i + 1, x))).otherwise(F.array(step(1, F.lit("order.created"), F.lit(1), first)))
    later = F.array(
        step(2, F.when(k % 29 == 0, "order.cancelled").otherwise("order.confirmed"), F.lit(1), first),
        F.when(F.col("flag") == "P", step(3, F.lit("order.refunded"), F.lit(1), first)),
    )
    steps = F.filter(F.concat(created, later), lambda x: x.isNotNull())
    seller = F.array_min(F.transform("lines", lambda x: x["l_suppkey"]))
    told = _payload({
        "order_id": k,
        "seller_id": seller,
        "customer_token": F.col("customer"),
        "market": F.substring("region", 1, 2),
        "currency": F.col("currency"),
        "gross_amount": total,
        "created_at": F.date_format("at", "yyyy-MM-dd HH:mm:ss"),
    })
    # In a select of its own: beside explode it would be made for each event again, from lines that each event carries.
    rows = base.select("k", "at", told.alias("told"), steps.alias("steps")).select("k", "at", "told", F.explode("steps").alias("step"))
    n = F.col("step.n")
    of_line = {"sku": F.col("step.sku"), "location_id": F.col("step.location"), "quantity": F.col("step.quantity")}
    whole = F.create_map(*[x for name, c in of_line.items() for x in (F.lit(name), c.cast("string"))])
    line = F.when(F.col("step.sku").isNotNull() & F.col("step.location").isNotNull() & F.col("step.quantity").isNotNull(), whole).otherwise(_payload(of_line))
    return _bronze(
        rows, "orders", F.col("at") + F.make_dt_interval(hours=n - 1), k, n, F.col("step.type"),
        F.map_concat("told", line),
        # A line's event after the first has the line in its id.
        F.concat_ws("-", F.lit("order"), k.cast("string"), n.cast("string"), F.when(F.col("step.line") > 1, F.col("step.line").cast("string"))), k % 3, k * 64 + n * 16 + F.col("step.line"),
    )


def payment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authorized payments, then captured or failed by order status; every 41st capture is short by one, every 43rd missing."""
    base = orders_with_lines(spark, sf_dir)
    k = F.col("k")
    total = F.aggregate("lines", F.lit(0).cast("decimal(20,2)"), lambda a, x: (a + x["l_extendedprice"].cast("decimal(20,2)")).cast("decimal(20,2)"))
    steps = F.array(
        F.struct(F.lit(1).alias("n"), F.lit("payment.authorized").alias("type")),
        F.when(k % 43 != 0, F.struct(F.lit(2).alias("n"), F.when(F.col("flag") == "O", "payment.failed").otherwise("payment.captured").alias("type"))),
        F.when(F.col("flag") == "P", F.struct(F.lit(3).alias("n"), F.lit("payment.reversed").alias("type"))),
    )
    base = base.select("k", "at", "flag", "currency", total.alias("total"))  # summed once an order; no event carries its lines
    rows = base.withColumn("step", F.explode(F.filter(steps, lambda x: x.isNotNull())))
    n = F.col("step.n")
    return _bronze(
        rows, "payments", F.col("at") + F.make_dt_interval(hours=n), k, n, F.col("step.type"),
        {
            "payment_id": F.concat(F.lit("p"), k.cast("string")),
            "order_id": k,
            "currency": F.when(k % 47 == 0, "GBP").otherwise(F.col("currency")),
            "amount": F.when(k % 41 == 0, F.col("total") + 1).otherwise(F.col("total")).cast("decimal(20,2)"),
        },
        F.concat_ws("-", F.lit("payment"), k.cast("string"), n.cast("string")), k % 3, k * 4 + n,
    )


def shipment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created, dispatched and delivered (or exception) events, one shipment per order, from its first ship date."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("ship"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("at"))
    k = F.col("l_orderkey")
    steps = F.array(
        F.struct(F.lit(1).alias("n"), F.lit("shipment.created").alias("type")),
        F.struct(F.lit(2).alias("n"), F.lit("shipment.dispatched").alias("type")),
        F.struct(F.lit(3).alias("n"), F.when(k % 37 == 0, "shipment.exception").otherwise("shipment.delivered").alias("type")),
    )
    rows = lines.join(orders, "l_orderkey").withColumn("step", F.explode(steps))
    n = F.col("step.n")
    return _bronze(
        rows, "shipments", F.col("ship") + F.make_dt_interval(days=n - 1), k, n, F.col("step.type"),
        {"shipment_id": F.concat(F.lit("s"), k.cast("string")), "order_id": k, "promised_at": F.date_format(F.col("at") + F.expr("INTERVAL 30 DAYS"), "yyyy-MM-dd HH:mm:ss")},
        F.concat_ws("-", F.lit("shipment"), k.cast("string"), n.cast("string")), k % 3, k * 4 + n,
    )


def inventory_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An adjustment of 100 at the first ship date of a SKU and location, a reservation per line, a release per return."""
    lines = _lines(spark, sf_dir).select("l_orderkey", F.explode("lines").alias("x")).select("l_orderkey", "x.*")
    place = (F.col("l_suppkey") % 5).alias("location")
    opened = lines.groupBy(F.col("l_partkey").alias("sku"), place).agg(F.min("l_shipdate").alias("at"))
    opened = opened.select("sku", "location", "at", F.lit("inventory.adjusted").alias("type"), F.lit(100).cast("long").alias("q"), F.concat_ws("-", F.lit("open"), "sku", "location").alias("id"))
    kinds = F.array(F.lit("inventory.reserved"), F.when(F.col("l_returnflag") == "R", F.lit("inventory.released")))
    moves = lines.select(
        F.col("l_partkey").alias("sku"), place, F.col("l_shipdate").alias("at"), F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("type"),
        F.col("l_quantity").cast("long").alias("q"), F.concat_ws("-", "l_orderkey", "line_id").alias("id"),
    )
    rows = opened.unionByName(moves)
    adjusted = F.col("type") == "inventory.adjusted"
    return _bronze(
        rows, "inventory", F.col("at"), F.col("sku"), F.lit(1), F.col("type"),
        {"sku": F.col("sku"), "location_id": F.col("location"), "quantity": F.when(~adjusted, F.col("q")), "quantity_delta": F.when(adjusted, F.col("q"))},
        F.concat_ws("-", "id", "type"), F.col("sku") % 3, F.pmod(F.xxhash64("id", "type"), F.lit(1 << 40)),
    )


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer change events from user activity; times are cut to the hour, so changes tie."""
    rows = table(spark, sf_dir, "events")
    e = F.col("event_id")
    tier = F.when(F.col("event_type") == "signup", "PLUS").when(F.col("event_type") == "purchase", "PREMIUM").otherwise("STANDARD")
    return _bronze(
        rows, "customers", F.date_trunc("hour", F.col("ts")), F.col("user_id"), e, F.lit("customer.changed"),
        {
            "customer_id": F.col("user_id"),
            "op": F.when(F.col("event_type") == "error", "d").otherwise("u"),
            "email_token": F.concat(F.lit("t"), F.col("user_id").cast("string")),
            "country": F.element_at(F.array(F.lit("IT"), F.lit("DE"), F.lit("FR")), (e % 3 + 1).cast("int")),
            "customer_tier": tier,
            "source_lsn": e,
        },
        e.cast("string"), F.col("user_id") % 3, e,
    )


def raw_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker records with JSON envelopes: truncated, incomplete, repeated and late ones among them."""
    rows = table(spark, sf_dir, "events")
    e = F.col("event_id")
    at = F.when(e % 53 == 0, F.col("ts") - F.expr("INTERVAL 30 HOURS")).otherwise(F.col("ts"))
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    envelope = F.to_json(
        F.struct(
            F.concat(F.lit("event-"), F.lpad(e.cast("string"), 8, "0")).alias("event_id"),
            F.concat(F.lit("site."), F.col("event_type")).alias("event_type"),
            F.lit(1).alias("event_version"),
            F.when(e % 43 != 0, stamp).alias("occurred_at"),
            F.date_format(F.when(e % 59 == 0, at - F.expr("INTERVAL 1 HOUR")).otherwise(at), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("produced_at"),
            F.lit("site").alias("producer"),
            F.concat(F.lit("trace-"), F.lpad(e.cast("string"), 8, "0")).alias("trace_id"),
            F.col("user_id").cast("string").alias("partition_key"),
            F.map_filter(
                F.create_map(
                    F.lit("amount"), F.when(e % 61 == 0, "1e999").otherwise(F.col("value").cast("decimal(20,2)").cast("string")),
                    F.lit("currency"), F.when(e % 67 == 0, "euro").otherwise("EUR"),
                    F.lit("quantity"), F.when(e % 71 == 0, "several").otherwise("1"),
                ),
                lambda _, v: v.isNotNull(),
            ).alias("payload"),
            e.alias("producer_sequence"),
        )
    )
    value = F.when(e % 41 == 0, F.substring(envelope, 1, 20)).otherwise(envelope)
    base = rows.select(e.alias("e"), F.col("user_id").cast("string").cast("binary").alias("key"), value.cast("binary").alias("value"), F.col("event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"), (e * 2).alias("offset"), F.col("ts").alias("timestamp"))
    again = base.where(e % 17 == 0).withColumn("offset", F.col("offset") + 1)
    return base.unionByName(again).drop("e")


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spreadsheet rows, all strings: invoice, product, quantity, day serial, price, customer, country."""
    base = orders_with_lines(spark, sf_dir).select("k", "customer", "country", "at", F.explode("lines").alias("x"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), "p_retailprice")
    k = F.col("k")
    rows = base.withColumn("part", F.col("x.l_partkey")).join(parts, "part", "left")
    # A product has five digits; what goes beyond them follows as letters.
    beyond = F.when(F.col("part") < 100_000, "").otherwise(F.translate(F.floor(F.col("part") / 100_000).cast("string"), "0123456789", "ABCDEFGHIJ"))
    cells = {
        "row_id": F.concat_ws("-", k.cast("string"), F.col("x.line_id")),
        "invoice": F.concat(F.when(k % 19 == 0, "C").otherwise(""), padded(k, 6)),
        "product": F.when(F.col("part") % 23 == 0, "POST").otherwise(F.concat(F.lpad((F.col("part") % 100_000).cast("string"), 5, "0"), beyond)),
        "quantity": F.when(k % 31 == 0, "0").otherwise(F.col("x.l_quantity").cast("long").cast("string")),
        "day_serial": F.datediff(F.col("at"), F.lit("1899-12-30").cast("date")).cast("string"),
        "price": F.when(F.col("part") % 37 == 0, "NaN").when(F.col("part") % 41 == 0, "n/a").otherwise(F.col("p_retailprice").cast("decimal(20,2)").cast("string")),
        "customer": F.when(F.col("customer") % 50 == 0, "").otherwise(F.col("customer").cast("string")),
        "country": F.when((k % 53 == 0) & (F.col("x.line_id") == "2"), "Elsewhere").otherwise(F.col("country")),
    }
    return rows.select(*[c.alias(n) for n, c in cells.items()])
