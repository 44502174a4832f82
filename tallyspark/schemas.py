"""Types of the event envelope, of nested purchase contents and of control rows."""

from __future__ import annotations

KAFKA_SHAPE = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"

ENVELOPE = (
    "event_id string, event_type string, event_version int, occurred_at timestamp, produced_at timestamp, "
    "producer string, trace_id string, partition_key string, payload map<string,string>, producer_sequence long"
)

ITEMS = "array<struct<line_id:string,product_id:string,category:string,quantity:bigint,amount:decimal(20,2)>>"
RETURNS = "array<struct<return_id:string,line_id:string,quantity:bigint,amount:decimal(20,2),occurred_at:timestamp>>"

SNAPSHOT = (
    "source string, order_id string, version long, customer_id string, currency string, country string, "
    f"purchased_at string, status string, items {ITEMS.replace('decimal(20,2)', 'string')}, "
    f"returns {RETURNS.replace('decimal(20,2)', 'string').replace('timestamp', 'string')}"
)

AUDIT = (
    "run_id string, pipeline string, dataset string, started_at timestamp, ended_at timestamp, status string, "
    "input_rows long, output_rows long, rejected_rows long, input_bound string, output_version string, "
    "settings map<string,string>, failure string"
)

PUBLICATION = "pipeline string, sequence long, as_of date, bound long, visibility string, versions map<string,string>, created_by string"
