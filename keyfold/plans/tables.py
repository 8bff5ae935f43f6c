"""Keyed logs derived from the test tables.

Each function reads only the columns it needs and adds no shuffle of its own
beyond what its operator-based derivations name. ``off`` and ``seq`` are the
event id, which rises with the event's time; offsets need not be dense.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.functions.errors import error_category
from keyfold.functions.times import from_micros, instant, micros
from keyfold.operators.scan import Running, by_position, running
from keyfold.operators.sequence import per_key_sequence
from keyfold.session import configure

HOUR_US = 3_600_000_000

# Known columns save reading every file's footer before a query is planned.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def pick(column: str, choices: dict, otherwise=None):
    """CASE over the values of a column."""
    out = None
    for value, result in choices.items():
        hit = F.col(column) == value
        result = result if hasattr(result, "alias") else F.lit(result)
        out = F.when(hit, result) if out is None else out.when(hit, result)
    return out if otherwise is None else out.otherwise(otherwise)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("part"),
        F.col("event_id").alias("off"),
        instant("ts").alias("ts"),
        F.col("user_id").cast("string").alias("key"),
        "event_id", "user_id", "event_type", "value", "props",
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record log: three payload forms, and every 97th record an excise."""
    excise = F.col("event_id") % 97 == 96
    number = F.col("event_id").cast("string")
    payload = (
        F.when(F.col("event_id") % 3 == 0, F.concat(
            F.lit('{"id":"e'), number, F.lit('","type":"'), F.col("event_type"), F.lit('"}')))
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"id":'), number, F.lit(',"type":null}')))
        .otherwise(F.col("props"))
    )
    return events(spark, sf_dir).select(
        "topic", "part", "off", "ts", "key", "event_id",
        F.col("event_type").alias("dup_id"),
        pick("event_type", {
            "purchase": "order.purchase", "signup": "account.signup",
            "click": "user.click", "view": "admin.user.view",
        }).alias("type"),
        F.when(F.col("event_id") % 10 == 0, "group-a")
        .when(F.col("event_id") % 10 != 1, "group-b").alias("source_system"),
        excise.alias("is_excise"),
        F.when(~excise, F.col("value")).alias("item"),
        F.when(~excise, payload).alias("payload"),
    )


def _ops(spark, sf_dir, collection, op, item, map_key=None) -> DataFrame:
    source = events(spark, sf_dir)
    columns = ["topic", "key", F.lit(collection).alias("collection"),
               F.col("event_id").alias("seq"), "ts", op.alias("op")]
    if map_key is not None:
        columns.append(map_key.alias("map_key"))
    return source.select(*columns, item.alias("item"))


def value_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = pick("event_type", {"error": "clear", "view": "get"}, "set")
    return _ops(spark, sf_dir, "total", op, F.when(op == "set", F.col("value")))


def map_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = F.col("event_type") == "error"
    op = F.when(error & (F.col("event_id") % 5 == 0), "clear").when(error, "delete").otherwise("set")
    key = F.concat(F.lit("k"), (F.col("event_id") % 7).cast("string"))
    return _ops(spark, sf_dir, "totals", op, F.when(op == "set", F.col("value")), key)


def push_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = pick("event_type", {"error": "clear"}, "push")
    return _ops(spark, sf_dir, "backlog", op, F.when(op == "push", F.col("event_id")))


def queue_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = pick("event_type", {"purchase": "shift", "error": "shift"}, "push")
    return _ops(spark, sf_dir, "queue", op, F.when(op == "push", F.col("event_id")))


def deque_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = F.when(F.col("event_id") % 29 == 0, "clear").otherwise(pick("event_type", {
        "click": "unshift", "purchase": "pop", "error": "shift",
    }, "push"))
    return _ops(spark, sf_dir, "deque", op,
                F.when(op.isin("push", "unshift"), F.col("event_id")))


def message_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pushes of whole messages, as references into the record log."""
    ref = F.struct("topic", "part", "off")
    return _ops(spark, sf_dir, "messages", F.lit("push"), ref)


def message_map_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = pick("event_type", {"error": "delete"}, "set")
    key = F.concat(F.lit("k"), (F.col("event_id") % 7).cast("string"))
    return _ops(spark, sf_dir, "msg-index", op,
                F.when(op == "set", F.struct("topic", "part", "off")), key)


def _in_attempts(rows: DataFrame) -> DataFrame:
    """Two days of a key's operations make one attempt."""
    turn = F.col("attempt") + F.col("user_id")
    return rows.withColumn("attempt", F.floor(micros("ts") / F.lit(48 * HOUR_US)).cast("bigint")).withColumn(
        "outcome", F.when(turn % 3 == 0, "failed").when(turn % 11 == 5, "crashed").otherwise("ok"))


def txn_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = pick("event_type", {"click": "commit", "error": "rollback"}, "set")
    return _in_attempts(events(spark, sf_dir)).select(
        "topic", "key", F.lit("total").alias("collection"), "attempt", "outcome",
        F.col("event_id").alias("seq"), "ts", op.alias("op"),
        F.when(op == "set", F.col("value")).alias("item"),
    )


def _attempted(spark: SparkSession, sf_dir: str, collection: str, op, item, map_key=None) -> DataFrame:
    """Operations of attempts as in ``txn_ops``, on another collection."""
    control = pick("event_type", {"click": "commit", "error": "rollback"})
    op = F.coalesce(control, op)
    columns = [] if map_key is None else [map_key.alias("map_key")]
    return _in_attempts(events(spark, sf_dir)).select(
        "topic", "key", F.lit(collection).alias("collection"), "attempt", "outcome", F.col("event_id").alias("seq"), "ts",
        op.alias("op"), *columns, F.when(op.isin("set", "push"), item).alias("item"))


def txn_map_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = F.when(F.col("event_type") != "purchase", "set").when(F.col("event_id") % 5 == 0, "clear").otherwise("delete")
    return _attempted(spark, sf_dir, "totals", op, F.col("value"),
                      F.concat(F.lit("k"), (F.col("event_id") % 7).cast("string")))


def txn_deque_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attempted(spark, sf_dir, "backlog", pick("event_type", {"purchase": "shift"}, "push"), F.col("event_id"))


def catalog_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups publish and retire collections as events go by."""
    return events(spark, sf_dir).select(
        F.when(F.col("event_id") % 2 == 0, "checkout").otherwise("billing").alias("subsystem"),
        F.col("event_type").alias("collection"), F.concat(F.lit("g"), F.col("key")).alias("group_id"),
        F.when(F.col("event_id") % 11 == 0, "message").otherwise("json").alias("payload"),
        (F.col("event_id") % 3 != 0).alias("published"), "ts", F.col("event_id").alias("seq"))


def timer_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unschedules name the time of the key's latest schedule before them."""
    op = pick("event_type", {
        "view": "schedule", "click": "schedule", "signup": "clear_and_schedule",
        "purchase": "unschedule", "error": "clear",
    })
    delay_h = pick("event_type", {"view": 6, "click": 24, "signup": 12})
    rows = events(spark, sf_dir).select(
        "topic", "key", F.col("event_id").alias("seq"), "ts", op.alias("op"),
        (micros("ts") + delay_h * HOUR_US).alias("_at"),
    )
    known = running(rows, ["topic", "key"], ["seq"], by_position("seq"),
                    {"_last": Running("last", F.col("_at"), before=True)})
    at = F.when(F.col("op") == "unschedule", F.col("_last")).otherwise(F.col("_at"))
    return known.select("topic", "key", "seq", "ts", "op", from_micros(at).alias("fire_at"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Handler attempts; five of a key make one record."""
    numbered = per_key_sequence(
        events(spark, sf_dir).select("topic", "part", "off", "key", "ts", "event_type", "value")
    )
    failed = F.col("event_type") == "error"
    rows = numbered.select(
        "topic", "part", "off", "key", "ts",
        F.floor((F.col("n") - 1) / 5).cast("bigint").alias("record_no"),
        (1 + (F.col("n") - 1) % 5).cast("bigint").alias("attempt_no"),
        F.when(failed, "failed").otherwise("ok").alias("outcome"),
        F.when(failed, F.when(F.col("value") < 20, "TypeError").otherwise("IOError")).alias("error_class"),
        (F.col("value") * 1000).cast("bigint").alias("duration_ms"),
    )
    return rows.withColumns({
        "class": F.when(F.col("attempt_no") == 1, "normal").otherwise("failure"),
        "error_category": error_category("error_class", ["TypeError"]),
    })


def attempt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts without record numbers: nothing to shuffle."""
    failed = F.col("event_type") == "error"
    return events(spark, sf_dir).select(
        "topic", "part", "off", "key", "ts",
        F.when(F.col("event_id") % 3 == 0, "normal").otherwise("failure").alias("class"),
        F.when(failed, "failed").otherwise("ok").alias("outcome"),
        F.when(failed, F.when(F.col("value") < 20, "TypeError").otherwise("IOError")).alias("error_class"),
        (F.col("value") * 1000).cast("bigint").alias("duration_ms"),
    )


SUBSYSTEMS = ["inventory", "billing", "email"]


def requests(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    orders = table(spark, sf_dir, "orders") if orders is None else orders
    return orders.select(
        F.col("o_orderkey").alias("request_id"),
        instant("o_orderdate").alias("ts"),
        F.col("o_custkey").cast("string").alias("key"),
        F.array(*[F.lit(s) for s in SUBSYSTEMS]).alias("subsystems"),
        F.lit(300_000).cast("bigint").alias("timeout_ms"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("payload"),
    )


def responses(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Line items as responses; some of them carry times before their request."""
    sent = requests(spark, sf_dir).select("request_id", F.col("ts").alias("_sent"))
    lineitem = table(spark, sf_dir, "lineitem") if lineitem is None else lineitem
    lines = lineitem.select(
        F.col("l_orderkey").alias("request_id"),
        # unique within a request
        ((F.col("l_linenumber").cast("bigint") * 10**9 + F.col("l_partkey")) * 10**7
         + F.col("l_suppkey")).alias("resp_no"),
        F.when(F.col("l_suppkey") % 4 == 0, "inventory").when(F.col("l_suppkey") % 4 == 1, "billing")
        .when(F.col("l_suppkey") % 4 == 2, "email").otherwise("other").alias("subsystem"),
        (F.col("l_linenumber") * 97 + F.col("l_suppkey") % 50
         - F.when(F.col("l_partkey") % 10 == 0, 400).otherwise(0)).cast("bigint").alias("_delay"),
        (F.col("l_returnflag") != "R").alias("ok"),
        F.col("l_quantity").alias("_quantity"),
    )
    return lines.join(sent, "request_id").select(
        "request_id", "resp_no", "subsystem",
        from_micros(micros("_sent") + F.col("_delay") * 1_000_000).alias("ts"),
        "ok",
        F.when(F.col("ok"), F.col("_quantity")).alias("value"),
        F.when(~F.col("ok"), "handler").alias("kind"),
        F.when(~F.col("ok"), "handler failed").alias("message"),
    )


def lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event reads the next user's value at its own time."""
    return events(spark, sf_dir).select(
        "topic", (F.col("user_id") + 1).cast("string").alias("key"),
        F.lit("total").alias("collection"),
        F.col("event_id").alias("lookup_id"), F.col("ts").alias("read_ts"),
    )


def map_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "topic", (F.col("user_id") + 1).cast("string").alias("key"),
        F.lit("totals").alias("collection"), F.col("event_id").alias("lookup_id"), F.col("ts").alias("read_ts"),
        F.concat(F.lit("k"), (F.col("event_id") % 9).cast("string")).alias("map_key"),
    )


def map_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for several map keys: one repeated, one never present, some empty."""
    key = F.concat(F.lit("k"), (F.col("event_id") % 7).cast("string"))
    keys = F.when(F.col("event_id") % 11 == 0, F.array().cast("array<string>")).otherwise(
        F.array(key, F.lit("missing"), key)
    )
    return events(spark, sf_dir).select(
        F.col("event_id").alias("request_id"), "topic", "key",
        F.lit("totals").alias("collection"), F.col("ts").alias("read_ts"), keys.alias("keys"),
    )


def deque_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes from -6 to 5, some halves between them."""
    index = (F.col("event_id") % 12 - 6).cast("double") + F.when(
        F.col("event_id") % 13 == 0, 0.5).otherwise(0.0)
    return events(spark, sf_dir).select(
        "topic", (F.col("user_id") + 1).cast("string").alias("key"),
        F.lit("backlog").alias("collection"), F.col("event_id").alias("lookup_id"), F.col("ts").alias("read_ts"),
        index.alias("i"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the groups of each subsystem publish, one row per source and collection."""
    return records(spark, sf_dir).where("source_system IS NOT NULL").select(
        F.when(F.col("type") == "order.purchase", "checkout").otherwise("billing").alias("subsystem"),
        F.coalesce("type", F.lit("internal")).alias("collection"),
        F.when(F.col("type") == "user.click", "message").otherwise("json").alias("payload"),
        F.col("type").isNotNull().alias("published"),
        F.col("source_system").alias("group_id"),
    ).distinct()
