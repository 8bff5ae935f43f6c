"""Streaming forms and user handlers as queries.

The test tables are read as file streams and run to their end, where everything still
open is closed (``run_to_end``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.functions.times import from_micros, instant, micros
from keyfold.plans import tables
from keyfold.streaming import dedup, handlers, requests
from keyfold.streaming.handler import run_stream, run_table
from keyfold.streaming.run import END, run_available, run_to_end

HOUR_US = tables.HOUR_US
SIX_HOURS_S = 6 * 3600
STREAMS = {}


def stream(fn):
    STREAMS[fn.__name__] = fn
    return fn


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = tables.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}*.parquet")


def _records(source: DataFrame, payload) -> DataFrame:
    return source.select(
        F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("part"),
        F.col("event_id").alias("off"), instant("ts").alias("ts"),
        F.col("user_id").cast("string").alias("key"), payload.alias("payload"),
    )


#: The tables are in the order of their times, so nothing lags.
IN_ORDER = "0 seconds"


#: The record that ends a stream: a tombstone of a key that no event has.
_LAST = {"topic": "end", "part": 0, "off": -1, "ts": END, "key": "end"}


def _name(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex}"


def _sent(rows: DataFrame) -> DataFrame:
    body = F.from_json("body", "kind string, window_start_us bigint, ids array<bigint>")
    return rows.where("kind = 'emit'").select("key", body.alias("b")).select(
        "key", "b.kind", from_micros("b.window_start_us").alias("window_start"),
        F.size("b.ids").cast("bigint").alias("n"), F.posexplode("b.ids").alias("pos", "event_id"))


@stream
def window_notify_stream(spark, sf_dir):
    handler = handlers.WindowNotify(SIX_HOURS_S, 3)
    records = _records(_read(spark, sf_dir, "events"), F.col("props"))
    return _sent(run_to_end(lambda r: run_stream(r, handler, handler.collections, watermark=IN_ORDER), _name("window-notify"), (records, _LAST)))


@stream
def window_notify_handler(spark, sf_dir):
    """The same handler over the table, tombstones included."""
    handler = handlers.WindowNotify(3 * 24 * 3600, 100)
    return _sent(run_table(tables.records(spark, sf_dir), handler, handler.collections))


@stream
def keyed_counter_handler(spark, sf_dir):
    handler = handlers.KeyCounter(2 * 24 * 3600)
    records = _records(tables.table(spark, sf_dir, "events"), F.col("props"))
    count = F.get_json_object("body", "$.count").cast("bigint")
    return run_table(records, handler, handler.collections).select("key", "off", count.alias("count"))


def _timer_payload():
    op = tables.pick("event_type", {
        "view": "schedule", "click": "schedule", "signup": "clear_and_schedule", "error": "clear",
    }, "none")
    delay_h = tables.pick("event_type", {"view": 6, "click": 24, "signup": 12})
    return F.to_json(F.struct(op.alias("op"), (micros("ts") + delay_h * HOUR_US).alias("fire_us")))


@stream
def timer_stream(spark, sf_dir):
    records = _records(_read(spark, sf_dir, "events"), _timer_payload())
    fired = run_to_end(lambda r: run_stream(r, handlers.TimerLog(), watermark=IN_ORDER), _name("timers"), (records, _LAST))
    return fired.where("kind = 'emit'").select(
        "key", from_micros(F.get_json_object("body", "$.fire_us").cast("bigint")).alias("fire_at"))


@stream
def dedup_stream(spark, sf_dir):
    kind = tables.pick("event_type", {
        "purchase": "order.purchase", "signup": "account.signup",
        "click": "user.click", "view": "admin.user.view",
    })
    records = _records(_read(spark, sf_dir, "events"), kind)
    kept = dedup.dedup_stream(records, event_id="payload")
    return run_available(kept, _name("dedup"), event_time=False).select("key", "off", F.col("payload").alias("type"))


def _requests(spark, sf_dir):
    """Requests and responses as streams, each with its end."""
    orders = tables.requests(spark, sf_dir, _read(spark, sf_dir, "orders"))
    answers = tables.responses(spark, sf_dir, _read(spark, sf_dir, "lineitem"))
    last = {"request_id": -1, "ts": END}
    return (orders, last | {"subsystems": ["end"], "timeout_ms": 0}), (answers, last | {"subsystem": "end", "resp_no": 0})


@stream
def request_outcomes_stream(spark, sf_dir):
    rows = run_to_end(lambda q, a: requests.request_outcomes_stream(q, a, IN_ORDER), _name("requests"), *_requests(spark, sf_dir))
    return rows.where("request_id <> -1").select("request_id", "subsystem", "ok", "value", "kind", "message", "resp_ts")


@stream
def request_outcomes_join(spark, sf_dir):
    rows = run_to_end(lambda q, a: requests.request_outcomes_join(q, a, 300, IN_ORDER), _name("joined"), *_requests(spark, sf_dir))
    return rows.where("request_id <> -1").select("request_id", "subsystem", F.equal_null("kind", F.lit("timeout")).alias("timed_out"))
