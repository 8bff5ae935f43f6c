"""Every operator as a query over the whole test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.functions import errors, filters, payload
from keyfold.functions.times import micros, round_timer
from keyfold.operators import (
    anchored, deques, excise, failures, maps, published, refs, requests, sequence, timers, txn,
    values, versions, windows,
)
from keyfold.operators.scan import hot_keys
from keyfold.plans import streams, tables
from keyfold.schema import ATTEMPT, RECORD
from keyfold.session import shared_dir
from keyfold.sources import log
from keyfold.sources.published import append_versions, read_published, read_versions
from keyfold.sources.seen import append_kept

ASOF = dt.datetime(2024, 1, 20)
SIX_HOURS_S = 6 * 3600
SIX_HOURS_MS = SIX_HOURS_S * 1000
GROUP = "group-a"
PREFIXES = ["user.", "account."]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def local_times(df: DataFrame) -> DataFrame:
    """Instants as local timestamps, the form the test tables use."""
    stamps = [f.name for f in df.schema.fields if f.dataType == T.TimestampType()]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: local_times(fn(spark, sf_dir))
    return fn


def _asof():
    return F.lit(ASOF).cast("timestamp")


def _written(rows: DataFrame) -> str:
    """The path of a table in the shared folder with these rows."""
    path = f"{shared_dir(rows.sparkSession)}/log-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return path


# sources and sinks

@query
def read_log(spark, sf_dir):
    """The records written as files and read back as a log."""
    path = _written(tables.records(spark, sf_dir).select(*RECORD.fieldNames()))
    return log.read_log(spark, "events", path=path, format="parquet").select(
        "topic", "part", "off", "ts", "key", "source_system", "event_id", "event_type"
    )


@query
def split_excise(spark, sf_dir):
    messages, excises = log.split_excise(tables.records(spark, sf_dir))
    columns = ["off", "key"]
    return messages.select(*columns, F.lit("message").alias("kind")).unionByName(
        excises.select(*columns, F.lit("excise").alias("kind"))
    )


@query
def write_log(spark, sf_dir):
    rows = tables.records(spark, sf_dir).where("NOT is_excise").select(
        "topic", "key", F.struct(F.col("off").alias("id"), F.col("item")).alias("payload")
    )
    header = F.col("headers")[0]
    return log.outgoing(rows, GROUP).select(
        "topic", "key",
        F.get_json_object("value", "$.id").cast("bigint").alias("id"),
        F.get_json_object("value", "$.item").cast("double").alias("item"),
        header["key"].alias("header"), header["value"].cast("string").alias("source_system"),
    )


@query
def write_excise(spark, sf_dir):
    gone = excise.excised_keys(tables.records(spark, sf_dir))
    return log.outgoing_excise(gone, GROUP).select("topic", "key", "value")


@query
def write_dead_letters(spark, sf_dir):
    routed = failures.route_by_mode(tables.attempts(spark, sf_dir), "low_latency")
    return log.dead_letters(routed, "failed-messages").select(
        "topic", "from_topic", "key", "record_no", "attempts"
    )


@query
def read_attempts(spark, sf_dir):
    """Attempts written as files and read back, with the category of their errors."""
    path = _written(tables.attempts(spark, sf_dir).select(*ATTEMPT.fieldNames()))
    return log.read_attempts(spark, path).withColumn("error_category", errors.error_category("error_class", ["TypeError"]))


@query
def resolve_refs(spark, sf_dir):
    kept = tables.records(spark, sf_dir).where("off % 10 <> 3")
    pushed = tables.message_ops(spark, sf_dir).select("key", "seq", "item")
    return refs.resolve_refs(pushed, kept, columns=["item", "ts"]).select(
        "key", "seq", F.col("message").isNotNull().alias("found"),
        F.col("message.item").alias("item"), F.col("message.ts").alias("ts"),
    )


@query
def resolve_refs_chunked(spark, sf_dir):
    """The latest message of each key, from a log stored by ranges of offsets."""
    path = f"{shared_dir(spark)}/chunked-{uuid.uuid4().hex}"
    kept = tables.records(spark, sf_dir).where("off % 10 <> 3").select(*RECORD.fieldNames())
    log.write_chunked_log(kept, path, 1000)
    ops = tables.message_ops(spark, sf_dir).withColumn("op", F.lit("set"))
    found = refs.resolve_refs(values.value_latest(ops), log.read_chunked_log(spark, path), columns=["ts"], chunk_offsets=1000)
    return found.select("key", "seq", F.col("message").isNotNull().alias("found"), F.col("message.ts").alias("ts"))


@query
def published_snapshot(spark, sf_dir):
    rows = tables.records(spark, sf_dir).where("source_system IS NOT NULL AND item IS NOT NULL")
    ops = rows.select(
        "topic", "key", F.coalesce("type", F.lit("internal")).alias("collection"),
        F.col("source_system").alias("group_id"), F.col("off").alias("seq"), "ts",
        F.lit("set").alias("op"), "item",
    )
    snapshot = values.value_latest(ops, ["topic", "key", "collection", "group_id"])
    return read_published(
        snapshot, tables.catalog(spark, sf_dir), "checkout", "order.purchase"
    ).select("key", "seq", "item")


# projections and filters

@query
def decode_payload(spark, sf_dir):
    rows = tables.records(spark, sf_dir)
    # every 13th payload loses its last character
    broken = F.when(F.col("off") % 13 == 0, F.expr("substr(payload, 1, length(payload) - 1)"))
    rows = rows.withColumn("payload", F.coalesce(broken, "payload"))
    return payload.checked_payload(rows).select(
        "off", F.try_variant_get("document", "$.k", "bigint").alias("k"), "error_category")


@query
def encode_payload(spark, sf_dir):
    value = F.when(F.col("event_id") % 5 == 0, float("nan")).when(
        F.col("event_id") % 5 == 1, float("inf")).otherwise(F.col("value"))
    rows = tables.events(spark, sf_dir).select(
        "off", F.struct(value.alias("n"), F.array(value).alias("a")).alias("payload"))
    text = payload.encode_payload(rows, "payload")
    return rows.select("off", text.alias("json")).select(
        "off",
        F.get_json_object("json", "$.n").cast("double").alias("n"),
        F.get_json_object("json", "$.a[0]").try_cast("double").alias("a0"),
        (F.instr("json", "NaN") > 0).alias("has_nan"),
    )


@query
def event_metadata(spark, sf_dir):
    rows = tables.records(spark, sf_dir).select("off", "payload")
    return payload.with_event_metadata(rows).select("off", "event_id", "event_type")


@query
def filter_event_types(spark, sf_dir):
    rows = tables.records(spark, sf_dir)
    return rows.where(filters.allowed_event("type", PREFIXES)).select("off", "key", "type")


@query
def filter_source_system(spark, sf_dir):
    rows = tables.records(spark, sf_dir)
    return rows.where(filters.from_elsewhere("source_system", GROUP)).select(
        "off", "key", "source_system")


@query
def round_timers(spark, sf_dir):
    return tables.events(spark, sf_dir).select("off", round_timer("ts").alias("fire_at"))


@query
def reject_null_items(spark, sf_dir):
    ops = tables.value_ops(spark, sf_dir).withColumn(
        "item", F.when(F.col("seq") % 7 != 0, F.col("item")))
    return payload.checked_items(ops).select("seq", "op", "error_category")


@query
def validate_utf8(spark, sf_dir):
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("value"))
    cut = F.when(F.col("doc_id") % 5 == 0, F.concat("value", F.unhex(F.lit("C3"))))
    return payload.checked_utf8(docs.withColumn("value", F.coalesce(cut, "value"))).select(
        "doc_id", F.length("payload").cast("bigint").alias("chars"), "error_category")


@query
def record_columns(spark, sf_dir):
    return payload.record_columns(tables.records(spark, sf_dir))


# order and duplicates

@query
def per_key_sequence(spark, sf_dir):
    rows = tables.records(spark, sf_dir).select("topic", "part", "off", "key")
    return sequence.per_key_sequence(rows).select("key", "off", "n")


@query
def dedup_keyed(spark, sf_dir):
    rows = tables.records(spark, sf_dir).select("topic", "part", "off", "ts", "key", "dup_id")
    return sequence.first_occurrences(rows, "dup_id").select("key", "off", "dup_id")


@query
def dedup_ttl(spark, sf_dir):
    rows = tables.records(spark, sf_dir).select("topic", "part", "off", "ts", "key", "type")
    return sequence.dedup_ttl(rows, event_id="type").select("key", "off", "type")


@query
def dedup_runs(spark, sf_dir):
    """What ten runs keep, each over the records of its time and the ids that those before it kept."""
    rows = tables.records(spark, sf_dir).select("topic", "part", "off", "ts", "key", "type")
    path = f"{shared_dir(spark)}/kept-{uuid.uuid4().hex}"
    low, high = rows.agg(F.min(micros("ts")), F.max(micros("ts"))).first()
    if low is None:
        return rows.select("key", "off", "type")
    turn = F.floor((micros("ts") - low) * 10 / (high - low + 1))
    for run in range(10):
        append_kept(rows.where(turn == run), path, run, event_id="type")
    return spark.read.schema(rows.schema).parquet(f"{path}/kept").select("key", "off", "type")


@query
def dedup_version(spark, sf_dir):
    rows = tables.records(spark, sf_dir).select("topic", "off", "key", "dup_id")
    seen = rows.where("off % 3 = 0").select(
        "topic", "key", "dup_id",
        F.when(F.col("off") % 2 == 0, "1").otherwise("2").alias("version")).distinct()
    return sequence.drop_seen(rows, seen, "2", "dup_id").select("key", "off", "dup_id")


@query
def filtered_sequence(spark, sf_dir):
    """Filter by source and type, remove duplicates, number what is left."""
    rows = tables.records(spark, sf_dir).where(
        filters.from_elsewhere("source_system", GROUP)
        & filters.allowed_event("type", PREFIXES) & filters.is_message()
    ).select("topic", "part", "off", "ts", "key", "type")
    fresh = sequence.dedup_ttl(rows, SIX_HOURS_S * 12, "type")
    return sequence.per_key_sequence(fresh, hot=hot_keys(rows, ["topic", "key"])).select(
        "key", "off", "type", "n")


# keyed state

@query
def value_latest(spark, sf_dir):
    return values.value_latest(tables.value_ops(spark, sf_dir)).select("key", "seq", "ts", "item")


@query
def value_asof(spark, sf_dir):
    return values.value_asof(tables.value_ops(spark, sf_dir)).select("key", "seq", "op", "current")


@query
def keyed_counter(spark, sf_dir):
    rows = tables.records(spark, sf_dir).select("topic", "part", "off", "ts", "key")
    return values.keyed_counter(rows, 2 * 24 * 3600).select("key", "off", "count")


@query
def map_fold(spark, sf_dir):
    return maps.map_fold(tables.map_ops(spark, sf_dir)).select("key", "map_key", "seq", "item")


def _map(spark, sf_dir):
    return maps.map_fold(tables.map_ops(spark, sf_dir))


@query
def map_get(spark, sf_dir):
    return maps.map_get(_map(spark, sf_dir), tables.map_lookups(spark, sf_dir)).select(
        "lookup_id", "key", "map_key", "item")


@query
def map_get_many(spark, sf_dir):
    answered = maps.map_get_many(_map(spark, sf_dir), tables.map_requests(spark, sf_dir))
    return answered.select(
        "request_id", "key", F.size("items").cast("bigint").alias("n"),
        F.get("items", F.lit(0)).alias("first_item"), F.get("items", F.lit(1)).alias("missing_item"),
        F.get("items", F.lit(2)).alias("repeated_item"))


@query
def map_has(spark, sf_dir):
    return maps.map_has(_map(spark, sf_dir), tables.map_lookups(spark, sf_dir)).select(
        "lookup_id", "key", "map_key", "present")


@query
def map_entries(spark, sf_dir):
    return maps.map_entries(_map(spark, sf_dir)).select("key", "map_key", "item")


@query
def map_keys_backward(spark, sf_dir):
    return maps.map_keys(_map(spark, sf_dir), backward=True).select("key", "map_key")


@query
def map_values(spark, sf_dir):
    return maps.map_values(_map(spark, sf_dir)).select("key", "item")


@query
def deque_push_capacity(spark, sf_dir):
    return deques.deque_latest(tables.push_ops(spark, sf_dir), 5).select("key", "pos", "rpos", "item")


@query
def deque_shift_fold(spark, sf_dir):
    return deques.deque_fold(tables.queue_ops(spark, sf_dir)).select("key", "pos", "seq", "item")


@query
def deque_fold(spark, sf_dir):
    return deques.deque_fold(tables.deque_ops(spark, sf_dir), 4).select("key", "pos", "seq", "item")


@query
def deque_popped(spark, sf_dir):
    return deques.deque_removed(tables.deque_ops(spark, sf_dir), 4).select("key", "seq", "op", "item")


@query
def deque_lengths(spark, sf_dir):
    """The length after every operation."""
    return deques.deque_trace(tables.deque_ops(spark, sf_dir), 4).select("key", "seq", "length")


def _deque(spark, sf_dir):
    return deques.deque_latest(tables.push_ops(spark, sf_dir), 5)


@query
def deque_length(spark, sf_dir):
    return deques.deque_length(_deque(spark, sf_dir), tables.deque_lookups(spark, sf_dir)).select(
        "lookup_id", "key", "length", "is_empty")


@query
def deque_at(spark, sf_dir):
    return deques.deque_at(_deque(spark, sf_dir), tables.deque_lookups(spark, sf_dir)).select(
        "lookup_id", "key", "i", "item", "error_category")


@query
def deque_values(spark, sf_dir):
    return deques.deque_values(_deque(spark, sf_dir), backward=True).select("key", "pos", "item")


@query
def message_value_latest(spark, sf_dir):
    ops = tables.message_ops(spark, sf_dir).withColumn("op", F.lit("set"))
    return refs.message_value(ops, tables.records(spark, sf_dir)).select(
        "key", "seq", F.col("message.ts").alias("ts"),
        F.col("message.payload").isNull().alias("is_excise"))


@query
def message_map_latest(spark, sf_dir):
    kept = tables.records(spark, sf_dir).where("off % 10 <> 3")
    return refs.message_map(tables.message_map_ops(spark, sf_dir), kept).select(
        "key", "map_key", "seq", F.col("message").isNotNull().alias("found"),
        F.col("message.ts").alias("ts"))


@query
def message_deque_latest(spark, sf_dir):
    newest = deques.deque_latest(tables.message_ops(spark, sf_dir), 3)
    kept = tables.records(spark, sf_dir).where("off % 10 <> 3")
    return refs.resolve_refs(newest, kept, columns=["ts"]).select(
        "key", "pos", "seq", F.col("message").isNotNull().alias("found"),
        F.col("message.ts").alias("ts"))


@query
def reject_item_kind(spark, sf_dir):
    ops = tables.events(spark, sf_dir).select(
        F.col("off").alias("seq"),
        F.when(F.col("event_type") == "error", "clear").otherwise("set").alias("op"),
        F.when(F.col("event_id") % 4 == 0, F.struct("topic", "part", "off")).alias("ref"),
        F.when(F.col("event_id") % 4 != 0, F.col("props")).alias("item"))
    accepted, rejected = refs.reject_item_kind(ops, "json")
    return accepted.select("seq", F.lit(None).cast("string").alias("error_category")).unionByName(
        rejected.select("seq", "error_category"))


@query
def committed_ops(spark, sf_dir):
    return txn.committed_ops(tables.txn_ops(spark, sf_dir)).select("key", "attempt", "seq", "item")


@query
def read_uncommitted(spark, sf_dir):
    return txn.committed_ops(tables.txn_ops(spark, sf_dir), read_uncommitted=True).select(
        "key", "attempt", "seq", "item")


@query
def committed_value(spark, sf_dir):
    """The value each key holds once failed attempts are undone."""
    return values.value_latest(txn.committed_ops(tables.txn_ops(spark, sf_dir))).select(
        "key", "seq", "item")


@query
def ttl_expire(spark, sf_dir):
    return txn.unexpired(_map(spark, sf_dir), 5 * 24 * 3600, F.lit(dt.datetime(2024, 1, 30))).select(
        "key", "map_key", "ts", "item")


# timers and windows

@query
def timer_fold(spark, sf_dir):
    return timers.timer_fold(tables.timer_ops(spark, sf_dir)).select("key", "fire_at")


@query
def timers_pending(spark, sf_dir):
    ops = tables.timer_ops(spark, sf_dir).where(F.col("ts") <= _asof())
    return timers.timers_pending(ops, 2**60, ASOF).select("key", "fire_at")


@query
def timer_survives_rollback(spark, sf_dir):
    """Every attempt schedules a timer; failed attempts leave theirs behind."""
    ops = tables.txn_ops(spark, sf_dir).select(
        "topic", "key", "seq", "ts", F.lit("schedule").alias("op"),
        (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("fire_at"))
    return timers.timer_fold(ops).select("key", "fire_at")


@query
def anchored_windows(spark, sf_dir):
    rows = tables.events(spark, sf_dir).select("topic", "key", "off", "ts")
    placed = anchored.assign_windows(
        rows.withColumn("_us", F.unix_micros("ts")), ["topic", "key"], "_us", SIX_HOURS_S * 1_000_000)
    return placed.groupBy("key", F.timestamp_micros("start_us").alias("window_start"),
                          F.timestamp_micros("end_us").alias("window_end")).agg(
        F.count("*").alias("n"))


def _sent(notifications):
    return notifications.select(
        "key", "kind", "window_start", "fire_at", "n",
        F.posexplode("event_ids").alias("pos", "event_id"))


@query
def window_notify(spark, sf_dir):
    rows = tables.events(spark, sf_dir).select("topic", "part", "off", "ts", "key", "event_id")
    return _sent(windows.window_notify(rows, SIX_HOURS_S, 3))


@query
def window_notify_excise(spark, sf_dir):
    rows = tables.records(spark, sf_dir).select(
        "topic", "part", "off", "ts", "key", "event_id", "is_excise")
    return _sent(windows.window_notify(rows, 3 * 24 * 3600, 100, excise="is_excise"))


@query
def state_ttl_window(spark, sf_dir):
    rows = tables.events(spark, sf_dir).select("topic", "part", "off", "ts", "key", "event_id")
    return _sent(windows.window_notify(rows, 24 * 3600, 100, ttl_seconds=SIX_HOURS_S * 2))


# excise

@query
def excise_cascade(spark, sf_dir):
    return excise.excise_cascade(tables.records(spark, sf_dir)).select("key", "off", "item")


@query
def compacted_view(spark, sf_dir):
    return excise.compacted_view(tables.records(spark, sf_dir)).select("key", "off", "ts", "item")


@query
def excise_audit(spark, sf_dir):
    rows = tables.records(spark, sf_dir)
    state = values.value_latest(tables.value_ops(spark, sf_dir))
    return excise.excise_audit(rows, {"totals": _map(spark, sf_dir), "total": state}).select(
        "table", "key", "rows")


@query
def excise_purge(spark, sf_dir):
    return excise.purge(_map(spark, sf_dir), tables.records(spark, sf_dir)).select(
        "key", "map_key", "item")


# failures

@query
def classify_errors(spark, sf_dir):
    rows = tables.attempt_log(spark, sf_dir)
    category = errors.error_category("error_class", ["ValueProblem"], {"TypeError": "ValueProblem"})
    return rows.select("off", "error_class", category.alias("error_category"))


@query
def backoff_schedule(spark, sf_dir):
    n = F.col("attempt_no")
    return tables.attempts(spark, sf_dir).select(
        "key", "off", "attempt_no",
        errors.backoff_ms(n * 4).alias("retry_ms"),
        errors.elapsed_ms(n * 4).alias("retry_total_ms"),
        errors.backoff_ms(n * 4, errors.DEFER_BASE_MS, errors.DEFER_CAP_MS).alias("defer_ms"),
        errors.elapsed_ms(n * 4, errors.DEFER_BASE_MS, errors.DEFER_CAP_MS).alias("defer_total_ms"))


def _route(name, **options):
    def run(spark, sf_dir):
        return failures.route_by_mode(tables.attempts(spark, sf_dir), **options).select(
            "key", "record_no", "attempts", "disposition")

    run.__name__ = name
    query(run)


_route("route_pipeline", mode="pipeline")
_route("route_low_latency", mode="low_latency")
_route("route_best_effort", mode="best_effort")


@query
def deferred_queue(spark, sf_dir):
    return failures.deferred_queue(tables.attempts(spark, sf_dir)).select(
        "key", "record_no", "arrived", "resolved", "blocked_until", "state")


@query
def failure_rate_gate(spark, sf_dir):
    gate = failures.failure_rate_gate(tables.attempt_log(spark, sf_dir), 0.25, SIX_HOURS_MS)
    return gate.select("part", "ts", "attempts", "failed", F.round("rate", 9).alias("rate"),
                       "deferral_enabled")


@query
def monopolizing_keys(spark, sf_dir):
    return failures.monopolizing_keys(
        tables.attempt_log(spark, sf_dir), 0.003, SIX_HOURS_MS
    ).select("key", "ts", "busy_ms", "rejected", "error_category")


@query
def flag_timeouts(spark, sf_dir):
    return tables.attempt_log(spark, sf_dir).select(
        "off", "duration_ms", errors.timed_out("duration_ms", stall_threshold_ms=60_000).alias("timed_out"))


@query
def stalled_partitions(spark, sf_dir):
    return failures.stalled_partitions(
        tables.events(spark, sf_dir), F.lit(dt.datetime(2024, 1, 30, 23, 59)), 300_000
    ).select("part", "last_ts", "idle_ms", "stalled")


@query
def stall_summary(spark, sf_dir):
    return failures.stall_summary(failures.stalled_partitions(
        tables.events(spark, sf_dir), F.lit(dt.datetime(2024, 1, 30, 23, 59)), 300_000))


@query
def execution_share(spark, sf_dir):
    return failures.execution_share(tables.attempt_log(spark, sf_dir)).select(
        "key", "total_ms", "failure_ms", F.round("failure_share", 9).alias("failure_share"),
        "over_target")


@query
def execution_share_total(spark, sf_dir):
    return failures.execution_share(tables.attempt_log(spark, sf_dir), by=()).select(
        "total_ms", "failure_ms", F.round("failure_share", 9).alias("failure_share"), "over_target")


# requests

def _outcomes(spark, sf_dir):
    return requests.request_outcomes(tables.requests(spark, sf_dir), tables.responses(spark, sf_dir))


OUTCOME = ["request_id", "subsystem", "ok", "value", "kind", "message", "resp_ts"]


@query
def request_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir).select(*OUTCOME)


@query
def request_excise_outcomes(spark, sf_dir):
    return requests.request_excise_outcomes(
        tables.requests(spark, sf_dir), tables.responses(spark, sf_dir)).select(*OUTCOME)


@query
def outcome_maps(spark, sf_dir):
    found = requests.outcome_maps(_outcomes(spark, sf_dir))
    billing = F.col("outcomes")["billing"]
    return found.select("request_id", F.size("outcomes").cast("bigint").alias("n"),
                        billing["ok"].alias("billing_ok"), billing["kind"].alias("billing_kind"))


@query
def decode_outcome(spark, sf_dir):
    rows = tables.records(spark, sf_dir)
    broken = F.when(F.col("off") % 13 == 0, F.expr("substr(payload, 2)"))
    error = F.when(F.col("off") % 17 == 0, "formatMismatch")
    body = F.when(error.isNull() & F.col("payload").isNotNull(), F.coalesce(broken, "payload"))
    out = requests.decode_outcome(
        body, F.coalesce(error, F.lit("handler")), F.lit("sent by the handler"))
    return rows.select("off", out.alias("o")).select("off", "o.ok", "o.kind")


@query
def fan_in_summary(spark, sf_dir):
    return requests.fan_in_summary(_outcomes(spark, sf_dir))


# published state

def _committed(ops):
    return txn.commit_log(ops)


@query
def commit_log(spark, sf_dir):
    return _committed(tables.txn_ops(spark, sf_dir)).select(
        "key", "attempt", "seq", "item", F.timestamp_micros("commit_us").alias("commit_ts"))


@query
def value_versions(spark, sf_dir):
    found = versions.value_versions(_committed(tables.txn_ops(spark, sf_dir)))
    return found.select("key", "seq", "item", F.timestamp_micros("from_us").alias("from_ts"), F.timestamp_micros("to_us").alias("to_ts"))


@query
def map_versions_appended(spark, sf_dir):
    """Versions of maps from three runs, each over the attempts of its time."""
    log = _committed(tables.txn_map_ops(spark, sf_dir))
    path = f"{shared_dir(spark)}/versions-{uuid.uuid4().hex}"
    low, high = log.agg(F.min("attempt"), F.max("attempt")).first()
    turn = F.floor((F.col("attempt") - low) * 3 / (high - low + 1))
    for run in range(3):
        append_versions(log.where(turn == run), path, run)
    return read_versions(spark, path).select(
        "key", "map_key", "seq", "item", F.timestamp_micros("from_us").alias("from_ts"), F.timestamp_micros("to_us").alias("to_ts"))


@query
def published_value_get(spark, sf_dir):
    log = _committed(tables.txn_ops(spark, sf_dir)).withColumn("ts", F.timestamp_micros("commit_us"))
    return published.published_value_get(log, tables.lookups(spark, sf_dir)).select("lookup_id", "key", "read_ts", "item")


@query
def published_map_read(spark, sf_dir):
    return published.published_map_get(
        _committed(tables.txn_map_ops(spark, sf_dir)), tables.map_lookups(spark, sf_dir)
    ).select("lookup_id", "key", "map_key", "item", "present")


@query
def published_map_get_many(spark, sf_dir):
    return published.published_map_get_many(
        _committed(tables.txn_map_ops(spark, sf_dir)), tables.map_requests(spark, sf_dir)
    ).select("request_id", "key", F.col("pos").cast("bigint").alias("pos"), "map_key", "item")


@query
def published_map_entries(spark, sf_dir):
    return published.published_map_entries(
        _committed(tables.txn_map_ops(spark, sf_dir)), tables.lookups(spark, sf_dir).withColumn("collection", F.lit("totals"))
    ).select("lookup_id", "key", "map_key", "item")


@query
def published_deque_read(spark, sf_dir):
    return published.published_deque_at(
        _committed(tables.txn_deque_ops(spark, sf_dir)), tables.deque_lookups(spark, sf_dir), 4
    ).select("lookup_id", "key", "i", "item", "error_category", "length", "is_empty")


@query
def published_deque_values(spark, sf_dir):
    return published.published_deque_values(
        _committed(tables.txn_deque_ops(spark, sf_dir)), tables.deque_lookups(spark, sf_dir), 4
    ).select("lookup_id", "key", "pos", "item")


@query
def serving_group(spark, sf_dir):
    """Which group answers each read, while groups publish and retire collections."""
    asked = tables.events(spark, sf_dir).select(
        F.col("event_id").alias("lookup_id"), F.col("ts").alias("read_ts"), F.col("event_type").alias("collection"),
        F.when(F.col("event_id") % 3 == 0, "checkout").otherwise("billing").alias("subsystem"))
    return published.serving_group(asked, tables.catalog_changes(spark, sf_dir)).select(
        "lookup_id", "subsystem", "collection", "group_id")


@query
def stale_read(spark, sf_dir):
    return published.stale_read(
        tables.value_ops(spark, sf_dir), tables.lookups(spark, sf_dir), SIX_HOURS_MS
    ).select("lookup_id", "key", "read_ts", "filled_at", "item")


@query
def publish_catalog(spark, sf_dir):
    asked = tables.records(spark, sf_dir).select(
        "off", F.when(F.col("off") % 2 == 0, "checkout").otherwise("billing").alias("subsystem"),
        F.coalesce("type", F.lit("internal")).alias("collection"))
    return published.publish_catalog(asked, tables.catalog(spark, sf_dir)).select(
        "off", "subsystem", "collection", "group_id")


for _name, _fn in streams.STREAMS.items():
    QUERIES[_name] = (lambda fn: lambda spark, sf_dir: local_times(fn(spark, sf_dir)))(_fn)
