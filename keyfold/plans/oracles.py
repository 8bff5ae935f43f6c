"""The same results in plain SQL, for checking.

Written independently of the operators: ordinary windows over whole keys,
``NOT EXISTS`` and row-by-row recursion, all of which are fine on small tables.
"""

from __future__ import annotations

PARTS = {
    "ev": """SELECT 'events' AS topic, CAST(user_id % 4 AS INT) AS part, event_id AS off, ts,
        CAST(user_id AS VARCHAR) AS key, event_id, user_id, event_type, value, props FROM events""",
    "records": """SELECT topic, part, off, ts, key, event_id, event_type AS dup_id,
        CASE event_type WHEN 'purchase' THEN 'order.purchase' WHEN 'signup' THEN 'account.signup'
             WHEN 'click' THEN 'user.click' WHEN 'view' THEN 'admin.user.view' END AS type,
        CASE event_id % 10 WHEN 0 THEN 'group-a' WHEN 1 THEN NULL ELSE 'group-b' END AS source_system,
        event_id % 97 = 96 AS is_excise,
        CASE WHEN event_id % 97 = 96 THEN NULL ELSE value END AS item,
        CASE WHEN event_id % 97 = 96 THEN NULL
             WHEN event_id % 3 = 0 THEN '{"id":"e' || event_id || '","type":"' || event_type || '"}'
             WHEN event_id % 3 = 1 THEN '{"id":' || event_id || ',"type":null}'
             ELSE props END AS payload
        FROM ev""",
    "value_ops": """SELECT key, event_id AS seq, ts,
        CASE event_type WHEN 'error' THEN 'clear' WHEN 'view' THEN 'get' ELSE 'set' END AS op,
        CASE WHEN event_type NOT IN ('error', 'view') THEN value END AS item FROM ev""",
    "map_ops": """SELECT key, event_id AS seq, ts, 'k' || (event_id % 7) AS map_key,
        CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN 'clear'
             WHEN event_type = 'error' THEN 'delete' ELSE 'set' END AS op,
        CASE WHEN event_type <> 'error' THEN value END AS item FROM ev""",
    "map_rows": """SELECT key, map_key, seq, ts, item FROM (
        SELECT m.*, row_number() OVER (PARTITION BY key, map_key ORDER BY seq DESC) AS r
        FROM map_ops m WHERE op <> 'clear'
          AND NOT EXISTS (SELECT 1 FROM map_ops c WHERE c.key = m.key AND c.op = 'clear' AND c.seq > m.seq)
        ) WHERE r = 1 AND op = 'set'""",
    "push_rows": """SELECT key, seq, item, cast(count(*) OVER (PARTITION BY key) - r AS BIGINT) AS pos,
        CAST(-r AS BIGINT) AS rpos FROM (
        SELECT key, event_id AS seq, event_id AS item,
               row_number() OVER (PARTITION BY key ORDER BY event_id DESC) AS r
        FROM ev p WHERE event_type <> 'error'
          AND NOT EXISTS (SELECT 1 FROM ev c WHERE c.key = p.key AND c.event_type = 'error'
                          AND c.event_id > p.event_id)) WHERE r <= 5""",
    "deque_ops": """SELECT key, event_id AS seq, row_number() OVER (PARTITION BY key ORDER BY event_id) AS rn,
        CASE WHEN event_id % 29 = 0 THEN 'clear'
             ELSE CASE event_type WHEN 'click' THEN 'unshift' WHEN 'purchase' THEN 'pop'
                  WHEN 'error' THEN 'shift' ELSE 'push' END END AS op FROM ev""",
    "deque_steps": """SELECT key, rn, seq, op, NULL::BIGINT AS item,
        CASE WHEN op IN ('push', 'unshift') THEN [seq] ELSE []::BIGINT[] END AS q
        FROM deque_ops WHERE rn = 1
        UNION ALL
        SELECT o.key, o.rn, o.seq, o.op,
        CASE o.op WHEN 'pop' THEN s.q[-1] WHEN 'shift' THEN s.q[1] END,
        CASE o.op
          WHEN 'push' THEN (CASE WHEN len(s.q) >= 4 THEN list_append(s.q[2:], o.seq) ELSE list_append(s.q, o.seq) END)
          WHEN 'unshift' THEN (CASE WHEN len(s.q) >= 4 THEN list_prepend(o.seq, s.q[1:3]) ELSE list_prepend(o.seq, s.q) END)
          WHEN 'pop' THEN s.q[1:len(s.q) - 1]
          WHEN 'shift' THEN s.q[2:]
          ELSE []::BIGINT[] END
        FROM deque_steps s JOIN deque_ops o ON o.key = s.key AND o.rn = s.rn + 1""",
    "txn_ops": """SELECT key, attempt, seq, ts, item, op,
        CASE WHEN (attempt + user_id) % 3 = 0 THEN 'failed'
             WHEN (attempt + user_id) % 11 = 5 THEN 'crashed' ELSE 'ok' END AS outcome
        FROM (SELECT key, user_id, CAST(floor(epoch_us(ts) / 172800000000) AS BIGINT) AS attempt,
              event_id AS seq, ts,
              CASE event_type WHEN 'click' THEN 'commit' WHEN 'error' THEN 'rollback' ELSE 'set' END AS op,
              CASE WHEN event_type NOT IN ('click', 'error') THEN value END AS item FROM ev)""",
    # rule by rule: undone by a rollback; after the last commit of an unfinished attempt
    "txn_kept": """SELECT t.*,
        EXISTS (SELECT 1 FROM txn_ops c WHERE c.key = t.key AND c.attempt = t.attempt
                AND c.op = 'commit' AND c.seq > t.seq) AS committed
        FROM txn_ops t WHERE op = 'set' AND NOT EXISTS (
          SELECT 1 FROM txn_ops r WHERE r.key = t.key AND r.attempt = t.attempt AND r.op = 'rollback'
          AND r.seq > t.seq AND NOT EXISTS (
            SELECT 1 FROM txn_ops c WHERE c.key = t.key AND c.attempt = t.attempt AND c.op = 'commit'
            AND c.seq > t.seq AND c.seq < r.seq))""",
    # what readers may see, and from when: the next commit, or the end of an attempt that went well
    "seen": """SELECT * FROM (SELECT t.*, e.event_type, coalesce(
          (SELECT min(c.ts) FROM txn_ops c WHERE c.key = t.key AND c.attempt = t.attempt AND c.op = 'commit' AND c.seq > t.seq),
          CASE WHEN outcome = 'ok' THEN (SELECT max(a.ts) FROM txn_ops a WHERE a.key = t.key AND a.attempt = t.attempt) END) AS commit_ts
        FROM txn_kept t JOIN ev e ON e.event_id = t.seq) WHERE commit_ts IS NOT NULL""",
    "seen_map": """SELECT key, seq, commit_ts, 'k' || (seq % 7) AS map_key, item,
        CASE WHEN event_type <> 'purchase' THEN 'set' WHEN seq % 5 = 0 THEN 'clear' ELSE 'delete' END AS op FROM seen""",
    "seen_deque": """SELECT key, seq, commit_ts, CASE WHEN event_type = 'purchase' THEN 'shift' ELSE 'push' END AS op,
        row_number() OVER (PARTITION BY key ORDER BY seq) AS rn FROM seen""",
    "seen_steps": """SELECT key, rn, commit_ts, CASE WHEN op = 'push' THEN [seq] ELSE []::BIGINT[] END AS q FROM seen_deque WHERE rn = 1
        UNION ALL SELECT o.key, o.rn, o.commit_ts, CASE WHEN o.op = 'shift' THEN s.q[2:]
          WHEN len(s.q) >= 4 THEN list_append(s.q[2:], o.seq) ELSE list_append(s.q, o.seq) END
        FROM seen_steps s JOIN seen_deque o ON o.key = s.key AND o.rn = s.rn + 1""",
    "seen_queue": """SELECT l.lookup_id, l.key, l.i, coalesce(arg_max(s.q, s.rn), []::BIGINT[]) AS q FROM deque_lookups l
        LEFT JOIN seen_steps s ON s.key = l.key AND s.commit_ts <= l.read_ts GROUP BY ALL""",
    "timer_raw": """SELECT key, event_id AS seq, ts,
        CASE event_type WHEN 'signup' THEN 'clear_and_schedule' WHEN 'purchase' THEN 'unschedule'
             WHEN 'error' THEN 'clear' ELSE 'schedule' END AS op,
        CASE event_type WHEN 'view' THEN ts + INTERVAL 6 HOUR WHEN 'click' THEN ts + INTERVAL 24 HOUR
             WHEN 'signup' THEN ts + INTERVAL 12 HOUR END AS due FROM ev""",
    "timer_ops": """SELECT key, seq, ts, op, date_trunc('second', INTERVAL 500 MILLISECOND +
        CASE WHEN op = 'unschedule' THEN last_value(due IGNORE NULLS) OVER (
            PARTITION BY key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ELSE due END) AS fire_at FROM timer_raw""",
    "attempts": """SELECT topic, part, off, key, ts,
        CAST(floor((n - 1) / 5) AS BIGINT) AS record_no, 1 + (n - 1) % 5 AS attempt_no,
        CASE WHEN n % 5 = 1 THEN 'normal' ELSE 'failure' END AS class,
        CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS outcome,
        CASE WHEN event_type = 'error' THEN CASE WHEN value < 20 THEN 'TypeError' ELSE 'IOError' END END AS error_class,
        CASE WHEN event_type = 'error' THEN CASE WHEN value < 20 THEN 'permanent' ELSE 'transient' END END AS error_category,
        CAST(floor(value * 1000) AS BIGINT) AS duration_ms
        FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY part, off) AS n FROM ev)""",
    "record_end": """SELECT key, record_no, max(attempt_no) AS attempts,
        arg_max(outcome, attempt_no) AS outcome,
        CASE WHEN arg_max(outcome, attempt_no) = 'failed' THEN
             arg_max(coalesce(error_category, ''), attempt_no) END AS category
        FROM attempts GROUP BY key, record_no""",
    "attempt_log": """SELECT part, off, key, ts,
        CASE WHEN event_id % 3 = 0 THEN 'normal' ELSE 'failure' END AS class,
        CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS failed,
        CASE WHEN event_type = 'error' THEN CASE WHEN value < 20 THEN 'TypeError' ELSE 'IOError' END END AS error_class,
        CAST(floor(value * 1000) AS BIGINT) AS duration_ms FROM ev""",
    "asked": """SELECT o_orderkey AS request_id, o_orderdate AS ts, subsystem
        FROM orders, (VALUES ('inventory'), ('billing'), ('email')) s(subsystem)""",
    "answers": """SELECT l_orderkey AS request_id, (CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey) * 10000000 + l_suppkey AS resp_no,
        CASE l_suppkey % 4 WHEN 0 THEN 'inventory' WHEN 1 THEN 'billing' WHEN 2 THEN 'email' ELSE 'other' END AS subsystem,
        o_orderdate + INTERVAL 1 SECOND * (l_linenumber * 97 + l_suppkey % 50
            - CASE WHEN l_partkey % 10 = 0 THEN 400 ELSE 0 END) AS ts,
        l_returnflag <> 'R' AS ok, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "outcomes": """SELECT request_id, subsystem, coalesce(ok, FALSE) AS ok, value,
        CASE WHEN ok IS NULL THEN 'timeout' WHEN NOT ok THEN 'handler' END AS kind,
        CASE WHEN ok IS NULL THEN 'no response arrived before the deadline'
             WHEN NOT ok THEN 'handler failed' END AS message, resp_ts
        FROM (SELECT q.request_id, q.subsystem, a.ok, a.value, a.ts AS resp_ts,
              row_number() OVER (PARTITION BY q.request_id, q.subsystem ORDER BY a.ts, a.resp_no) AS r
              FROM asked q LEFT JOIN answers a ON a.request_id = q.request_id
              AND a.subsystem = q.subsystem AND a.ts BETWEEN q.ts AND q.ts + INTERVAL 300 SECOND)
        WHERE r = 1""",
    "lookups": """SELECT event_id AS lookup_id, CAST(user_id + 1 AS VARCHAR) AS key, ts AS read_ts
        FROM ev""",
    "map_lookups": """SELECT event_id AS lookup_id, CAST(user_id + 1 AS VARCHAR) AS key, ts AS read_ts,
        'k' || (event_id % 9) AS map_key FROM ev""",
    "deque_lookups": """SELECT event_id AS lookup_id, CAST(user_id + 1 AS VARCHAR) AS key, ts AS read_ts,
        CAST(event_id % 12 - 6 AS DOUBLE) + CASE WHEN event_id % 13 = 0 THEN 0.5 ELSE 0 END AS i
        FROM ev""",
    "catalog": """SELECT DISTINCT CASE WHEN type = 'order.purchase' THEN 'checkout' ELSE 'billing' END AS subsystem,
        coalesce(type, 'internal') AS collection, CASE WHEN type = 'user.click' THEN 'message' ELSE 'json' END AS payload,
        type IS NOT NULL AS published, source_system AS group_id
        FROM records WHERE source_system IS NOT NULL""",
    "readable": """SELECT subsystem, collection, min(group_id) AS group_id FROM catalog
        WHERE payload = 'json' AND published GROUP BY 1, 2""",
    "excised": """SELECT key, max(off) AS off, max(ts) AS ts FROM records WHERE is_excise GROUP BY key""",
}

NEEDS = {
    "records": ["ev"], "value_ops": ["ev"], "map_ops": ["ev"], "map_rows": ["map_ops"],
    "push_rows": ["ev"], "deque_ops": ["ev"], "deque_steps": ["deque_ops"], "txn_ops": ["ev"],
    "txn_kept": ["txn_ops"], "seen": ["txn_kept"], "seen_map": ["seen"], "seen_deque": ["seen"],
    "seen_steps": ["seen_deque"], "seen_queue": ["seen_steps", "deque_lookups"], "timer_raw": ["ev"], "timer_ops": ["timer_raw"], "attempts": ["ev"],
    "record_end": ["attempts"], "attempt_log": ["ev"], "outcomes": ["asked", "answers"],
    "lookups": ["ev"], "map_lookups": ["ev"], "deque_lookups": ["ev"], "catalog": ["records"],
    "readable": ["catalog"], "excised": ["records"],
}


def sql(needs: str, select: str, **extra: str) -> str:
    """A query with the parts it needs as common table expressions."""
    order: list[str] = []

    def add(name):
        for n in NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for name in needs.split():
        add(name)
    parts = {n: PARTS[n] for n in order} | extra
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({t})" for n, t in parts.items()) + "\n" + select


def walk(key: str, end: str, where: str = "TRUE", reset: str = "FALSE", source: str = "ev") -> dict[str, str]:
    """Windows found by stepping through each key's records in time order.

    ``w`` gives every record its window start; ``end`` computes a window's end
    from the start ``t``. ``reset`` marks records that only close the window.
    """
    rows = f"""SELECT *, {reset} AS drops, row_number() OVER (PARTITION BY {key} ORDER BY ts, off) AS rn
        FROM {source} WHERE {where}"""
    first = "CASE WHEN drops THEN NULL ELSE ts END"
    following = "CASE WHEN r.drops THEN NULL WHEN w.start IS NULL OR r.ts >= {e} THEN r.ts ELSE w.start END"
    e = end.format(t="w.start")
    return {
        "wr": rows,
        "w": f"""SELECT wr.*, {first} AS start, 1 AS win FROM wr WHERE rn = 1
            UNION ALL
            SELECT r.*, {following.format(e=e)},
                   w.win + CASE WHEN r.drops OR w.start IS NULL OR r.ts >= {e} THEN 1 ELSE 0 END
            FROM w JOIN wr r ON {' AND '.join(f'r.{k.strip()} = w.{k.strip()}' for k in key.split(','))} AND r.rn = w.rn + 1""",
    }


def seconds_after(interval: str) -> str:
    return "date_trunc('second', {t} + INTERVAL " + interval + " + INTERVAL 500 MILLISECOND)"


def notified(width: str, capacity: int, keep: str = "TRUE") -> dict[str, str]:
    """Messages of each notification from the windows ``w``."""
    fire = seconds_after(width).format(t="start")
    return {
        "sent": f"""SELECT key, win, start, {fire} AS fire_at, event_id, off, ts,
            off = min(off) OVER (PARTITION BY key, win) AS is_first FROM w WHERE start IS NOT NULL""",
        "ranked": f"""SELECT *, row_number() OVER (PARTITION BY key, win, is_first ORDER BY ts DESC, off DESC) AS r
            FROM sent WHERE is_first OR ({keep})""",
        "notes": f"""SELECT key, win, is_first, CASE WHEN is_first THEN 'first' ELSE 'summary' END AS kind,
            start AS window_start, fire_at, count(*) OVER (PARTITION BY key, win, is_first) AS n,
            CAST(row_number() OVER (PARTITION BY key, win, is_first ORDER BY ts, off) - 1 AS INT) AS pos, event_id
            FROM ranked WHERE r <= {capacity}""",
    }


NOTE = "key, kind, window_start, fire_at, n, pos, event_id"


def _backoff(n, base, cap):
    return f"least({base} * CAST(pow(2, {n} - 1) AS BIGINT), {cap})"


def _elapsed(n, base, cap):
    return f"(SELECT CAST(sum({_backoff('k', base, cap)}) AS BIGINT) FROM range(1, {n} + 1) t(k))"


def _route(transient, permanent):
    return sql("record_end", f"""SELECT key, record_no, attempts, CASE WHEN outcome = 'ok' THEN 'done'
        WHEN category = 'permanent' THEN '{permanent}' ELSE {transient} END AS disposition FROM record_end""")


LOW_LATENCY = "CASE WHEN attempts > 3 THEN 'dead_letter' ELSE 'retry' END"

_STRING_FIELD = "CASE WHEN json_type(payload::JSON, '$.{f}') = 'VARCHAR' THEN json_extract_string(payload::JSON, '$.{f}') END"
_ID, _TYPE = _STRING_FIELD.format(f="id"), _STRING_FIELD.format(f="type")

ORACLES = {
    "read_log": sql("records", f"""SELECT topic, part, off, ts, key, source_system,
        {_ID} AS event_id, {_TYPE} AS event_type FROM records"""),
    "split_excise": sql("records", "SELECT off, key, CASE WHEN payload IS NULL THEN 'excise' ELSE 'message' END AS kind FROM records"),
    "write_log": sql("records", """SELECT topic, key, off AS id, item, 'source-system' AS header,
        'group-a' AS source_system FROM records WHERE NOT is_excise"""),
    "write_excise": sql("records", "SELECT DISTINCT topic, key, CAST(NULL AS VARCHAR) AS value FROM records WHERE is_excise"),
    "write_dead_letters": sql("record_end", """SELECT 'failed-messages' AS topic, 'events' AS from_topic, key, record_no, attempts
        FROM record_end WHERE outcome = 'failed' AND (category = 'permanent' OR attempts > 3)"""),
    "read_attempts": sql("attempts", "SELECT * FROM attempts"),
    "resolve_refs": sql("ev", """SELECT key, event_id AS seq, event_id % 10 <> 3 AS found,
        CASE WHEN event_id % 10 <> 3 AND event_id % 97 <> 96 THEN value END AS item,
        CASE WHEN event_id % 10 <> 3 THEN ts END AS ts FROM ev"""),
    "resolve_refs_chunked": sql("ev", """SELECT key, event_id AS seq, event_id % 10 <> 3 AS found, CASE WHEN event_id % 10 <> 3 THEN ts END AS ts
        FROM ev QUALIFY row_number() OVER (PARTITION BY key ORDER BY event_id DESC) = 1"""),
    "published_snapshot": sql("records readable", """SELECT key, seq, item FROM (
        SELECT key, off AS seq, item, row_number() OVER (PARTITION BY key ORDER BY off DESC) AS r
        FROM records JOIN readable ON readable.collection = records.type AND subsystem = 'checkout'
             AND group_id = source_system
        WHERE item IS NOT NULL AND type = 'order.purchase') WHERE r = 1"""),
    "decode_payload": sql("records", """SELECT off,
        CASE WHEN off % 13 <> 0 THEN CAST(json_extract_string(payload::JSON, '$.k') AS BIGINT) END AS k,
        CASE WHEN off % 13 = 0 THEN 'permanent' END AS error_category FROM records WHERE payload IS NOT NULL"""),
    "encode_payload": sql("ev", """SELECT off, CASE WHEN event_id % 5 > 1 THEN value END AS n,
        CASE WHEN event_id % 5 > 1 THEN value END AS a0, FALSE AS has_nan FROM ev"""),
    "event_metadata": sql("records", f"SELECT off, {_ID} AS event_id, {_TYPE} AS event_type FROM records"),
    "filter_event_types": sql("records", """SELECT off, key, type FROM records
        WHERE type IS NULL OR starts_with(type, 'user.') OR starts_with(type, 'account.')"""),
    "filter_source_system": sql("records", """SELECT off, key, source_system FROM records
        WHERE source_system IS DISTINCT FROM 'group-a'"""),
    "round_timers": sql("ev", "SELECT off, date_trunc('second', ts + INTERVAL 500 MILLISECOND) AS fire_at FROM ev"),
    "reject_null_items": sql("value_ops", """SELECT seq, op,
        CASE WHEN op = 'set' AND seq % 7 = 0 THEN 'transient' END AS error_category FROM value_ops"""),
    "validate_utf8": """SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN length(text) END AS chars,
        CASE WHEN doc_id % 5 = 0 THEN 'permanent' END AS error_category FROM documents""",
    "record_columns": sql("ev", "SELECT topic, part, off, ts, key FROM ev"),
    "per_key_sequence": sql("ev", "SELECT key, off, row_number() OVER (PARTITION BY key ORDER BY part, off) AS n FROM ev"),
    "dedup_keyed": sql("records", """SELECT key, off, dup_id FROM (SELECT *, row_number() OVER (
        PARTITION BY key, dup_id ORDER BY part, off) AS r FROM records) WHERE r = 1"""),
    "dedup_ttl": sql("records", """SELECT key, off, type FROM w WHERE ts = start
        UNION ALL SELECT key, off, type FROM records WHERE type IS NULL""",
        **walk("key, type", seconds_after("7 DAY"), "type IS NOT NULL", source="records")),
    "dedup_version": sql("records", """SELECT key, off, dup_id FROM records r WHERE NOT EXISTS (
        SELECT 1 FROM records s WHERE s.key = r.key AND s.dup_id = r.dup_id AND s.off % 3 = 0 AND s.off % 2 = 1)"""),
    "filtered_sequence": sql("records", """SELECT key, off, type,
        row_number() OVER (PARTITION BY key ORDER BY off) AS n FROM (
        SELECT key, off, type FROM w WHERE ts = start
        UNION ALL SELECT key, off, type FROM records WHERE type IS NULL AND payload IS NOT NULL
            AND source_system IS DISTINCT FROM 'group-a')""",
        **walk("key, type", seconds_after("3 DAY"), """payload IS NOT NULL AND source_system IS DISTINCT FROM 'group-a'
            AND (starts_with(type, 'user.') OR starts_with(type, 'account.'))""", source="records")),
    "value_latest": sql("value_ops", """SELECT key, seq, ts, item FROM (SELECT *, row_number() OVER (
        PARTITION BY key ORDER BY seq DESC) AS r FROM value_ops WHERE op <> 'get') WHERE r = 1 AND op = 'set'"""),
    "value_asof": sql("value_ops", """SELECT a.key, a.seq, a.op, CASE WHEN w.op = 'set' THEN w.item END AS current
        FROM value_ops a LEFT JOIN value_ops w ON w.key = a.key AND w.seq = (
          SELECT max(b.seq) FROM value_ops b WHERE b.key = a.key AND b.seq <= a.seq AND b.op <> 'get')"""),
    "keyed_counter": sql("ev", """SELECT key, off, row_number() OVER (PARTITION BY key, island ORDER BY off) AS count
        FROM (SELECT key, off, sum(fresh) OVER (PARTITION BY key ORDER BY off) AS island FROM (
          SELECT key, off, CASE WHEN ts - lag(ts) OVER (PARTITION BY key ORDER BY off) >= INTERVAL 48 HOUR
                 THEN 1 ELSE 0 END AS fresh FROM ev))"""),
    "map_fold": sql("map_rows", "SELECT key, map_key, seq, item FROM map_rows"),
    "map_get": sql("map_rows map_lookups", """SELECT lookup_id, key, map_key, item
        FROM map_lookups LEFT JOIN map_rows USING (key, map_key)"""),
    "map_get_many": sql("ev map_rows", """SELECT event_id AS request_id, ev.key, CAST(3 AS BIGINT) AS n,
        item AS first_item, CAST(NULL AS DOUBLE) AS missing_item, item AS repeated_item
        FROM ev LEFT JOIN map_rows m ON m.key = ev.key AND m.map_key = 'k' || (event_id % 7)
        WHERE event_id % 11 <> 0
        UNION ALL SELECT event_id, key, 0, NULL, NULL, NULL FROM ev WHERE event_id % 11 = 0"""),
    "map_has": sql("map_rows map_lookups", """SELECT lookup_id, key, map_key, seq IS NOT NULL AS present
        FROM map_lookups LEFT JOIN map_rows USING (key, map_key)"""),
    "map_entries": sql("map_rows", "SELECT key, map_key, item FROM map_rows ORDER BY key, map_key"),
    "map_keys_backward": sql("map_rows", "SELECT key, map_key FROM map_rows ORDER BY key, map_key DESC"),
    "map_values": sql("map_rows", "SELECT key, item FROM map_rows ORDER BY key, map_key"),
    "deque_push_capacity": sql("push_rows", "SELECT key, pos, rpos, item FROM push_rows"),
    # the n-th shift that finds something removes the n-th push
    "deque_shift_fold": sql("ev", """SELECT key, CAST(pushed - taken - 1 AS BIGINT) AS pos, seq, seq AS item FROM (
        SELECT p.key, p.seq, p.pushed, t.taken FROM q p JOIN (
          SELECT key, max(shifts + least(0, low)) AS taken FROM q GROUP BY key) t USING (key) WHERE p.step = 1)
        WHERE pushed > taken""",
        q="""SELECT *, min(total) OVER (PARTITION BY key ORDER BY seq) AS low FROM (
          SELECT key, event_id AS seq, CASE WHEN event_type IN ('purchase', 'error') THEN -1 ELSE 1 END AS step,
            sum(CASE WHEN event_type IN ('purchase', 'error') THEN -1 ELSE 1 END) OVER k AS total,
            sum(CASE WHEN event_type IN ('purchase', 'error') THEN 1 ELSE 0 END) OVER k AS shifts,
            sum(CASE WHEN event_type IN ('purchase', 'error') THEN 0 ELSE 1 END) OVER k AS pushed
          FROM ev WINDOW k AS (PARTITION BY key ORDER BY event_id))"""),
    "deque_fold": sql("deque_steps", """SELECT key, CAST(unnest(range(len(q))) AS BIGINT) AS pos, unnest(q) AS seq, unnest(q) AS item
        FROM deque_steps s WHERE rn = (SELECT max(rn) FROM deque_ops o WHERE o.key = s.key)"""),
    "deque_popped": sql("deque_steps", "SELECT key, seq, op, item FROM deque_steps WHERE op IN ('pop', 'shift')"),
    "deque_lengths": sql("deque_steps", "SELECT key, seq, len(q) AS length FROM deque_steps"),
    "deque_length": sql("push_rows deque_lookups", """SELECT lookup_id, key, coalesce(n, 0) AS length, n IS NULL AS is_empty
        FROM deque_lookups LEFT JOIN (SELECT key, count(*) AS n FROM push_rows GROUP BY key) USING (key)"""),
    "deque_at": sql("push_rows deque_lookups", """SELECT lookup_id, l.key, i, item,
        CASE WHEN i <> floor(i) THEN 'transient' END AS error_category
        FROM deque_lookups l LEFT JOIN push_rows p ON p.key = l.key AND i = CASE WHEN i >= 0 THEN pos ELSE rpos END"""),
    "deque_values": sql("push_rows", "SELECT key, pos, item FROM push_rows ORDER BY key, pos DESC"),
    "message_value_latest": sql("records", """SELECT key, off AS seq, ts, is_excise FROM (SELECT *, row_number() OVER (
        PARTITION BY key ORDER BY off DESC) AS r FROM records) WHERE r = 1"""),
    "message_map_latest": sql("ev", """SELECT key, map_key, seq, seq % 10 <> 3 AS found, CASE WHEN seq % 10 <> 3 THEN ts END AS ts
        FROM (SELECT key, 'k' || (event_id % 7) AS map_key, event_id AS seq, ts, event_type, row_number() OVER (
        PARTITION BY key, event_id % 7 ORDER BY event_id DESC) AS r FROM ev) WHERE r = 1 AND event_type <> 'error'"""),
    "message_deque_latest": sql("ev", """SELECT key, CAST(least(3, n) - r AS BIGINT) AS pos, seq, seq % 10 <> 3 AS found,
        CASE WHEN seq % 10 <> 3 THEN ts END AS ts FROM (SELECT key, event_id AS seq, ts,
        row_number() OVER (PARTITION BY key ORDER BY event_id DESC) AS r, count(*) OVER (PARTITION BY key) AS n
        FROM ev) WHERE r <= 3"""),
    "reject_item_kind": sql("ev", """SELECT off AS seq, CASE WHEN event_type <> 'error' AND event_id % 4 = 0
        THEN 'transient' END AS error_category FROM ev"""),
    "committed_ops": sql("txn_kept", "SELECT key, attempt, seq, item FROM txn_kept WHERE committed OR outcome = 'ok'"),
    "read_uncommitted": sql("txn_kept", """SELECT key, attempt, seq, item FROM txn_kept
        WHERE committed OR outcome IN ('ok', 'crashed')"""),
    "committed_value": sql("txn_kept", """SELECT key, seq, item FROM (SELECT *, row_number() OVER (
        PARTITION BY key ORDER BY seq DESC) AS r FROM txn_kept WHERE committed OR outcome = 'ok') WHERE r = 1"""),
    "ttl_expire": sql("map_rows", """SELECT key, map_key, ts, item FROM map_rows
        WHERE ts + INTERVAL 5 DAY > TIMESTAMP '2024-01-30 00:00:00'"""),
    "timer_fold": sql("timer_ops", """SELECT DISTINCT key, fire_at FROM timer_ops s
        WHERE op IN ('schedule', 'clear_and_schedule') AND NOT EXISTS (
          SELECT 1 FROM timer_ops c WHERE c.key = s.key AND c.seq > s.seq AND c.ts < s.fire_at
          AND (c.op IN ('clear', 'clear_and_schedule') OR (c.op = 'unschedule' AND c.fire_at = s.fire_at)))"""),
    "timers_pending": sql("timer_ops", """SELECT DISTINCT key, fire_at FROM timer_ops s
        WHERE op IN ('schedule', 'clear_and_schedule') AND ts <= TIMESTAMP '2024-01-20 00:00:00'
          AND fire_at > TIMESTAMP '2024-01-20 00:00:00' AND NOT EXISTS (
          SELECT 1 FROM timer_ops c WHERE c.key = s.key AND c.seq > s.seq AND c.ts < s.fire_at
          AND c.ts <= TIMESTAMP '2024-01-20 00:00:00'
          AND (c.op IN ('clear', 'clear_and_schedule') OR (c.op = 'unschedule' AND c.fire_at = s.fire_at)))"""),
    "timer_survives_rollback": sql("ev", "SELECT DISTINCT key, " + seconds_after("6 HOUR").format(t="ts") + " AS fire_at FROM ev"),
    "anchored_windows": sql("ev", "SELECT key, start AS window_start, " + seconds_after("6 HOUR").format(t="start")
        + " AS window_end, count(*) AS n FROM w GROUP BY key, start", **walk("key", seconds_after("6 HOUR"))),
    "window_notify": sql("ev", f"SELECT {NOTE} FROM notes",
        **walk("key", seconds_after("6 HOUR")), **notified("6 HOUR", 3)),
    "window_notify_excise": sql("records", f"""SELECT {NOTE} FROM notes WHERE is_first OR NOT EXISTS (
        SELECT 1 FROM records x WHERE x.is_excise AND x.key = notes.key AND x.ts >= notes.window_start
        AND x.ts < notes.fire_at)""",
        **walk("key", seconds_after("3 DAY"), reset="is_excise", source="records"), **notified("3 DAY", 100)),
    "state_ttl_window": sql("ev", f"""SELECT {NOTE} FROM notes WHERE is_first OR NOT EXISTS (
        SELECT 1 FROM w x WHERE x.key = notes.key AND x.start > notes.window_start AND x.start < notes.fire_at)""",
        **walk("key", seconds_after("12 HOUR")), **notified("24 HOUR", 100, "ts + INTERVAL 12 HOUR > fire_at")),
    "excise_cascade": sql("records excised", """SELECT r.key, r.off, item FROM records r LEFT JOIN excised x ON x.key = r.key
        WHERE NOT is_excise AND (x.off IS NULL OR r.off > x.off)"""),
    "compacted_view": sql("records", """SELECT key, off, ts, item FROM (SELECT *, row_number() OVER (
        PARTITION BY key ORDER BY off DESC) AS r FROM records) WHERE r = 1 AND NOT is_excise"""),
    "excise_audit": sql("excised map_rows value_ops", """SELECT 'totals' AS "table", m.key, count(*) AS rows
        FROM map_rows m JOIN excised x ON x.key = m.key AND m.ts <= x.ts GROUP BY m.key
        UNION ALL SELECT 'total', v.key, count(*) FROM (SELECT *, row_number() OVER (
          PARTITION BY key ORDER BY seq DESC) AS r FROM value_ops WHERE op <> 'get') v
        JOIN excised x ON x.key = v.key AND v.ts <= x.ts WHERE r = 1 AND op = 'set' GROUP BY v.key"""),
    "excise_purge": sql("excised map_rows", """SELECT m.key, map_key, item FROM map_rows m LEFT JOIN excised x ON x.key = m.key
        WHERE x.ts IS NULL OR m.ts > x.ts"""),
    "classify_errors": sql("attempt_log", """SELECT off, error_class, CASE error_class WHEN 'TypeError' THEN 'permanent'
        WHEN 'IOError' THEN 'transient' END AS error_category FROM attempt_log"""),
    "backoff_schedule": sql("attempts", f"""SELECT key, off, attempt_no,
        {_backoff('attempt_no * 4', 20, 300000)} AS retry_ms, {_elapsed('attempt_no * 4', 20, 300000)} AS retry_total_ms,
        {_backoff('attempt_no * 4', 1000, 86400000)} AS defer_ms, {_elapsed('attempt_no * 4', 1000, 86400000)} AS defer_total_ms
        FROM attempts"""),
    "route_pipeline": _route("'defer'", "dropped"),
    "route_low_latency": _route(LOW_LATENCY, "dead_letter"),
    "route_best_effort": _route("'dropped'", "dropped"),
    "deferred_queue": sql("attempts", """SELECT key, record_no, arrived, resolved,
        CASE WHEN until < TIMESTAMP '9999-01-01' THEN until END AS blocked_until,
        CASE WHEN until > arrived THEN 'waiting' WHEN parked THEN 'parked' ELSE 'clear' END AS state
        FROM (SELECT *, max(CASE WHEN parked THEN coalesce(resolved, TIMESTAMP '9999-12-31') END) OVER (
          PARTITION BY key ORDER BY record_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until
          FROM (SELECT key, record_no, min(ts) AS arrived, min(ts) FILTER (outcome = 'ok') AS resolved,
                bool_or(coalesce(error_category = 'transient', FALSE))
                AND NOT bool_or(coalesce(error_category = 'permanent', FALSE)) AS parked
                FROM attempts GROUP BY key, record_no))"""),
    "failure_rate_gate": sql("attempt_log", """SELECT DISTINCT part, ts, attempts, failed, round(failed / attempts, 9) AS rate,
        failed / attempts <= 0.25 AS deferral_enabled FROM (SELECT part, ts, count(*) OVER k AS attempts,
        CAST(sum(failed) OVER k AS BIGINT) AS failed FROM attempt_log
        WINDOW k AS (PARTITION BY part ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW))"""),
    "monopolizing_keys": sql("attempt_log", """SELECT DISTINCT key, ts, busy_ms, busy_ms > 64800 AS rejected,
        CASE WHEN busy_ms > 64800 THEN 'transient' END AS error_category FROM (
        SELECT key, ts, CAST(sum(duration_ms) OVER (PARTITION BY key ORDER BY ts
        RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) AS BIGINT) AS busy_ms FROM attempt_log)"""),
    "flag_timeouts": sql("attempt_log", "SELECT off, duration_ms, duration_ms > 48000 AS timed_out FROM attempt_log"),
    "stalled_partitions": sql("ev", """SELECT part, max(ts) AS last_ts,
        CAST(floor((epoch_us(TIMESTAMP '2024-01-30 23:59:00') - epoch_us(max(ts))) / 1000) AS BIGINT) AS idle_ms,
        TIMESTAMP '2024-01-30 23:59:00' - max(ts) > INTERVAL 300 SECOND AS stalled FROM ev GROUP BY part"""),
    "stall_summary": sql("ev", """SELECT count(*) AS assigned_partitions, bool_or(stalled) AS is_stalled FROM (
        SELECT TIMESTAMP '2024-01-30 23:59:00' - max(ts) > INTERVAL 300 SECOND AS stalled FROM ev GROUP BY part)"""),
    "execution_share": sql("attempt_log", """SELECT key, CAST(total AS BIGINT) AS total_ms, CAST(failure AS BIGINT) AS failure_ms,
        round(failure / total, 9) AS failure_share, failure / total > 0.3 AS over_target
        FROM (SELECT key, sum(duration_ms) AS total,
        coalesce(sum(duration_ms) FILTER (class = 'failure'), 0) AS failure FROM attempt_log GROUP BY key)"""),
    "execution_share_total": sql("attempt_log", """SELECT CAST(total AS BIGINT) AS total_ms, CAST(failure AS BIGINT) AS failure_ms,
        round(failure / total, 9) AS failure_share, failure / total > 0.3 AS over_target
        FROM (SELECT sum(duration_ms) AS total,
        coalesce(sum(duration_ms) FILTER (class = 'failure'), 0) AS failure FROM attempt_log)"""),
    "request_outcomes": sql("outcomes", "SELECT * FROM outcomes"),
    "request_excise_outcomes": sql("outcomes", "SELECT * FROM outcomes WHERE request_id % 7 = 0"),
    "outcome_maps": sql("outcomes", """SELECT request_id, count(*) AS n, bool_or(ok) FILTER (subsystem = 'billing') AS billing_ok,
        max(kind) FILTER (subsystem = 'billing') AS billing_kind FROM outcomes GROUP BY request_id"""),
    "decode_outcome": sql("records", """SELECT off, off % 17 <> 0 AND payload IS NOT NULL AND off % 13 <> 0 AS ok,
        CASE WHEN off % 17 = 0 THEN 'formatMismatch' WHEN payload IS NULL THEN 'handler'
             WHEN off % 13 = 0 THEN 'malformedResponse' END AS kind FROM records"""),
    "fan_in_summary": sql("outcomes", """SELECT subsystem, CASE WHEN ok THEN 'success' ELSE kind END AS kind,
        count(*) AS n FROM outcomes GROUP BY 1, 2"""),
    "commit_log": sql("seen", "SELECT key, attempt, seq, item, commit_ts FROM seen"),
    "map_versions_appended": sql("seen_map", """SELECT key, map_key, seq, item, commit_ts AS from_ts, to_ts FROM (
        SELECT m.*, least((SELECT min(c.commit_ts) FROM seen_map c WHERE c.key = m.key AND c.op = 'clear' AND c.seq > m.seq),
          (SELECT min(w.commit_ts) FROM seen_map w WHERE w.key = m.key AND w.map_key = m.map_key AND w.op <> 'clear' AND w.seq > m.seq)) AS to_ts
        FROM seen_map m WHERE op = 'set') WHERE to_ts IS NULL OR to_ts > commit_ts"""),
    "value_versions": sql("seen", """SELECT key, seq, item, commit_ts AS from_ts, to_ts FROM (
        SELECT *, lead(commit_ts) OVER (PARTITION BY key ORDER BY seq) AS to_ts FROM seen) WHERE to_ts IS NULL OR to_ts > commit_ts"""),
    "published_value_get": sql("lookups seen", """SELECT lookup_id, l.key, read_ts, arg_max(s.item, s.seq) AS item
        FROM lookups l LEFT JOIN seen s ON s.key = l.key AND s.commit_ts <= l.read_ts GROUP BY ALL"""),
    "published_map_read": sql("map_lookups seen_map", """SELECT lookup_id, key, map_key, CASE WHEN op = 'set' THEN item END AS item,
        coalesce(op = 'set', FALSE) AS present FROM (SELECT lookup_id, l.key, l.map_key, arg_max(op, seq) AS op, arg_max(item, seq) AS item
        FROM map_lookups l LEFT JOIN seen_map s ON s.key = l.key AND commit_ts <= read_ts AND (op = 'clear' OR s.map_key = l.map_key)
        GROUP BY ALL)"""),
    "published_map_get_many": sql("ev seen_map", """SELECT request_id, key, pos, map_key, CASE WHEN op = 'set' THEN item END AS item FROM (
        SELECT request_id, l.key, pos, l.map_key, arg_max(op, seq) AS op, arg_max(item, seq) AS item FROM (
          SELECT event_id AS request_id, key, ts AS read_ts, pos, CASE WHEN pos = 1 THEN 'missing' WHEN pos IS NOT NULL THEN 'k' || (event_id % 7) END AS map_key
          FROM ev LEFT JOIN (SELECT unnest([0, 1, 2])::BIGINT AS pos) ON event_id % 11 <> 0) l
        LEFT JOIN seen_map s ON s.key = l.key AND commit_ts <= read_ts AND (op = 'clear' OR s.map_key = l.map_key) GROUP BY ALL)"""),
    "published_map_entries": sql("lookups seen_map", """SELECT lookup_id, key, map_key, item FROM (
        SELECT lookup_id, l.key, m.map_key, arg_max(op, seq) AS op, arg_max(item, seq) AS item
        FROM lookups l, (SELECT DISTINCT map_key FROM seen_map) m, seen_map s
        WHERE s.key = l.key AND commit_ts <= read_ts AND (op = 'clear' OR s.map_key = m.map_key) GROUP BY ALL) WHERE op = 'set'"""),
    "published_deque_read": sql("seen_queue", """SELECT lookup_id, key, i,
        CASE WHEN i = floor(i) THEN CASE WHEN i >= 0 THEN q[CAST(i AS BIGINT) + 1] ELSE q[CAST(i AS BIGINT)] END END AS item,
        CASE WHEN i <> floor(i) THEN 'transient' END AS error_category, CAST(len(q) AS BIGINT) AS length, len(q) = 0 AS is_empty FROM seen_queue"""),
    "published_deque_values": sql("seen_queue", """SELECT lookup_id, key, CAST(unnest(range(len(q))) AS BIGINT) AS pos, unnest(q) AS item
        FROM seen_queue"""),
    "serving_group": sql("ev", """SELECT lookup_id, subsystem, collection, min(group_id) FILTER (open) AS group_id FROM (
        SELECT l.lookup_id, l.subsystem, l.collection, c.group_id, arg_max(c.open, c.seq) AS open FROM (
          SELECT event_id AS lookup_id, ts AS read_ts, event_type AS collection,
          CASE WHEN event_id % 3 = 0 THEN 'checkout' ELSE 'billing' END AS subsystem FROM ev) l
        LEFT JOIN (SELECT CASE WHEN event_id % 2 = 0 THEN 'checkout' ELSE 'billing' END AS subsystem, event_type AS collection,
          'g' || key AS group_id, ts, event_id AS seq, event_id % 11 <> 0 AND event_id % 3 <> 0 AS open FROM ev) c
        ON c.subsystem = l.subsystem AND c.collection = l.collection AND c.ts <= l.read_ts GROUP BY ALL) GROUP BY ALL"""),
    "stale_read": sql("lookups value_ops", """SELECT lookup_id, f.key, f.ts AS read_ts, start AS filled_at, item
        FROM w f ASOF LEFT JOIN (SELECT * FROM value_ops WHERE op <> 'get') v
        ON v.key = f.key AND f.start >= v.ts""",
        timed="SELECT lookup_id, lookup_id AS off, key, read_ts AS ts FROM lookups",
        **walk("key", "date_trunc('millisecond', {t} + INTERVAL 6 HOUR)", source="timed")),
    "publish_catalog": sql("records readable", """SELECT off, r.subsystem, r.collection, group_id FROM (
        SELECT off, CASE WHEN off % 2 = 0 THEN 'checkout' ELSE 'billing' END AS subsystem,
        coalesce(type, 'internal') AS collection FROM records) r JOIN readable USING (subsystem, collection)"""),

    # streams and handlers
    "window_notify_stream": sql("ev", """SELECT key, kind, window_start, n, pos, event_id FROM notes""",
        **walk("key", seconds_after("6 HOUR")), **notified("6 HOUR", 3)),
    "window_notify_handler": sql("records", """SELECT key, kind, window_start, n, pos, event_id FROM notes
        WHERE is_first OR NOT EXISTS (SELECT 1 FROM records x WHERE x.is_excise AND x.key = notes.key
        AND x.ts >= notes.window_start AND x.ts < notes.fire_at)""",
        **walk("key", seconds_after("3 DAY"), reset="is_excise", source="records"), **notified("3 DAY", 100)),
    "timer_stream": sql("timer_ops", """SELECT DISTINCT key, fire_at FROM timer_ops s
        WHERE op IN ('schedule', 'clear_and_schedule') AND NOT EXISTS (
          SELECT 1 FROM timer_ops c WHERE c.key = s.key AND c.seq > s.seq AND c.ts < s.fire_at
          AND c.op IN ('clear', 'clear_and_schedule'))"""),
    "request_outcomes_stream": sql("outcomes", "SELECT * FROM outcomes"),
    "request_outcomes_join": sql("outcomes", "SELECT request_id, subsystem, resp_ts IS NULL AS timed_out FROM outcomes"),
}
ORACLES["keyed_counter_handler"] = ORACLES["keyed_counter"]
ORACLES["dedup_stream"] = ORACLES["dedup_ttl"]
ORACLES["dedup_runs"] = ORACLES["dedup_ttl"]
