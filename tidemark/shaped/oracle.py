"""The registered queries as plain SQL over the same tables.

Written in the direct form -- naive distinct counts, list filters -- so that it checks
the operators rather than repeating how they work.
"""

from __future__ import annotations

import itertools

from pyspark.sql import types as T

from tidemark.schema.flat import BASE
from tidemark.schema.raw import PARAM_VALUE, PROPERTY_VALUE, RAW
from tidemark.shaped import canonical, events

_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _sql_type(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        return f"STRUCT({', '.join(f'{f.name} {_sql_type(f.dataType)}' for f in kind.fields)})"
    if isinstance(kind, T.ArrayType):
        return f"{_sql_type(kind.elementType)}[]"
    return _TYPES[kind.simpleString()]


def _cast(text: str, kind: T.DataType) -> str:
    return f"CAST({text} AS {_sql_type(kind)})"


def _struct(parts: dict[str, str]) -> str:
    return "{" + ", ".join(f"'{name}': {text}" for name, text in parts.items()) + "}"


def _bag(entries, value_type: T.StructType) -> str:
    kind = events.full_type(value_type)
    made = []
    for key, sub_field, text, present in entries:
        value = {
            f.name: _cast(
                text if f.name == sub_field
                else "micros" if f.name == "set_timestamp_micros" and key else "NULL",
                f.dataType,
            )
            for f in value_type.fields
        }
        name = "CAST(NULL AS VARCHAR)" if key is None else f"'{key}'"
        entry = _struct({"key": name, "value": _struct(value)})
        made.append(f"CASE WHEN {present} THEN {entry} END")
    full = f"list_filter([{', '.join(made)}], lambda p: p IS NOT NULL)"
    null = f"CASE WHEN {events.NULL_ENTRY} THEN list_append({full}, NULL) ELSE {full} END"
    return (
        f"CASE WHEN {events.NULL_BAG} THEN NULL WHEN {events.EMPTY_BAG} "
        f"THEN CAST([] AS {_sql_type(kind)}) ELSE {null} END"
    )


def _column(field: T.StructField, path: str, numbers) -> str:
    if path == "event_params":
        return _bag(events.PARAM_ENTRIES, PARAM_VALUE)
    if path == "user_properties":
        return _bag(events.PROPERTY_ENTRIES, PROPERTY_VALUE)
    if path == "items":
        item = _struct({
            f.name: _cast(events.ITEM_VALUES.get(f.name, "NULL"), f.dataType)
            for f in field.dataType.elementType.fields
        })
        return f"CASE WHEN event_type = 'purchase' THEN [{item}] END"
    if isinstance(field.dataType, T.StructType):
        return _struct({
            f.name: _column(f, f"{path}.{f.name}", numbers) for f in field.dataType.fields
        })
    number = next(numbers) if "." in path else 0
    return _cast(events.leaf_expression(path, field.dataType, number), field.dataType)


def _exported() -> str:
    numbers = itertools.count()
    columns = ",\n".join(f"{_column(f, f.name, numbers)} AS {f.name}" for f in RAW.fields)
    return f"""
src AS (
    SELECT event_id, user_id, event_type, value, epoch_us(ts) AS micros,
           CAST(ts AS DATE) AS _dt, strftime(ts, '%Y%m%d') AS day_text,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           epoch_us(ts) // 21600000000 AS session_id
    FROM events
),
exported AS (SELECT {columns}, _dt FROM src)"""


def _filled(name: str, kind: T.DataType) -> str:
    return (
        f"coalesce(list_transform({name}, lambda p: "
        f"{{'key': coalesce(p.key, ''), 'value': p.value}}), CAST([] AS {_sql_type(kind)}))"
    )


def _raw() -> str:
    return f"""{_exported()},
loaded AS (
    SELECT * REPLACE (
        coalesce(event_date, '') AS event_date,
        coalesce(event_timestamp, 0) AS event_timestamp,
        coalesce(event_name, '') AS event_name,
        coalesce(platform, '') AS platform,
        {_filled("event_params", RAW["event_params"].dataType)} AS event_params,
        {_filled("user_properties", RAW["user_properties"].dataType)} AS user_properties,
        coalesce(items, CAST([] AS {_sql_type(RAW["items"].dataType)})) AS items
    ) FROM exported
)"""


_DAY = "coalesce(CAST(try_strptime(event_date, '%Y%m%d') AS DATE), _dt)"


def _base_columns() -> str:
    made = []
    for column in BASE:
        text = {"event_date": _DAY, "event_ts": "make_timestamp(event_timestamp)"}.get(
            column.name, column.path
        )
        made.append(f"{text} AS {column.name}")
    return ", ".join(made)


def _lookup(bag: str, key: str, sub_field: str) -> str:
    return f"list_filter({bag}, lambda p: p.key = '{key}')[1].value.{sub_field}"


_DYNAMIC = {
    "_empty_int": ("event_params", "", "int_value"),
    "_7th_try_float": ("event_params", "7th_try", "float_value"),
    "engagement_time_msec_int": ("event_params", "engagement_time_msec", "int_value"),
    "ga_session_id_int": ("event_params", "ga_session_id", "int_value"),
    "k_int": ("event_params", "k", "int_value"),
    "score_double": ("event_params", "score", "double_value"),
    "screen_name_str": ("event_params", "screen-name", "string_value"),
    "session_engaged_int": ("event_params", "session_engaged", "int_value"),
    "_worth_double": ("user_properties", "_worth", "double_value"),
    "up_k_int": ("user_properties", "k", "int_value"),
    "up_user_id_str": ("user_properties", "user_id", "string_value"),
}


def _flat() -> str:
    dynamic = ", ".join(f"{_lookup(*place)} AS {name}" for name, place in _DYNAMIC.items())
    return f"{_raw()},\nflat AS (SELECT {_base_columns()}, {dynamic}, _dt FROM loaded)"


_SUBS = ("string_value", "int_value", "float_value", "double_value")


def _found(where: str = "TRUE") -> str:
    """Key discovery: one row per day, bag, key and sub-field with values."""
    parts = [
        f"""SELECT _dt, '{bag}' AS source, p.key AS key, '{sub}' AS sub_field,
                   count(p.value.{sub}) AS n
            FROM (SELECT _dt, unnest({bag}) AS p FROM loaded WHERE {where})
            GROUP BY ALL HAVING count(p.value.{sub}) > 0"""
        for bag in ("event_params", "user_properties") for sub in _SUBS
    ]
    return f"{_raw()},\nfound AS ({' UNION ALL '.join(parts)})"


_PAIR = "{'u': user_pseudo_id, 's': ga_session_id_int}"


def _users(event: str) -> str:
    return f"count(DISTINCT user_pseudo_id) FILTER (event_name = '{event}')"


def _times(event: str) -> str:
    return f"count(*) FILTER (event_name = '{event}')"


_SESSIONS = f"count(DISTINCT {_PAIR}) FILTER (ga_session_id_int IS NOT NULL)"
_SECONDS = "round(CAST(sum(coalesce(engagement_time_msec_int, 0)) AS DOUBLE) / 1000, 3)"
_REVENUE = ("round(sum(CASE WHEN event_name = 'in_app_purchase' "
            "THEN coalesce(event_value_in_usd, 0) ELSE 0 END), 2)")


def _kpi(flat: str = "flat") -> str:
    return f"""
    SELECT _dt, count(DISTINCT user_pseudo_id) AS dau, {_users('first_open')} AS new_users,
           {_SESSIONS} AS sessions,
           count(DISTINCT {_PAIR}) FILTER (session_engaged_int = 1) AS engaged_sessions,
           {_SECONDS} AS engagement_sec, count(*) AS events,
           {_times('send_prompt')} AS prompts_sent, {_users('send_prompt')} AS prompt_users,
           {_times('prompt_result')} AS prompt_results, {_times('chat_start')} AS chat_starts,
           {_times('paywall_view')} AS paywall_views, {_users('paywall_view')} AS paywall_users,
           {_times('in_app_purchase')} AS purchases, {_users('in_app_purchase')} AS buyers,
           {_REVENUE} AS revenue_usd,
           round(sum(coalesce(publisher_ad_revenue_in_usd, 0)), 4) AS ad_revenue_usd,
           {_users('app_remove')} AS app_removes
    FROM {flat} GROUP BY _dt"""


def _latest(column: str) -> str:
    return f"arg_max({column}, {{'a': event_timestamp, 'b': {column}}})"


_USER_DAILY = f"""
    SELECT _dt, user_pseudo_id,
           max(CASE WHEN event_name = 'first_open' THEN 1 ELSE 0 END) AS is_new,
           count(*) AS events, count(DISTINCT ga_session_id_int) AS sessions,
           {_SECONDS} AS engagement_sec, {_times('send_prompt')} AS prompts_sent,
           {_times('in_app_purchase')} AS purchases, {_REVENUE} AS revenue_usd,
           min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts,
           {_latest('platform')} AS platform,
           {_latest("coalesce(geo_country, '')")} AS country,
           {_latest("coalesce(app_info_version, '')")} AS app_version
    FROM flat WHERE user_pseudo_id IS NOT NULL GROUP BY _dt, user_pseudo_id"""

_RETENTION = """
    SELECT c._dt AS cohort_dt, CAST(date_diff('day', c._dt, a._dt) AS INTEGER) AS day_n,
           count(DISTINCT a.user_pseudo_id) AS retained_users
    FROM users c JOIN users a ON a.user_pseudo_id = c.user_pseudo_id
    WHERE c.is_new = 1 AND a._dt >= c._dt GROUP BY ALL"""

_CHOSEN = """
chosen AS (
    SELECT *, CASE WHEN _dt <= DATE '2024-01-20' THEN 0 ELSE 1 END AS _is_intraday FROM loaded
)"""

_CALENDAR = """
calendar AS (
    SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day
    FROM (SELECT min(CAST(ts AS DATE)) - 2 AS a, max(CAST(ts AS DATE)) + 3 AS b FROM events)
)"""

_METRICS = """
    SELECT _dt, count(*) AS rows,
           count(*) FILTER (user_pseudo_id IS NULL OR user_pseudo_id = '') AS null_pseudo,
           count(*) FILTER (len(event_params) = 0) AS empty_params,
           count(DISTINCT event_name) AS uniq_event_names,
           CAST(max(len(event_params)) AS INTEGER) AS max_params_len
    FROM broken GROUP BY _dt"""

_TYPE_OF = """CASE sub_field WHEN 'string_value' THEN 'string' WHEN 'int_value' THEN 'bigint'
              ELSE 'double' END"""


def _name_case() -> str:
    whens = " ".join(
        f"WHEN source = '{s}' AND key = '{k}' AND sub_field = '{f}' THEN '{name}'"
        for name, (s, k, f) in _DYNAMIC.items()
    )
    return f"CASE {whens} END"


def _registry_rows(first_seen: str = "min(_dt)") -> str:
    return f"""
    SELECT source, key, sub_field, {_name_case()} AS column_name, {_TYPE_OF} AS column_type,
           {first_seen} AS first_seen, max(_dt) AS last_seen, CAST(sum(n) AS BIGINT) AS n_seen
    FROM found GROUP BY source, key, sub_field"""


# Names by position among the keys that share a cleaned-up name: the first one of all
# gets it plain unless it is taken, the first one left in each bag gets the prefix, the
# others a number from 2.
_COLUMN_NAMES = """
keys AS (
    SELECT 'event_params' AS source, concat(event_type, '-', CAST(k % 7 AS VARCHAR)) AS key FROM src
    UNION SELECT 'event_params', concat(event_type, '.', CAST(k % 5 AS VARCHAR)) FROM src
    UNION SELECT 'event_params', concat(event_type, '_', CAST(k % 3 AS VARCHAR)) FROM src
    UNION SELECT 'event_params', concat(event_type, ' ', CAST(k % 4 AS VARCHAR)) FROM src
    UNION SELECT 'user_properties', concat(event_type, '_', CAST(k % 6 AS VARCHAR)) FROM src
    UNION SELECT 'user_properties', concat(event_type, '~', CAST(k % 2 AS VARCHAR)) FROM src
),
ranked AS (
    SELECT source, key, regexp_replace(key, '[^0-9A-Za-z_]', '_', 'g') || '_int' AS plain,
           row_number() OVER (PARTITION BY plain ORDER BY source, key)
               + CASE WHEN plain = 'click_0_int' THEN 1 ELSE 0 END AS place
    FROM keys
),
left_over AS (
    SELECT *, CASE source WHEN 'event_params' THEN 'ep_' ELSE 'up_' END || plain AS prefixed,
           row_number() OVER (PARTITION BY plain, source ORDER BY key) AS again
    FROM ranked WHERE place > 1
)
SELECT source, key, 'int_value' AS sub_field, plain AS column_name FROM ranked WHERE place = 1
UNION ALL
SELECT source, key, 'int_value',
       prefixed || CASE WHEN again > 1 THEN CAST(again AS VARCHAR) ELSE '' END
FROM left_over"""


def _coverage() -> str:
    parts = [
        f"SELECT '{name}' AS \"column\", count(*) AS rows, count({name}) AS non_null, "
        f"round(count({name}) / count(*), 4) AS ratio FROM exported"
        for name in RAW.names
    ]
    return " UNION ALL ".join(parts)


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(part.strip().rstrip(",") for part in parts) + "\n"


def _drift() -> str:
    number, publisher = (RAW[n].dataType.simpleString() for n in ("event_bundle_sequence_id", "publisher"))
    return f"""
        SELECT DISTINCT CAST(ts AS DATE) AS _dt, "column", kind, declared, actual
        FROM events JOIN (VALUES
            (0, 'note', 'extra', NULL, 'string'), (1, 'note', 'extra', NULL, 'string'),
            (2, 'note', 'extra', NULL, 'string'), (1, 'publisher', 'missing', '{publisher}', NULL),
            (2, 'event_bundle_sequence_id', 'mismatched', '{number}', 'string')
        ) AS t(rest, "column", kind, declared, actual) ON day(ts) % 3 = rest"""


def _uneven(text: str, name: str = "exported") -> str:
    """The SQL with ``name`` (exported or loaded) replaced by its uneven rows."""
    kind = _sql_type(RAW["event_params"].dataType)
    changed = f"""
{name} AS (
    SELECT * REPLACE (
        CASE WHEN {events.FEW_USERS} THEN NULL ELSE user_pseudo_id END AS user_pseudo_id,
        CASE WHEN {events.FEW_BAGS} THEN CAST([] AS {kind}) ELSE event_params END AS event_params
    ) FROM even
)"""
    before = f"{name} AS (SELECT" if name == "exported" else f"{name} AS (\n    SELECT"
    assert before in text
    text = text.replace(before, before.replace(name, "even"), 1)
    if name == "exported":
        return text.replace(",\nloaded AS (", f",{changed},\nloaded AS (", 1)
    return f"{text},{changed}"


_BROKEN = f"""
broken AS (
    SELECT * REPLACE (CASE WHEN {events.NO_NAMES} THEN NULL ELSE event_name END AS event_name)
    FROM loaded
)"""


def _listed(text: str) -> str:
    """A text of each entry ``p`` of the event's bag."""
    return f"array_to_string(list_transform(event_params, lambda p: {text}), '|')"


def oracle_sql() -> dict[str, str]:
    """SQL per registered query."""
    raw, flat, found = _with(_raw()), _with(_flat()), _with(_found())
    broken = _with(_uneven(_raw(), "loaded"), _BROKEN)
    chosen = _with(_raw(), _CHOSEN)
    users = _with(_flat(), f"users AS ({_USER_DAILY})")
    exported = _with(_exported())
    counts = "SELECT _dt, count(*) AS rows FROM loaded GROUP BY _dt"
    whole = ", ".join(canonical.whole_row(spark=False))
    retained = _with(_flat(), f"users AS ({_USER_DAILY})", f"retained AS ({_RETENTION})")
    return {
        "raw_scan": exported + f"""
            SELECT {', '.join(canonical.whole_row(False, ('publisher', 'event_original_occurrence_timestamp')))}
            FROM exported""",
        "mixed_type_scan": exported + f"""
            SELECT {', '.join(f.name for f in RAW.fields if f.dataType.simpleString() in _TYPES)},
                   CASE WHEN event_bundle_sequence_id % 4 < 3 THEN geo.country END AS country,
                   device.web_info.browser AS browser,
                   {_listed("coalesce(p.key, '?')")} AS keys,
                   {_listed("coalesce(CAST(p.value.int_value AS VARCHAR), '?')")} AS ints,
                   CASE WHEN event_bundle_sequence_id % 4 = 2 THEN {_listed("'?'")}
                        ELSE {_listed("coalesce(p.value.string_value, '?')")} END AS texts,
                   _dt
            FROM exported""",
        "broken_files": """
            SELECT _dt, part, CASE WHEN broken THEN 0 ELSE rows END AS rows, broken
            FROM (SELECT *, day(_dt) % 3 = 1 AND part = day(_dt) % 5 AS broken
                  FROM (SELECT CAST(ts AS DATE) AS _dt, event_id % 5 AS part, count(*) AS rows
                        FROM events GROUP BY ALL))""",
        "raw_defaults": raw + f"SELECT {whole}, _dt FROM loaded",
        "day_layouts": """
            SELECT CAST(ts AS DATE) AS _dt,
                   CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-20'
                        THEN strftime(ts, 'dt=%Y-%m-%d') ELSE strftime(ts, 'dt=%Y%m%d')
                   END AS folder,
                   count(*) AS rows
            FROM events GROUP BY ALL""",
        "file_statistics": """
            SELECT DISTINCT CAST(ts AS DATE) AS _dt, CAST(1 AS BIGINT) AS files, TRUE AS has_bytes
            FROM events""",
        "final_over_intraday": exported + f"""
            SELECT _dt, CASE WHEN _dt <= DATE '2024-01-20' THEN 0 ELSE 1 END AS _is_intraday, {whole}
            FROM exported""",
        "raw_load": chosen + f"""
            SELECT {whole}, TRUE AS has_ingested_at, _dt, 'run-1' AS _run_id,
                   'events' AS _source_table, _is_intraday
            FROM chosen""",
        "replace_days": """
            SELECT CAST(ts AS DATE) AS _dt,
                   CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-11' THEN 'run-2' ELSE 'run-1'
                   END AS _run_id,
                   count(*) AS rows
            FROM events GROUP BY ALL""",
        "snapshot_export": exported + f"SELECT {whole} FROM exported",
        "run_log": _with(_raw(), _CHOSEN, _CALENDAR, """
            per_day AS (SELECT _dt, _is_intraday, count(*) AS n FROM chosen GROUP BY ALL)""") + """
            SELECT day AS event_date,
                   CASE WHEN n IS NULL THEN '' WHEN _is_intraday = 1
                        THEN strftime(day, 'events_intraday_%Y%m%d')
                        ELSE strftime(day, 'events_%Y%m%d') END AS source_table,
                   coalesce(_is_intraday, 1) AS is_intraday, 'tables' AS strategy,
                   coalesce(n, 0) AS source_row_count, CAST(0 AS BIGINT) AS files_read,
                   coalesce(n, 0) AS rows_inserted, 'run-1' AS run_id,
                   CASE WHEN n IS NULL THEN 'skipped' ELSE 'success' END AS status,
                   '' AS error_message
            FROM calendar LEFT JOIN per_day ON day = _dt""",
        "load_existing_files": _with(_raw(), _CALENDAR, f"per_day AS ({counts})") + """
            SELECT day AS event_date, 1 AS is_intraday,
                   CASE WHEN rows IS NOT NULL THEN 1 END AS _is_intraday,
                   rows, coalesce(rows, 0) AS rows_inserted,
                   CASE WHEN rows IS NULL THEN 'skipped' ELSE 'success' END AS status,
                   CAST(rows IS NOT NULL AS BIGINT) AS files_read, rows IS NOT NULL AS has_bytes
            FROM calendar LEFT JOIN per_day ON day = _dt
            WHERE day >= (SELECT min(_dt) FROM per_day)""",
        "ttl_survivors": raw + """
            SELECT _dt, event_timestamp, event_name, user_pseudo_id FROM loaded
            WHERE _dt + 15 > DATE '2024-01-25'""",
        "expired_days": raw + """
            SELECT _dt, count(*) AS rows FROM loaded WHERE _dt + 15 > DATE '2024-01-25'
            GROUP BY _dt""",
        "compacted_storage": raw + """
            SELECT _dt, count(*) AS rows, CAST(1 AS BIGINT) AS files,
                   TRUE AS has_bytes, FALSE AS too_many_files
            FROM loaded GROUP BY _dt""",
        "storage_total": raw + """
            SELECT count(DISTINCT _dt) AS files, count(*) AS rows, count(*) > 0 AS has_bytes,
                   FALSE AS too_large
            FROM loaded""",
        "range_status": _with(_raw(), _CALENDAR, f"""per_day AS (
            SELECT _dt, count(*) FILTER ({events.LOST}) AS lost FROM loaded GROUP BY _dt)""") + """
            SELECT day AS _dt, CASE WHEN lost IS NULL THEN 'skipped' WHEN lost > 0 THEN 'failed'
                                    ELSE 'success' END AS status
            FROM calendar LEFT JOIN per_day ON day = _dt""",
        "flat_base": raw + f"SELECT {_base_columns()}, _dt FROM loaded",
        "event_date_fallback": raw + f"""
            SELECT event_timestamp, event_date, _dt, {_DAY} AS day FROM loaded""",
        "event_date_d": raw + """
            SELECT event_timestamp, event_date,
                   CAST(try_strptime(event_date, '%Y%m%d') AS DATE) AS event_date_d FROM loaded""",
        "event_ts": "SELECT epoch_us(ts) AS event_timestamp, ts AS event_ts FROM events",
        "flat_dynamic": flat + f"""
            SELECT _dt, event_timestamp, {', '.join(_DYNAMIC)} FROM flat""",
        "param_lookup": raw + f"""
            SELECT event_timestamp,
                   {_lookup('event_params', 'ga_session_id', 'int_value')} AS ga_session_id,
                   {_lookup('event_params', 'screen-name', 'string_value')} AS screen_name
            FROM loaded""",
        "user_prop_lookup": raw + f"""
            SELECT event_timestamp, user_pseudo_id,
                   {_lookup('user_properties', '_worth', 'double_value')} AS ltv,
                   {_lookup('user_properties', '_worth', 'set_timestamp_micros')} AS ltv_set
            FROM loaded""",
        "param_exists": raw + """
            SELECT _dt, count(*) AS n FROM loaded
            WHERE list_contains(list_transform(event_params, lambda p: p.key), '7th_try')
            GROUP BY _dt""",
        "param_keys": raw + """
            SELECT event_timestamp,
                   array_to_string(list_transform(event_params, lambda p: p.key), '|') AS keys
            FROM loaded WHERE event_name = 'send_prompt'""",
        "param_count": raw + f"""
            SELECT event_timestamp, CAST(len(event_params) AS INTEGER) AS n_params,
                   len(event_params) = 0 AS is_empty FROM loaded""",
        "kpi_missing_dynamic": _with(_flat(), """
            bare AS (SELECT * REPLACE (CAST(NULL AS BIGINT) AS ga_session_id_int,
                                       CAST(NULL AS BIGINT) AS session_engaged_int,
                                       CAST(NULL AS BIGINT) AS engagement_time_msec_int)
                     FROM flat)""") + _kpi("bare"),
        "peek_day": flat + """
            SELECT *, 'run-1' AS _run_id FROM flat WHERE _dt = DATE '2024-01-15'
            ORDER BY event_timestamp, event_bundle_sequence_id LIMIT 1""",
        "local_day": """
            SELECT CAST(ts + INTERVAL 7 HOUR AS DATE) AS local_day, count(*) AS n
            FROM events GROUP BY ALL""",
        "kpi_trend": _with(_flat(), f"kpi AS ({_kpi()})") + """
            SELECT _dt, dau, new_users, sessions, prompts_sent, revenue_usd FROM kpi""",
        "flat_selection": flat + """
            SELECT event_date, event_name, ga_session_id_int, screen_name_str, geo_country
            FROM flat WHERE _dt = DATE '2024-01-15'""",
        "discover_keys": found + "SELECT _dt, source, key, sub_field, n FROM found",
        "explore_event_params": raw + f"""
            SELECT p.key AS key, {', '.join(f'count(p.value.{s}) AS n_{s}' for s in _SUBS)},
                   count(*) AS n_total, min(p.value.string_value) AS sample
            FROM (SELECT unnest(event_params) AS p FROM loaded) GROUP BY p.key""",
        "explore_user_props": raw + f"""
            SELECT p.key AS key,
                   {', '.join(f'count(p.value.{s}) AS n_{s}'
                              for s in (*_SUBS, 'set_timestamp_micros'))},
                   count(*) AS n_total, min(p.value.string_value) AS sample
            FROM (SELECT unnest(user_properties) AS p FROM loaded) GROUP BY p.key""",
        "mart_daily_kpi": flat + _kpi(),
        "mart_daily_events": flat + f"""
            SELECT _dt, event_name, count(*) AS events, count(DISTINCT user_pseudo_id) AS users,
                   {_SESSIONS} AS sessions FROM flat GROUP BY _dt, event_name""",
        "mart_daily_geo": flat + f"""
            SELECT _dt, coalesce(geo_country, '') AS country, platform,
                   count(DISTINCT user_pseudo_id) AS users, {_users('first_open')} AS new_users,
                   {_SESSIONS} AS sessions, count(*) AS events,
                   {_times('in_app_purchase')} AS purchases, {_users('in_app_purchase')} AS buyers,
                   {_REVENUE} AS revenue_usd
            FROM flat GROUP BY _dt, coalesce(geo_country, ''), platform""",
        "mart_user_daily": flat + _USER_DAILY,
        "event_counts": raw + """
            SELECT _dt, event_name, count(*) AS n FROM loaded GROUP BY ALL""",
        "partition_counts": raw + counts,
        "mart_retention": users + _RETENTION,
        "retention_pct": retained + """
            SELECT cohort_dt,
                   max(retained_users) FILTER (day_n = 0) AS cohort_size,
                   round_even(max(retained_users) FILTER (day_n = 1)
                         / max(retained_users) FILTER (day_n = 0) * 100, 1) AS d1_pct,
                   round_even(max(retained_users) FILTER (day_n = 7)
                         / max(retained_users) FILTER (day_n = 0) * 100, 1) AS d7_pct
            FROM retained GROUP BY cohort_dt""",
        "qc_metrics": broken + _METRICS,
        "qc_verdicts": _with(_uneven(_raw(), "loaded"), _BROKEN, f"m AS ({_METRICS})") + """
            SELECT _dt, CASE WHEN rows = 0 THEN 'fail' ELSE 'ok' END AS rows_verdict,
                   CASE WHEN null_pseudo / rows > 0.05 THEN 'warn' ELSE 'ok' END AS user_verdict,
                   CASE WHEN empty_params / rows > 0.2 THEN 'warn' ELSE 'ok' END AS params_verdict,
                   CASE WHEN uniq_event_names <= 0 THEN 'fail' ELSE 'ok' END AS names_verdict
            FROM m""",
        "qc_nested": broken + """
            SELECT _dt, max(len(event_params)) > 0 AS nested_readable FROM broken GROUP BY _dt""",
        "row_reconcile": _with(_raw(), f"""
            pairs AS (SELECT _dt, count(*) AS source_rows,
                             count(*) FILTER (NOT ({events.LOST})) AS loaded_rows
                      FROM loaded GROUP BY _dt)""") + """
            SELECT _dt, source_rows, loaded_rows, abs(loaded_rows - source_rows) AS diff,
                   CASE WHEN loaded_rows = source_rows THEN 'ok'
                        WHEN _dt > DATE '2024-01-20' AND source_rows > 0
                             AND abs(loaded_rows - source_rows) / source_rows <= 0.005 THEN 'warn'
                        ELSE 'fail' END AS verdict
            FROM pairs""",
        "flat_reconcile": raw + f"""
            SELECT _dt, count(*) AS raw_rows, count(*) FILTER (NOT ({events.LOST})) AS flat_rows,
                   CASE WHEN count(*) FILTER ({events.LOST}) > 0 THEN 'fail' ELSE 'ok' END AS verdict
            FROM loaded GROUP BY _dt""",
        "mart_reconcile": raw + f"""
            SELECT _dt, count(*) AS flat_rows, count(*) FILTER (NOT ({events.LOST})) AS mart_events,
                   CASE WHEN count(*) FILTER ({events.LOST}) > 0 THEN 'fail' ELSE 'ok' END AS verdict
            FROM loaded GROUP BY _dt""",
        "registry_latest": found + """
            SELECT source, key, sub_field, concat_ws('/', source, key) AS column_name,
                   'any' AS column_type, _dt AS first_seen, _dt AS last_seen, n AS n_seen
            FROM found
            QUALIFY row_number() OVER (PARTITION BY source, key, sub_field ORDER BY _dt DESC) = 1""",
        "registry_merged": found + """
            SELECT source, key, sub_field, concat_ws('/', source, key) AS column_name,
                   'any' AS column_type, _dt AS first_seen, _dt AS last_seen, n AS n_seen
            FROM found
            QUALIFY row_number() OVER (PARTITION BY source, key, sub_field ORDER BY _dt DESC) = 1""",
        "registry_replaced": _with(_found(f"_dt < DATE '2024-01-11' OR NOT ({events.LOST})"))
        + _registry_rows(),
        "registry_upsert": found + f"""
            SELECT * FROM ({_registry_rows()}) WHERE last_seen > DATE '2024-01-20'""",
        "registry_rebuild": found + _registry_rows(),
        "column_names": _with(_exported(), _COLUMN_NAMES.split("\nSELECT", 1)[0])
        + "SELECT" + _COLUMN_NAMES.split("\nSELECT", 1)[1],
        "added_columns": found + f"""
            SELECT column_name, column_type FROM ({_registry_rows()})
            WHERE source = 'user_properties'""",
        "column_coverage": exported + _coverage(),
        "schema_drift": _drift(),
        "flatten_days": flat + f"""
            SELECT _dt, event_date, event_timestamp, event_ts, event_name, user_pseudo_id,
                   platform, geo_country, app_info_version, device_web_browser,
                   stlc_dv360_partner_name, {', '.join(_DYNAMIC)}, 'run-1' AS _run_id
            FROM flat""",
        "daily_run": _with(_uneven(_flat()), """
            bad AS (SELECT _dt FROM loaded GROUP BY _dt HAVING max(len(event_params)) = 0)""",
            f"kpi AS ({_kpi()})") + """
            SELECT *, 'run-1' AS _run_id FROM kpi WHERE _dt NOT IN (SELECT _dt FROM bad)""",
        "daily_log": _with(_uneven(_raw()), _CALENDAR, """
            m AS (SELECT _dt, count(*) AS rows, max(len(event_params)) AS longest,
                         count(*) FILTER (user_pseudo_id IS NULL OR user_pseudo_id = '') AS users,
                         count(*) FILTER (len(event_params) = 0) AS bags
                  FROM loaded GROUP BY _dt)""") + """
            SELECT day AS event_date, 'run-1' AS run_id,
                   CASE WHEN rows IS NULL THEN 'skipped' WHEN longest = 0 THEN 'failed'
                        ELSE 'success' END AS status,
                   CASE WHEN rows IS NULL THEN 'load' WHEN longest = 0 THEN 'checks'
                        ELSE 'marts' END AS stage,
                   CASE WHEN longest = 0 THEN 'no event_params could be read' ELSE '' END AS message,
                   concat_ws('; ',
                       CASE WHEN users / rows > 0.05
                            THEN printf('%.1f%% of rows have no user', 100 * users / rows) END,
                       CASE WHEN bags / rows > 0.2
                            THEN printf('%.1f%% of rows have no event_params', 100 * bags / rows)
                       END) AS warnings
            FROM calendar LEFT JOIN m ON day = _dt""",
        "stored_retention": users + _RETENTION,
        "retention_incremental": _with(
            _flat(),
            f"left_flat AS (SELECT * FROM flat WHERE _dt < DATE '2024-01-11' OR NOT ({events.LOST}))",
            f"users AS ({_USER_DAILY.replace('FROM flat', 'FROM left_flat')})",
        ) + _RETENTION,
        "content_reconcile": raw + f"""
            SELECT _dt, count(*) AS left_rows, count(*) FILTER (NOT ({events.LOST})) AS right_rows,
                   CASE WHEN bool_or({events.LOST}
                                     OR day(_dt) % 5 = 1 AND event_bundle_sequence_id % 7 = 0
                                     OR day(_dt) % 5 = 2 AND event_bundle_sequence_id % 97 = 0)
                        THEN 'fail' ELSE 'ok' END AS verdict
            FROM loaded GROUP BY _dt""",
    }
