"""The same queries as plain SQL over the benchmark tables (DuckDB dialect)."""

from __future__ import annotations

_EVENTS = """
ev_rows AS (
  SELECT event_id, ts, user_id, event_type, CAST(ts AS DATE) AS load_date FROM events
),
ev AS (
  SELECT user_id, event_type, load_date, ts, event_id,
         md5(coalesce(event_type, '')) AS attr_hash
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, load_date
                                     ORDER BY ts DESC, event_id DESC) AS rn
        FROM ev_rows WHERE user_id IS NOT NULL)
  WHERE rn = 1
)"""


def _dim(staged: str, key: str, attributes: str, name: str) -> str:
    return f"""
{name}_ranges AS (
  SELECT *, lead(load_date) OVER (PARTITION BY {key} ORDER BY load_date) AS repaired_valid_to
  FROM (SELECT *, lag(attr_hash) OVER (PARTITION BY {key} ORDER BY load_date) AS previous_hash
        FROM {staged})
  WHERE previous_hash IS NULL OR attr_hash <> previous_hash
),
{name} AS (
  SELECT md5(CAST({key} AS VARCHAR) || '|' || CAST(load_date AS VARCHAR) || '|' || attr_hash)
           AS business_sk,
         {key}, {attributes}, attr_hash, load_date AS valid_from,
         repaired_valid_to AS valid_to, repaired_valid_to IS NULL AS is_current
  FROM {name}_ranges
)"""


def _orders(name: str, attributes: str, hash_sql: str) -> str:
    return f"""
{name} AS (
  SELECT o_custkey, {attributes}, load_date, o_orderdate, o_orderkey,
         md5({hash_sql}) AS attr_hash
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, load_date
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS load_date
              FROM orders)
        WHERE o_custkey IS NOT NULL)
  WHERE rn = 1
)"""


_ORDERS = _orders(
    "ord",
    "o_orderstatus, o_orderpriority",
    "coalesce(o_orderstatus, '') || '|' || coalesce(o_orderpriority, '')",
)

_RAW = """
raw AS (
  SELECT
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '   '
         WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
         ELSE ' LIC-' || CAST(o_custkey AS VARCHAR) || ' ' END AS license_nbr,
    '  ' || c_name || '   ' || lower(c_mktsegment) AS business_name,
    CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS business_name2,
    CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN ''
         ELSE left(o_orderpriority, 1) END AS address_building,
    CASE WHEN o_orderstatus = 'P' THEN NULL
         WHEN o_orderstatus = 'O' THEN '  '
         ELSE ' ' || replace(n_name, '_', '  ') END AS address_street,
    lower(r_name) AS address_city,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ' '
         ELSE left(r_name, 2) END AS address_state,
    CAST(c_nationkey AS VARCHAR) AS address_zip,
    o_orderstatus || '  ' || lower(o_orderstatus) AS license_status,
    lower(o_orderpriority) AS license_category,
    CASE WHEN o_orderstatus = 'P' THEN '2020-13-45'
         WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%m/%d/%Y')
         ELSE strftime(o_orderdate, ' %Y-%m-%dT%H:%M:%S') END AS license_creation_date,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS load_date,
    o_orderdate AS ingested_at,
    o_orderkey AS source_row_number,
    o_totalprice
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

_STAGE = """
norm AS (
  SELECT
    trim(license_nbr) AS license_nbr,
    upper(regexp_replace(trim(business_name), '\\s+', ' ', 'g')) AS business_name,
    upper(regexp_replace(trim(business_name2), '\\s+', ' ', 'g')) AS business_name2,
    upper(regexp_replace(trim(concat_ws(', ',
      nullif(trim(address_building) || ' ' || trim(address_street), ' '),
      nullif(trim(address_city), ''), nullif(trim(address_state), ''),
      nullif(trim(address_zip), ''))), '\\s+', ' ', 'g')) AS address_full,
    upper(regexp_replace(trim(license_status), '\\s+', ' ', 'g')) AS license_status,
    upper(regexp_replace(trim(license_category), '\\s+', ' ', 'g')) AS license_category,
    CASE WHEN regexp_matches(trim(license_creation_date), '^\\d{{4}}-\\d{{2}}-\\d{{2}}')
         THEN TRY_CAST(left(trim(license_creation_date), 10) AS DATE) END
      AS license_creation_date,
    load_date, ingested_at, source_row_number
  FROM {source}
),
hashed AS (
  SELECT *, md5(coalesce(business_name, '') || '|' || coalesce(business_name2, '') || '|' ||
                coalesce(address_full, '') || '|' || coalesce(license_status, '') || '|' ||
                coalesce(license_category, '')) AS attr_hash
  FROM norm
),
reg AS (
  SELECT license_nbr, business_name, business_name2, address_full, license_status,
         license_category, license_creation_date, load_date, ingested_at,
         source_row_number, attr_hash
  FROM (SELECT *, row_number() OVER (PARTITION BY license_nbr, load_date
                  ORDER BY ingested_at DESC, source_row_number DESC) AS rn
        FROM hashed WHERE license_nbr IS NOT NULL AND license_nbr <> '')
  WHERE rn = 1
)"""

_CONTRACT = (
    "license_nbr, business_name, business_name2, address_building, address_street, "
    "address_city, address_state, address_zip, license_status, license_category, "
    "license_creation_date"
).split(", ")

_REGISTRY = f"{_RAW}, {_STAGE.format(source='raw')}"

# A CSV file has no NULLs: missing values come back as empty fields.
_FROM_CSV = f"""{_RAW},
landed AS (
  SELECT {", ".join(f"coalesce({c}, '') AS {c}" for c in _CONTRACT)},
         load_date, TIMESTAMP '2024-02-01 06:00:00' AS ingested_at, source_row_number
  FROM raw
),
{_STAGE.format(source="landed")}"""

_REG_ATTRIBUTES = (
    "business_name, business_name2, address_full, license_status, license_category, "
    "license_creation_date"
)
_BLANK = "(license_nbr IS NULL OR trim(license_nbr) = '')"

_EV_DIM = f"{_EVENTS}, {_dim('ev', 'user_id', 'event_type', 'dim')}"
_REG_DIM = f"{_REGISTRY}, {_dim('reg', 'license_nbr', _REG_ATTRIBUTES, 'dim')}"
_OR_DIM = (
    f"{_ORDERS}, {_dim('ord', 'o_custkey', 'o_orderstatus, o_orderpriority', 'dim')}"
)
_COLLIDED = ", ".join(
    [
        _orders("by_status", "o_orderstatus AS state", "coalesce(o_orderstatus, '')"),
        _dim("by_status", "o_custkey", "state", "status_dim"),
        _orders("by_priority", "o_orderpriority AS state", "coalesce(o_orderpriority, '')"),
        _dim("by_priority", "o_custkey", "state", "priority_dim"),
        """
collided AS (
  SELECT *, coalesce(valid_to, DATE '9999-12-31') AS ends
  FROM (SELECT * FROM status_dim UNION ALL SELECT * FROM priority_dim)
)""",
    ]
)

_PROFILES = f"""{_REGISTRY},
held AS (
  SELECT CAST(ingested_at AS DATE) AS load_date,
         {", ".join(f"bool_or(coalesce(trim({c}), '') <> '') AS {c}" for c in _CONTRACT)},
         bool_or(o_totalprice > 450000) AS order_size
  FROM raw GROUP BY 1
),
profiles AS (
  SELECT load_date,
         concat_ws(',', {", ".join(f"CASE WHEN NOT {c} THEN '{c}' END" for c in sorted(_CONTRACT))})
           AS missing_columns,
         CASE WHEN order_size THEN 'order_size' ELSE '' END AS added_columns,
         CASE WHEN NOT license_nbr THEN 'failed'
              WHEN NOT ({" AND ".join(_CONTRACT)}) OR order_size THEN 'warning'
              ELSE 'passed' END AS status
  FROM held
)"""


def _select(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _text(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


_DIM_TEXT = f"business_sk, attr_hash, {_text('valid_from', 'valid_to')}, is_current"
_REG_DIM_COLUMNS = (
    "license_nbr, business_name, business_name2, address_full, license_status, "
    f"license_category, {_text('license_creation_date')}, {_DIM_TEXT}"
)


def _landed(column: str) -> str:
    return f"coalesce({column}, '') AS {column}"


def _null_columns(*columns: str) -> str:
    """How many of these expressions are NULL in some row."""
    some = (f"CAST(coalesce(bool_or(({c}) IS NULL), false) AS BIGINT)" for c in columns)
    return f"CAST({' + '.join(some)} AS BIGINT)"


def _rules(table: str, source: str, columns: dict[str, str]) -> str:
    """Nulls of each of these expressions, a row per column."""
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}_not_null' AS rule, "
        f"count(*) FILTER (WHERE null_here) AS violations "
        f"FROM (SELECT ({value}) IS NULL AS null_here FROM {source})"
        for column, value in columns.items()
    )


CUSTOMERS = (
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer"
)

ORACLE: dict[str, str] = {
    "normalize_text": _select(
        _REGISTRY,
        "SELECT source_row_number, license_nbr, business_name, license_status, "
        "license_category FROM norm",
    ),
    "address_full": _select(_REGISTRY, "SELECT source_row_number, address_full FROM norm"),
    "safe_date": _select(
        _REGISTRY, f"SELECT source_row_number, {_text('license_creation_date')} FROM norm"
    ),
    "attr_hash": _select(_REGISTRY, "SELECT source_row_number, attr_hash FROM hashed"),
    "accept_rows": _select(
        _REGISTRY,
        f"SELECT source_row_number, license_nbr, {_text('load_date')} FROM raw "
        f"WHERE NOT {_BLANK}",
    ),
    "reject_rows": _select(
        _REGISTRY,
        "SELECT source_row_number, 'missing_license_nbr' AS reject_reason, "
        f"{_text('load_date')} FROM raw WHERE {_BLANK}",
    ),
    "reject_counts": _select(
        _REGISTRY,
        f"SELECT {_text('load_date')}, count(*) FILTER (WHERE NOT {_BLANK}) AS row_count, "
        f"count(*) FILTER (WHERE {_BLANK}) AS rejected_count FROM raw GROUP BY raw.load_date",
    ),
    "stage_events": _select(
        _EVENTS,
        f"SELECT user_id, event_type, {_text('load_date', 'ts')}, event_id, attr_hash FROM ev",
    ),
    "stage_orders": _select(
        _ORDERS,
        "SELECT o_custkey, o_orderstatus, o_orderpriority, "
        f"{_text('load_date', 'o_orderdate')}, o_orderkey, attr_hash FROM ord",
    ),
    "stage_registry": _select(
        _REGISTRY,
        "SELECT license_nbr, business_name, business_name2, address_full, license_status, "
        f"license_category, {_text('license_creation_date', 'load_date', 'ingested_at')}, "
        "source_row_number, attr_hash FROM reg",
    ),
    "latest_snapshot": _select(
        _EVENTS,
        f"SELECT user_id, event_type, {_text('load_date', 'ts')}, event_id, attr_hash FROM ev "
        "WHERE load_date = (SELECT max(load_date) FROM ev)",
    ),
    "scd2_events": _select(_EV_DIM, f"SELECT user_id, event_type, {_DIM_TEXT} FROM dim"),
    "scd2_orders": _select(
        _OR_DIM,
        f"SELECT o_custkey, o_orderstatus, o_orderpriority, {_DIM_TEXT} FROM dim",
    ),
    "scd2_registry": _select(_REG_DIM, f"SELECT {_REG_DIM_COLUMNS} FROM dim"),
    "scd2_ranges": _select(
        _OR_DIM,
        f"SELECT o_custkey, attr_hash, {_text('load_date')}, previous_hash, "
        f"{_text('repaired_valid_to')} FROM dim_ranges",
    ),
    "scd2_incremental": _select(
        _EV_DIM, f"SELECT user_id, event_type, {_DIM_TEXT} FROM dim"
    ),
    "snapshot_merge": _select(
        f"""{_EVENTS},
merged AS (
  SELECT *, load_date + INTERVAL 6 HOUR AS run_ts,
         lag(attr_hash) OVER (PARTITION BY user_id ORDER BY load_date) AS previous_hash
  FROM ev
),
opened AS (
  SELECT *, lead(run_ts) OVER (PARTITION BY user_id ORDER BY load_date) AS next_ts
  FROM merged WHERE previous_hash IS NULL OR attr_hash <> previous_hash
)""",
        f"SELECT user_id, event_type, {_text('load_date')}, attr_hash, "
        "md5(CAST(user_id AS VARCHAR) || '|' || CAST(run_ts AS VARCHAR)) AS dbt_scd_id, "
        "CAST(run_ts AS VARCHAR) AS dbt_updated_at, CAST(run_ts AS VARCHAR) AS dbt_valid_from, "
        "CAST(next_ts AS VARCHAR) AS dbt_valid_to FROM opened",
    ),
    "repair_keys": _select(
        f"{_ORDERS}, newest AS (SELECT o_custkey, max(load_date) AS max_load_date FROM ord "
        "GROUP BY 1)",
        "SELECT DISTINCT o_custkey, CAST(load_date AS VARCHAR) AS late_arriving_load_date, "
        f"{_text('max_load_date')} FROM ord JOIN newest USING (o_custkey) "
        "WHERE load_date < max_load_date",
    ),
    "as_of_filter": _select(
        _EV_DIM,
        f"SELECT user_id, event_type, {_DIM_TEXT} FROM dim WHERE valid_from <= DATE '2024-01-15' "
        "AND (valid_to IS NULL OR valid_to > DATE '2024-01-15')",
    ),
    "as_of_join": _select(
        _EV_DIM,
        "SELECT e.event_id, e.user_id, d.event_type AS state, "
        "CAST(d.valid_from AS VARCHAR) AS valid_from FROM events e LEFT JOIN dim d "
        "ON e.user_id = d.user_id AND d.valid_from <= CAST(e.ts AS DATE) "
        "AND (d.valid_to IS NULL OR d.valid_to > CAST(e.ts AS DATE))",
    ),
    "address_changes": _select(
        _REG_DIM,
        "SELECT license_nbr, business_name, prev_address AS old_address, "
        "address_full AS new_address, CAST(valid_from AS VARCHAR) AS changed_on "
        "FROM (SELECT *, lag(address_full) OVER (PARTITION BY license_nbr ORDER BY valid_from) "
        "AS prev_address FROM dim) "
        "WHERE prev_address IS NOT NULL AND address_full <> prev_address",
    ),
    "status_history": _select(
        _REG_DIM,
        "SELECT license_nbr, business_name, license_status, "
        "CAST(valid_from AS VARCHAR) AS effective_from, "
        "CAST(valid_to AS VARCHAR) AS effective_to, is_current FROM dim "
        "ORDER BY license_nbr, valid_from",
    ),
    "attribute_changes": _select(
        _EV_DIM,
        "SELECT user_id, prev AS old_value, event_type AS new_value, "
        "CAST(valid_from AS VARCHAR) AS changed_on "
        "FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY valid_from) "
        "AS prev FROM dim) WHERE prev IS NOT NULL AND event_type <> prev",
    ),
    "quality_summary": _select(
        _EV_DIM,
        "SELECT (SELECT CAST(max(load_date) AS VARCHAR) FROM ev_rows) AS snapshot_date, "
        "(SELECT count(*) FROM ev_rows WHERE load_date = (SELECT max(load_date) FROM ev_rows)) "
        "AS raw_rows_ingested, (SELECT count(*) FROM dim) AS total_versions, "
        "(SELECT count(*) FROM dim WHERE is_current) AS current_rows, "
        "(SELECT count(DISTINCT user_id) FROM dim WHERE is_current) "
        "AS unique_current_businesses",
    ),
    "run_summary": _select(
        _REG_DIM,
        "SELECT (SELECT CAST(max(load_date) AS VARCHAR) FROM raw "
        f"WHERE NOT {_BLANK}) AS snapshot_date, "
        f"(SELECT count(*) FROM raw WHERE NOT {_BLANK} AND load_date = "
        f"(SELECT max(load_date) FROM raw WHERE NOT {_BLANK})) AS raw_rows_ingested, "
        "(SELECT count(*) FROM dim) AS total_versions, "
        "(SELECT count(*) FROM dim WHERE is_current) AS current_rows, "
        "(SELECT count(DISTINCT license_nbr) FROM dim WHERE is_current) "
        "AS unique_current_businesses, "
        "(SELECT count(*) FROM dim WHERE is_current) AS current_row_check",
    ),
    "dq_not_null": _select(
        _REGISTRY,
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM raw"
            for c in [*_CONTRACT, "load_date", "ingested_at"]
        )
        + ") WHERE null_rows > 0",
    ),
    "dq_unique": _select(
        _EV_DIM,
        "SELECT business_sk, count(*) AS occurrences "
        "FROM (SELECT * FROM dim UNION ALL SELECT * FROM dim) "
        "GROUP BY 1 HAVING count(*) > 1",
    ),
    "dq_one_current": _select(
        _COLLIDED,
        "SELECT o_custkey, count(*) AS current_count FROM collided WHERE is_current "
        "GROUP BY 1 HAVING count(*) > 1",
    ),
    "dq_overlaps": _select(
        _COLLIDED,
        "SELECT a.o_custkey, a.business_sk AS version_a, b.business_sk AS version_b, "
        "CAST(a.valid_from AS VARCHAR) AS a_from, CAST(a.valid_to AS VARCHAR) AS a_to, "
        "CAST(b.valid_from AS VARCHAR) AS b_from, CAST(b.valid_to AS VARCHAR) AS b_to "
        "FROM collided a JOIN collided b ON a.o_custkey = b.o_custkey "
        "AND a.business_sk <> b.business_sk AND a.valid_from < b.ends "
        "AND a.ends > b.valid_from",
    ),
    "dq_overlaps_linear": _select(
        f"""{_COLLIDED},
starts AS (
  SELECT o_custkey, valid_from, count(*) AS versions, max(ends) AS ends
  FROM collided GROUP BY 1, 2
),
reach AS (
  SELECT *, max(ends) OVER (PARTITION BY o_custkey ORDER BY valid_from
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_end
  FROM starts
)""",
        f"SELECT o_custkey, {_text('valid_from')}, versions, {_text('previous_end')} FROM reach "
        "WHERE versions > 1 OR previous_end > reach.valid_from",
    ),
    "dq_suite": _select(
        f"""{_REG_DIM},
broken AS (
  SELECT business_sk, license_nbr, attr_hash, valid_from, is_current FROM dim
  UNION ALL
  SELECT business_sk, license_nbr, NULL, valid_from, is_current FROM dim WHERE is_current
)""",
        "SELECT 'raw_not_null' AS check_name, "
        + _null_columns("load_date", "if(license_category = '1-urgent', NULL, ingested_at)")
        + f" AS violations FROM raw WHERE NOT {_BLANK} "
        "UNION ALL SELECT 'staged_not_null', "
        + _null_columns(
            "license_nbr", "load_date", "if(license_category = '2-HIGH', NULL, attr_hash)"
        )
        + " FROM reg UNION ALL SELECT 'dim_not_null', "
        + _null_columns("business_sk", "license_nbr", "attr_hash", "valid_from", "is_current")
        + " FROM broken "
        "UNION ALL SELECT 'dim_unique', count(*) FROM (SELECT business_sk FROM broken GROUP BY 1 "
        "HAVING count(*) > 1) "
        "UNION ALL SELECT 'dim_one_current', count(*) FROM (SELECT license_nbr FROM broken "
        "WHERE is_current GROUP BY 1 HAVING count(*) > 1) "
        "UNION ALL SELECT 'dim_no_overlaps', count(*) FROM (SELECT license_nbr, valid_from "
        "FROM broken GROUP BY ALL HAVING count(*) > 1)",
    ),
    "freshness": """
SELECT CAST(max_loaded_at AS VARCHAR) AS max_loaded_at, age_seconds,
       CASE WHEN max_loaded_at IS NULL OR age_seconds > 172800 THEN 'error'
            WHEN age_seconds > 86400 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max(ts) AS max_loaded_at,
             datesub('second', max(ts), TIMESTAMP '2024-02-01 00:00:00') AS age_seconds
      FROM events)""",
    "replace_partition": _select(
        _EVENTS,
        f"SELECT event_id, user_id, event_type, {_text('load_date')} FROM ev_rows "
        "WHERE load_date NOT IN (DATE '2024-01-12', DATE '2024-01-18') OR event_type <> 'error'",
    ),
    "replace_emptied": _select(
        _EVENTS,
        f"SELECT event_id, user_id, event_type, {_text('load_date')} FROM ev_rows "
        "WHERE load_date <> DATE '2024-01-18'",
    ),
    "keyed_upsert": _select(
        _EVENTS,
        f"SELECT user_id, event_type, {_text('load_date')} FROM ev JOIN (SELECT user_id, "
        "max(load_date) AS load_date FROM ev GROUP BY 1) USING (user_id, load_date)",
    ),
    "append_log": _select(
        _PROFILES, "SELECT status, 2 * count(*) AS events FROM profiles GROUP BY 1"
    ),
    "schema_profile": _select(
        _PROFILES,
        f"SELECT {_text('load_date')}, missing_columns, added_columns, status FROM profiles",
    ),
    "drift_latest": _select(
        _PROFILES,
        "SELECT CAST(CAST(date_trunc('month', load_date) AS DATE) AS VARCHAR) AS load_date, "
        "missing_columns, added_columns, status FROM (SELECT *, row_number() OVER "
        "(PARTITION BY date_trunc('month', load_date) ORDER BY load_date DESC) AS rn "
        "FROM profiles) WHERE rn = 1",
    ),
    **dict.fromkeys(
        ("csv_round_trip", "land_twice"),
        _select(
            _REGISTRY,
            f"SELECT {', '.join(map(_landed, _CONTRACT))}, {_text('load_date')} FROM raw",
        ),
    ),
    "csv_records": _select(
        _REGISTRY,
        "SELECT "
        + ", ".join(
            "coalesce(business_name2, '') || chr(10) || '\"' || business_name || '\",' || chr(10) "
            "|| chr(10) AS business_name2"
            if c == "business_name2"
            else _landed(c)
            for c in _CONTRACT
        )
        + f", {_text('load_date')} FROM raw",
    ),
    "source_row_numbers": _select(
        _REGISTRY,
        f"SELECT {_text('load_date')}, count(*) AS records, count(*) AS distinct_numbers, "
        "CAST(2 AS BIGINT) AS first_number, 1 + count(*) AS last_number "
        "FROM raw GROUP BY raw.load_date",
    ),
    "load_raw": _select(
        _REGISTRY,
        f"SELECT {', '.join(map(_landed, _CONTRACT))}, '2024-02-01 06:00:00' AS ingested_at, "
        f"{_text('load_date')} FROM raw WHERE NOT {_BLANK}",
    ),
    "load_dlq": _select(
        _REGISTRY,
        f"SELECT {_text('load_date')}, 'missing_license_nbr' AS reject_reason, business_name, "
        f"license_category, '2024-02-01 06:00:00' AS rejected_at FROM raw WHERE {_BLANK}",
    ),
    "load_audit": _select(
        _REGISTRY,
        f"SELECT {_text('load_date')}, count(*) FILTER (WHERE NOT {_BLANK}) AS row_count, "
        f"count(*) FILTER (WHERE {_BLANK}) AS rejected_count, 'loaded' AS status, "
        "'2024-02-01 06:00:00' AS loaded_at FROM raw GROUP BY raw.load_date "
        "ORDER BY load_date DESC",
    ),
    "reload_idempotent": _select(
        _REGISTRY,
        f"SELECT {_text('load_date')}, '2024-02-01 07:00:00' AS ingested_at, "
        f"count(*) AS row_count FROM raw WHERE NOT {_BLANK} GROUP BY raw.load_date",
    ),
    **dict.fromkeys(
        ("backfill", "load_then_build", "load_broken_off", "catch_up"),
        _select(
            f"{_FROM_CSV}, {_dim('reg', 'license_nbr', _REG_ATTRIBUTES, 'dim')}",
            f"SELECT {_REG_DIM_COLUMNS} FROM dim",
        ),
    ),
    "file_checksums": "SELECT c_nationkey, sha256(string_agg(c_custkey || '|' || c_name || "
    "chr(10), '' ORDER BY c_custkey)) AS checksum FROM customer GROUP BY 1",
    "latest_file": "SELECT strftime(max(date_trunc('month', o_orderdate)), '%Y-%m-%d') AS month "
    "FROM orders",
    "constraints": _select(
        f"""{_REGISTRY},
parts AS (
  SELECT load_date, license_status, count(*) FILTER (WHERE {_BLANK}) AS rejected
  FROM raw GROUP BY 1, 2
)""",
        _rules(
            "raw",
            "raw",
            {
                "ingested_at": "if(license_category = '1-urgent', NULL, ingested_at)",
                "source_row_number": "source_row_number",
                "load_date": "load_date",
            },
        )
        + " UNION ALL "
        + _rules(
            "dlq",
            f"raw WHERE {_BLANK}",
            {
                "source_file_uri": "'feed'",
                "source_row_number": "if(license_status = 'P  p', source_row_number, NULL)",
                "reject_reason": "license_nbr",
                "raw_payload": "business_name2",
                "rejected_at": "ingested_at",
                "load_date": "load_date",
            },
        )
        + " UNION ALL "
        + _rules(
            "audit",
            "parts",
            {
                **dict.fromkeys(
                    ("source_file_uri", "row_count", "checksum", "status", "loaded_at", "updated_at"),
                    "1",
                ),
                "rejected_count": "nullif(rejected, 0)",
                "load_date": "load_date",
            },
        )
        + " UNION ALL SELECT 'audit', 'key', count(*) - count(DISTINCT load_date) FROM parts",
    ),
    "paged_source": CUSTOMERS,
    "paged_extract": CUSTOMERS,
    "landed_pages": CUSTOMERS,
}
