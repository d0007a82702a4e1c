"""The registered queries as SQL for DuckDB."""

from __future__ import annotations

LOAD_TS = 1_704_326_400_000_000


def _standard(family: str, branches: list[tuple[str, str, str, str, str]]) -> str:
    """Union of (table, row_key, name, value, ts) branches as standard cells."""
    keyspace, cf = family.split(".")
    return " UNION ALL ".join(
        f"SELECT '{keyspace}' AS keyspace, '{cf}' AS cf, CAST({key} AS VARCHAR) AS row_key,"
        f" CAST({name} AS VARCHAR) AS name, CAST({value} AS VARCHAR) AS value,"
        f" CAST({ts} AS BIGINT) AS ts FROM {table}"
        for table, key, name, value, ts in branches
    )


def _super(family: str, branches: list[tuple[str, str, str, str, str]]) -> str:
    """Union of (table, row_key, super, name, value) branches as super cells."""
    keyspace, cf = family.split(".")
    return " UNION ALL ".join(
        f"SELECT '{keyspace}' AS keyspace, '{cf}' AS cf, CAST({key} AS VARCHAR) AS row_key,"
        f" CAST({super_} AS VARCHAR) AS super, CAST({name} AS VARCHAR) AS name,"
        f" CAST({value} AS VARCHAR) AS value, CAST({LOAD_TS} AS BIGINT) AS ts FROM {table}"
        for table, key, super_, name, value in branches
    )


def _newest(cells: str) -> str:
    return (
        "SELECT keyspace, cf, row_key, name, value, ts FROM (SELECT *, row_number() OVER"
        " (PARTITION BY keyspace, cf, row_key, name ORDER BY ts DESC, value DESC) AS n"
        f" FROM ({cells})) WHERE n = 1"
    )


_LT = str(LOAD_TS)
_CUSTOMERS = _standard(
    "shop.customers",
    [
        ("customer", "c_custkey", "'name'", "c_name", _LT),
        ("customer", "c_custkey", "'segment'", "c_mktsegment", _LT),
    ],
)
_BY_TYPE = _standard(
    "web.events", [("events", "user_id", "event_type", "event_id", "epoch_us(ts)")]
)
_NEWEST_BY_TYPE = _newest(_BY_TYPE)
_BAD_TS = "CASE WHEN event_type = 'error' THEN 'x' ELSE CAST(epoch_us(ts) AS VARCHAR) END"
_EDGES = _standard(
    "shop.graph",
    [
        ("lineitem", "l_orderkey", "l_partkey", "'0'", _LT),
        ("lineitem", "l_orderkey", "l_suppkey", "'0'", _LT),
    ],
)
_LONG_EDGES = (
    "SELECT l_orderkey, l_partkey AS name FROM lineitem WHERE l_linenumber <> 5"
    " UNION SELECT l_orderkey, -l_suppkey FROM lineitem"
)
_SUPER_EVENTS = _super(
    "web.events_super", [("events", "user_id", "event_type", "event_id", "epoch_us(ts)")]
)
_LONG_ORDERS = _super(
    "shop.orders_long",
    [
        ("orders", "o_custkey", "o_orderkey", "1", "o_orderstatus"),
        ("orders", "o_custkey", "o_orderkey", "2", "o_orderpriority"),
    ],
)
_JSON_ENTRIES = (
    "'{' || string_agg('\"' || name || '\":\"' || value || '\"', ',' ORDER BY name) || '}'"
)
_SPACED_ENTRIES = _JSON_ENTRIES.replace("','", "', '") + " || ' '"
_EVENT_FIELDS = _newest(
    _standard(
        "web.events",
        [
            ("events", "user_id", name, value, "epoch_us(ts)")
            for name, value in (
                ("'type'", "event_type"), ("'event_id'", "event_id"), ("'at'", "epoch_us(ts)"),
            )
        ],
    )
)
_SUPER_LINE = (
    "row_key || chr(9) || super || chr(9) || name || chr(9) || value AS value"
)


def oracle_sql() -> dict[str, str]:
    return {
        "load_dump_table": f"""
            WITH cells AS ({_newest(_standard("web.events", [
                ("events", "user_id", "'type'", "event_type", "epoch_us(ts)"),
                ("events", "user_id", "'event_id'", "event_id", "epoch_us(ts)"),
            ]))})
            SELECT row_key || chr(9) || string_agg(value || chr(9), '' ORDER BY name) AS value
            FROM cells GROUP BY row_key""",
        "load_table": _CUSTOMERS,
        "load_table_ts": _standard(
            "web.events",
            [
                ("events", "event_id", "'type'", "event_type", "epoch_us(ts)"),
                ("events", "event_id", "'at'", "epoch_us(ts)", "epoch_us(ts)"),
            ],
        ),
        "load_table_bad_ts": _standard(
            "web.events",
            [
                (
                    "events",
                    "event_id",
                    name,
                    value,
                    f"CASE WHEN event_type = 'error' THEN {_LT} ELSE epoch_us(ts) END",
                )
                for name, value in (("'type'", "event_type"), ("'at'", _BAD_TS))
            ],
        ),
        "load_table_reject_ts": """
            SELECT CAST(event_id AS VARCHAR) AS row_key, 'type' AS name, event_type AS value,
                   CAST(epoch_us(ts) AS BIGINT) AS ts, '' AS reason
            FROM events WHERE event_type <> 'error'
            UNION ALL
            SELECT CAST(event_id AS VARCHAR), 'at', CAST(epoch_us(ts) AS VARCHAR),
                   CAST(epoch_us(ts) AS BIGINT), ''
            FROM events WHERE event_type <> 'error'
            UNION ALL
            SELECT CAST(event_id AS VARCHAR), '', event_id || chr(9) || event_type || chr(9) || 'x',
                   CAST(0 AS BIGINT), 'bad_timestamp'
            FROM events WHERE event_type = 'error'""",
        "load_table_wide": _standard(
            "shop.customers",
            [
                ("customer WHERE c_nationkey <> 3", "c_custkey", name, value, _LT)
                for name, value in (
                    ("'key'", "c_custkey"),
                    ("'nation'", "c_nationkey"),
                    ("'segment'", "c_mktsegment"),
                )
            ],
        ),
        "load_columns": _EDGES,
        "load_columns_long": f"""
            SELECT 'shop' AS keyspace, 'graph_long' AS cf, CAST(l_orderkey AS VARCHAR) AS row_key,
                   CAST(name AS VARCHAR) AS name, '1' AS value, CAST({_LT} AS BIGINT) AS ts
            FROM ({_LONG_EDGES})""",
        "load_map": _standard(
            "web.events",
            [
                ("events", "event_id", name, value, _LT)
                for name, value in (
                    ("'type'", "event_type"),
                    ("'user'", "user_id"),
                    ("'ok'", "'true'"),
                    ("'rate'", "'1.5'"),
                )
            ],
        ),
        "load_map_props": _standard(
            "web.events",
            [("events", "event_id", "'k'", "json_extract_string(props, '$.k')", _LT)],
        ),
        "load_map_long": _standard(
            "web.events_long", [("events", "user_id", "event_id", "event_type", _LT)]
        ),
        "load_super_map": _SUPER_EVENTS,
        "load_super_map_long": _LONG_ORDERS,
        "load_super_pairs": _super(
            "shop.orders",
            [
                ("orders", "o_custkey", "o_orderkey", "'status'", "o_orderstatus"),
                ("orders", "o_custkey", "o_orderkey", "'priority'", "o_orderpriority"),
            ],
        ),
        "load_super_pairs_long": _super(
            "shop.orders_long",
            [
                ("orders", "o_custkey", "o_orderkey", "1", "o_orderstatus"),
                ("orders WHERE o_orderstatus <> 'O'", "o_custkey", "o_orderkey", "7", "'m'"),
                ("orders WHERE o_orderstatus <> 'O'", "o_custkey", "o_orderkey", "2", "o_orderpriority"),
            ],
        ),
        "load_key_value": _newest(
            _standard("web.events", [("events", "user_id", "event_type", "event_id", _LT)])
        ),
        "load_counts": """
            SELECT count(*) AS loaded_rows,
                   2 * count(*) - count(*) FILTER (l_linenumber = 5) AS loaded_columns,
                   count(*) FILTER (l_linenumber = 5) AS bad_columns
            FROM lineitem""",
        "rejects": """
            SELECT key AS row_key,
                   CASE WHEN status = 'O' AND key = '' THEN 'missing_key'
                        WHEN status = 'O' THEN 'missing_json'
                        WHEN key = '' THEN 'empty_key'
                        WHEN status = 'F' THEN 'bad_json'
                        ELSE 'null_value' END AS reason,
                   line
            FROM (SELECT *, key || chr(9) || text AS line
                  FROM (SELECT CASE WHEN o_orderpriority = '2-HIGH' THEN ''
                                    ELSE CAST(o_orderkey AS VARCHAR) END AS key,
                               o_orderstatus AS status,
                               CASE WHEN o_orderstatus = 'O' THEN ''
                                    WHEN o_orderstatus = 'F' THEN '{"a":'
                                    ELSE '{"a":"1","b":null}' END AS text
                        FROM orders))""",
        "reconcile": _NEWEST_BY_TYPE,
        "merge_cells": _newest(
            _standard(
                "web.events",
                [
                    ("events", "user_id", "'label'", "event_type", "epoch_us(ts)"),
                    ("events", "user_id", "'at'", "epoch_us(ts)", "epoch_us(ts)"),
                    ("customer", "c_custkey", "'label'", "c_mktsegment", _LT),
                    ("customer", "c_custkey", "'who'", "c_name", _LT),
                ],
            )
        ),
        "dump_table": f"""
            SELECT row_key || chr(9) || string_agg(value || chr(9), '' ORDER BY name) AS value
            FROM ({_NEWEST_BY_TYPE}) WHERE name IN ('view', 'click', 'absent', 'purchase')
            GROUP BY row_key""",
        "dump_column_names": f"""
            SELECT row_key || chr(9) || string_agg(name || chr(9), '' ORDER BY name) AS value
            FROM (SELECT DISTINCT row_key, name FROM ({_EDGES})) GROUP BY row_key""",
        "dump_column_names_long": f"""
            SELECT l_orderkey || chr(9) || string_agg(name || chr(9), '' ORDER BY name) AS value
            FROM ({_LONG_EDGES}) GROUP BY l_orderkey""",
        "dump_column_names_super": """
            SELECT user_id || chr(9) || string_agg(event_type || chr(9), '' ORDER BY event_type) AS value
            FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id""",
        "dump_super_map": f"SELECT {_SUPER_LINE} FROM ({_SUPER_EVENTS})",
        "dump_super_map_long": f"SELECT {_SUPER_LINE} FROM ({_LONG_ORDERS})",
        "dump_super_map_first": f"""
            SELECT {_SUPER_LINE}
            FROM (SELECT *, dense_rank() OVER (PARTITION BY row_key ORDER BY CAST(super AS BIGINT)) AS n
                  FROM ({_LONG_ORDERS})) WHERE n <= 3""",
        "dump_map": f"""
            SELECT row_key || chr(9) || {_JSON_ENTRIES} AS value
            FROM ({_NEWEST_BY_TYPE}) GROUP BY row_key""",
        "map_prepare": f"""
            SELECT row_key, {_JSON_ENTRIES} AS json
            FROM (SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS name,
                         max(CAST(event_id AS VARCHAR)) AS value
                  FROM events GROUP BY ALL) GROUP BY row_key""",
        "map_prepare_ordered": f"""
            SELECT row_key, {_JSON_ENTRIES} AS json
            FROM ({_NEWEST_BY_TYPE}) GROUP BY row_key""",
        "super_map_prepare": f"""
            SELECT row_key, '{{' || string_agg('"' || super || '":' || inner_json, ',' ORDER BY super) || '}}' AS json
            FROM (SELECT row_key, super, {_JSON_ENTRIES} AS inner_json
                  FROM (SELECT CAST(o_custkey AS VARCHAR) AS row_key, o_orderstatus AS super,
                               o_orderpriority AS name, CAST(max(o_orderkey) AS VARCHAR) AS value
                        FROM orders GROUP BY ALL)
                  GROUP BY row_key, super)
            GROUP BY row_key""",
        "store": f"SELECT * FROM ({_NEWEST_BY_TYPE}) WHERE name IN ('click', 'view')",
        "compact": f"""
            SELECT row_key || chr(9) || {_JSON_ENTRIES} AS value
            FROM ({_NEWEST_BY_TYPE}) GROUP BY row_key""",
        "text_files": _CUSTOMERS,
        "reload_column_names": f"SELECT DISTINCT * FROM ({_EDGES})",
        "reload_map": f"""
            SELECT keyspace, cf, row_key, name, value, CAST({_LT} AS BIGINT) AS ts
            FROM ({_NEWEST_BY_TYPE})""",
        "reload_super_map": f"""
            SELECT * REPLACE (CASE WHEN super = 'click' THEN '' ELSE value END AS value)
            FROM ({_SUPER_EVENTS})""",
        "overwrite_lines": """
            SELECT c_custkey || chr(9) || c_name || chr(9) || c_mktsegment AS value
            FROM customer""",
        "load_table_now": f"SELECT row_key, name, value, true AS recent FROM ({_CUSTOMERS})",
        "bad_bytes": _standard(
            "shop.customers",
            [("customer", "c_custkey", "'segment'", "chr(65533) || c_mktsegment", _LT)],
        ),
        "record_rejects": """
            SELECT CASE WHEN event_type = 'click' THEN 'bad_field_count' ELSE '' END AS reason,
                   user_id || chr(9) || event_type || chr(9) || epoch_us(ts)
                   || CASE WHEN event_type = 'click' THEN ''
                           WHEN event_type = 'view' THEN chr(9)
                           ELSE chr(9) || event_id END AS line
            FROM events""",
        "dump_table_many_names": f"""
            SELECT row_key || chr(9) || string_agg(value || chr(9), '' ORDER BY name) AS value
            FROM ({_NEWEST_BY_TYPE}) WHERE name IN ('view', 'click', 'purchase')
            GROUP BY row_key""",
        "base_merge": _EVENT_FIELDS,
        "base_with_deltas": f"""
            SELECT row_key || chr(9) || string_agg(value || chr(9), '' ORDER BY name) AS value
            FROM ({_EVENT_FIELDS}) WHERE name <> 'at' GROUP BY row_key""",
        "base_dump_map": f"""
            SELECT row_key || chr(9) || {_JSON_ENTRIES} AS value
            FROM ({_NEWEST_BY_TYPE}) GROUP BY row_key""",
        "base_column_names": f"""
            SELECT row_key || chr(9) || string_agg(name || chr(9), '' ORDER BY name) AS value
            FROM (SELECT DISTINCT row_key, name FROM ({_EDGES})) GROUP BY row_key""",
        "base_super_map_first": f"""
            SELECT {_SUPER_LINE}
            FROM (SELECT *, dense_rank() OVER (PARTITION BY row_key ORDER BY CAST(super AS BIGINT)) AS n
                  FROM ({_LONG_ORDERS})) WHERE n <= 3""",
        "batch_records": f"""
            SELECT row_key, super, name, value, '' AS reason FROM ({_LONG_ORDERS})
            UNION ALL
            SELECT CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), 'q', '', 'bad_long_name'
            FROM orders""",
        "batch_counts": """
            SELECT count(*) AS loaded_rows,
                   2 * count(*) - count(*) FILTER (l_linenumber = 5) AS loaded_columns,
                   count(*) FILTER (l_linenumber = 5) AS bad_columns
            FROM lineitem""",
        "compact_by_name": f"SELECT DISTINCT * FROM ({_EDGES}) WHERE name IN ('1', '7', '10')",
        "name_pieces": f"""
            SELECT row_key || chr(9) || string_agg(name || chr(9), '' ORDER BY name) AS value
            FROM (SELECT DISTINCT row_key, name FROM ({_EDGES})) GROUP BY row_key""",
        "map_pieces": f"""
            SELECT row_key || chr(9) || {_SPACED_ENTRIES} AS value
            FROM ({_NEWEST_BY_TYPE}) GROUP BY row_key""",
        "prepared_pieces": f"""
            SELECT row_key || chr(9) || {_SPACED_ENTRIES} AS value
            FROM ({_NEWEST_BY_TYPE}) GROUP BY row_key""",
        "prepared_super_pieces": _super(
            "shop.orders",
            [
                (
                    "(SELECT o_custkey, o_orderstatus, o_orderpriority, max(o_orderkey) AS o"
                    " FROM orders GROUP BY ALL)",
                    "o_custkey", "o_orderstatus", "o_orderpriority", "o",
                ),
            ],
        ),
        "load_super_map_numbers": _super(
            "shop.orders",
            [
                ("lineitem", "l_orderkey || '-' || l_linenumber", super_, name, value)
                for super_, name, value in (
                    ("'s'", "'price'", "printf('%.2f', l_extendedprice)"),
                    ("'s'", "'power'", "'-1e3'"),
                    ("'s'", "'zero'", "'0.50'"),
                    ("'s'", "'key'", "l_partkey"),
                    ("'s'", "'text'", "'a\":7,\\'"),
                    ("'t'", "'flag'", "'true'"),
                )
            ],
        ),
        "append_stream": _EVENT_FIELDS,
        "long_name_bytes": """
            SELECT -l_partkey AS name,
                   CASE WHEN l_partkey = 0 THEN '0000000000000000'
                        ELSE to_hex(CAST(18446744073709551616 - l_partkey AS HUGEINT)) END AS bytes,
                   -l_partkey AS back
            FROM lineitem""",
    }
