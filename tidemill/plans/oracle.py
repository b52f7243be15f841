"""DuckDB SQL for the registered queries, written from the tables' columns and not from the Spark code's JSON."""

from __future__ import annotations

from tidemill.operators.stats import POISSON_CUTS

# Building blocks -----------------------------------------------------------------------------------------------

_EVENTS = """
ev AS (SELECT e.event_id, e.user_id, e.event_type, e.value, e.ts, epoch_us(e.ts) // 1000 AS ms, p.p_name
       FROM events e JOIN part p ON e.event_id % (SELECT count(*) FROM part) = p.p_partkey)"""

_SEARCH = _EVENTS + """,
page AS (SELECT *, CASE WHEN event_id % 10 <> 0 THEN p_name END AS item,
                CASE WHEN event_type = 'error' THEN 'sku_id' ELSE 'keyword' END AS item_type
         FROM ev WHERE event_type <> 'signup'),
search AS (SELECT item AS fullword, ms FROM page WHERE item_type = 'keyword' AND item IS NOT NULL)"""

_WORDS = _SEARCH + r""",
words AS (SELECT unnest(regexp_extract_all(lower(fullword), '[\p{L}\p{N}]+')) AS keyword, ms FROM search)"""

_WINDOWS = _WORDS + """,
windows AS (SELECT time_bucket(INTERVAL 10 MINUTES, make_timestamp(ms * 1000)) AS w, keyword, count(*) AS keyword_count
            FROM words GROUP BY ALL)"""

_WINDOW_COLUMNS = """
SELECT strftime(w + INTERVAL 8 HOURS, '%Y-%m-%d %H:%M:%S') AS stt,
       strftime(w + INTERVAL 490 MINUTES, '%Y-%m-%d %H:%M:%S') AS edt,
       strftime(w + INTERVAL 8 HOURS, '%Y-%m-%d') AS cur_date, keyword, keyword_count FROM windows"""

_LOGS = _EVENTS + """,
good AS (SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS mid, ms AS ts, event_type, p_name,
                CASE WHEN event_type IN ('signup', 'view') THEN '1' WHEN event_type <> 'click' THEN '0' END AS is_new
         FROM ev WHERE event_id % 97 <> 0)"""

_DAY = "CAST(make_timestamp(ts * 1000) + INTERVAL 8 HOURS AS DATE)"
_BEFORE = "(PARTITION BY mid ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

# The remembered day before each record, by windows over all records of a device.
_WRITTEN = _LOGS + f""",
s1 AS (SELECT *, {_DAY} AS d, coalesce(is_new = '1', false) AS n FROM good),
s2 AS (SELECT *, coalesce(max(CAST(n AS INT)) OVER {_BEFORE}, 0) AS seen FROM s1),
s3 AS (SELECT *, CASE WHEN NOT n AND seen = 1 THEN d - 1 END AS moved, CASE WHEN n THEN d END AS claimed FROM s2),
s4 AS (SELECT *, coalesce(last(moved IGNORE NULLS) OVER {_BEFORE}, first(claimed IGNORE NULLS) OVER {_BEFORE}) AS s FROM s3),
fixed AS (SELECT seq, mid, ts, event_type, CASE WHEN n AND s IS NOT NULL AND s <> d THEN '0' ELSE is_new END AS is_new FROM s4)"""

_DOCUMENTED = _LOGS + f""",
s1 AS (SELECT *, {_DAY} AS d, coalesce(is_new = '1', false) AS n FROM good),
s4 AS (SELECT *, first(CASE WHEN n THEN d ELSE d - 1 END) OVER {_BEFORE} AS s FROM s1),
fixed AS (SELECT seq, mid, ts, CASE WHEN n AND s IS NOT NULL AND s <> d THEN '0' ELSE is_new END AS is_new FROM s4)"""

_SPLIT_TAGS = """
SELECT 'err' AS tag, is_new, seq FROM {t} WHERE event_type = 'error'
UNION ALL SELECT 'start', is_new, seq FROM {t} WHERE event_type = 'signup'
UNION ALL SELECT 'page', is_new, seq FROM {t} WHERE event_type <> 'signup'
UNION ALL SELECT 'display', is_new, seq FROM {t}, range(seq % 4) WHERE event_type <> 'signup'
UNION ALL SELECT 'action', is_new, seq FROM {t}, range(seq % 3) WHERE event_type <> 'signup'"""

_SPLIT_ROWS = """
SELECT 'err' AS tag, seq, mid, is_new, p_name AS item, NULL AS entry, CAST(NULL AS INT) AS pos, NULL AS shown,
    CAST(NULL AS INT) AS action_no, ts FROM {t} WHERE event_type = 'error'
UNION ALL SELECT 'start', seq, mid, is_new, NULL, 'icon', NULL, NULL, NULL, ts FROM {t} WHERE event_type = 'signup'
UNION ALL SELECT 'page', seq, mid, is_new, p_name, NULL, NULL, NULL, NULL, ts FROM {t} WHERE event_type <> 'signup'
UNION ALL SELECT 'display', seq, mid, is_new, p_name, NULL, CAST(r.range AS INT), p_name, NULL, ts FROM {t}, range(seq % 4) r
    WHERE event_type <> 'signup'
UNION ALL SELECT 'action', seq, mid, is_new, p_name, NULL, NULL, NULL, CAST(r.range AS INT), NULL FROM {t}, range(seq % 3) r
    WHERE event_type <> 'signup'"""

_SPLIT_COUNTS = f"""WITH {_WRITTEN}, tags AS ({_SPLIT_TAGS.format(t='fixed')})
SELECT tag, is_new, count(*) AS n, CAST(sum(seq) AS BIGINT) AS seqs FROM tags GROUP BY ALL"""

_SPLIT_OUTPUTS = f"""{_LOGS}, tags AS ({_SPLIT_TAGS.format(t='good')}
UNION ALL SELECT 'dirty', NULL, event_id FROM ev WHERE event_id % 97 = 0)"""

_CHANGES = """
changes AS (SELECT CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
                   epoch_us(ts) // 1000 AS ts_ms, event_id AS position, user_id, event_type, value,
                   CASE event_type WHEN 'signup' THEN 'user_info' WHEN 'purchase' THEN 'order_info' ELSE 'other' END AS source_table
            FROM events)"""

_LATEST = f"""WITH {_CHANGES},
last AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, position DESC) = 1)
SELECT user_id, event_type, value, ts_ms FROM last WHERE op <> 'd'"""

_ROUTED = _CHANGES + """,
routed AS (SELECT *, CASE source_table WHEN 'user_info' THEN 'dim_user' ELSE 'dwd_order' END AS sink_table,
                  CAST(user_id AS VARCHAR) AS row_key FROM changes WHERE source_table <> 'other')"""

_CONFIG = """
config AS (SELECT event_type AS source_table, 'dim_' || event_type AS sink_table,
                  'user_id,' || CASE WHEN value >= 10 THEN 'value' ELSE 'event_type' END AS sink_columns,
                  'user_id' AS row_key, value < 0.5 AS removed
           FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) = 1)"""

_SALES = """
sales AS (SELECT l.*, o.o_orderpriority, o.o_orderstatus, CAST(l_returnflag = 'R' AS INT) AS response
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_POLICIES = """
policies AS (SELECT o_orderkey AS id, o_totalprice AS premium, c_acctbal AS balance,
    CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3
         WHEN '4-NOT SPECIFIED' THEN 2 WHEN '5-LOW' THEN 1 END AS priority,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2
         WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 END AS segment,
    CAST(o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AS INT) AS response
    FROM orders JOIN customer ON o_custkey = c_custkey)"""

_PREMIUMS = """
gross AS (SELECT o_custkey AS policy, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / 100 AS gross
          FROM orders GROUP BY 1),
ceded AS (SELECT o_custkey AS policy, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) * 30 / 10000 AS ceded
          FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
equity AS (SELECT c_custkey AS policy, c_acctbal AS equity FROM customer),
bound AS (SELECT coalesce(g.policy, c.policy, e.policy) AS policy, gross, ceded, equity
          FROM gross g FULL JOIN ceded c ON g.policy = c.policy
          FULL JOIN equity e ON coalesce(g.policy, c.policy) = e.policy)"""

_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_CATEGORIES = ["l_returnflag", "l_linestatus", "o_orderpriority"]


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _long(table: str, columns: list[str], key: str | None = None) -> str:
    keep = f"{key}, " if key else ""
    return _union(f"SELECT {keep}'{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM {table}" for c in columns)


def _bounds(table: str, columns: list[str]) -> str:
    return f"""
cells AS ({_long(table, columns)}),
quart AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                 quantile_cont(value, 0.75) AS q3 FROM cells GROUP BY 1),
bounds AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM quart)"""


def _islands(floor: str) -> str:
    return f"""WITH chars AS (
  SELECT doc_id, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS pos FROM documents),
runs AS (SELECT doc_id, c, pos - row_number() OVER (PARTITION BY doc_id, c ORDER BY pos) AS island FROM chars),
sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id, c, island),
best AS (SELECT doc_id, max(n) AS n FROM sizes GROUP BY doc_id)
SELECT d.doc_id, CAST(CASE WHEN text IS NULL THEN NULL WHEN text = '' THEN 0 WHEN n = 1 THEN {floor} ELSE n END AS INT) AS run
FROM documents d LEFT JOIN best USING (doc_id)"""


def _share(index: str, normalize: str) -> str:
    over = f"OVER (PARTITION BY {index})" if normalize == "index" else None
    zero, one = "count(*) FILTER (response = 0)", "count(*) FILTER (response = 1)"
    if over:
        return f"""WITH {_SALES} SELECT {index}, round({zero} / count(*), 6) AS "0", round({one} / count(*), 6) AS "1"
FROM sales GROUP BY {index}"""
    return f"""WITH {_SALES} SELECT {index},
round({zero} / (SELECT count(*) FROM sales WHERE response = 0), 6) AS "0",
round({one} / (SELECT count(*) FROM sales WHERE response = 1), 6) AS "1" FROM sales GROUP BY {index}"""


# Queries -------------------------------------------------------------------------------------------------------

ORACLE_SQL: dict[str, str] = {
    "kafka_json_table": f"""WITH {_CHANGES} SELECT op, ts_ms, position, source_table,
        CASE WHEN op = 'd' THEN user_id END AS before_user, CASE WHEN op <> 'd' THEN user_id END AS after_user,
        CASE WHEN op <> 'd' THEN value END AS after_value FROM changes""",
    "page_log_table": f"""WITH {_SEARCH} SELECT CAST(user_id AS VARCHAR) AS mid, item, item_type, ms AS ts, ms AS et_ms
        FROM page""",
    "change_log_source": f"""WITH {_CHANGES}
        SELECT 'r' AS op, CAST(0 AS BIGINT) AS ts_ms, 'user_info' AS source_table, c_custkey AS customer,
               CAST(NULL AS BIGINT) AS user_id FROM customer
        UNION ALL SELECT op, ts_ms, source_table, NULL, user_id FROM changes WHERE source_table = 'user_info'""",
    "csv_source": "SELECT * FROM customer",
    "dim_table_scan": """SELECT CAST(n_nationkey AS VARCHAR) AS rk, n_name AS dic_name,
        CAST(n_regionkey AS VARCHAR) AS parent_code FROM nation""",
    "kafka_sink_records": f"""WITH {_LOGS}, lines AS ({_SPLIT_ROWS.format(t='good')}
        UNION ALL SELECT 'dirty', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM ev WHERE event_id % 97 = 0)
        SELECT 'dwd_traffic_' || tag AS topic, * EXCLUDE (tag) FROM lines""",
    "log_split_rows": f"WITH {_WRITTEN}, whole AS (SELECT fixed.*, p_name FROM fixed JOIN ev ON seq = event_id) {_SPLIT_ROWS.format(t='whole')}",
    "routed_sink": f"""WITH {_ROUTED} SELECT sink_table, op, ts_ms, row_key, user_id,
        CASE sink_table WHEN 'dim_user' THEN event_type END AS event_type, CASE sink_table WHEN 'dwd_order' THEN value END AS value FROM routed""",
    "generic_sink": "SELECT concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_orderpriority) AS value FROM orders",
    "olap_json_sink": f"WITH {_WINDOWS} {_WINDOW_COLUMNS}",
    "multi_sink": f"WITH {_SPLIT_OUTPUTS} SELECT tag, count(*) AS n FROM tags GROUP BY 1",
    "dim_table_sink": _LATEST,
    "catalog_ddl": "SELECT 'dim_base_dic' AS table_name, count(*) AS n FROM nation",
    "cdc_parse": f"WITH {_CHANGES} SELECT op, ts_ms, position, user_id, event_type, value FROM changes",
    "cdc_clean": f"""WITH {_CHANGES} SELECT position, op, CASE WHEN op = 'd' THEN user_id END AS before_user,
        CASE WHEN op <> 'd' THEN user_id END AS after_user FROM changes""",
    "cdc_config_state": f"""WITH {_CONFIG} SELECT source_table, sink_table, sink_columns, row_key FROM config
        WHERE NOT removed""",
    "cdc_route": f"""WITH {_ROUTED} SELECT position, op, source_table, sink_table, row_key, user_id,
        CASE sink_table WHEN 'dim_user' THEN event_type END AS event_type,
        CASE sink_table WHEN 'dwd_order' THEN value END AS value FROM routed""",
    "cdc_upsert_latest": _LATEST,
    "dim_table_autocreate": f"WITH {_CONFIG} SELECT sink_table AS table_name FROM config WHERE NOT removed",
    "cdc_table_passthrough": f"""WITH {_CHANGES} SELECT op, ts_ms, position, CASE WHEN op = 'd' THEN user_id END AS before_user_id,
        CASE WHEN op = 'd' THEN value END AS before_value, CASE WHEN op <> 'd' THEN user_id END AS after_user_id,
        CASE WHEN op <> 'd' THEN value END AS after_value FROM changes""",
    "dim_enrich": """SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS code, n_name AS dic_name,
        CAST(n_regionkey AS VARCHAR) AS parent_code FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "log_parse_valid": f"WITH {_LOGS} SELECT seq, mid, is_new, ts FROM good",
    "log_dirty": f"WITH {_LOGS} SELECT event_id AS seq, 'not a JSON object' AS reason FROM ev WHERE event_id % 97 = 0",
    "visitor_repair": f"WITH {_WRITTEN} SELECT seq, mid, ts, is_new FROM fixed",
    "visitor_repair_documented": f"WITH {_DOCUMENTED} SELECT seq, mid, ts, is_new FROM fixed",
    "log_err": f"""WITH {_LOGS} SELECT seq, mid, is_new, seq % 7 AS error_code, p_name AS item, ts FROM good
        WHERE event_type = 'error'""",
    "log_start": f"WITH {_LOGS} SELECT seq, mid, is_new, 'icon' AS entry, ts FROM good WHERE event_type = 'signup'",
    "log_display": f"""WITH {_LOGS} SELECT seq, mid, is_new, p_name AS item, r.range AS pos, p_name AS page_item, ts
        FROM good, range(seq % 4) r WHERE event_type <> 'signup'""",
    "log_action": f"""WITH {_LOGS} SELECT seq, mid, is_new, event_type AS action_id, r.range AS action_no,
        p_name AS page_item, CAST(NULL AS BIGINT) AS ts FROM good, range(seq % 3) r WHERE event_type <> 'signup'""",
    "log_page": f"""WITH {_LOGS} SELECT seq, mid, is_new, p_name AS item, CASE WHEN seq % 4 = 0 THEN '[]' END AS displays,
        CASE WHEN seq % 3 = 0 THEN '[]' END AS actions, ts FROM good WHERE event_type <> 'signup'""",
    "log_split": _SPLIT_COUNTS,
    "event_time": f"WITH {_SEARCH} SELECT ms AS ts, ms * 1000 AS et_us FROM page",
    "search_filter": f"WITH {_SEARCH} SELECT fullword, ms AS et_ms FROM search",
    "keyword_tokenize": r"""WITH words AS (
        SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word FROM documents)
        SELECT word, count(*) AS n FROM words GROUP BY 1""",
    "keyword_lateral": f"WITH {_WORDS} SELECT keyword, ms AS et_ms FROM words",
    "keyword_window_count": f"WITH {_WINDOWS} {_WINDOW_COLUMNS}",
    "date_helpers": """WITH t AS (SELECT event_id, epoch_us(ts) // 1000 AS ms, ts + INTERVAL 8 HOURS AS clock FROM events)
        SELECT event_id, ms, strftime(clock, '%Y-%m-%d') AS date_text, strftime(clock, '%Y-%m-%d %H:%M:%S') AS datetime_text,
               strftime(clock, '%Y%m%d') AS partition_text,
               epoch_us(date_trunc('second', clock) - INTERVAL 8 HOURS) // 1000 AS datetime_ms,
               epoch_us(CAST(date_trunc('day', clock) AS TIMESTAMP) - INTERVAL 8 HOURS) // 1000 AS date_ms FROM t""",
    "window_format": """SELECT strftime(o_orderdate, '%Y/%m/%d %H') AS hour_text, '2024-12-11' AS literal_text,
        count(*) AS n FROM orders GROUP BY 1""",
    "null_counts": "WITH j AS (SELECT d.doc_id, text, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))\n"
        + _union(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM j"
                 for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")),
    "frame_info": _union(
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null FROM orders"
        for c, t in (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
                     ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"))),
    "describe_numeric": f"""WITH cells AS ({_long('lineitem', _NUMBERS)})
        SELECT "column", count(*) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std,
               round(min(value), 4) AS min, round(quantile_cont(value, 0.25), 4) AS q1,
               round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.75), 4) AS q3,
               round(max(value), 4) AS max FROM cells GROUP BY 1""",
    "describe_object": f"WITH {_SALES}, cells AS ("
        + _union(f"SELECT '{c}' AS \"column\", {c} AS value FROM sales" for c in _CATEGORIES)
        + """), counts AS (SELECT "column", value, count(*) AS n FROM cells WHERE value IS NOT NULL GROUP BY ALL),
        tops AS (SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) = 1),
        sums AS (SELECT "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique" FROM counts GROUP BY 1)
        SELECT "column", count, "unique", value AS top, n AS freq FROM sums JOIN tops USING ("column")""",
    "distinct_values": f"WITH {_SALES} " + "\nUNION\n".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM sales" for c in [*_CATEGORIES, "l_linenumber"]),
    "iqr_bounds": f"""WITH {_bounds('lineitem', _NUMBERS)} SELECT "column", round(q1, 6) AS q1, round(q3, 6) AS q3,
        round(iqr, 6) AS iqr, round(lower, 6) AS lower, round(upper, 6) AS upper FROM bounds""",
    "iqr_remove": f"""WITH {_bounds('events', ['value', 'user_id'])}
        SELECT event_id, user_id, e.value FROM events e, (SELECT * FROM bounds WHERE "column" = 'value') v,
               (SELECT * FROM bounds WHERE "column" = 'user_id') u
        WHERE e.value BETWEEN v.lower AND v.upper AND user_id BETWEEN u.lower AND u.upper""",
    "iqr_outliers": f"""WITH {_bounds('events', ['value', 'user_id'])},
        keyed AS ({_long('events', ['value', 'user_id'], 'event_id')})
        SELECT event_id, "column", value FROM keyed JOIN bounds USING ("column") WHERE value < lower OR value > upper""",
    "box_stats": f"""WITH {_bounds('events', ['value', 'user_id'])}
        SELECT "column", round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
               round(min(value) FILTER (value BETWEEN lower AND upper), 6) AS whisker_low,
               round(max(value) FILTER (value BETWEEN lower AND upper), 6) AS whisker_high,
               count(*) FILTER (value < lower OR value > upper) AS fliers
        FROM cells JOIN bounds USING ("column") GROUP BY 1""",
    "encode_categories": """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4
        WHEN '4-NOT SPECIFIED' THEN 2 WHEN '5-LOW' THEN 1 END AS o_orderpriority FROM orders""",
    "drop_columns": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "head_rows": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    "value_counts": "SELECT l_quantity AS value, count(*) AS n FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY 1",
    "value_shares": f"""WITH {_SALES} SELECT o_orderpriority AS value,
        round(count(*) / (SELECT count(o_orderpriority) FROM sales), 6) AS share FROM sales
        WHERE o_orderpriority IS NOT NULL GROUP BY 1""",
    "crosstab_index": _share("o_orderpriority", "index"),
    "crosstab_columns": _share("l_quantity", "columns"),
    "crosstab_sorted": _share("l_linenumber", "columns"),
    "group_median": f"""WITH {_SALES} SELECT response, round(median(l_extendedprice), 6) AS median FROM sales
        GROUP BY 1""",
    "group_counts_2d": f"WITH {_SALES} SELECT o_orderpriority, response, count(*) AS n FROM sales GROUP BY ALL",
    "group_mean_ci": f"""WITH {_SALES} SELECT o_orderpriority, l_linestatus, count(response) AS n,
        round(avg(response), 5) AS mean,
        round(avg(response) - 1.959963984540054 * stddev_samp(response) / sqrt(count(response)), 5) AS low,
        round(avg(response) + 1.959963984540054 * stddev_samp(response) / sqrt(count(response)), 5) AS high
        FROM sales GROUP BY ALL""",
    "corr_matrix": f"WITH {_SALES} " + _union(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM sales"
        for a in [*_NUMBERS, "response"] for b in [*_NUMBERS, "response"]),
    "corr_rank": f"WITH {_SALES} " + _union(
        f"SELECT '{c}' AS \"column\", round(corr({c}, response), 6) AS corr FROM sales" for c in _NUMBERS),
    "train_test_split": f"""WITH {_POLICIES} SELECT id,
        CAST('0x' || substr(md5('42:' || id), 1, 8) AS UBIGINT) % 5 = 0 AS is_test FROM policies""",
    "class_counts": f"WITH {_POLICIES} SELECT response, count(*) AS n FROM policies GROUP BY 1",
    "smote_oversample": f"""WITH {_POLICIES},
        few AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS place FROM policies WHERE response = 1),
        sizes AS (SELECT (SELECT count(*) FROM few) AS n, (SELECT count(*) FROM policies WHERE response = 0)
                         - (SELECT count(*) FROM few) AS missing),
        pairs AS (SELECT a.id AS base, b.id AS near,
            (a.premium - b.premium) * (a.premium - b.premium) + (a.balance - b.balance) * (a.balance - b.balance)
            + (a.priority - b.priority) * (a.priority - b.priority) + (a.segment - b.segment) * (a.segment - b.segment) AS d2
            FROM few a JOIN few b ON a.id <> b.id),
        near AS (SELECT base, list(near ORDER BY d2, near)[1:5] AS ids FROM pairs GROUP BY 1),
        copies AS (SELECT few.*, unnest(range(1, missing // n + 1 + CASE WHEN place < missing % n THEN 1 ELSE 0 END)) AS copy
                   FROM few, sizes),
        drawn AS (SELECT *, md5('42:' || id || ':' || copy) AS digest FROM copies),
        chosen AS (SELECT d.*, CAST('0x' || substr(digest, 9, 8) AS UBIGINT) / 4294967296.0 AS u,
                   ids[CAST(CAST('0x' || substr(digest, 1, 8) AS UBIGINT) % len(ids) AS BIGINT) + 1] AS pick
                   FROM drawn d JOIN near ON d.id = near.base)
        SELECT c.id AS base, c.copy, round(c.premium + u * (p.premium - c.premium), 4) AS premium,
               round(c.balance + u * (p.balance - c.balance), 4) AS balance,
               round(c.priority + u * (p.priority - c.priority), 4) AS priority,
               round(c.segment + u * (p.segment - c.segment), 4) AS segment, 1 AS response
        FROM chosen c JOIN few p ON c.pick = p.id""",
    "column_concat": f"""WITH {_POLICIES}, counts AS (SELECT response, count(*) AS n FROM policies GROUP BY 1)
        SELECT response, (SELECT max(n) FROM counts) AS n FROM counts""",
    "classification_metrics": f"""WITH {_SALES}, o AS (SELECT
            count(*) FILTER (response = 1 AND g) AS tp, count(*) FILTER (response = 0 AND g) AS fp,
            count(*) FILTER (response = 1 AND NOT g) AS fn, count(*) FILTER (response = 0 AND NOT g) AS tn
            FROM (SELECT response, l_quantity >= 30 AND l_discount >= 0.03 AS g FROM sales))
        SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
               round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
               round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM o""",
    "confusion_matrix": f"""WITH {_SALES}, g AS (
            SELECT response AS actual, CAST(l_quantity >= 30 AND l_discount >= 0.03 AS INT) AS predicted FROM sales)
        SELECT a AS actual, p AS predicted, count(g.actual) AS n FROM (VALUES (1), (0)) x(a) CROSS JOIN (VALUES (1), (0)) y(p)
        LEFT JOIN g ON g.actual = a AND g.predicted = p GROUP BY ALL""",
    "column_bind": f"WITH {_PREMIUMS} SELECT policy, gross, ceded, equity FROM bound",
    "column_bind_position": """WITH c AS (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_custkey) - 1 AS position FROM customer),
        o AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders)
        SELECT coalesce(c.position, o.position) AS position, c_custkey, c_acctbal, o_orderkey, o_totalprice
        FROM c FULL JOIN o ON c.position = o.position""",
    "retained_premium_ratio": f"""WITH {_PREMIUMS}, r AS (
            SELECT policy, coalesce(gross, 0) - coalesce(ceded, 0) AS retained, (equity + equity) / 2 AS avg_equity FROM bound)
        SELECT policy, round(retained, 4) AS retained_premium, round(avg_equity, 4) AS average_equity,
               round(retained / nullif(avg_equity, 0) * 100, 4) AS ratio_percent FROM r""",
    "longest_run": _islands("0"),
    "longest_run_min1": _islands("1"),
    "longest_distinct_span": """WITH chars AS (
            SELECT doc_id, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS pos FROM documents),
        last AS (SELECT doc_id, pos, coalesce(lag(pos) OVER (PARTITION BY doc_id, c ORDER BY pos), 0) + 1 AS start FROM chars),
        spans AS (SELECT doc_id, pos - max(start) OVER (PARTITION BY doc_id ORDER BY pos) + 1 AS n FROM last),
        best AS (SELECT doc_id, max(n) AS n FROM spans GROUP BY 1)
        SELECT d.doc_id, CAST(CASE WHEN text IS NULL THEN NULL ELSE coalesce(n, 0) END AS INT) AS span
        FROM documents d LEFT JOIN best USING (doc_id)""",
    "watermark_zero": f"""WITH {_WINDOWS}
        {_WINDOW_COLUMNS} WHERE w + INTERVAL 10 MINUTES <= (SELECT make_timestamp(max(ms) * 1000) FROM page)""",
    "stream_log_split": _SPLIT_COUNTS,
    "stream_dimension": _LATEST,
    "stream_route": """WITH kinds AS (
            SELECT r_regionkey AS k, (['click', 'error', 'purchase', 'signup', 'view'])[r_regionkey + 1] AS kind FROM region
            WHERE r_regionkey BETWEEN 0 AND 4),
        versions AS (
            SELECT kind, part, part >= k AND (k % 2 = 1 OR part <> k + 2) AS live,
                CASE WHEN k % 2 = 0 AND part >= k + 3 THEN 'user_id,event_type,value' WHEN k % 2 = 0 THEN 'user_id,value'
                     WHEN part >= k + 4 THEN 'value' ELSE 'user_id,event_type' END AS columns FROM kinds, range(6) r(part)),
        changes AS (
            SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ts_ms, CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op,
                CASE WHEN event_id % 101 <> 0 THEN event_type END AS source_table,
                event_id * 6 // (SELECT max(event_id) + 1 FROM events) AS part FROM events),
        arrived AS (
            SELECT event_id, min(v.part) AS batch FROM changes c JOIN versions v ON v.kind = c.source_table AND v.live AND v.part >= c.part
            GROUP BY 1)
        SELECT source_table, CASE WHEN batch IS NOT NULL THEN (SELECT live FROM versions e WHERE e.kind = source_table AND e.part = 5)
                END AS has_table, CAST(batch AS INT) AS batch,
            CASE WHEN batch IS NOT NULL THEN 'dwd_' || source_table END AS sink_table, op, ts_ms,
            CASE WHEN batch IS NOT NULL THEN CAST(user_id AS VARCHAR) END AS row_key,
            CASE WHEN contains(columns, 'user_id') THEN user_id END AS user_id,
            CASE WHEN contains(columns, 'event_type') THEN event_type END AS event_type,
            CASE WHEN contains(columns, 'value') THEN value END AS value
        FROM changes LEFT JOIN arrived USING (event_id) LEFT JOIN versions v ON v.kind = source_table AND v.part = batch""",
    "snapshot_handover": f"""WITH {_CHANGES},
        placed AS (SELECT *, CAST(user_id % 8 AS INT) AS chunk FROM changes),
        handed AS (SELECT *, (chunk + 2) * (SELECT max(position) FROM changes) // 12 AS upto FROM placed),
        last AS (SELECT user_id, chunk, upto, arg_max(op, position) AS op, arg_max(event_type, position) AS event_type,
            arg_max(value, position) AS value FROM handed WHERE position <= upto GROUP BY ALL)
        SELECT 'r' AS op, upto AS position, chunk, user_id, event_type, value FROM last WHERE op <> 'd'
        UNION ALL SELECT op, position, chunk, user_id, event_type, value FROM handed WHERE position > upto""",
    "stream_visitor_days": f"WITH {_WRITTEN} SELECT seq, mid, ts, is_new FROM fixed",
    "late_records": f"""WITH {_EVENTS},
        arrived AS (SELECT event_id, ms, 2 * event_id + CASE WHEN event_id % 13 = 0 THEN 81 ELSE 0 END AS place FROM ev),
        seen AS (SELECT event_id, ms, max(ms) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM arrived)
        SELECT event_id, ms AS ts, coalesce(newest >= (ms // 600000 + 1) * 600000, false) AS late FROM seen""",
    "open_windows": f"""WITH {_WINDOWS}, shown AS (
        SELECT *, w + INTERVAL 10 MINUTES > (SELECT make_timestamp(max(ms) * 1000) FROM page) AS open FROM windows)
        {_WINDOW_COLUMNS.replace('FROM windows', ', open FROM shown')}""",
    "group_mean_bootstrap": f"""WITH {_SALES},
        hashed AS (SELECT o_orderpriority, l_linestatus, response, b.range AS block,
            md5('42:' || l_orderkey || ':' || l_linenumber || ':' || b.range) AS h FROM sales, range(25) b),
        words AS (SELECT o_orderpriority, l_linestatus, response, block * 8 + w.range AS draw,
            CAST('0x' || substr(h, CAST(4 * w.range + 1 AS INT), 4) AS INT) AS u FROM hashed, range(8) w),
        means AS (SELECT o_orderpriority, l_linestatus, draw, sum(w * response) / sum(w) AS m
            FROM (SELECT *, {' + '.join(f'(u >= {cut})::INT' for cut in POISSON_CUTS)} AS w FROM words)
            WHERE w > 0 GROUP BY ALL),
        bounds AS (SELECT o_orderpriority, l_linestatus, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high FROM means GROUP BY ALL),
        whole AS (SELECT o_orderpriority, l_linestatus, count(*) AS n, avg(response) AS mean FROM sales GROUP BY ALL)
        SELECT o_orderpriority, l_linestatus, n, round(mean, 5) AS mean, round(low, 5) AS low, round(high, 5) AS high
        FROM whole JOIN bounds USING (o_orderpriority, l_linestatus)""",
    "corr_matrix_wide": """WITH cells AS (
            SELECT vec_id, i - 1 AS i, CASE WHEN v >= -0.15 THEN v END AS v FROM (
                SELECT vec_id, unnest(generate_series(1, len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings))
        SELECT 'e' || x.i AS a, 'e' || y.i AS b, count(*) FILTER (x.v IS NOT NULL AND y.v IS NOT NULL) AS n,
            round(corr(x.v, y.v), 6) AS corr FROM cells x JOIN cells y USING (vec_id) GROUP BY x.i, y.i""",
    "keyword_dictionary": r"""WITH RECURSIVE listed AS (
            SELECT DISTINCT w FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w FROM benchmark)
            WHERE length(w) BETWEEN 2 AND 4),
        vocabulary AS (SELECT list(w) AS v FROM listed),
        runs AS (SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w FROM documents) GROUP BY 1),
        best AS (
            SELECT w, length(w) AS p, [{'c': 0, 'k': 0, 'l': 0}] AS s FROM runs
            UNION ALL
            SELECT w, p - 1, list_prepend(list_max(list_concat([{'c': s[1].c, 'k': s[1].k, 'l': 0}], list_transform(
                list_filter([2, 3, 4], lambda z: z <= length(w) - p + 1 AND list_contains(v, substr(w, p, z))),
                lambda z: {'c': s[z].c + z, 'k': s[z].k - 1, 'l': z}))), s) FROM best, vocabulary WHERE p >= 1),
        walked AS (
            SELECT w, s, 1 AS a, s[1].l AS l FROM best WHERE p = 0
            UNION ALL
            SELECT w, s, a + greatest(l, 1), s[a + greatest(l, 1)].l FROM walked WHERE a + greatest(l, 1) <= length(w)),
        gaps AS (SELECT w, a, a - row_number() OVER (PARTITION BY w ORDER BY a) AS island FROM walked WHERE l = 0),
        parts AS (
            SELECT w, substr(w, a, l) AS word FROM walked WHERE l > 0
            UNION ALL SELECT w, substr(w, min(a), CAST(count(*) AS INT)) FROM gaps GROUP BY w, island)
        SELECT word, CAST(sum(n) AS BIGINT) AS n FROM parts JOIN runs USING (w) GROUP BY 1""",
    "model_columns": f"""WITH {_POLICIES} SELECT id, response, true AS same_boosted, true AS same_tree FROM policies
        WHERE CAST('0x' || substr(md5('42:' || id), 1, 8) AS UBIGINT) % 5 = 0""",
    "stream_dirty_logs": f"WITH {_LOGS} SELECT event_id AS seq, 'not a JSON object' AS reason FROM ev WHERE event_id % 97 = 0",
}
