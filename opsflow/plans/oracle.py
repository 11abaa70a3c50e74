"""Independent SQL for each bound query (DuckDB dialect, tables as views).

Each statement restates the query's semantics directly on the driver tables;
column names and types match the Spark result.
"""

from __future__ import annotations

IN_CAT = "('1','2','3','657','786','898')"
OTHERS = "('1','119','882','444')"
CODE = ("CASE event_type WHEN 'click' THEN 'OK' WHEN 'purchase' THEN 'OK' WHEN 'view' THEN 'DLT' "
        "WHEN 'error' THEN 'SRC' WHEN 'signup' THEN 'TGT' END")
FREQ = "CASE n_regionkey WHEN 1 THEN 'MLY_01' WHEN 3 THEN 'MLT_15' ELSE 'DLY' END"
MONTHLY = "('MLY_01','MLY_21','MLY_25','MLY_16','MLY_26','MLT_15','DLY_MLY_16')"

DM = f"""dm AS (
  SELECT event_id, user_id, event_type, ts,
         json_extract_string(props, '$.k') AS k,
         TRY_CAST(CAST(user_id AS VARCHAR) || CASE WHEN event_type = 'error' THEN 'x' ELSE '' END AS INTEGER) AS m_c,
         CAST(CAST(round(value) AS INTEGER) AS VARCHAR) AS udAcc,
         CASE WHEN hour(ts) < 12 THEN CAST(day(ts) AS VARCHAR)
              ELSE CAST(day(ts) AS VARCHAR) || '-' || CAST(hour(ts) AS VARCHAR) END AS cat_id
  FROM events),
g AS (
  SELECT *, CASE WHEN k IN {OTHERS} OR ((k IN {IN_CAT}) <> (cat_id IN {IN_CAT})) THEN NULL ELSE k END AS udId
  FROM dm)"""

PART_TEXT = """pt AS (
  SELECT p_partkey, p_type, p_size,
         lower(p_type) || '/' || CASE WHEN p_size % 4 = 0 THEN 'ap' ELSE p_brand END || '~' || p_name
           || '  ' || chr(9) || p_type || '/' || CAST(p_size AS VARCHAR)
           || CASE WHEN p_size > 25 THEN '~x/y' ELSE '' END AS tranT1
  FROM part),
pn AS (SELECT *, regexp_replace(upper(tranT1), '\\s+', ' ', 'g') AS tranT FROM pt),
tk AS (SELECT *, string_split_regex(tranT, '/|~') AS w FROM pn),
tt AS (SELECT *, w[1] AS TT_0, w[2] AS TT_1, w[3] AS TT_2, w[4] AS TT_3, w[5] AS TT_4 FROM tk)"""

TXN = """t AS (
  SELECT o.o_orderkey, o.o_custkey, e.event_id AS tranI,
         CASE WHEN o.o_custkey IS NULL OR o.o_orderdate IS NULL OR o.o_totalprice IS NULL
                   OR e.props IS NULL OR e.event_id IS NULL THEN 0 ELSE 1 END AS Var
  FROM orders o LEFT JOIN events e ON o.o_orderkey = e.event_id)"""

LONG = f"""lg AS (
  SELECT 'UC_' || CAST(user_id AS VARCHAR) AS usecase, CAST(ts AS DATE) AS report_date,
         arg_min({CODE}, row(ts, event_id)) AS category
  FROM events GROUP BY ALL)"""

MTD = f"""mt AS (
  SELECT usecase,
         count_if(category = 'OK') AS ok, count_if(category = 'DLT') AS dlt,
         count_if(category IN ('OK','DBA','DLT','FIN','PRX','SFD','CBS','PRM','SRC','TGT')) AS n
  FROM lg WHERE report_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY usecase),
mtd AS (
  SELECT usecase,
         CAST(CASE WHEN n > 0 THEN (ok * 100) // n END AS BIGINT) AS mtd,
         CAST(CASE WHEN n > 0 THEN ((n - dlt) * 100) // n END AS BIGINT) AS mtd_dl
  FROM mt)"""

DAYS = [f"2024-01-{d:02d}" for d in range(30, 0, -1)]
MATRIX = "mx AS (SELECT 'UC_' || CAST(c_custkey AS VARCHAR) AS usecase, " + ", ".join(
    f"max(CASE WHEN lg.report_date = DATE '{d}' THEN category END) AS d{d.replace('-', '')}" for d in DAYS
) + " FROM customer LEFT JOIN lg ON lg.usecase = 'UC_' || CAST(c_custkey AS VARCHAR) GROUP BY c_custkey)"

CLUSTERS = """cd AS (
  SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN 'j-' || CAST(o_orderkey AS VARCHAR) ELSE '' END AS ClusterId,
         CAST(floor(o_totalprice / 1000) AS INTEGER) AS NormalizedInstanceHours,
         CASE WHEN o_orderstatus = 'P' AND o_totalprice < 100000 THEN NULL
              ELSE o_orderdate + INTERVAL 1 HOUR END AS ReadyDateTime,
         o_orderdate AS CreationDateTime,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 3 DAY END AS EndDateTime,
         CASE o_orderstatus WHEN 'F' THEN 'TERMINATED' WHEN 'O' THEN 'WAITING' WHEN 'P' THEN 'RUNNING' ELSE '' END AS State
  FROM orders)"""

NOW = "TIMESTAMP '2024-01-30 00:00:00'"


def _one_point(inside: str, days: str, value: str = "value") -> str:
    """Average of the points inside a window if the first and the last lie in one period of ``days`` + 4 days."""
    period = f"(greatest({days} + 4, 1) * 86400)"
    return (f"CASE WHEN floor(epoch(min(ts) FILTER (WHERE {inside})) / {period}) = floor(epoch(max(ts) FILTER (WHERE {inside})) / {period}) "
            f"THEN round(avg({value}) FILTER (WHERE {inside}), 6) END")


LAST_12, LAST_3 = (f"ts >= {NOW} - INTERVAL {h} HOUR AND ts <= {NOW}" for h in (12, 3))
IDLE = f"""SELECT user_id AS ClusterId,
         {_one_point("TRUE", f"floor((epoch({NOW}) - epoch(min(ts))) / 86400)")} AS idle_pct,
         {_one_point(LAST_12, "0")} AS idle_pct_12h,
         {_one_point(LAST_3, "0")} AS idle_pct_3h
  FROM events GROUP BY 1"""

LOG_FIELDS = ("CAST(event_id AS VARCHAR)", "'BB'", "''", "''", "'table' || CAST(user_id AS VARCHAR)",
              "'Data Transfer'", "upper(event_type)", "''",
              "CASE WHEN event_type = 'purchase' THEN 'Data Transfer Completed' ELSE 'Transfer Started' END",
              "strftime(ts, '%Y-%m-%d %H:%M:%S')", "strftime(ts, '%Y-%m-%d')")

SQL: dict[str, str] = {
    # ---------------------------------------------------------------- feeds
    "json_flatten": "SELECT ts AS msg_time, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "pad_columns": """
SELECT event_id, ts AS msg_time, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       '' AS paperNum, '' AS due, '' AS jour, '' AS merch, '' AS location, '' AS bCode,
       '' AS accCatDets, '' AS accDisWhenCreate, '' AS accLim, '' AS accN, '' AS bookedAmt, '' AS isHidden,
       CASE WHEN value < 0 THEN 1 ELSE 0 END AS amtId
FROM events""",
    "rename_map": """
SELECT p_partkey, p_name AS catN, p_type AS catType, p_size AS isCat, p_brand AS subtext,
       p_retailprice AS "Output", CAST(p_partkey AS VARCHAR) AS catId, '' AS merchN
FROM part""",
    "sign_flag": "SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS amtId FROM customer",
    "default_category": """
SELECT c_custkey, c_acctbal AS amount,
       '' AS det_Cat, '' AS acc, '' AS subTCreate, '' AS merchN, '' AS subtext, ' ' AS isCat, '' AS catOut,
       '' AS hasUncertainCat,
       CASE WHEN c_acctbal < 0 THEN '956' ELSE '953' END AS catId,
       CASE WHEN c_acctbal < 0 THEN 'OP (T)' ELSE 'OI' END AS catN,
       'Exp' AS catType
FROM customer""",
    "feed_route": """
SELECT event_id,
       CASE WHEN event_type IN ('purchase','click') THEN 'A' WHEN event_type = 'view' THEN 'B'
            WHEN event_type IN ('signup','error') THEN 'C' END AS feed,
       CASE WHEN event_type IN ('purchase','click') THEN 'A_out' WHEN event_type = 'view' THEN 'B_out'
            WHEN event_type IN ('signup','error') THEN 'C_out' END AS output_topic,
       CASE WHEN event_type IN ('purchase','click') THEN 'A_group' WHEN event_type = 'view' THEN 'B_group'
            WHEN event_type IN ('signup','error') THEN 'C_group' END AS consumer_group,
       CASE WHEN event_type IN ('purchase','click','signup','error') THEN 'categorize'
            WHEN event_type = 'view' THEN 'default' END AS branch
FROM events""",
    # ---------------------------------------------------------------- latest
    "latest_message": """
SELECT event_id, ts, user_id, event_type, value, props, CAST(1 AS INTEGER) AS msg_number
FROM (SELECT *, rank() OVER (PARTITION BY trim(CAST(user_id AS VARCHAR)), trim(event_type)
                             ORDER BY CAST(ts AS DATE) DESC) AS r FROM events)
WHERE r = 1""",
    # ---------------------------------------------------------------- categorization
    "completeness": f"WITH {TXN} SELECT o_orderkey, Var FROM t",
    "invalid_union": f"""
WITH {TXN}
SELECT t.o_orderkey, t.Var, CAST(c.c_nationkey AS VARCHAR) AS catId, n.n_name AS catN
FROM t LEFT JOIN customer c ON t.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE t.Var = 1
UNION ALL
SELECT o_orderkey, Var, NULL, NULL FROM t WHERE Var = 0""",
    "text_normalize": f"WITH {PART_TEXT} SELECT p_partkey, tranT1, tranT FROM pn",
    "token_split": f"WITH {PART_TEXT} SELECT p_partkey, TT_0, TT_1, TT_2, TT_3, TT_4 FROM tt",
    "counterparty": f"""
WITH {PART_TEXT},
j AS (
  SELECT l.l_orderkey, l.l_linenumber, tt.*,
         CASE WHEN starts_with(o.o_orderpriority, '1') THEN 'Remittance'
              WHEN starts_with(o.o_orderpriority, '2') THEN 'BILL'
              WHEN starts_with(o.o_orderpriority, '3') THEN 'Others'
              ELSE o.o_orderpriority END AS payType
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN tt ON l.l_partkey = tt.p_partkey)
SELECT l_orderkey, l_linenumber, payType,
       CASE WHEN regexp_matches(TT_0, '^U') THEN ''
            WHEN regexp_matches(TT_0, '^A') THEN TT_1
            WHEN regexp_matches(TT_0, '^M') THEN TT_3
            WHEN regexp_matches(TT_0, '^E') THEN TT_2
            WHEN regexp_matches(TT_0, '^C') THEN TT_1
            WHEN regexp_matches(TT_0, '^B') THEN TT_1
            WHEN regexp_matches(TT_0, '^N') THEN TT_2
            WHEN regexp_matches(TT_0, '^I') THEN TT_3
            WHEN regexp_matches(lower(payType), '^remit') THEN ''
            WHEN lower(payType) = 'bill' AND TT_1 = 'AP' THEN TT_3
            WHEN lower(payType) = 'others' AND regexp_matches(tranT, '^(C|I|S)') THEN TT_0
            ELSE '' END AS counP_Name_TT
FROM j""",
    "decision_guard": f"""
WITH {DM}
SELECT event_id, user_id, m_c, cat_id, udId, udAcc, CAST(1.5 AS DOUBLE) AS Dec_Wt FROM g""",
    "decision_list": f"""
WITH {DM}
SELECT c.c_custkey,
       COALESCE(array_to_string(list(g.udId ORDER BY g.udAcc DESC NULLS LAST, g.event_id ASC)
                                FILTER (WHERE g.udId IS NOT NULL), ','), '') AS usDecCatId
FROM customer c LEFT JOIN g ON c.c_custkey = g.user_id
GROUP BY c.c_custkey""",
    "decision_positions": f"""
WITH {DM}
SELECT event_id, user_id, udId, udAcc,
       row_number() OVER (PARTITION BY user_id ORDER BY udAcc DESC NULLS LAST, event_id ASC NULLS FIRST) AS position
FROM g WHERE udId IS NOT NULL""",
    "running_list": f"""
WITH {DM},
r AS (SELECT event_id, user_id, udAcc, udId, dense_rank() OVER (PARTITION BY user_id ORDER BY udAcc DESC NULLS LAST) AS a FROM g),
w AS (SELECT event_id, user_id, udAcc, count(udId) OVER peers AS running_len,
             list({{'a': a, 'e': event_id, 'i': udId}}) OVER peers AS l
      FROM r WINDOW peers AS (PARTITION BY user_id ORDER BY a)),
i AS (SELECT event_id, user_id, udAcc, running_len,
             [x.i FOR x IN list_sort(l) IF x.i IS NOT NULL] AS ids FROM w)
SELECT event_id, user_id, udAcc, running_len,
       CAST(COALESCE(list_sum(list_transform(ids, lambda x, n: CAST('0x' || substr(md5(n || ':' || x), 1, 8) AS BIGINT))), 0) AS BIGINT) AS list_digest
FROM i""",
    "decision_blocks": f"""
WITH {DM},
p AS (SELECT user_id, udId, row_number() OVER (PARTITION BY user_id ORDER BY udAcc DESC NULLS LAST, event_id) AS n
      FROM g WHERE udId IS NOT NULL)
SELECT user_id, CAST((n - 1) // 4 AS BIGINT) AS block, string_agg(udId, ',' ORDER BY n) AS ids FROM p GROUP BY ALL""",
    "candidate_set": f"""
WITH {DM},
u AS (
  SELECT user_id,
         COALESCE(list(udId) FILTER (WHERE udId IS NOT NULL), []) AS dec,
         list(DISTINCT event_type) AS types,
         COALESCE(list(DISTINCT k) FILTER (WHERE event_type = 'click'), []) AS decCat,
         COALESCE(list(DISTINCT k) FILTER (WHERE event_type = 'view'), []) AS nextBest,
         COALESCE(list(DISTINCT k) FILTER (WHERE event_type = 'signup'), []) AS nextBestId
  FROM g GROUP BY user_id)
SELECT user_id,
       array_to_string(list_sort(list_distinct(list_concat(types, dec))), ',') AS usDecCatId,
       array_to_string(list_sort(list_distinct(
           list_concat(list_concat(list_concat(list_concat(types, dec), decCat), nextBest), nextBestId))), ',') AS setNext
FROM u""",
    "explode_scores": f"""
WITH {DM}
SELECT event_id, k AS cat_id, udAcc AS cat_wt FROM dm WHERE event_type NOT IN ('error', 'signup')
UNION ALL
SELECT event_id, CAST(CAST(k AS INTEGER) + 100 AS VARCHAR), udAcc FROM dm WHERE event_type NOT IN ('error', 'signup')
UNION ALL
SELECT event_id, NULL, NULL FROM dm WHERE event_type IN ('error', 'signup')""",
    "score_json": f"""
WITH {DM}
SELECT event_id, '{{"catId":"' || k || '","score":"' || udAcc || '"}}' AS nextBest0 FROM dm""",
    "tree_enrich": """
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN c_nationkey + 100 WHEN c_custkey % 7 <> 0 THEN c_nationkey END AS k
           FROM customer)
SELECT c_custkey, CAST(k AS VARCHAR) AS catId, n.n_name AS catN, CAST(n.n_regionkey AS VARCHAR) AS catRegion
FROM c LEFT JOIN nation n ON k = n.n_nationkey""",
    # ---------------------------------------------------------------- envelope
    "envelope": """
SELECT CAST(user_id AS VARCHAR) AS key,
       '{"event_id":' || CAST(event_id AS VARCHAR) || ',"ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
       || '","user_id":' || CAST(user_id AS VARCHAR) || ',"event_type":"' || event_type
       || '","value":' || CAST(value AS VARCHAR) || ',"props":' || props || '}' AS value
FROM events""",
    "envelope_structured": """
SELECT CAST(user_id AS VARCHAR) AS key,
       '{"event_id":' || CAST(event_id AS VARCHAR) || ',"ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
       || '","user_id":' || CAST(user_id AS VARCHAR) || ',"event_type":"' || event_type
       || '","value":' || CAST(value AS VARCHAR) || ',"props":{"k":'
       || COALESCE(CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR), 'null') || '}}' AS value
FROM events""",
    # ---------------------------------------------------------------- streams
    "stream_latest": """
SELECT event_id, ts, user_id, event_type, value, props, CAST(1 AS INTEGER) AS msg_number, batch_id
FROM (SELECT *, CAST(CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END AS BIGINT) AS batch_id,
             rank() OVER (PARTITION BY ts < TIMESTAMP '2024-01-16 00:00:00', trim(CAST(user_id AS VARCHAR)),
                          trim(event_type) ORDER BY CAST(ts AS DATE) DESC) AS r
      FROM events)
WHERE r = 1""",
    "stream_enrich": """
WITH l AS (
  SELECT * FROM (SELECT *, CAST(CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END AS BIGINT) AS batch_id,
             rank() OVER (PARTITION BY ts < TIMESTAMP '2024-01-16 00:00:00', trim(CAST(user_id AS VARCHAR)),
                          trim(event_type) ORDER BY CAST(ts AS DATE) DESC) AS r
      FROM events) WHERE r = 1)
SELECT l.event_id, l.user_id, l.event_type, CAST(c.k AS VARCHAR) AS catId, n.n_name AS catN, l.batch_id
FROM l LEFT JOIN (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN c_nationkey + 100
                                         WHEN c_custkey % 7 <> 0 THEN c_nationkey END AS k FROM customer) c
  ON l.user_id = c.c_custkey
LEFT JOIN nation n ON c.k = n.n_nationkey""",
    # ---------------------------------------------------------------- transfer
    "manifest_lookup": """
WITH m AS (
  SELECT CASE WHEN p_size % 2 = 0 THEN 'P' ELSE 'p' END || '~cc~' || replace(lower(p_brand), '#', '') AS PROCESS_NAME,
         'table' || CAST(p_partkey AS VARCHAR) AS DEST_TABLE_NAME,
         CASE WHEN p_size % 3 = 1 THEN 'M' WHEN p_size % 3 = 2 THEN 'd' END AS M_INDICATOR,
         '/data/' || lower(p_type) AS STORAGE_LOCATION,
         CASE WHEN p_size % 5 <> 0 THEN 'o_orderkey, o_totalprice' END AS COLUMN_LIST,
         CASE WHEN p_size % 7 <> 0 THEN 'o_totalprice > ' || CAST(CAST(trunc(p_retailprice) AS INTEGER) AS VARCHAR) END AS WHERE_CLAUSE
  FROM part)
SELECT PROCESS_NAME, DEST_TABLE_NAME, M_INDICATOR, COLUMN_LIST, WHERE_CLAUSE,
       CASE WHEN M_INDICATOR IS NULL OR lower(M_INDICATOR) = 'm' THEN STORAGE_LOCATION
            ELSE STORAGE_LOCATION || '/year=2024/month=01/day=30/' END AS location
FROM m WHERE lower(PROCESS_NAME) = 'p~cc~brand2'""",
    "transfer_project": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 100000""",
    "dated_scan": "SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
    "load_gate": """
SELECT p_partkey, 'table' || CAST(p_partkey AS VARCHAR) AS DEST_TABLE_NAME FROM part
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_linestatus = 'F'
                  AND year(l_shipdate) = 1997)""",
    "audit_rows": """
SELECT event_type AS TableName, 'p~cc~' || event_type || '~M' AS process_name, DATE '2024-01-30' AS LoadDate,
       s.Status, TIMESTAMP '2024-01-30 23:30:00' AS ProcessDateTime
FROM (SELECT DISTINCT event_type FROM events) CROSS JOIN (VALUES ('Started'), ('Finished')) s(Status)""",
    "error_rows": """
SELECT 'table' || CAST(user_id AS VARCHAR) AS TableName, ts AS start_time, 'failed: ' || props AS error
FROM events WHERE event_type = 'error'""",
    # ---------------------------------------------------------------- runs
    "log_parse": f"""
SELECT {LOG_FIELDS[0]} AS log_id, {LOG_FIELDS[1]} AS source, {LOG_FIELDS[4]} AS table_name, {LOG_FIELDS[5]} AS stage,
       {LOG_FIELDS[6]} AS status, {LOG_FIELDS[8]} AS message, {LOG_FIELDS[9]} AS log_ts, {LOG_FIELDS[10]} AS log_date,
       concat_ws('~', {', '.join(LOG_FIELDS)}) AS export_line
FROM events""",
    "completed_processes": """
SELECT DISTINCT 'p~cc~' || event_type || '~M' AS process FROM events
WHERE event_type IN ('purchase', 'click') AND value >= 150""",
    "process_key": """
WITH k AS (
  SELECT p_partkey, lower(substr(p_type, 1, 2)) || '~cc~table' || CAST(p_partkey AS VARCHAR)
         || CASE WHEN p_size % 7 = 0 THEN '' ELSE '~' || CASE WHEN p_size % 2 = 0 THEN 't' ELSE 'M' END END AS process_key
  FROM part)
SELECT p_partkey, process_key, string_split(process_key, '~')[1] AS src, string_split(process_key, '~')[2] AS db,
       string_split(process_key, '~')[3] AS tbl, string_split(process_key, '~')[4] AS indicator
FROM k""",
    "readiness": """
WITH k AS (
  SELECT p_partkey, lower(substr(p_type, 1, 2)) AS src, 'table' || CAST(p_partkey AS VARCHAR) AS tbl,
         CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 2 = 0 THEN 't' ELSE 'M' END AS indicator
  FROM part),
w AS (SELECT *, src || '~cc~' || tbl || COALESCE('~' || indicator, '') AS process_key,
             'success-' || src || '-cc-' || tbl AS prefix FROM k),
m AS (
  SELECT DISTINCT 'success-' || lower(substr(p_type, 1, 2)) || '-cc-table' || CAST(l_partkey AS VARCHAR) || '-'
         || strftime(l_shipdate, '%Y%m%d') AS marker
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT p_partkey, process_key, indicator,
       CASE WHEN COALESCE(indicator, '') = 't'
            THEN EXISTS (SELECT 1 FROM m WHERE starts_with(m.marker, w.prefix)) ELSE TRUE END AS ready
FROM w""",
    "pending": """
SELECT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
    "numbered_pending": """
SELECT c_custkey, row_number() OVER (ORDER BY c_name) AS position,
       CAST(row_number() OVER (ORDER BY c_name) AS VARCHAR) || '. ' || c_name AS line
FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
    "pending_all": """
SELECT o_custkey FROM orders EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""",
    "run_status": """
WITH s AS (
  SELECT c_mktsegment, c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS pending,
         c_acctbal >= 0 AS ready FROM customer),
a AS (
  SELECT c_mktsegment, CAST(count_if(pending) AS BIGINT) AS transfer_pending,
         CAST(count_if(pending AND NOT ready) AS BIGINT) AS ingestion_pending,
         CAST(count_if(pending AND ready) AS BIGINT) AS ingestion_completed
  FROM s GROUP BY c_mktsegment)
SELECT *, CASE WHEN transfer_pending = 0 THEN 'SUCCESS' WHEN ingestion_completed = 0 THEN 'PENDING'
               ELSE 'RUNNING' END AS status
FROM a""",
    "latest_attempt": """
SELECT user_id, ts, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type DESC) AS k FROM events) t
WHERE k = 1""",
    # ---------------------------------------------------------------- dashboard
    "daily_status": f"""
WITH raw AS (
  SELECT e.event_id, lower(n.n_name) AS k, {CODE.replace('event_type', 'e.event_type')} AS category
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE CAST(e.ts AS DATE) = DATE '2024-01-29'),
f AS (SELECT k, arg_min(category, event_id) AS category FROM raw GROUP BY k)
SELECT n_name AS usecase, CAST(n_regionkey + 10 AS VARCHAR) || ':00' AS SLA, {FREQ} AS FREQ, f.category
FROM nation LEFT JOIN f ON lower(n_name) = f.k""",
    "code_tally": f"""
WITH {LONG}
SELECT COALESCE(NULLIF(regexp_extract(upper(category), '\\b(OK|DBA|DLT|FIN|PRX|SFD|CBS|PRM|SRC|TGT)\\b', 1), ''),
                'UNCLASSIFIED') AS code, count(*) AS n
FROM lg GROUP BY 1""",
    "mtd_success": f"WITH {LONG}, {MTD} SELECT * FROM mtd",
    "status_matrix": f"WITH {LONG}, {MATRIX} SELECT * FROM mx",
    "history_unpivot": f"""
WITH {LONG}
SELECT usecase, category, report_date FROM lg
WHERE report_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' AND category IS NOT NULL""",
    "dashboard_order": f"""
WITH {LONG}, {MTD},
um AS (SELECT 'UC_' || CAST(c_custkey AS VARCHAR) AS usecase, {FREQ} AS FREQ
       FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT mtd.usecase, um.FREQ, mtd, mtd_dl,
       row_number() OVER (ORDER BY CAST(COALESCE(um.FREQ IN {MONTHLY}, FALSE) AS INTEGER), COALESCE(mtd, 0), mtd.usecase) AS position
FROM mtd LEFT JOIN um ON mtd.usecase = um.usecase""",
    "failure_list": f"""
WITH r AS (
  SELECT event_id, concat_ws(',', 'UC_' || CAST(user_id AS VARCHAR), '10:00', 'DLY', strftime(ts, '%Y-%m-%d'),
         strftime(ts, '%H:%M:%S'), CAST(event_id AS VARCHAR),
         CASE WHEN event_type = 'click' THEN 'SUCCESS' WHEN event_type = 'purchase' THEN 'Success' ELSE 'FAILED' END,
         {CODE}) AS line
  FROM events)
SELECT event_id, line FROM r WHERE NOT contains(line, 'SUCCESS')""",
    "status_colour": f"""
WITH {LONG}
SELECT usecase, report_date, category,
       CASE WHEN category = 'OK' THEN '#9FE2BF' WHEN category = 'DLT' THEN '#FFBF00'
            WHEN category IN ('DBA','FIN','PRX','SFD','CBS','PRM','SRC','TGT') THEN '#FFFF00' END AS colour
FROM lg""",
    "report_rows": f"""
WITH {LONG}, {MATRIX}
SELECT usecase,
       '<tr><td class="y_n">' || replace(concat_ws(',', usecase, {', '.join(f"COALESCE(d{d.replace('-', '')}, '')" for d in DAYS)}),
                                        ',', '</td><td class="y_n">') || '</td></tr>' AS html
FROM mx""",
    "history_rollover": f"WITH {LONG} SELECT usecase, category, report_date FROM lg WHERE report_date = DATE '2024-01-30'",
    # ---------------------------------------------------------------- clusters
    "cluster_flatten": f"""
WITH {CLUSTERS}
SELECT ClusterId, NormalizedInstanceHours, ReadyDateTime, CreationDateTime, EndDateTime, State FROM cd
WHERE State IN ('WAITING', 'RUNNING') AND CreationDateTime >= TIMESTAMP '2001-07-02 00:00:00'""",
    "creator_extract": """
WITH d AS (
  SELECT 'user' || CAST(user_id AS VARCHAR) AS Username,
         CASE WHEN event_type = 'error' THEN '{}'
              WHEN event_type = 'view' THEN '{"responseElements": {}}'
              WHEN event_type = 'signup' THEN '{"responseElements": {"other": "x"}}'
              ELSE '{"eventName": "RunJobFlow", "responseElements": {"jobFlowId": "j-' || CAST(event_id AS VARCHAR) || '"}}'
         END AS doc
  FROM events WHERE event_type <> 'view' AND ts >= TIMESTAMP '2024-01-10 00:00:00')
SELECT Username,
       CASE WHEN json_extract(doc, '$.responseElements') IS NULL
              OR json_keys(json_extract(doc, '$.responseElements')) = [] THEN 'No responseElements'
            ELSE COALESCE(json_extract_string(doc, '$.responseElements.jobFlowId'), '') END AS ClusterId
FROM d""",
    "cluster_runtime": f"""
WITH {CLUSTERS},
r AS (SELECT ClusterId, CASE WHEN ReadyDateTime IS NOT NULL
                  THEN date_diff('second', ReadyDateTime, COALESCE(EndDateTime, TIMESTAMP '2001-08-01 00:00:00')) END AS runtime
      FROM cd)
SELECT *, row_number() OVER (ORDER BY runtime DESC NULLS LAST, ClusterId ASC NULLS FIRST) AS position FROM r""",
    "idle_windows": IDLE,
    "cluster_report": f"""
WITH cl AS (
  SELECT c_custkey, 'j-' || CAST(c_custkey AS VARCHAR) AS ClusterId, CAST(floor(abs(c_acctbal) / 10) AS INTEGER) AS NormalizedInstanceHours,
         c_mktsegment AS State, t AS ReadyDateTime, t - INTERVAL 1 HOUR AS CreationDateTime,
         CASE WHEN c_custkey % 3 = 0 THEN t + INTERVAL 5 DAY END AS EndDateTime
  FROM (SELECT *, CASE WHEN c_custkey % 11 <> 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey % 28 AS INTEGER)) END AS t
        FROM customer)),
ev AS (SELECT cl.*, value, ts, TIMESTAMP '2024-01-30 00:00:00' AS now FROM events JOIN cl ON user_id = c_custkey),
idle AS (
  SELECT ClusterId,
         {_one_point("ts >= ReadyDateTime AND ts <= COALESCE(EndDateTime, now)",
                     "floor((epoch(max(COALESCE(EndDateTime, now))) - epoch(max(ReadyDateTime))) / 86400)")} AS idle_pct,
         {_one_point("ts >= now - INTERVAL 12 HOUR AND ts <= now", "0")} AS idle_pct_12h,
         {_one_point("ts >= now - INTERVAL 3 HOUR AND ts <= now", "0")} AS idle_pct_3h
  FROM ev GROUP BY 1),
cr AS (SELECT 'user-' || o_orderpriority AS Username, 'j-' || CAST(o_custkey AS VARCHAR) AS ClusterId FROM orders),
r AS (
  SELECT cr.Username, cl.ClusterId, cl.NormalizedInstanceHours,
         CASE WHEN ReadyDateTime IS NOT NULL THEN date_diff('second', ReadyDateTime,
              COALESCE(EndDateTime, TIMESTAMP '2024-01-30 00:00:00')) END AS runtime, cl.State,
         idle.idle_pct, idle.idle_pct_12h, idle.idle_pct_3h, CAST(cl.NormalizedInstanceHours * 0.25 AS DOUBLE) AS ApproxCost,
         cl.ReadyDateTime, cl.CreationDateTime, cl.EndDateTime
  FROM cl LEFT JOIN cr ON cl.ClusterId = cr.ClusterId LEFT JOIN idle ON cl.ClusterId = idle.ClusterId)
SELECT *, row_number() OVER (ORDER BY NormalizedInstanceHours DESC NULLS LAST, ClusterId ASC NULLS FIRST,
                             Username ASC NULLS FIRST) AS position
FROM r""",
}


DECISIONS = f"""m AS (
  SELECT e.event_id, e.user_id, e.event_type AS et, json_extract_string(e.props, '$.k') AS k,
         CAST(CAST(round(e.value) AS INTEGER) AS VARCHAR) AS udAcc,
         CAST(CASE WHEN e.user_id % 4 = 0 AND e.event_id % 2 = 0 THEN c.c_nationkey + 1 ELSE c.c_nationkey END AS VARCHAR) AS cat_id
  FROM events e JOIN customer c ON e.user_id = c.c_custkey),
g AS (SELECT *, CASE WHEN k IN {OTHERS} OR ((k IN {IN_CAT}) <> (cat_id IN {IN_CAT})) THEN NULL ELSE k END AS udId FROM m)"""
PER_ACCOUNT = """l AS (
  SELECT user_id, list_sort(list_distinct(list(cat_id))) AS cats,
         COALESCE(list(udId ORDER BY udAcc DESC NULLS LAST, event_id) FILTER (WHERE udId IS NOT NULL), []) AS lst
  FROM g GROUP BY user_id),
d AS (SELECT user_id, array_to_string(cats, '-') AS cat_id, list_concat(cats, lst) AS cand,
             list_distinct(list_concat(cats, lst)) AS dset FROM l)"""


def _categorize_sql(latest: bool) -> str:
    """The categorization pipeline on orders left-joined to events; with
    ``latest``, rows arrive in two batches and the latest message per key is kept
    per batch first."""
    batch = "CAST(CASE WHEN o.o_orderdate < TIMESTAMP '1998-06-01' THEN 0 ELSE 1 END AS BIGINT)"
    src = f"""base AS (
  SELECT o.o_orderkey, o.o_custkey AS accIdent, o.o_orderdate AS tranDt, o.o_totalprice AS cost, e.event_id AS tranI,
         e.event_type || '/' || o.o_orderpriority || '~' || e.props AS tranT1,
         CASE WHEN starts_with(o.o_orderpriority, '2') THEN 'Bill' ELSE 'Others' END AS payType,
         {batch} AS batch_id
  FROM orders o LEFT JOIN events e ON o.o_orderkey = e.event_id),"""
    if latest:
        src += """
lt AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY batch_id, trim(CAST(tranI AS VARCHAR)),
                                            trim(CAST(cost AS VARCHAR)), trim(tranT1) ORDER BY tranDt DESC) AS r
                      FROM base) WHERE r = 1),"""
    rows = "lt" if latest else "base"
    extra = ", batch_id" if latest else ""
    return f"""
WITH {src}
t AS (
  SELECT *, CASE WHEN accIdent IS NULL OR tranDt IS NULL OR cost IS NULL OR tranI IS NULL OR tranT1 IS NULL
                 THEN 0 ELSE 1 END AS Var
  FROM {rows}),
v AS (SELECT *, regexp_replace(upper(tranT1), '\\s+', ' ', 'g') AS tranT FROM t WHERE Var = 1),
w AS (SELECT *, string_split_regex(tranT, '/|~') AS ws FROM v),
tt AS (SELECT *, ws[1] AS TT_0, ws[2] AS TT_1, ws[3] AS TT_2, ws[4] AS TT_3 FROM w),
cp AS (
  SELECT *, CASE WHEN regexp_matches(TT_0, '^U') THEN ''
                 WHEN regexp_matches(TT_0, '^A') THEN TT_1
                 WHEN regexp_matches(TT_0, '^M') THEN TT_3
                 WHEN regexp_matches(TT_0, '^E') THEN TT_2
                 WHEN regexp_matches(TT_0, '^C') THEN TT_1
                 WHEN regexp_matches(TT_0, '^B') THEN TT_1
                 WHEN regexp_matches(TT_0, '^N') THEN TT_2
                 WHEN regexp_matches(TT_0, '^I') THEN TT_3
                 WHEN regexp_matches(lower(payType), '^remit') THEN ''
                 WHEN lower(payType) = 'bill' AND TT_1 = 'AP' THEN TT_3
                 WHEN lower(payType) = 'others' AND regexp_matches(tranT, '^(C|I|S)') THEN TT_0
                 ELSE '' END AS counP_Name_TT
  FROM tt),
{DECISIONS},
{PER_ACCOUNT}
SELECT cp.o_orderkey, cp.Var, cp.tranT, cp.TT_0, cp.counP_Name_TT,
       COALESCE(array_to_string(list_filter(d.cand, lambda x, i: list_position(d.cand, x) = i), ','), '') AS usDecCatId,
       COALESCE(array_to_string(list_sort(d.dset), ','), '') AS setNext,
       d.cat_id AS catId, n.n_name AS catN{extra.replace('batch_id', 'cp.batch_id')}
FROM cp LEFT JOIN d ON cp.accIdent = d.user_id LEFT JOIN nation n ON d.cat_id = CAST(n.n_nationkey AS VARCHAR)
UNION ALL
SELECT o_orderkey, Var, regexp_replace(upper(tranT1), '\\s+', ' ', 'g'), NULL, NULL, NULL, NULL, NULL, NULL{extra}
FROM t WHERE Var = 0"""


SQL["audit_sink"] = SQL["audit_rows"]
SQL["error_sink"] = SQL["error_rows"]
SQL["finished_count"] = """
SELECT count(*) AS count FROM lineitem WHERE l_partkey = 7 AND l_linestatus = 'F' AND year(l_shipdate) = 1997"""
SQL["previous_day"] = "SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-14'"
SQL["log_export"] = f"SELECT concat_ws('~', {', '.join(LOG_FIELDS)}) AS export_line FROM events"
SQL["run_status_failed"] = """
WITH s AS (
  SELECT c_nationkey, c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS pending,
         c_acctbal >= 0 AS ready FROM customer)
SELECT c_nationkey, CAST(count_if(pending) AS BIGINT) AS transfer_pending,
       CAST(count_if(pending AND NOT ready) AS BIGINT) AS ingestion_pending,
       CAST(count_if(pending AND ready) AS BIGINT) AS ingestion_completed,
       CASE WHEN count_if(pending) = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status
FROM s GROUP BY c_nationkey"""
SQL["rollover_days"] = f"""
WITH {LONG} SELECT usecase, category, report_date FROM lg WHERE report_date BETWEEN DATE '2024-01-29' AND DATE '2024-01-30'"""
SQL["snapshot"] = f"WITH {LONG} SELECT usecase, category, report_date, 'ts-20240130-2330' AS snapshot_ts FROM lg"
SQL["report_csv"] = f"""
SELECT Username, ClusterId, CAST(NormalizedInstanceHours AS VARCHAR) AS NormalizedInstanceHours,
       CAST(runtime AS VARCHAR) AS runtime, State, CAST(idle_pct AS VARCHAR) AS idle_pct, CAST(idle_pct_12h AS VARCHAR) AS idle_pct_12h,
       CAST(idle_pct_3h AS VARCHAR) AS idle_pct_3h, CAST(ApproxCost AS VARCHAR) AS ApproxCost,
       strftime(ReadyDateTime, '%Y-%m-%d %H:%M:%S') AS ReadyDateTime, strftime(CreationDateTime, '%Y-%m-%d %H:%M:%S') AS CreationDateTime,
       strftime(EndDateTime, '%Y-%m-%d %H:%M:%S') AS EndDateTime, CAST(position AS VARCHAR) AS position
FROM ({SQL["cluster_report"]})"""
SQL["cluster_pages"] = f"WITH {CLUSTERS} SELECT * FROM cd"
SQL["event_pages"] = SQL["creator_extract"]
SQL["daily_status_words"] = f"""
WITH raw AS (
  SELECT e.event_id, {CODE.replace('event_type', 'e.event_type')} AS category,
         lower(concat_ws(',', printf('%010d', e.event_id),
           CASE e.event_id % 4 WHEN 0 THEN lower(n_name) WHEN 1 THEN 'job' WHEN 2 THEN n_name || '_x' ELSE n_name END,
           CASE e.event_id % 4 WHEN 1 THEN 'late for ' || n_name || '!' WHEN 2 THEN 'x' || n_name ELSE '-' END)) AS line
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE CAST(e.ts AS DATE) = DATE '2024-01-29'),
f AS (SELECT n_name AS k, arg_min(category, event_id) AS category
      FROM nation JOIN raw ON regexp_matches(line, '(^|[^a-z0-9_])' || lower(n_name) || '($|[^a-z0-9_])') GROUP BY 1)
SELECT n_name AS usecase, CAST(n_regionkey + 10 AS VARCHAR) || ':00' AS SLA, {FREQ} AS FREQ, f.category
FROM nation LEFT JOIN f ON n_name = f.k"""
SQL["dashboard_lines"] = f"""
WITH {LONG}, {MTD},
r AS (SELECT n_name AS usecase, CAST(n_regionkey + 10 AS VARCHAR) || ':00' AS SLA, {FREQ} AS FREQ, mtd, mtd_dl, c_mktsegment AS owner
      FROM mtd JOIN customer ON usecase = 'UC_' || CAST(c_custkey AS VARCHAR) JOIN nation ON c_nationkey = n_nationkey)
SELECT *, row_number() OVER (ORDER BY CAST(COALESCE(FREQ IN {MONTHLY}, FALSE) AS INTEGER), COALESCE(mtd, 0),
       concat_ws(',', usecase, SLA, FREQ, COALESCE(CAST(mtd AS VARCHAR), ''), COALESCE(CAST(mtd_dl AS VARCHAR), ''), owner)) AS position
FROM r"""
SQL["snapshot_as_of"] = f"""
WITH {LONG.replace("FROM events GROUP BY ALL", "FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20' GROUP BY ALL")}, {MTD}
SELECT 'raw' AS kind, concat_ws(',', 'UC_' || CAST(user_id AS VARCHAR), '10:00', 'DLY', strftime(ts, '%Y-%m-%d'),
         strftime(ts, '%H:%M:%S'), CAST(event_id AS VARCHAR),
         CASE WHEN event_type = 'click' THEN 'SUCCESS' WHEN event_type = 'purchase' THEN 'Success' ELSE 'FAILED' END, {CODE}) AS line,
       '20240120_2330' AS snapshot_ts
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-20'
UNION ALL
SELECT 'master', concat_ws(',', n_name, CAST(n_regionkey + 10 AS VARCHAR) || ':00', {FREQ}), '20240120_2330' FROM nation
UNION ALL
SELECT 'matrix', concat_ws(',', usecase, COALESCE(CAST(mtd AS VARCHAR), ''), COALESCE(CAST(mtd_dl AS VARCHAR), '')), '20240120_2330' FROM mtd"""
SQL["marker_listing"] = """
WITH k AS (SELECT s_suppkey, 's' || s_nationkey AS src, 'supplier' || s_suppkey AS tbl,
                  CASE WHEN s_suppkey % 3 <> 0 THEN 't' ELSE 'M' END AS indicator FROM supplier),
m AS (SELECT 'success-s' || s_nationkey || '-cc-supplier' || s_suppkey || '-20240130' AS marker FROM supplier WHERE s_suppkey % 2 = 0)
SELECT s_suppkey, src || '~cc~' || tbl || '~' || indicator AS process_key, indicator,
       indicator = 'M' OR EXISTS (SELECT 1 FROM m WHERE starts_with(marker, 'success-' || src || '-cc-' || tbl)) AS ready
FROM k"""
SQL["categorize_map_rows"] = f"""
WITH t AS (
  SELECT o.o_orderkey, o.o_custkey, CASE WHEN e.event_id IS NULL OR e.props IS NULL OR o.o_custkey IS NULL OR o.o_orderdate IS NULL
                                              OR o.o_totalprice IS NULL THEN 0 ELSE 1 END AS Var
  FROM orders o LEFT JOIN events e ON o.o_orderkey = e.event_id),
{DECISIONS},
l AS (SELECT user_id, et, COALESCE(list(udId ORDER BY udAcc DESC NULLS LAST, event_id) FILTER (WHERE udId IS NOT NULL), []) AS lst
      FROM g GROUP BY user_id, et),
v AS (SELECT DISTINCT user_id, et, cat_id FROM g),
r AS (
  SELECT v.*, list_concat([cat_id], lst) AS cand,
         CASE et WHEN 'click' THEN [cat_id, '42'] ELSE [] END AS decCat,
         CASE et WHEN 'view' THEN ['11', '12'] ELSE [] END AS best,
         CASE et WHEN 'signup' THEN ['77', cat_id] ELSE [] END AS bestId,
         CASE et WHEN 'view' THEN '{{}}'
                 WHEN 'purchase' THEN '{{"catId":"' || cat_id || '","score":"0.75"}}'
                 WHEN 'click' THEN '{{"catId":"' || cat_id || '","score":"0.25"}}'
                 ELSE '{{"catId":"' || cat_id || '"}}' END AS nextBest0,
         CASE et WHEN 'click' THEN [{{'i': cat_id, 's': '0.9'}}, {{'i': '3', 's': '0.5'}}]
                 WHEN 'purchase' THEN [{{'i': cat_id, 's': '0.4'}}] ELSE [NULL] END AS scores
  FROM v JOIN l USING (user_id, et)),
x AS (SELECT r.*, unnest(scores) AS score FROM r)
SELECT t.o_orderkey, t.Var, substr(et, 1, 1) AS subT_create,
       CASE WHEN et IN ('purchase', 'click') THEN 'P' WHEN et IS NOT NULL THEN 'O' END AS subT,
       CASE WHEN Var = 1 THEN COALESCE(array_to_string(list_filter(cand, lambda c, i: list_position(cand, c) = i), ','), '') END AS usDecCatId,
       CASE WHEN Var = 1 THEN COALESCE(array_to_string(list_sort(list_distinct(
            list_concat(list_concat(list_concat(cand, decCat), best), bestId))), ','), '') END AS setNext,
       CASE WHEN Var = 1 THEN COALESCE(array_to_string(best, ','), '') END AS nextBestCat1,
       CASE WHEN Var = 1 THEN COALESCE(x.nextBest0, '{{}}') END AS nextBest0,
       '{{"catId":"' || score.i || '","score":"' || score.s || '"}}' AS cat, score.i AS catId, score.s AS cat_wt, n_name AS catN
FROM t LEFT JOIN x ON t.o_custkey = x.user_id AND Var = 1 LEFT JOIN nation ON score.i = CAST(n_nationkey AS VARCHAR)"""
SQL["feed_stream"] = f"""
WITH b AS (
  SELECT CASE event_type WHEN 'view' THEN 'B' WHEN 'signup' THEN 'C' WHEN 'error' THEN 'C' ELSE 'A' END AS feed,
         CAST(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS BIGINT) AS batch_id,
         event_id, user_id, event_type, ts, CAST(floor(value / 50) AS INTEGER) - 1 AS amount FROM events),
t AS (SELECT *, event_id % 5 <> 0 AS ok FROM b
      QUALIFY rank() OVER (PARTITION BY feed, batch_id, user_id, event_type, amount ORDER BY ts DESC) = 1),
{DECISIONS},
{PER_ACCOUNT}
SELECT feed, batch_id, CAST(t.user_id AS VARCHAR) AS key, 't' || t.user_id AS tranId, amount, event_type AS tranText,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS msg_time,
       CASE WHEN feed = 'B' THEN ' ' WHEN ok THEN '1' ELSE '0' END AS isCat,
       CASE WHEN feed <> 'B' THEN CASE WHEN ok THEN d.cat_id END WHEN amount < 0 THEN '956' ELSE '953' END AS catId,
       CASE WHEN feed <> 'B' THEN CASE WHEN ok THEN n_name END WHEN amount < 0 THEN 'OP (T)' ELSE 'OI' END AS catN,
       CASE WHEN feed <> 'B' AND ok THEN COALESCE(array_to_string(list_filter(d.cand, lambda x, i: list_position(d.cand, x) = i), ','), '') END AS usDecCatId,
       CASE WHEN feed <> 'B' AND ok THEN upper(event_type) END AS counP_Name_TT
FROM t LEFT JOIN d ON t.user_id = d.user_id LEFT JOIN nation ON d.cat_id = CAST(n_nationkey AS VARCHAR)"""
SQL["categorize_batch"] = _categorize_sql(latest=False)
SQL["stream_categorize"] = _categorize_sql(latest=True)
