"""DuckDB oracle SQL for every registered query.

Written independently of the Spark code: the literal merge is stated as rules on what the
candidates offer each id, the corrected merge as per-source QUALIFY reductions.  Tables are the driver's
views: region nation customer supplier part orders lineitem events ….
"""

from __future__ import annotations


def _ts(d: int) -> str:
    return f"TIMESTAMP '2024-01-{d:02d} 00:00:00'"


def _run(d: int) -> str:
    return f"2024-01-{d:02d} 06:00:00"


def _rd(d: int) -> str:
    return f"DATE '2024-01-{d:02d}'"


BASE = """b AS (
  SELECT c.c_custkey AS k, c.c_name, n.n_name, c.c_mktsegment
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def oltp_customer(d: int, deletes: bool) -> str:
    if d == 1:
        sel = f"SELECT k AS id, c_name AS name, {_ts(1)} AS created_at, {_ts(1)} AS updated_at FROM b WHERE k % 20 <> 0"
    else:
        sel = f"""SELECT k AS id,
          CASE WHEN k % 20 <> 0 AND k % 29 = 0 THEN c_name || ' III'
               WHEN k % 20 <> 0 AND k % 23 = 0 THEN c_name || ' II' ELSE c_name END AS name,
          CASE WHEN k % 20 = 0 THEN {_ts(2)} ELSE {_ts(1)} END AS created_at,
          CASE WHEN k % 20 = 0 OR k % 29 = 0 OR k % 23 = 0 THEN {_ts(2)} ELSE {_ts(1)} END AS updated_at
        FROM b"""
    if not deletes:
        return sel
    gone = "id % 31 = 0" if d >= 3 else "FALSE"
    return f"""SELECT id, name, created_at,
        CASE WHEN {gone} THEN {_ts(3)} ELSE updated_at END AS updated_at,
        CASE WHEN {gone} THEN {_ts(3)} END AS deleted_at
      FROM ({sel})"""


def oltp_address(d: int) -> str:
    addr2 = """CASE WHEN k % 20 = 0 THEN n_name WHEN k % 29 = 0 THEN n_name || '_v9'
                    WHEN k % 7 = 0 THEN n_name || '_v2' ELSE n_name END"""
    upd2 = f"CASE WHEN k % 20 = 0 OR k % 29 = 0 OR k % 7 = 0 OR k % 13 = 0 THEN {_ts(2)} ELSE {_ts(1)} END"
    if d == 1:
        addr, upd, where = "n_name", _ts(1), "WHERE k % 20 <> 0"
    elif d == 2:
        addr, upd, where = addr2, upd2, ""
    else:
        addr = f"CASE WHEN k % 62 = 0 THEN n_name || '_v3' ELSE {addr2} END"
        upd = f"CASE WHEN k % 62 = 0 OR k % 7 = 0 THEN {_ts(3)} ELSE {upd2} END"
        where = ""
    return f"""SELECT k + 1000000 AS id, k AS cust_id, {addr} AS address,
        CASE WHEN k % 20 = 0 THEN {_ts(2)} ELSE {_ts(1)} END AS created_at, {upd} AS updated_at
      FROM b {where}"""


def oltp_payment(d: int) -> str:
    pm2 = "CASE WHEN k % 20 = 0 THEN c_mktsegment WHEN k % 29 = 0 THEN 'CARD' WHEN k % 11 = 0 THEN 'CASH' ELSE c_mktsegment END"
    upd2 = f"CASE WHEN k % 20 = 0 OR k % 29 = 0 OR k % 11 = 0 THEN {_ts(2)} ELSE {_ts(1)} END"
    if d == 1:
        pm, upd, where = "c_mktsegment", _ts(1), "WHERE k % 20 <> 0 AND k % 17 <> 0"
    else:
        where = "WHERE k % 20 = 0 OR k % 17 <> 0 OR k % 11 = 0 OR k % 29 = 0"
        if d == 2:
            pm, upd = pm2, upd2
        else:
            pm = f"CASE WHEN k % 41 = 0 THEN 'WIRE' ELSE {pm2} END"
            upd = f"CASE WHEN k % 41 = 0 THEN {_ts(3)} ELSE {upd2} END"
    return f"""SELECT k + 2000000 AS id, k AS cust_id, {pm} AS payment_method,
        CASE WHEN k % 20 = 0 OR k % 17 = 0 THEN {_ts(2)} ELSE {_ts(1)} END AS created_at, {upd} AS updated_at
      FROM b {where}"""


DELETED_ENTRIES = f"""de AS (
  SELECT k + 3000000 AS id, 'customer' AS table_name, k AS table_id, {_ts(3)} AS created_at, {_ts(3)} AS updated_at
  FROM b WHERE k % 37 = 0
  UNION ALL
  SELECT k + 6000000, 'customer_payment', k + 2000000, {_ts(3)}, {_ts(3)} FROM b WHERE k % 43 = 0)"""


def stages(prefix: str, days: int, deletes: bool = False) -> list[str]:
    """CTEs {prefix}_{c|a|p}{d}: day 1 full extract, later days above the carried high-water mark."""
    ctes = []
    for t, fn, cols in (
        ("c", lambda d: oltp_customer(d, deletes), "id, name, created_at, updated_at" + (", deleted_at" if deletes else "")),
        ("a", oltp_address, "id, cust_id, address, created_at, updated_at"),
        ("p", oltp_payment, "id, cust_id, payment_method, created_at, updated_at"),
    ):
        for d in range(1, days + 1):
            name = f"{prefix}_{t}{d}"
            if d == 1:
                ctes.append(f"{name} AS ({fn(1)})")
            else:
                marks = ", ".join(f"(SELECT max(updated_at) FROM {prefix}_{t}{e})" for e in range(d - 1, 0, -1))
                mark = f"coalesce({marks})" if d > 2 else marks
                ctes.append(f"{name} AS (SELECT {cols} FROM ({fn(d)}) WHERE updated_at > {mark})")
    return ctes


def _new_cols(id_expr: str, d: int) -> str:
    return (
        f"md5(CAST({id_expr} AS VARCHAR) || '{_run(d)}') AS etl_key"
    )


def full_transform(name: str, c: str, a: str, p: str, d: int, skip_deleted: bool = False) -> str:
    where = "WHERE c.deleted_at IS NULL" if skip_deleted else ""
    return f"""{name} AS (
  SELECT {_new_cols('c.id', d)}, c.id, c.name, ca.address, cp.payment_method,
         {_rd(d)} AS etl_start_date, DATE '9999-12-31' AS etl_end_date, 'Y' AS etl_current_ind,
         TIMESTAMP '{_run(d)}' AS etl_timestamp
  FROM {c} c LEFT JOIN {a} ca ON c.id = ca.cust_id LEFT JOIN {p} cp ON c.id = cp.cust_id {where})"""


def literal_temp(name: str, c: str, a: str, p: str, tgt: str, d: int, skip_deleted: bool = False) -> str:
    """Candidates: every staged customer with its children, and every different way in which the staged
    values of an id replace those of its current row (as lists of what each source offers an id)."""
    offers = " ".join(
        f"LEFT JOIN (SELECT {key} AS id, list({v}) AS {v}s FROM {src} GROUP BY 1) USING (id)"
        for src, key, v in ((c, "id", "name"), (a, "cust_id", "address"), (p, "cust_id", "payment_method"))
    )
    return full_transform(f"{name}_all", c, a, p, d, skip_deleted) + f""",
{name}_offers AS (
  SELECT id, name AS n0, address AS a0, payment_method AS p0, unnest(coalesce(names, [NULL])) AS n, addresss, payment_methods
  FROM (SELECT id, name, address, payment_method FROM {tgt} WHERE etl_current_ind = 'Y') {offers}),
{name}_ways AS (
  SELECT id, n0, a0, p0, n, unnest(coalesce(addresss, [NULL])) AS a, payment_methods FROM {name}_offers),
{name} AS (
  SELECT * FROM {name}_all
  UNION ALL
  SELECT DISTINCT {_new_cols('id', d)}, id, coalesce(n, n0), coalesce(a, a0), coalesce(p, p0),
         {_rd(d)}, DATE '9999-12-31', 'Y', TIMESTAMP '{_run(d)}'
  FROM (SELECT *, unnest(coalesce(payment_methods, [NULL])) AS p FROM {name}_ways)
  WHERE coalesce(n, a, p) IS NOT NULL)"""


def _apply_close(src: str, hit_sql: str, d: int) -> str:
    return f"""SELECT etl_key, id, name, address, payment_method, etl_start_date,
         CASE WHEN hit THEN {_rd(d)} - 1 ELSE etl_end_date END AS etl_end_date,
         CASE WHEN hit THEN 'N' ELSE etl_current_ind END AS etl_current_ind,
         CASE WHEN hit THEN TIMESTAMP '{_run(d)}' ELSE etl_timestamp END AS etl_timestamp
  FROM (SELECT t.*, ({hit_sql}) AS hit FROM {src} t)"""


def literal_merge(prefix: str, tgt: str, temp: str, d: int, extra_close_ids: str | None = None) -> list[str]:
    """Rules per id, as CTEs {prefix}_t1 (what is closed), {prefix}_nv and {prefix}_nk (what is added),
    {prefix} (all).  ``said`` is what an id's attributes say together, NULL if one is missing:

    * a current row is closed if the candidates offer its id anything that says something else;
    * a candidate is a new version if it says something else than the last closed row of its id;
    * a candidate is a new key if its id isn't in the dimension."""
    said = "(name || address || payment_method)"
    offered = f"""(SELECT x.*, offered FROM {tgt} x LEFT JOIN (
      SELECT id, list(DISTINCT {said}) FILTER ({said} IS NOT NULL) AS offered FROM {temp} GROUP BY id) o ON o.id = x.id)"""
    differs = f"t.etl_current_ind = 'Y' AND len(list_filter(t.offered, lambda o: o <> {said})) > 0"
    closed = f"{prefix}_t1"
    ctes = [f"{closed} AS ({_apply_close(offered, differs, d)})"]
    if extra_close_ids is not None:
        named = f"t.etl_current_ind = 'Y' AND t.id IN ({extra_close_ids})"
        ctes.append(f"{prefix}_t1x AS ({_apply_close(closed, named, d)})")
        closed = f"{prefix}_t1x"
    added = f"* REPLACE (TIMESTAMP '{_run(d)}' AS etl_timestamp)"
    ctes.append(f"""{prefix}_last AS (
  SELECT id, arg_max({{'said': {said}}}, (etl_timestamp, etl_start_date, etl_key)).said AS last
  FROM {closed} WHERE etl_current_ind = 'N' GROUP BY id)""")
    ctes.append(f"{prefix}_nv AS (SELECT {added} FROM {temp} WHERE {said} <> (SELECT last FROM {prefix}_last l WHERE l.id = {temp}.id))")
    ctes.append(f"{prefix}_nk AS (SELECT {added} FROM {temp} WHERE id NOT IN (SELECT id FROM {tgt}))")
    ctes.append(f"{prefix} AS (FROM {closed} UNION ALL FROM {prefix}_nv UNION ALL FROM {prefix}_nk)")
    return ctes


def corrected_merge(prefix: str, tgt: str, c: str, a: str, p: str, d: int, soft: bool = False, hard_ids: str | None = None) -> list[str]:
    """CTEs {prefix}_cls (classified candidates) and {prefix} (new dimension)."""
    deleted_at = "deleted_at" if soft else "CAST(NULL AS TIMESTAMP)"
    gone = "(sc.deleted_at IS NOT NULL)"
    if hard_ids is not None:
        gone = f"({gone} OR i.id IN (SELECT id FROM ({hard_ids})))"
    ctes = [
        f"""{prefix}_sc AS (SELECT id, name, {deleted_at} AS deleted_at FROM {c}
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, {deleted_at} DESC, name DESC) = 1)""",
        f"""{prefix}_sa AS (SELECT cust_id, address FROM {a}
  QUALIFY row_number() OVER (PARTITION BY cust_id ORDER BY updated_at DESC, id DESC) = 1)""",
        f"""{prefix}_sp AS (SELECT cust_id, payment_method FROM {p}
  QUALIFY row_number() OVER (PARTITION BY cust_id ORDER BY updated_at DESC, id DESC) = 1)""",
        f"""{prefix}_ids AS (SELECT id FROM {prefix}_sc UNION SELECT cust_id FROM {prefix}_sa UNION SELECT cust_id FROM {prefix}_sp)""",
        f"""{prefix}_pv AS (
  SELECT id, bool_or(etl_current_ind = 'Y') OVER (PARTITION BY id) AS has_cur, name, address, payment_method
  FROM {tgt} WHERE id IN (SELECT id FROM {prefix}_ids)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY (etl_current_ind = 'Y') DESC, etl_timestamp DESC,
                                               etl_start_date DESC, etl_key DESC) = 1)""",
        f"""{prefix}_cand AS (
  SELECT i.id, coalesce(sc.name, pv.name) AS name, coalesce(sa.address, pv.address) AS address,
         coalesce(sp.payment_method, pv.payment_method) AS payment_method,
         coalesce(pv.has_cur, FALSE) AS has_cur, {gone} AS del,
         pv.name AS p_name, pv.address AS p_address, pv.payment_method AS p_payment
  FROM {prefix}_ids i
  LEFT JOIN {prefix}_sc sc ON sc.id = i.id
  LEFT JOIN {prefix}_sa sa ON sa.cust_id = i.id
  LEFT JOIN {prefix}_sp sp ON sp.cust_id = i.id
  LEFT JOIN {prefix}_pv pv ON pv.id = i.id
  WHERE sc.id IS NOT NULL OR coalesce(pv.has_cur, FALSE))""",
        f"""{prefix}_cls AS (
  SELECT *, (NOT has_cur OR name IS DISTINCT FROM p_name OR address IS DISTINCT FROM p_address
             OR payment_method IS DISTINCT FROM p_payment) AS changed
  FROM {prefix}_cand)""",
    ]
    close_set = f"SELECT id FROM {prefix}_cls WHERE has_cur AND (changed OR del)"
    if hard_ids is not None:
        close_set += f" UNION SELECT id FROM ({hard_ids})"
    hit = f"t.etl_current_ind = 'Y' AND t.id IN ({close_set})"
    ctes.append(
        f"""{prefix} AS (
  {_apply_close(tgt, hit, d)}
  UNION ALL
  SELECT {_new_cols('id', d)}, id, name, address, payment_method, {_rd(d)} AS etl_start_date,
         DATE '9999-12-31' AS etl_end_date, 'Y' AS etl_current_ind, TIMESTAMP '{_run(d)}' AS etl_timestamp
  FROM {prefix}_cls WHERE changed AND NOT del)"""
    )
    return ctes


def corrected_temp(prefix: str, d: int) -> str:
    return f"""SELECT {_new_cols('id', d)}, id, name, address, payment_method, {_rd(d)} AS etl_start_date,
         DATE '9999-12-31' AS etl_end_date, 'Y' AS etl_current_ind, TIMESTAMP '{_run(d)}' AS etl_timestamp
  FROM {prefix}_cls WHERE changed AND NOT del"""


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _dims(mode: str, days: int, stage_days: int = 3) -> list[str]:
    """Stages s_* of days 1..stage_days, dimension states {L|C}{d} for d = 1..days."""
    ctes = [BASE] + stages("s", max(days, stage_days))
    m = "L" if mode == "literal" else "C"
    ctes.append(full_transform(f"{m}1", "s_c1", "s_a1", "s_p1", 1))
    for d in range(2, days + 1):
        if mode == "literal":
            ctes.append(literal_temp(f"tmp{d}", f"s_c{d}", f"s_a{d}", f"s_p{d}", f"{m}{d - 1}", d))
            ctes += literal_merge(f"{m}{d}", f"{m}{d - 1}", f"tmp{d}", d)
        else:
            ctes += corrected_merge(f"{m}{d}", f"{m}{d - 1}", f"s_c{d}", f"s_a{d}", f"s_p{d}", d)
    return ctes


def _deletes(mode: str, soft: bool) -> str:
    ctes = _dims(mode, 2) + stages("x", 3, deletes=True) + [DELETED_ENTRIES]
    m = "L" if mode == "literal" else "C"
    if mode == "literal":
        ctes.append(literal_temp("tmp3", "x_c3", "x_a3", "x_p3", f"{m}2", 3, skip_deleted=soft))
        if soft:
            ids = "SELECT id FROM x_c3 WHERE deleted_at IS NOT NULL"
        else:
            ids = "SELECT c.id FROM (SELECT table_id FROM de WHERE table_name = 'customer') d JOIN x_c3 c ON d.table_id = c.id"
        ctes += literal_merge("R", f"{m}2", "tmp3", 3, extra_close_ids=ids)
    elif soft:
        ctes += corrected_merge("R", f"{m}2", "x_c3", "x_a3", "x_p3", 3, soft=True)
    else:
        ctes += corrected_merge(
            "R", f"{m}2", "x_c3", "x_a3", "x_p3", 3, hard_ids="SELECT table_id AS id FROM de WHERE table_name = 'customer'"
        )
    return _with(ctes, "SELECT * FROM R")


DIM_COLS = "etl_key, id, name, address, payment_method, etl_start_date, etl_end_date, etl_current_ind, etl_timestamp"

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["extract_full"] = _with([BASE], oltp_customer(3, False))

ORACLE_SQL["extract_delta_events"] = """
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00')"""

ORACLE_SQL["extract_delta_ties"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00')"""

ORACLE_SQL["high_water_mark"] = """
SELECT 'orders' AS table_name, max(o_orderdate) AS max_updated FROM orders
UNION ALL SELECT 'events', max(ts) FROM events
UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem"""

ORACLE_SQL["hwm_upsert"] = """
WITH prior AS (
  SELECT 'orders' AS table_name, max(o_orderdate) AS max_updated FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
  UNION ALL SELECT 'events', max(ts) FROM events
  UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01 00:00:00'
  UNION ALL SELECT 'events_' || event_type, max(ts) FROM events GROUP BY event_type),
new AS (
  SELECT 'orders' AS table_name, max(o_orderdate) AS max_updated FROM orders
    WHERE o_orderdate > (SELECT max_updated FROM prior WHERE table_name = 'orders')
  UNION ALL SELECT 'events', max(ts) FROM events WHERE ts > (SELECT max_updated FROM prior WHERE table_name = 'events')
  UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem
    WHERE l_shipdate > (SELECT max_updated FROM prior WHERE table_name = 'lineitem'))
SELECT coalesce(prior.table_name, new.table_name) AS table_name, coalesce(new.max_updated, prior.max_updated) AS max_updated
FROM prior FULL JOIN new ON prior.table_name = new.table_name"""

ORACLE_SQL["full_transform_all"] = _with(
    _dims("corrected", 1)
    + [
        f"f_c AS ({oltp_customer(3, False)})",
        f"f_a AS ({oltp_address(3)})",
        f"f_p AS ({oltp_payment(3)})",
        full_transform("F3", "f_c", "f_a", "f_p", 3),
    ],
    f"SELECT {DIM_COLS} FROM F3",
)
ORACLE_SQL["full_transform"] = ORACLE_SQL["full_transform_all"]
# whichever the cutoff, a table's mark ends at its largest value
ORACLE_SQL["hwm_upsert_all"] = ORACLE_SQL["high_water_mark"]
ORACLE_SQL["delta_transform_literal"] = _with(
    _dims("literal", 1) + [literal_temp("tmp2", "s_c2", "s_a2", "s_p2", "L1", 2)], "SELECT * FROM tmp2"
)
ORACLE_SQL["delta_transform_corrected"] = _with(
    _dims("corrected", 1) + corrected_merge("C2", "C1", "s_c2", "s_a2", "s_p2", 2), corrected_temp("C2", 2)
)

ORACLE_SQL["latest_per_key"] = """
SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""

ORACLE_SQL["children_latest"] = """
SELECT event_id, ts, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

_LIT2 = _dims("literal", 1) + [literal_temp("tmp2", "s_c2", "s_a2", "s_p2", "L1", 2)] + literal_merge("L2", "L1", "tmp2", 2)
ORACLE_SQL["scd2_close"] = _with(_LIT2, "SELECT * FROM L2_t1")
ORACLE_SQL["scd2_new_versions"] = _with(_LIT2, "SELECT * FROM L2_nv")
ORACLE_SQL["scd2_new_keys"] = _with(_LIT2, "SELECT * FROM L2_nk")
ORACLE_SQL["scd2_literal"] = _with(_dims("literal", 3), "SELECT * FROM L3")
ORACLE_SQL["scd2_corrected"] = _with(_dims("corrected", 3), "SELECT * FROM C3")

ORACLE_SQL["full_load_refresh"] = _with(
    _dims("corrected", 2)
    + [
        f"f_c AS ({oltp_customer(3, False)})",
        f"f_a AS ({oltp_address(3)})",
        f"f_p AS ({oltp_payment(3)})",
        full_transform("F3", "f_c", "f_a", "f_p", 3),
    ],
    f"SELECT {DIM_COLS}, 'current' AS generation FROM F3 UNION ALL SELECT {DIM_COLS}, 'backup' AS generation FROM C2",
)

ORACLE_SQL["soft_delete_literal"] = _deletes("literal", soft=True)
ORACLE_SQL["soft_delete_corrected"] = _deletes("corrected", soft=True)
ORACLE_SQL["hard_delete_literal"] = _deletes("literal", soft=False)
ORACLE_SQL["hard_delete_corrected"] = _deletes("corrected", soft=False)

# The pipeline queries run the same three days through extraction, landing, staging and the
# store; their result is the dimension after day 3.
ORACLE_SQL["pipeline_corrected"] = ORACLE_SQL["scd2_corrected"]
ORACLE_SQL["pipeline_literal"] = ORACLE_SQL["scd2_literal"]

ORACLE_SQL["scd2_as_of"] = _with(
    _dims("corrected", 3),
    """SELECT id, name, address, payment_method, etl_start_date, etl_end_date FROM C3
WHERE etl_start_date <= DATE '2024-01-02' AND etl_end_date >= DATE '2024-01-02'""",
)

_NULLED_ORDERS = "(SELECT CASE WHEN o_orderkey % 1000 <> 0 THEN o_orderkey END AS o_orderkey FROM orders)"

ORACLE_SQL["dq_metrics"] = f"""
SELECT 'orders' AS table_name, count(*) AS total_count,
       CAST(sum(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count
FROM {_NULLED_ORDERS}"""

ORACLE_SQL["dq_gate"] = f"""
WITH m AS (
  SELECT 'orders' AS table_name, count(*) AS total_count,
         CAST(sum(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count FROM {_NULLED_ORDERS}
  UNION ALL
  SELECT 'lineitem', count(*), CAST(sum(CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM lineitem
  UNION ALL
  SELECT 'supplier', count(*), CAST(sum(CASE WHEN s_suppkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM supplier
  UNION ALL
  SELECT 'orders_delta', count(*), CAST(sum(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT)
  FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders))
SELECT table_name, total_count, null_count,
       CASE WHEN total_count > 0 AND coalesce(null_count, 0) < 10 THEN 'load_target' ELSE 'notify' END AS route
FROM m"""

ORACLE_SQL["gated_append"] = """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_nationkey < 12
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
WHERE s_nationkey >= 12
  AND (SELECT count(*) > 0 AND coalesce(sum(CASE WHEN s_suppkey IS NULL THEN 1 ELSE 0 END), 0) < 10
       FROM supplier WHERE s_nationkey >= 12)"""

ORACLE_SQL["file_arrival_ingest"] = """
SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS name, s_acctbal AS amount
FROM supplier WHERE s_nationkey IS NOT NULL"""

ORACLE_SQL["order_total"] = """
WITH docs AS (
  SELECT event_type, json_transform(props, '"MAP(VARCHAR, DOUBLE)"') AS m FROM events),
vals AS (
  SELECT event_type, CASE WHEN m IS NULL THEN NULL ELSE coalesce(list_sum(map_values(m)), 0.0) END AS v FROM docs)
SELECT event_type, count(*) AS n_documents, round(sum(v), 2) AS total_order_value,
       printf('Total order value is: %.2f', sum(v)) AS message
FROM vals GROUP BY event_type"""

ORACLE_SQL["calendar_activity"] = """
WITH dim(day, is_weekday, activity) AS (VALUES
  ('monday', TRUE, 'guitar lessons'), ('tuesday', TRUE, 'studying'), ('wednesday', TRUE, 'soccer practice'),
  ('thursday', TRUE, 'contributing to Airflow'), ('friday', TRUE, 'family dinner'),
  ('saturday', FALSE, 'going to the beach'), ('sunday', FALSE, 'sleeping in')),
o AS (SELECT lower(dayname(o_orderdate)) AS day, o_totalprice FROM orders)
SELECT o.day, dim.is_weekday, dim.activity,
       CASE WHEN dim.is_weekday THEN 'weekday_activities.' ELSE 'weekend_activities.' END || replace(dim.activity, ' ', '_') AS activity_id,
       'It''s ' || upper(substr(o.day, 1, 1)) || substr(o.day, 2) || ' and I''m busy with ' || dim.activity || '.' AS message,
       count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
FROM o LEFT JOIN dim ON o.day = dim.day
GROUP BY ALL"""

ORACLE_SQL["invitation_text"] = """
SELECT n_nationkey, n_name, 'Beach day!' AS subject,
       'It''s Saturday and I''m heading to the beach.<br>Come join me!' AS body,
       '<title>Beach day!</title><p>It''s Saturday and I''m heading to the beach.<br>Come join me!</p>' AS html
FROM nation"""

ORACLE_SQL["weekend_split"] = """
SELECT dayofweek(o_orderdate) IN (0, 6) AS is_weekend, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
FROM orders GROUP BY 1"""

ORACLE_SQL["extract_overlap"] = """
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00') - INTERVAL 1 DAY"""

ORACLE_SQL["csv_landing_roundtrip"] = """
SELECT doc_id,
       CASE doc_id % 6 WHEN 0 THEN '  ' || text || ' ' || chr(9)
                       WHEN 1 THEN '"' || text || '", ""x""'
                       WHEN 2 THEN ''
                       WHEN 3 THEN NULL
                       WHEN 4 THEN text || chr(13) || chr(10) || ', ' || chr(13) || ' end' || chr(10)
                       ELSE text END AS note,
       make_timestamp(doc_id * 7919000001) AS updated_at, lang
FROM documents"""

ORACLE_SQL["csv_ingest_rows"] = """
SELECT s_suppkey::INTEGER AS id, s_name AS name, s_acctbal AS amount FROM supplier"""

ORACLE_SQL["gated_ingest_files"] = """
SELECT CASE WHEN s_nationkey < 12 THEN s_suppkey::INTEGER END AS id, s_name AS name, s_acctbal AS amount,
       CASE WHEN s_nationkey < 12 THEN 'target' ELSE 'stage' END AS place
FROM supplier"""

ORACLE_SQL["file_arrival_gated"] = """
SELECT s_suppkey::INTEGER AS id, s_name AS name,
       CASE WHEN s_nationkey % 5 <> 0 THEN 'load_target' ELSE 'notify' END AS route
FROM supplier"""

ORACLE_SQL["as_of_pruned"] = ORACLE_SQL["scd2_as_of"]

# Every child is there on day 1; customers k % 20 = 0 come on day 2, as do some new names.
ORACLE_SQL["late_parent"] = f"""
WITH {BASE},
v AS (
  SELECT k AS id, c_name AS name, n_name AS address, c_mktsegment AS payment_method,
         CASE WHEN k % 20 = 0 THEN 2 ELSE 1 END AS first,
         CASE WHEN k % 20 = 0 THEN NULL WHEN k % 29 = 0 THEN c_name || ' III' WHEN k % 23 = 0 THEN c_name || ' II' END AS later
  FROM b),
d AS (
  SELECT id, name, address, payment_method, first, later IS NOT NULL AS over FROM v
  UNION ALL SELECT id, later, address, payment_method, 2, FALSE FROM v WHERE later IS NOT NULL)
SELECT id, name, address, payment_method, make_date(2024, 1, first) AS etl_start_date,
       CASE WHEN over THEN {_rd(1)} ELSE DATE '9999-12-31' END AS etl_end_date, CASE WHEN over THEN 'N' ELSE 'Y' END AS etl_current_ind
FROM d"""

_TWO = f"""{BASE},
a AS (SELECT k, n_name AS v, k % 3 AS h, 1 AS r FROM b UNION ALL SELECT k, n_name || ' annex', 1, 2 FROM b),
p AS (SELECT k, c_mktsegment AS v, k % 2 AS h, 1 AS r FROM b UNION ALL SELECT k, 'CASH', 0, 2 FROM b)"""

ORACLE_SQL["children_fanout_literal"] = f"""
WITH {_TWO}
SELECT b.k AS id, c_name AS name, a.v AS address, p.v AS payment_method FROM b JOIN a ON a.k = b.k JOIN p ON p.k = b.k"""

ORACLE_SQL["children_reduced_corrected"] = f"""
WITH {_TWO}
SELECT k AS id, c_name AS name, (SELECT arg_max(v, (h, r)) FROM a WHERE a.k = b.k) AS address,
       (SELECT arg_max(v, (h, r)) FROM p WHERE p.k = b.k) AS payment_method FROM b"""

ORACLE_SQL["deleted_entries_delta"] = _with([BASE, DELETED_ENTRIES], "SELECT id, table_name, table_id, created_at, updated_at FROM de")

ORACLE_SQL["csv_reordered"] = ORACLE_SQL["csv_ingest_rows"]
ORACLE_SQL["file_replaced_stream"] = ORACLE_SQL["csv_ingest_rows"]

ORACLE_SQL["dq_running"] = """
WITH loads AS (SELECT (s_nationkey % 3)::INTEGER AS load, count(*) AS n, count(*) FILTER (s_suppkey % 7 = 0) AS nulls FROM supplier GROUP BY 1),
running AS (SELECT load, sum(n) OVER (ORDER BY load)::BIGINT AS total_count, sum(nulls) OVER (ORDER BY load)::BIGINT AS null_count FROM loads)
SELECT *, CASE WHEN total_count > 0 AND null_count < 10 THEN 'load_target' ELSE 'notify' END AS route FROM running"""
