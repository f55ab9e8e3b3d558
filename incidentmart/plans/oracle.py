"""Independent SQL answers for the registered queries (DuckDB dialect).

Written by hand from the query definitions, not generated from the Spark
code; tables are the driver's pre-registered views.  Ratios use integer
arithmetic so they round half away from zero exactly:
``sign(a) * ((2*|a|*m*S + b) // (2*b)) / S`` for ``round(m*a/b, n)``, S = 10^n.
"""

from __future__ import annotations


def years_cte(table: str, column: str) -> str:
    """CTE ``cal``: every day of the calendar years that a table's dates touch."""
    return f"""
bounds AS (SELECT min(CAST({column} AS DATE)) AS lo, max(CAST({column} AS DATE)) AS hi FROM {table}),
cal AS (
    SELECT CAST(t.d AS DATE) AS full_date
    FROM bounds, generate_series(make_date(year(bounds.lo), 1, 1),
                                 make_date(year(bounds.hi), 12, 31), INTERVAL 1 DAY) AS t(d)
)"""


def dim_date_cte(name: str) -> str:
    """Date dimension CTE over the CTE ``cal``."""
    return f"""
{name} AS (
    SELECT
        CAST(strftime(full_date, '%Y%m%d') AS BIGINT) AS date_key,
        full_date,
        CAST(year(full_date) AS BIGINT) AS anio,
        CAST(quarter(full_date) AS BIGINT) AS trimestre,
        CAST(month(full_date) AS BIGINT) AS mes_numero,
        CASE month(full_date)
            WHEN 1 THEN 'Enero' WHEN 2 THEN 'Febrero' WHEN 3 THEN 'Marzo'
            WHEN 4 THEN 'Abril' WHEN 5 THEN 'Mayo' WHEN 6 THEN 'Junio'
            WHEN 7 THEN 'Julio' WHEN 8 THEN 'Agosto' WHEN 9 THEN 'Septiembre'
            WHEN 10 THEN 'Octubre' WHEN 11 THEN 'Noviembre' WHEN 12 THEN 'Diciembre'
        END AS mes_nombre,
        CAST(day(full_date) AS BIGINT) AS dia_mes,
        CAST(isodow(full_date) AS BIGINT) AS dia_semana_numero,
        CASE isodow(full_date)
            WHEN 1 THEN 'Lunes' WHEN 2 THEN 'Martes' WHEN 3 THEN 'Miércoles'
            WHEN 4 THEN 'Jueves' WHEN 5 THEN 'Viernes' WHEN 6 THEN 'Sábado'
            WHEN 7 THEN 'Domingo'
        END AS dia_semana_nombre,
        isodow(full_date) IN (6, 7) AS es_fin_semana
    FROM cal
)"""


DIM_DATE_CTE = years_cte("events", "ts") + "," + dim_date_cte("dim_fecha")

DIM_TIME_CTE = """
hm AS (
    SELECT h.h, m.m FROM range(0, 24) AS h(h) CROSS JOIN range(0, 60) AS m(m)
), dim_tiempo AS (
    SELECT CAST(h * 100 + m AS BIGINT) AS time_key, CAST(h AS BIGINT) AS hora,
           CAST(m AS BIGINT) AS minuto,
           lpad(CAST(h AS VARCHAR), 2, '0') || ':' || lpad(CAST(m AS VARCHAR), 2, '0') AS hora_texto,
           CASE WHEN h BETWEEN 0 AND 5 THEN 'Madrugada'
                WHEN h BETWEEN 6 AND 11 THEN 'Mañana'
                WHEN h BETWEEN 12 AND 17 THEN 'Tarde'
                ELSE 'Noche' END AS banda_horaria
    FROM hm
    UNION ALL
    SELECT -1, -1, -1, 'Sin esp.', 'Sin especificar'
)"""

EVENTS_FACT_CTE = """
ev AS (
    SELECT *, CAST(strftime(CAST(ts AS DATE), '%Y%m%d') AS BIGINT) AS date_key,
           CASE WHEN hour(ts) BETWEEN 0 AND 23 AND minute(ts) BETWEEN 0 AND 59
                THEN hour(ts) * 100 + minute(ts) ELSE -1 END AS time_key,
           1 AS num_events,
           CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_error,
           CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_purchase
    FROM events
)"""

ORDERS_MEASURES = """COUNT(*) AS total_orders,
           SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS total_urgent,
           SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS total_finished"""

EVENT_SUMS = """CAST(SUM(num_events) AS BIGINT) AS total_events,
           CAST(SUM(is_error) AS BIGINT) AS total_errors,
           CAST(SUM(is_purchase) AS BIGINT) AS total_purchases"""

BAND_ORD = """CASE banda_horaria WHEN 'Madrugada' THEN 1 WHEN 'Mañana' THEN 2
        WHEN 'Tarde' THEN 3 WHEN 'Noche' THEN 4 ELSE 5 END"""


def rounded(a: str, b: str, scale: int, mult: int = 1) -> str:
    """round(mult * a / b, scale), half away from zero, NULL when b = 0."""
    s = 10 ** scale
    return (f"CASE WHEN ({b}) = 0 OR ({b}) IS NULL OR ({a}) IS NULL THEN NULL ELSE "
            f"CAST(sign({a}) * ((2 * abs({a}) * {mult * s} + ({b})) // (2 * ({b}))) AS DOUBLE) / {s} END")


ORDERS_BASE_CTE = """
ob AS (
    SELECT o.o_orderkey, o.o_orderstatus, o.o_orderpriority,
           CAST(strftime(CAST(o.o_orderdate AS DATE), '%Y%m%d') AS BIGINT) AS date_key,
           1 AS num_orders,
           CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_urgent,
           CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_finished,
           n.n_nationkey, r.r_name, n.n_name, c.c_mktsegment
    FROM orders o
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

KEYED_CTE = """
loc AS (
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY n_nationkey, r_name, n_name, c_mktsegment) AS BIGINT) AS location_key, *
    FROM (SELECT DISTINCT n_nationkey, r_name, n_name, c_mktsegment FROM ob
          WHERE n_nationkey IS NOT NULL AND r_name IS NOT NULL AND n_name IS NOT NULL AND c_mktsegment IS NOT NULL)
), des AS (
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY o_orderstatus, o_orderpriority) AS BIGINT) AS descriptor_key, *
    FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM ob
          WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL)
), pro AS (
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY c_mktsegment, o_orderpriority) AS BIGINT) AS profile_key, *
    FROM (SELECT DISTINCT c_mktsegment, o_orderpriority FROM ob
          WHERE c_mktsegment IS NOT NULL AND o_orderpriority IS NOT NULL)
), fk AS (
    SELECT CAST(o_orderkey AS BIGINT) AS source_row_id, date_key, loc.location_key, des.descriptor_key,
           pro.profile_key, CAST(num_orders AS BIGINT) AS num_orders,
           CAST(is_urgent AS BIGINT) AS is_urgent, CAST(is_finished AS BIGINT) AS is_finished, ob.n_name
    FROM ob
    LEFT JOIN loc ON ob.n_nationkey = loc.n_nationkey AND ob.r_name = loc.r_name
                 AND ob.n_name = loc.n_name AND ob.c_mktsegment = loc.c_mktsegment
    LEFT JOIN des ON ob.o_orderstatus = des.o_orderstatus AND ob.o_orderpriority = des.o_orderpriority
    LEFT JOIN pro ON ob.c_mktsegment = pro.c_mktsegment AND ob.o_orderpriority = pro.o_orderpriority
)"""

STAR_CTE = ORDERS_BASE_CTE + "," + KEYED_CTE

ORACLE: dict[str, str] = {}

ORACLE["dim_date"] = f"WITH {DIM_DATE_CTE} SELECT * FROM dim_fecha"

ORACLE["dim_time"] = f"""WITH {DIM_TIME_CTE},
per AS (
    SELECT CASE WHEN hour(ts) BETWEEN 0 AND 23 AND minute(ts) BETWEEN 0 AND 59
                THEN hour(ts) * 100 + minute(ts) ELSE -1 END AS time_key,
           COUNT(*) AS n
    FROM events GROUP BY 1
)
SELECT t.*, CAST(COALESCE(per.n, 0) AS BIGINT) AS event_count
FROM dim_tiempo t LEFT JOIN per ON per.time_key = t.time_key"""

ORACLE["insert_if_absent"] = f"""WITH {DIM_DATE_CTE},
first_month AS (
    SELECT f.* FROM dim_fecha f, bounds
    WHERE year(f.full_date) = year(bounds.lo) AND month(f.full_date) = month(bounds.lo)
)
SELECT * FROM first_month
UNION ALL
SELECT * FROM dim_fecha WHERE date_key NOT IN (SELECT date_key FROM first_month)"""

ORACLE["entity_ranking"] = f"""WITH {EVENTS_FACT_CTE},
agg AS (
    SELECT n.n_name, {EVENT_SUMS}
    FROM ev JOIN customer c ON ev.user_id = c.c_custkey
            JOIN nation n ON c.c_nationkey = n.n_nationkey
            JOIN region r ON n.n_regionkey = r.r_regionkey
    GROUP BY n.n_name
), top AS (
    SELECT * FROM agg ORDER BY total_events DESC, n_name ASC LIMIT 10
)
SELECT CAST(RANK() OVER (ORDER BY total_events DESC) AS BIGINT) AS ranking, n_name,
       total_events, total_errors, total_purchases,
       {rounded('total_errors', 'total_events', 4)} AS errors_per_event,
       {rounded('total_purchases', 'total_events', 4)} AS purchases_per_event
FROM top"""

ORACLE["month_trend"] = f"""WITH m AS (
    SELECT CAST(month(o_orderdate) AS BIGINT) AS mes_numero,
           CASE month(o_orderdate)
               WHEN 1 THEN 'Enero' WHEN 2 THEN 'Febrero' WHEN 3 THEN 'Marzo'
               WHEN 4 THEN 'Abril' WHEN 5 THEN 'Mayo' WHEN 6 THEN 'Junio'
               WHEN 7 THEN 'Julio' WHEN 8 THEN 'Agosto' WHEN 9 THEN 'Septiembre'
               WHEN 10 THEN 'Octubre' WHEN 11 THEN 'Noviembre' WHEN 12 THEN 'Diciembre'
           END AS mes_nombre,
           {ORDERS_MEASURES}
    FROM orders
    GROUP BY 1, 2
), l AS (
    SELECT *, LAG(total_orders) OVER (ORDER BY mes_numero) AS prev FROM m
)
SELECT mes_numero, mes_nombre, CAST(total_orders AS BIGINT) AS total_orders,
       CAST(total_urgent AS BIGINT) AS total_urgent, CAST(total_finished AS BIGINT) AS total_finished,
       CAST(prev AS BIGINT) AS prev_total_orders,
       CAST(total_orders - prev AS BIGINT) AS change_orders,
       {rounded('(total_orders - prev)', 'prev', 2, 100)} AS pct_change_orders
FROM l"""

MOVING_CTE = f"""d AS (
    SELECT CAST(o_orderdate AS DATE) AS full_date, COUNT(*) AS total_orders
    FROM orders
    GROUP BY 1
), w AS (
    SELECT *, SUM(total_orders) OVER win AS s, COUNT(total_orders) OVER win AS c
    FROM d WINDOW win AS (ORDER BY full_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
), ma AS (
    SELECT full_date, CAST(total_orders AS BIGINT) AS total_orders,
           {rounded('s', 'c', 2)} AS moving_avg_7
    FROM w
)"""

ORACLE["moving_average_7"] = f"WITH {MOVING_CTE} SELECT * FROM ma"

ORACLE["series_long"] = f"""WITH {MOVING_CTE}
SELECT full_date, 'total_orders' AS variable, CAST(total_orders AS DOUBLE) AS value FROM ma
UNION ALL
SELECT full_date, 'moving_avg_7', moving_avg_7 FROM ma"""

ORACLE["weekday_band_profile"] = f"""WITH {DIM_DATE_CTE}, {DIM_TIME_CTE}, {EVENTS_FACT_CTE},
prof AS (
    SELECT d.dia_semana_numero, d.dia_semana_nombre, t.banda_horaria, {EVENT_SUMS}
    FROM ev JOIN dim_fecha d ON ev.date_key = d.date_key
            JOIN dim_tiempo t ON ev.time_key = t.time_key
    GROUP BY d.dia_semana_numero, d.dia_semana_nombre, t.banda_horaria
)
SELECT *, CAST({BAND_ORD} AS BIGINT) AS banda_orden FROM prof"""

ORACLE["weekday_band_matrix"] = f"""WITH {DIM_DATE_CTE}, {DIM_TIME_CTE}, {EVENTS_FACT_CTE},
prof AS (
    SELECT d.dia_semana_numero, t.banda_horaria, SUM(num_events) AS total_events
    FROM ev JOIN dim_fecha d ON ev.date_key = d.date_key
            JOIN dim_tiempo t ON ev.time_key = t.time_key
    GROUP BY d.dia_semana_numero, t.banda_horaria
), weekdays(dia_semana_numero, dia_semana_nombre) AS (
    VALUES (1, 'Lunes'), (2, 'Martes'), (3, 'Miércoles'), (4, 'Jueves'),
           (5, 'Viernes'), (6, 'Sábado'), (7, 'Domingo')
)
SELECT CAST(weekdays.dia_semana_numero AS BIGINT) AS dia_semana_numero, weekdays.dia_semana_nombre,
       CAST(MAX(CASE WHEN banda_horaria = 'Madrugada' THEN total_events END) AS BIGINT) AS "Madrugada",
       CAST(MAX(CASE WHEN banda_horaria = 'Mañana' THEN total_events END) AS BIGINT) AS "Mañana",
       CAST(MAX(CASE WHEN banda_horaria = 'Tarde' THEN total_events END) AS BIGINT) AS "Tarde",
       CAST(MAX(CASE WHEN banda_horaria = 'Noche' THEN total_events END) AS BIGINT) AS "Noche",
       CAST(MAX(CASE WHEN banda_horaria = 'Sin especificar' THEN total_events END) AS BIGINT) AS "Sin especificar"
FROM weekdays LEFT JOIN prof ON prof.dia_semana_numero = weekdays.dia_semana_numero
GROUP BY weekdays.dia_semana_numero, weekdays.dia_semana_nombre"""

TOP_MEMBERS_CTE = f"""agg AS (
    SELECT r.r_name, n.n_name, {ORDERS_MEASURES}
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                  JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey
    GROUP BY r.r_name, n.n_name
), rk AS (
    SELECT r_name, n_name, CAST(total_orders AS BIGINT) AS total_orders,
           CAST(total_urgent AS BIGINT) AS total_urgent,
           CAST(total_finished AS BIGINT) AS total_finished,
           CAST(ROW_NUMBER() OVER (PARTITION BY r_name ORDER BY total_orders DESC, n_name ASC) AS BIGINT)
               AS rank_in_region
    FROM agg
), top3 AS (SELECT * FROM rk WHERE rank_in_region <= 3)"""

ORACLE["top_members_per_group"] = f"WITH {TOP_MEMBERS_CTE} SELECT * FROM top3"

ORACLE["drilldown"] = f"WITH {TOP_MEMBERS_CTE} SELECT * FROM top3 WHERE r_name = 'AMERICA'"

ORACLE["group_list"] = f"WITH {TOP_MEMBERS_CTE} SELECT DISTINCT r_name FROM top3"

SHARE_SQL = f"""WITH {EVENTS_FACT_CTE},
agg AS (SELECT event_type, {EVENT_SUMS} FROM ev GROUP BY event_type),
tot AS (SELECT *, SUM(total_events) OVER () AS t FROM agg)
SELECT event_type, total_events, total_errors, total_purchases,
       {rounded('total_events', 't', 2, 100)} AS pct_events
FROM tot"""

ORACLE["share_of_total"] = SHARE_SQL

ORACLE["mart_round_trip"] = SHARE_SQL

ORACLE["measure_ranking"] = """WITH s AS (
    SELECT SUM(CAST(l_quantity AS BIGINT)) AS q, SUM(CAST(l_linenumber AS BIGINT)) AS ln,
           SUM(CAST(round(l_discount * 100) AS BIGINT)) AS d,
           SUM(CAST(round(l_tax * 100) AS BIGINT)) AS t
    FROM lineitem
), u AS (
    SELECT 'quantity' AS measure, q AS total FROM s
    UNION ALL SELECT 'line_number', ln FROM s
    UNION ALL SELECT 'discount_pct', d FROM s
    UNION ALL SELECT 'tax_pct', t FROM s
)
SELECT measure, CAST(total AS BIGINT) AS total,
       CAST(RANK() OVER (ORDER BY total DESC NULLS FIRST) AS BIGINT) AS ranking
FROM u"""

ORACLE["kpi"] = f"""WITH {EVENTS_FACT_CTE}
SELECT CAST(COUNT(*) AS BIGINT) AS fact_rows, CAST(SUM(num_events) AS BIGINT) AS total_events,
       COALESCE(format('{{:,}}', CAST(SUM(num_events) AS BIGINT)), '0') AS total_events_text
FROM ev"""

ORACLE["kpi_severity"] = f"""WITH {EVENTS_FACT_CTE}
SELECT CAST(COUNT(*) AS BIGINT) AS fact_rows, {EVENT_SUMS},
       COALESCE(format('{{:,}}', CAST(SUM(num_events) AS BIGINT)), '0') AS total_events_text,
       COALESCE(format('{{:,}}', CAST(SUM(is_error) AS BIGINT)), '0') AS total_errors_text,
       COALESCE(format('{{:,}}', CAST(SUM(is_purchase) AS BIGINT)), '0') AS total_purchases_text
FROM ev"""

ORACLE["profile_of_severe"] = f"""WITH {EVENTS_FACT_CTE}
SELECT c.c_mktsegment, {EVENT_SUMS}
FROM ev JOIN customer c ON ev.user_id = c.c_custkey
WHERE ev.event_type IN ('error', 'purchase')
GROUP BY c.c_mktsegment"""

TOKENS = ", ".join("'" + t + "'" for t in [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"])

STRIP = r"regexp_replace(raw, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g')"

ORACLE["clean_text"] = f"""WITH r AS (
    SELECT event_id,
           CASE event_id % 11
               WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   ' WHEN 3 THEN 'NA'
               WHEN 4 THEN '  ' || event_type || ' '
               WHEN 5 THEN chr(9) || event_type
               WHEN 6 THEN event_type || chr(160)
               WHEN 7 THEN 'null'
               WHEN 8 THEN ' NA ' || event_type
               ELSE event_type END AS raw
    FROM events
)
SELECT event_id,
       CASE WHEN raw IS NULL OR raw IN ({TOKENS}) THEN 'Sin especificar'
            WHEN {STRIP} = '' THEN 'Sin especificar'
            ELSE {STRIP} END AS clean_value
FROM r"""

ORACLE["coerce_numeric"] = """WITH r AS (
    SELECT event_id,
           CASE event_id % 17
               WHEN 0 THEN NULL WHEN 1 THEN 'x'
               WHEN 2 THEN ' ' || CAST(value AS VARCHAR) || ' '
               WHEN 3 THEN '-' || CAST(value AS VARCHAR)
               WHEN 4 THEN '3d' WHEN 5 THEN '0x1p3' WHEN 6 THEN '9007199254740993'
               WHEN 7 THEN '3f' WHEN 8 THEN '-.5e1'
               ELSE CAST(value AS VARCHAR) END AS raw
    FROM events
)
SELECT event_id, COALESCE(CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+') THEN TRY_CAST(trim(raw) AS BIGINT)
                               ELSE CAST(trunc(TRY_CAST(trim(raw) AS DOUBLE)) AS BIGINT) END, 0) AS value_int
FROM r"""

ORACLE["parse_date"] = """WITH p AS (
    SELECT event_id,
           CASE WHEN event_id % 13 = 0 THEN 2023 ELSE year(ts) END AS y,
           CASE WHEN event_id % 19 = 0 THEN 0 WHEN event_id % 5 = 0 THEN 2 ELSE month(ts) END AS m,
           CASE WHEN event_id % 17 = 0 THEN 30 WHEN event_id % 3 = 0 THEN 29 ELSE day(ts) END AS d
    FROM events
), v AS (
    SELECT *, CASE WHEN m BETWEEN 1 AND 12 AND d >= 1
                    AND d <= day(last_day(make_date(y, greatest(least(m, 12), 1), 1)))
                   THEN make_date(y, greatest(least(m, 12), 1), greatest(least(d, 28), 1)) + CAST(d - greatest(least(d, 28), 1) AS INTEGER)
              END AS parsed
    FROM p
)
SELECT event_id, CAST(y AS BIGINT) AS y, CAST(m AS BIGINT) AS m, CAST(d AS BIGINT) AS d,
       CAST(parsed AS DATE) AS parsed_date, parsed IS NOT NULL AS is_valid
FROM v"""

ORACLE["time_key_rules"] = f"""WITH {DIM_TIME_CTE}, r AS (
    SELECT event_id,
           CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 9 = 1 THEN 99 ELSE hour(ts) END AS h,
           CASE WHEN event_id % 8 = 0 THEN NULL WHEN event_id % 8 = 1 THEN 99
                WHEN event_id % 8 = 2 THEN 60 ELSE minute(ts) END AS m
    FROM events
), c AS (
    SELECT event_id, COALESCE(h, 0) AS hora, COALESCE(m, 0) AS minuto FROM r
), k AS (
    SELECT *, CASE WHEN hora BETWEEN 0 AND 23 AND minuto BETWEEN 0 AND 59
                   THEN hora * 100 + minuto ELSE -1 END AS tk
    FROM c
)
SELECT k.event_id, CAST(k.hora AS BIGINT) AS hora, CAST(k.minuto AS BIGINT) AS minuto,
       CAST(tk AS BIGINT) AS time_key, t.banda_horaria
FROM k LEFT JOIN dim_tiempo t ON t.time_key = k.tk"""

ORACLE["enrich_left"] = """WITH raw AS (
    SELECT c.c_custkey,
           CASE WHEN c.c_custkey % 10 = 0 THEN NULL ELSE n.n_regionkey END AS region_code,
           CASE WHEN c.c_custkey % 10 = 1 THEN c.c_nationkey + 100 ELSE c.c_nationkey END AS nation_code
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
), regions AS (
    SELECT r_regionkey AS region_code, r_name AS region_name FROM region
    UNION ALL SELECT NULL, 'REGION NULA'
)
SELECT raw.c_custkey, CAST(raw.region_code AS BIGINT) AS region_code,
       CAST(raw.nation_code AS BIGINT) AS nation_code,
       COALESCE(rg.region_name, 'Sin especificar') AS region_name,
       COALESCE(n.n_name, 'Sin especificar') AS nation_name
FROM raw
LEFT JOIN regions rg ON raw.region_code IS NOT DISTINCT FROM rg.region_code
LEFT JOIN nation n ON raw.region_code IS NOT DISTINCT FROM n.n_regionkey
                  AND raw.nation_code IS NOT DISTINCT FROM n.n_nationkey"""

ORACLE["dim_location"] = f"""WITH {STAR_CTE}
SELECT location_key, CAST(n_nationkey AS BIGINT) AS n_nationkey, r_name, n_name, c_mktsegment FROM loc"""

ORACLE["dim_descriptor"] = f"WITH {STAR_CTE} SELECT descriptor_key, o_orderstatus, o_orderpriority FROM des"

ORACLE["dim_profile"] = f"WITH {STAR_CTE} SELECT profile_key, c_mktsegment, o_orderpriority FROM pro"

FACT_COLS = ("source_row_id, date_key, location_key, descriptor_key, profile_key, "
             "num_orders, is_urgent, is_finished")

ORACLE["fact_keyed"] = f"WITH {STAR_CTE} SELECT {FACT_COLS} FROM fk"

ORACLE["load_summary"] = f"""WITH {ORDERS_BASE_CTE}
SELECT CAST(COUNT(*) AS BIGINT) AS fact_rows, CAST(SUM(num_orders) AS BIGINT) AS total_orders,
       CAST(SUM(is_urgent) AS BIGINT) AS total_urgent, CAST(SUM(is_finished) AS BIGINT) AS total_finished
FROM ob"""

DIRTY_BASE = ORDERS_BASE_CTE.replace("\nob AS", "\nclean AS") + """, ob AS (
    SELECT o_orderkey, CASE WHEN o_orderkey % 503 = 2 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
           o_orderpriority, date_key, num_orders, is_urgent, is_finished,
           CASE WHEN o_orderkey % 1009 = 4 THEN NULL ELSE n_nationkey END AS n_nationkey,
           CASE WHEN o_orderkey % 1009 = 4 THEN NULL ELSE r_name END AS r_name,
           CASE WHEN o_orderkey % 1009 = 4 THEN NULL ELSE n_name END AS n_name,
           CASE WHEN o_orderkey % 1009 = 4 THEN NULL ELSE c_mktsegment END AS c_mktsegment
    FROM clean
)"""

ORACLE["null_key_report"] = f"""WITH {DIRTY_BASE}, {KEYED_CTE}
SELECT CAST(COUNT(*) FILTER (WHERE date_key IS NULL) AS BIGINT) AS date_key_nulls,
       CAST(COUNT(*) FILTER (WHERE location_key IS NULL) AS BIGINT) AS location_key_nulls,
       CAST(COUNT(*) FILTER (WHERE descriptor_key IS NULL) AS BIGINT) AS descriptor_key_nulls,
       CAST(COUNT(*) FILTER (WHERE profile_key IS NULL) AS BIGINT) AS profile_key_nulls
FROM fk"""

ORACLE["top_check"] = f"""WITH {STAR_CTE}
SELECT n_name, CAST(SUM(num_orders) AS BIGINT) AS total_orders,
       CAST(SUM(is_urgent) AS BIGINT) AS total_urgent, CAST(SUM(is_finished) AS BIGINT) AS total_finished
FROM fk WHERE location_key IS NOT NULL GROUP BY n_name ORDER BY total_orders DESC, n_name ASC LIMIT 10"""


def _unique(table: str, rel: str, rule: str, keys: str) -> str:
    return (f"SELECT '{rule}' AS rule, '{table}' AS table_name, "
            f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS violations "
            f"FROM (SELECT {keys}, COUNT(*) AS n FROM {rel} GROUP BY {keys} HAVING COUNT(*) > 1)")


def _count(table: str, rel: str, rule: str, pred: str) -> str:
    return (f"SELECT '{rule}', '{table}', CAST(COUNT(*) FILTER (WHERE COALESCE({pred}, FALSE)) AS BIGINT) "
            f"FROM {rel}")


LENGTHS = {"r_name": 25, "n_name": 25, "c_mktsegment": 10, "o_orderstatus": 1, "o_orderpriority": 15}


def _attributes(table: str, rel: str, cols: list[str]) -> list[str]:
    return ([_count(table, rel, f"not_null:{c}", f"{c} IS NULL") for c in cols]
            + [_count(table, rel, f"length:{c}", f"length({c}) > {LENGTHS[c]}") for c in cols if c in LENGTHS])


def _fk(rel: str, col: str, dim: str, key: str) -> str:
    return (f"SELECT 'fk:{col}', 'fact', CAST(COUNT(*) AS BIGINT) FROM {rel} x "
            f"WHERE NOT EXISTS (SELECT 1 FROM {dim} y WHERE y.{key} = x.{col})")


_CONSTRAINT_PARTS = [
    _unique("dim_date", "dd", "pk", "date_key"),
    _unique("dim_date", "dd", "unique:full_date", "full_date"),
    _count("dim_date", "dd", "not_null:date_key", "date_key IS NULL"),
    _count("dim_date", "dd", "not_null:full_date", "full_date IS NULL"),
    _count("dim_date", "dd", "not_null:mes_nombre", "mes_nombre IS NULL"),
    _count("dim_date", "dd", "not_null:dia_semana_nombre", "dia_semana_nombre IS NULL"),
    _count("dim_date", "dd", "range:mes_numero", "NOT (mes_numero BETWEEN 1 AND 12)"),
    _count("dim_date", "dd", "range:dia_mes", "NOT (dia_mes BETWEEN 1 AND 31)"),
    _count("dim_date", "dd", "range:trimestre", "NOT (trimestre BETWEEN 1 AND 4)"),
    _count("dim_date", "dd", "range:dia_semana_numero", "NOT (dia_semana_numero BETWEEN 1 AND 7)"),
    _unique("dim_time", "dim_tiempo", "pk", "time_key"),
    _unique("dim_time", "dim_tiempo", "unique:hora_texto", "hora_texto"),
    *[_count("dim_time", "dim_tiempo", f"not_null:{c}", f"{c} IS NULL")
      for c in ("time_key", "hora", "minuto", "hora_texto", "banda_horaria")],
    _count("dim_time", "dim_tiempo", "range:hora", "NOT (hora BETWEEN -1 AND 23)"),
    _count("dim_time", "dim_tiempo", "range:minuto", "NOT (minuto BETWEEN -1 AND 59)"),
    _count("dim_time", "dim_tiempo", "domain:banda_horaria",
           "banda_horaria NOT IN ('Madrugada', 'Mañana', 'Tarde', 'Noche', 'Sin especificar')"),
    _unique("dim_location", "loc", "pk", "location_key"),
    _unique("dim_location", "loc", "unique:natural", "n_nationkey, r_name, n_name, c_mktsegment"),
    "SELECT 'fd:nation_segment->names', 'dim_location', CAST(COUNT(*) AS BIGINT) FROM ("
    "SELECT n_nationkey, c_mktsegment FROM loc GROUP BY n_nationkey, c_mktsegment "
    "HAVING COUNT(DISTINCT (r_name, n_name)) > 1)",
    *_attributes("dim_location", "loc", ["location_key", "n_nationkey", "r_name", "n_name", "c_mktsegment"]),
    _unique("dim_descriptor", "des", "pk", "descriptor_key"),
    _unique("dim_descriptor", "des", "unique:natural", "o_orderstatus, o_orderpriority"),
    *_attributes("dim_descriptor", "des", ["descriptor_key", "o_orderstatus", "o_orderpriority"]),
    _unique("dim_profile", "pro", "pk", "profile_key"),
    _unique("dim_profile", "pro", "unique:natural", "c_mktsegment, o_orderpriority"),
    *_attributes("dim_profile", "pro", ["profile_key", "c_mktsegment", "o_orderpriority"]),
    _unique("nation", "nation", "many_to_one:n_nationkey", "n_nationkey"),
    _unique("region", "region", "many_to_one:r_regionkey", "r_regionkey"),
    _unique("fact", "dirty", "pk", "source_row_id"),
    _count("fact", "dirty", "not_null:date_key", "date_key IS NULL"),
    _count("fact", "dirty", "not_null:location_key", "location_key IS NULL"),
    _count("fact", "dirty", "not_null:descriptor_key", "descriptor_key IS NULL"),
    _count("fact", "dirty", "not_null:profile_key", "profile_key IS NULL"),
    _count("fact", "dirty", "const:num_orders", "num_orders <> 1"),
    _count("fact", "dirty", "nonneg:is_urgent", "is_urgent < 0"),
    _count("fact", "dirty", "nonneg:is_finished", "is_finished < 0"),
    _count("fact", "dirty", "smallint:counts", "greatest(is_urgent, is_finished) > 32767"),
    _fk("dirty", "date_key", "dd", "date_key"),
    _fk("dirty", "location_key", "loc", "location_key"),
    _fk("dirty", "descriptor_key", "des", "descriptor_key"),
    _fk("dirty", "profile_key", "pro", "profile_key"),
]

ORACLE["constraint_report"] = f"""WITH {years_cte('orders', 'o_orderdate')},{dim_date_cte('dd')},
{DIM_TIME_CTE}, {STAR_CTE},
dirty AS (
    SELECT CASE WHEN source_row_id % 1000 = 7 THEN 1 ELSE source_row_id END AS source_row_id,
           CASE WHEN source_row_id % 997 = 3 THEN 19000101 ELSE date_key END AS date_key,
           location_key, descriptor_key, profile_key,
           CASE WHEN source_row_id % 991 = 5 THEN 2 ELSE num_orders END AS num_orders,
           CASE WHEN source_row_id % 983 = 11 THEN -1 ELSE is_urgent END AS is_urgent,
           CASE WHEN source_row_id % 977 = 13 THEN -1 ELSE is_finished END AS is_finished
    FROM fk
)
""" + "\nUNION ALL\n".join(_CONSTRAINT_PARTS)


# ---------------------------------------------------------------- marts, registry, whole orders

ORACLE["mart_merge"] = """SELECT o_orderstatus, o_orderpriority, COUNT(*) AS total_orders,
       CAST(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS total_urgent,
       CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS total_finished
FROM orders GROUP BY ALL"""

ORACLE["key_registry"] = """WITH c AS (
    SELECT o_custkey, MIN(CASE WHEN date_trunc('month', o_orderdate) = (SELECT date_trunc('month', MIN(o_orderdate)) FROM orders)
                               THEN 1 ELSE 2 END) AS first_load
    FROM orders GROUP BY o_custkey
)
SELECT row_number() OVER (ORDER BY first_load, o_custkey NULLS LAST) AS customer_key, o_custkey, CAST(first_load AS BIGINT) AS first_load FROM c"""

ORACLE["customer_ranking"] = f"""WITH c AS (
    SELECT o_custkey, COUNT(*) AS total_orders, CAST(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS total_urgent
    FROM orders GROUP BY o_custkey
), t AS (SELECT *, CAST(SUM(total_orders) OVER () AS BIGINT) AS whole FROM c)
SELECT o_custkey, total_orders, total_urgent, RANK() OVER (ORDER BY total_orders DESC) AS ranking,
       {rounded('total_urgent', 'total_orders', 4)} AS urgent_per_order, {rounded('total_orders', 'whole', 4, 100)} AS pct_orders
FROM t"""

ORACLE["order_series"] = f"""WITH o AS (
    SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders
), w AS (
    SELECT *, LAG(cents) OVER s AS prev_cents, CAST(SUM(cents) OVER f AS BIGINT) AS sum_7, COUNT(cents) OVER f AS n_7
    FROM o WINDOW s AS (ORDER BY o_orderkey), f AS (ORDER BY o_orderkey ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
)
SELECT o_orderkey, cents, prev_cents, cents - prev_cents AS change_cents,
       {rounded('(cents - prev_cents)', 'prev_cents', 2, 100)} AS pct_change, {rounded('sum_7', 'n_7', 2)} AS moving_avg_7
FROM w"""


# ---------------------------------------------------------------- the load path

RAW_CTE = """raw AS (
    SELECT event_id, CAST(ts AS DATE) AS full_date, 1 + user_id % 32 AS ie, 1 + user_id % 5 AS im,
           'Entidad ' || lpad(CAST(1 + user_id % 32 AS VARCHAR), 2, '0') AS entidad,
           'Municipio ' || CAST(1 + user_id % 5 AS VARCHAR) AS municipio,
           CASE WHEN user_id % 2 = 0 THEN 'Municipal' ELSE 'Suburbana' END AS cobertura,
           CASE WHEN event_id % 50 = 1 THEN 99 WHEN event_id % 50 = 0 THEN 0 ELSE hour(ts) END AS h,
           event_type AS tipo, event_id % 4 AS causa, event_id % 3 AS u, event_id % 2 AS s,
           CASE event_type WHEN 'error' THEN 'Fatal' WHEN 'purchase' THEN 'No fatal' ELSE 'Sólo daños' END AS clase,
           CASE event_id % 3 WHEN 0 THEN 'Mujer' WHEN 1 THEN 'Hombre' ELSE 'Sin especificar' END AS sexo,
           CASE WHEN event_id % 40 = 0 THEN 'No especificada' ELSE CAST(10 + event_id % 60 AS VARCHAR) || ' años' END AS edad,
           CASE WHEN event_id % 7 = 0 THEN 'Sí' ELSE 'No' END AS aliento, 'Sin especificar' AS cinturon,
           1 + event_id % 2 AS automovil, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS moto,
           CASE WHEN event_id % 11 = 0 THEN 2 ELSE 0 END AS camioneta,
           CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS muertos,
           CASE WHEN event_type = 'purchase' THEN 2 ELSE 0 END AS heridos
    FROM events
)"""

ORACLE["incident_load"] = f"""WITH {years_cte('events', 'ts')}, {RAW_CTE}
SELECT 'dim_fecha' AS table_name, (SELECT count(*) FROM cal) AS rows
UNION ALL SELECT 'dim_tiempo', 1441
UNION ALL SELECT 'dim_ubicacion', (SELECT count(*) FROM (SELECT DISTINCT ie, im, cobertura FROM raw))
UNION ALL SELECT 'dim_accidente', (SELECT count(*) FROM (SELECT DISTINCT tipo, causa, clase, u, s FROM raw))
UNION ALL SELECT 'dim_conductor', (SELECT count(*) FROM (SELECT DISTINCT sexo, edad, aliento FROM raw))
UNION ALL SELECT 'fact_accidentes', (SELECT count(*) FROM raw)"""

ORACLE["incident_increment"] = f"""WITH {RAW_CTE}
SELECT CAST(strftime(full_date, '%Y%m%d') AS BIGINT) AS date_key, CAST(COUNT(*) AS BIGINT) AS total_accidentes,
       CAST(SUM(muertos) AS BIGINT) AS total_muertos, CAST(SUM(heridos) AS BIGINT) AS total_heridos
FROM raw GROUP BY 1"""


def _fact_rule(rule: str, pred: str, extra: int = 0) -> str:
    return f"SELECT '{rule}', 'fact_accidentes', COUNT(*) FILTER (WHERE {pred}) - {extra} FROM raw"


# The violations that the query puts in, as counts over the events.
_RULE_PARTS = [
    "SELECT 'not_null:mes_nombre' AS rule, 'dim_fecha' AS table_name, COUNT(*) FILTER (WHERE month(full_date) = 2) AS violations FROM cal",
    "SELECT 'range:trimestre', 'dim_fecha', COUNT(*) FILTER (WHERE month(full_date) = 1) FROM cal",
    "SELECT 'domain:banda_horaria', 'dim_tiempo', 60",
    "SELECT 'pk', 'dim_ubicacion', COUNT(*) FILTER (WHERE im = 3) FROM place",
    "SELECT 'unique:natural', 'dim_ubicacion', COUNT(*) FILTER (WHERE im = 3) FROM place",
    "SELECT 'not_null:entidad', 'dim_ubicacion', COUNT(*) FILTER (WHERE ie = 7) FROM place",
    "SELECT 'length:municipio', 'dim_ubicacion', COUNT(*) FILTER (WHERE im = 2) FROM place",
    "SELECT 'fd:ids_coverage->names', 'dim_ubicacion', COUNT(*) FILTER (WHERE im = 3) FROM place",
    _fact_rule("const:num_accidentes", "automovil = 2 AND moto = 1"),
    _fact_rule("nonneg:vehicles", "camioneta = 2"),
    _fact_rule("nonneg:casualties", "camioneta = 2 AND heridos = 2"),
    _fact_rule("not_null:automovil", "automovil = 1 AND moto = 1"),
    _fact_rule("not_null:conductor_key", "heridos = 2 AND moto = 1"),
    _fact_rule("fk:conductor_key", "heridos = 2 AND moto = 1"),
    _fact_rule("fk:accidente_key", "muertos = 1 AND moto = 1"),
    _fact_rule("fk:date_key", "muertos = 1 AND camioneta = 2"),
    _fact_rule("equal:accidente_id=source_row_id", "muertos = 1 AND camioneta = 2"),
    _fact_rule("pk+unique:source_row_id", "muertos = 1 AND camioneta = 2", 1),
]

ORACLE["incident_rules"] = f"""WITH {years_cte('events', 'ts')}, {RAW_CTE},
place AS (SELECT DISTINCT ie, im, cobertura FROM raw)
SELECT rule, table_name, CAST(violations AS BIGINT) AS violations FROM (
""" + "\nUNION ALL\n".join(_RULE_PARTS) + "\n) WHERE violations > 0"

_SEVERITY = """CAST(count(*) AS BIGINT) AS total_accidentes, CAST(sum(muertos) AS BIGINT) AS total_muertos,
           CAST(sum(heridos) AS BIGINT) AS total_heridos"""


def _long(report: str, rel: str, label: str, measures: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{report}' AS report, {label} AS label, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM {rel}"
                              for m in measures)


_THREE = ["total_accidentes", "total_muertos", "total_heridos"]

ORACLE["incident_reports"] = f"""WITH {RAW_CTE},
ent AS (SELECT entidad, {_SEVERITY} FROM raw GROUP BY entidad),
q1 AS (
    SELECT *, RANK() OVER (ORDER BY total_accidentes DESC) AS ranking,
           {rounded('total_muertos', 'total_accidentes', 4)} AS muertos_por_accidente,
           {rounded('total_heridos', 'total_accidentes', 4)} AS heridos_por_accidente
    FROM ent ORDER BY total_accidentes DESC, entidad LIMIT 10
), mon AS (
    SELECT month(full_date) AS n, {_SEVERITY} FROM raw GROUP BY 1
), mon2 AS (
    SELECT *, LAG(total_accidentes) OVER (ORDER BY n) AS accidentes_mes_anterior FROM mon
), q2 AS (
    SELECT *, CAST(n AS VARCHAR) || '|' || ['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto',
             'Septiembre', 'Octubre', 'Noviembre', 'Diciembre'][n] AS label,
           total_accidentes - accidentes_mes_anterior AS variacion_accidentes,
           {rounded('(total_accidentes - accidentes_mes_anterior)', 'accidentes_mes_anterior', 2, 100)} AS variacion_porcentual_accidentes
    FROM mon2
), day AS (
    SELECT full_date, CAST(count(*) AS BIGINT) AS total_accidentes FROM raw GROUP BY 1
), day2 AS (
    SELECT *, SUM(total_accidentes) OVER w AS s, COUNT(*) OVER w AS c FROM day
    WINDOW w AS (ORDER BY full_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
), q3 AS (SELECT *, {rounded('s', 'c', 2)} AS promedio_movil_7_dias FROM day2
), band AS (
    SELECT isodow(full_date) AS dow, CASE WHEN h BETWEEN 0 AND 5 THEN 'Madrugada' WHEN h BETWEEN 6 AND 11 THEN 'Mañana'
             WHEN h BETWEEN 12 AND 17 THEN 'Tarde' WHEN h BETWEEN 18 AND 23 THEN 'Noche' ELSE 'Sin especificar' END AS banda_horaria,
           {_SEVERITY}
    FROM raw GROUP BY 1, 2
), q4 AS (
    SELECT *, CAST(dow AS VARCHAR) || '|' || ['Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado', 'Domingo'][dow]
             || '|' || banda_horaria AS label, {BAND_ORD} AS banda_orden
    FROM band
), mun AS (
    SELECT entidad, municipio, {_SEVERITY} FROM raw GROUP BY 1, 2
), q5 AS (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY entidad ORDER BY total_accidentes DESC, municipio) AS ranking_en_entidad
    FROM mun QUALIFY ranking_en_entidad <= 3
), cls AS (
    SELECT clase, {_SEVERITY} FROM raw GROUP BY clase
), cls2 AS (SELECT *, SUM(total_accidentes) OVER () AS t FROM cls
), q6 AS (SELECT *, {rounded('total_accidentes', 't', 2, 100)} AS porcentaje_accidentes FROM cls2
), veh AS (
    SELECT unnest(['Automovil', 'Motocicleta', 'Bicicleta', 'Camioneta', 'Camion', 'Microbus', 'Omnibus', 'Tractor',
                   'Ferrocarril', 'Otro vehiculo']) AS tipo_vehiculo,
           unnest([sum(automovil), sum(moto), 0, sum(camioneta), 0, 0, 0, 0, 0, 0]) AS total
    FROM raw
), q7 AS (SELECT *, RANK() OVER (ORDER BY total DESC) AS ranking FROM veh
), q8 AS (
    SELECT sexo || '|' || edad || '|' || aliento || '|' || cinturon AS label, {_SEVERITY}
    FROM raw WHERE muertos > 0 OR heridos > 0 GROUP BY 1
), cell AS (
    SELECT dow, ['Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado', 'Domingo'][dow] AS day_name, band
    FROM (SELECT unnest(range(1, 8)) AS dow), (SELECT unnest(['Madrugada', 'Mañana', 'Tarde', 'Noche', 'Sin especificar']) AS band)
), k2 AS (SELECT CAST(count(*) AS BIGINT) AS registros_fact, {_SEVERITY} FROM raw)
""" + " UNION ALL ".join([
    _long("q1", "q1", "entidad", ["ranking", *_THREE, "muertos_por_accidente", "heridos_por_accidente"]),
    _long("q2", "q2", "label", [*_THREE, "accidentes_mes_anterior", "variacion_accidentes", "variacion_porcentual_accidentes"]),
    _long("q3", "q3", "CAST(full_date AS VARCHAR)", ["total_accidentes", "promedio_movil_7_dias"]),
    _long("q4", "q4", "label", [*_THREE, "banda_orden"]),
    _long("q5", "q5", "entidad || '|' || municipio", [*_THREE, "ranking_en_entidad"]),
    _long("q6", "q6", "clase", [*_THREE, "porcentaje_accidentes"]),
    _long("q7", "q7", "tipo_vehiculo", ["total", "ranking"]),
    _long("q8", "q8", "label", _THREE),
    _long("k2", "k2", "''", ["registros_fact", *_THREE]),
    _long("q1_dashboard", "q1", "entidad", ["ranking", "total_accidentes"]),
    _long("q2_dashboard", "q2", "label", ["total_accidentes", "accidentes_mes_anterior", "variacion_accidentes", "variacion_porcentual_accidentes"]),
    _long("q4_dashboard", "q4", "label", ["total_accidentes", "banda_orden"]),
    "SELECT 'q4_matrix', day_name, band, CAST(q4.total_accidentes AS DOUBLE) FROM cell LEFT JOIN q4 ON cell.dow = q4.dow AND cell.band = q4.banda_horaria",
    _long("q6_dashboard", "q6", "clase", ["total_accidentes", "porcentaje_accidentes"]),
    _long("kpis_dashboard", "k2", "''", ["registros_fact", "total_accidentes"]),
    _long("q5_dashboard", "q5", "entidad || '|' || municipio", ["total_accidentes", "ranking_en_entidad"]),
])
