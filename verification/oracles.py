"""SQL for each registered query, written independently of the Spark plans (for DuckDB).

Where the engine aggregates, the SQL often takes another road on purpose: windows and self
joins instead of grouped maxima, lag instead of stage counts, pairwise overlap instead of
running maxima.
"""

from __future__ import annotations

LIFECYCLE = """['ORDER_ALLOCATED_TO_FC', 'PICKED_AND_PACKED', 'DISPATCHED_FROM_FC',
 'RECEIVED_AT_DS', 'ASSIGNED_TO_DRIVER', 'OUT_FOR_DELIVERY', 'DELIVERED']"""


def rnd(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    share = f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100.0"
    return f"CASE WHEN {whole} > 0 THEN {rnd(share, 1)} ELSE 0.0 END"


def esc(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    escaped = "replace(replace(" + text + r", '\', '\\'), '|', '\|')"
    return r"coalesce(" + escaped + r", '\N')"


def md5_of(*columns: str) -> str:
    return "md5(" + " || '|' || ".join(esc(c) for c in columns) + ")"


FACILITY_SQL = """
  SELECT '{prefix}' || {p}_{key} AS {entity}_id, {p}_name AS {entity}_name,
    'CITY_' || {p}_nationkey AS city, 'REGION_' || ({p}_nationkey % 5) AS region,
    'STATE_' || {p}_nationkey AS state, CAST(floor({p}_acctbal) AS INTEGER) AS daily_capacity,
    CAST({p}_{key} AS DOUBLE) / 50.0 + 10.0 AS latitude,
    CAST({p}_{key} AS DOUBLE) / 100.0 + 70.0 AS longitude
  FROM {table}"""

RAW_FC = FACILITY_SQL.format(
    prefix="FC_", p="s", key="suppkey", entity="fulfillment_center", table="supplier")
RAW_DS = FACILITY_SQL.format(
    prefix="DS_", p="c", key="custkey", entity="delivery_station", table="customer")

FC_TRACKED = ("fulfillment_center_name", "city", "region", "state", "daily_capacity")
DS_TRACKED = ("delivery_station_name", "city", "region", "state", "daily_capacity")
VEH_TRACKED = ("vehicle_type", "capacity", "home_facility_id", "home_facility_type", "status")


def first_load(source: str, key: str, tracked: tuple[str, ...], day: str) -> str:
    return f"""
  SELECT h.*, {md5_of(key, "effective_from", "row_hash", "NULL")} AS surrogate_key FROM (
    SELECT *, {md5_of(*tracked)} AS row_hash, DATE '{day}' AS effective_from,
      DATE '9999-12-31' AS effective_to, true AS is_current FROM {source}) h"""


def second_load(first: str, incoming: str, key: str, tracked: tuple[str, ...], day: str,
                columns: str) -> str:
    """Untouched, closed and new versions as three separate selections."""
    return f"""
  SELECT * FROM (
    WITH n AS (SELECT *, {md5_of(*tracked)} AS row_hash FROM {incoming}),
    ch AS (SELECT f.{key} AS k FROM {first} f JOIN n ON f.{key} = n.{key}
           WHERE f.is_current AND f.row_hash <> n.row_hash)
    SELECT {columns}, row_hash, effective_from, effective_to, is_current, surrogate_key
      FROM {first} WHERE {key} NOT IN (SELECT k FROM ch)
    UNION ALL
    SELECT {columns}, row_hash, effective_from, DATE '{day}', false, surrogate_key
      FROM {first} WHERE {key} IN (SELECT k FROM ch)
    UNION ALL
    SELECT {", ".join("n." + c.strip() for c in columns.split(","))}, n.row_hash, DATE '{day}',
      DATE '9999-12-31', true,
      {md5_of("n." + key, f"DATE '{day}'", "n.row_hash", "f.surrogate_key")}
      FROM n LEFT JOIN {first} f ON f.{key} = n.{key} AND f.is_current
      WHERE f.{key} IS NULL OR f.row_hash <> n.row_hash)"""


VIEWS = {
    "raw_fc": RAW_FC,
    "raw_ds": RAW_DS,
    "raw_vehicle": """
  SELECT 'VEH_' || p_partkey AS vehicle_id,
    CASE p_size % 3 WHEN 0 THEN 'TRUCK' WHEN 1 THEN 'VAN' ELSE 'BIKE' END AS vehicle_type,
    'DS_' || p_partkey AS home_facility_id, 'DELIVERY_STATION' AS home_facility_type,
    p_size AS capacity,
    CASE p_type WHEN 'SMALL' THEN 'IN_USE' WHEN 'LARGE' THEN 'MAINTENANCE'
      WHEN 'PROMO' THEN 'RETIRED' ELSE 'AVAILABLE' END AS status FROM part""",
    "fc": "SELECT * FROM raw_fc WHERE daily_capacity > 0",
    "ds": "SELECT * FROM raw_ds WHERE daily_capacity > 0",
    "vehicle": "SELECT * FROM raw_vehicle WHERE status IN ('AVAILABLE', 'IN_USE', 'MAINTENANCE')",
    "ev": f"""
  SELECT d.*, promised_delivery_time + delay_minutes * INTERVAL '1' MINUTE
      AS estimated_delivery_time,
    CAST(coalesce(list_position({LIFECYCLE}, shipment_status), 0) AS INTEGER) AS stage
  FROM (SELECT b.*, date_trunc('day', event_timestamp)
      + CASE delivery_type WHEN 'SAME_DAY' THEN INTERVAL '6' HOUR ELSE INTERVAL '48' HOUR END
      AS promised_delivery_time
    FROM (SELECT 'EVT_' || event_id AS event_id, date_trunc('second', ts)
        + (user_id % 90) * 30 * INTERVAL '1' DAY AS event_timestamp,
      'SHP_' || user_id || '_' || CAST(ts AS DATE) AS shipment_id,
      'ORD_' || user_id || '_' || CAST(ts AS DATE) AS order_id,
      'CUST_' || user_id AS customer_id,
      CASE WHEN event_type = 'signup' THEN
          CASE WHEN value < 30 THEN 'ORDER_ALLOCATED_TO_FC' ELSE 'PICKED_AND_PACKED' END
        WHEN event_type = 'view' THEN 'DISPATCHED_FROM_FC'
        WHEN event_type = 'click' THEN
          CASE WHEN value < 30 THEN 'RECEIVED_AT_DS' ELSE 'ASSIGNED_TO_DRIVER' END
        WHEN event_type = 'error' THEN 'OUT_FOR_DELIVERY' ELSE 'DELIVERED' END AS shipment_status,
      CASE WHEN event_type IN ('signup', 'view') THEN 'FC_' || (user_id // 2)
        WHEN event_type = 'click' THEN 'DS_' || (user_id * 7) END AS facility_id,
      CASE WHEN event_type IN ('signup', 'view') THEN 'FULFILLMENT_CENTER'
        WHEN event_type = 'click' THEN 'DELIVERY_STATION' END AS facility_type,
      CASE WHEN event_type = 'view' OR (event_type = 'click' AND value < 30)
          THEN 'VEH_' || (user_id * 3)
        WHEN event_type IN ('click', 'error', 'purchase') THEN 'VEH_' || (user_id * 5 + 1) END
        AS vehicle_id,
      CASE WHEN (user_id + day(ts)) % 10 < 3 THEN 'PRIME' ELSE 'STANDARD' END AS customer_tier,
      CASE WHEN (user_id + day(ts)) % 3 = 0 THEN 'SAME_DAY' ELSE 'STANDARD' END AS delivery_type,
      value > 100 AS is_delayed,
      CASE WHEN value > 100 THEN CAST(floor(value) AS INTEGER) ELSE 0 END AS delay_minutes,
      CAST(CASE WHEN event_type IN ('signup', 'view') THEN user_id // 2 ELSE user_id * 7 END
        AS DOUBLE) / 50.0 + 10.0 + (value - 50.0) / 10000.0 AS latitude,
      CAST(CASE WHEN event_type IN ('signup', 'view') THEN user_id // 2 ELSE user_id * 7 END
        AS DOUBLE) / 100.0 + 70.0 - (value - 50.0) / 10000.0 AS longitude,
      user_id, value FROM events) b) d""",
    "ord": """
  SELECT shipment_id, order_id, customer_id, customer_tier, delivery_type,
    promised_delivery_time, min(event_timestamp) AS event_timestamp,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS order_value,
    'FC_' || (user_id // 2 + CASE WHEN sum(CAST(value AS DECIMAL(18,2))) > 300 THEN 1 ELSE 0 END)
      AS fulfillment_center_id,
    'DS_' || (user_id * 7) AS delivery_station_id
  FROM ev GROUP BY shipment_id, order_id, customer_id, customer_tier, delivery_type,
    promised_delivery_time, user_id""",
    "enr": """
  SELECT ev.*, fc.fulfillment_center_name AS fc_name, fc.region AS fc_region,
    ds.delivery_station_name AS ds_name, ds.region AS ds_region, v.vehicle_type,
    estimated_delivery_time > promised_delivery_time AND shipment_status <> 'DELIVERED'
      AS is_sla_at_risk, customer_tier = 'PRIME' AS is_priority
  FROM ev
  LEFT JOIN fc ON facility_id = fulfillment_center_id AND facility_type = 'FULFILLMENT_CENTER'
  LEFT JOIN ds ON facility_id = delivery_station_id AND facility_type = 'DELIVERY_STATION'
  LEFT JOIN vehicle v ON ev.vehicle_id = v.vehicle_id""",
    "latest": """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY shipment_id
      ORDER BY event_timestamp DESC, stage DESC, event_id DESC) AS rn FROM enr) WHERE rn = 1""",
    "live": """
  SELECT *, event_timestamp AS stage_entered_at, event_timestamp AS last_updated FROM latest""",
    "stages": """
  SELECT k.shipment_id, a.t AS fc_received_at, d.t AS dispatched_from_fc_at,
    r.t AS received_at_ds_at, o.t AS out_for_delivery_at, x.t AS actual_delivery_time,
    f.id AS fc_id, s.id AS ds_id
  FROM (SELECT DISTINCT shipment_id FROM ev) k
  LEFT JOIN (SELECT shipment_id, min(event_timestamp) AS t FROM ev WHERE stage = 1 GROUP BY 1) a
    USING (shipment_id)
  LEFT JOIN (SELECT shipment_id, max(event_timestamp) AS t FROM ev WHERE stage = 3 GROUP BY 1) d
    USING (shipment_id)
  LEFT JOIN (SELECT shipment_id, min(event_timestamp) AS t FROM ev WHERE stage = 4 GROUP BY 1) r
    USING (shipment_id)
  LEFT JOIN (SELECT shipment_id, max(event_timestamp) AS t FROM ev WHERE stage = 6 GROUP BY 1) o
    USING (shipment_id)
  LEFT JOIN (SELECT shipment_id, max(event_timestamp) AS t FROM ev WHERE stage = 7 GROUP BY 1) x
    USING (shipment_id)
  LEFT JOIN (SELECT shipment_id, max(facility_id) AS id FROM ev
    WHERE facility_type = 'FULFILLMENT_CENTER' GROUP BY 1) f USING (shipment_id)
  LEFT JOIN (SELECT shipment_id, max(facility_id) AS id FROM ev
    WHERE facility_type = 'DELIVERY_STATION' GROUP BY 1) s USING (shipment_id)""",
    "cust": """
  SELECT customer_id, customer_tier FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
    ORDER BY event_timestamp DESC, order_id DESC) AS rn FROM ord) WHERE rn = 1""",
    "dim_fc": first_load("fc", "fulfillment_center_id", FC_TRACKED, "2024-01-01"),
    "dim_ds": first_load("ds", "delivery_station_id", DS_TRACKED, "2024-01-01"),
    "dim_veh": first_load("vehicle", "vehicle_id", VEH_TRACKED, "2024-01-01"),
    "dim_cust": first_load("cust", "customer_id", ("customer_tier",), "2024-01-01"),
    "calendar": """
  SELECT CAST(d AS DATE) AS full_date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
    CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
    CAST(week(d) AS INTEGER) AS week, dayname(d) AS day_name, monthname(d) AS month_name,
    isodow(d) IN (6, 7) AS is_weekend
  FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2030-12-31',
    INTERVAL '1' DAY)) AS d)""",
    "fact": f"""
  SELECT o.customer_id, l.vehicle_id, l.shipment_id, l.order_id, l.shipment_status, l.is_delayed,
    l.delay_minutes, l.customer_tier, l.delivery_type, l.promised_delivery_time,
    fc_received_at, dispatched_from_fc_at, received_at_ds_at, out_for_delivery_at,
    actual_delivery_time, fc_id, ds_id, o.order_value, v.vehicle_type,
    {rnd("(epoch(actual_delivery_time) - epoch(fc_received_at)) / 3600.0", 2)} AS lead_time_hours,
    {rnd("(epoch(dispatched_from_fc_at) - epoch(fc_received_at)) / 60.0", 1)} AS fc_time_minutes,
    {rnd("(epoch(out_for_delivery_at) - epoch(received_at_ds_at)) / 60.0", 1)} AS ds_time_minutes,
    CASE WHEN actual_delivery_time IS NOT NULL
      THEN actual_delivery_time > l.promised_delivery_time ELSE false END AS sla_breached,
    CASE v.vehicle_type WHEN 'TRUCK' THEN 100.0::DOUBLE WHEN 'VAN' THEN 50.0::DOUBLE
      WHEN 'BIKE' THEN 20.0::DOUBLE ELSE 0.0::DOUBLE END AS transportation_cost,
    CASE WHEN l.delay_minutes > 0 THEN CAST(l.delay_minutes AS DOUBLE) *
      CASE l.delivery_type WHEN 'SAME_DAY' THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END
      ELSE 0.0::DOUBLE END AS sla_penalty_amount,
    CASE WHEN actual_delivery_time > l.promised_delivery_time THEN o.order_value *
      CASE l.delivery_type WHEN 'SAME_DAY' THEN 0.15::DOUBLE ELSE 0.05::DOUBLE END
      ELSE 0.0::DOUBLE END AS refund_amount,
    f.surrogate_key AS fc_sk, d.surrogate_key AS ds_sk, dv.surrogate_key AS vehicle_sk,
    dc.surrogate_key AS customer_sk, c.date_key
  FROM latest l JOIN stages p ON l.shipment_id = p.shipment_id
  LEFT JOIN ord o ON o.shipment_id = l.shipment_id
  LEFT JOIN vehicle v ON v.vehicle_id = l.vehicle_id
  LEFT JOIN dim_fc f ON f.fulfillment_center_id = fc_id
  LEFT JOIN dim_ds d ON d.delivery_station_id = ds_id
  LEFT JOIN dim_veh dv ON dv.vehicle_id = l.vehicle_id
  LEFT JOIN dim_cust dc ON dc.customer_id = o.customer_id
  LEFT JOIN calendar c ON c.full_date =
    CAST(coalesce(fc_received_at, TIMESTAMP '2027-06-30 00:00:00') AS DATE)""",
    "warehouse": f"""
  SELECT fc_id, d.fulfillment_center_name AS fc_name, d.region,
    count(shipment_id) AS shipment_volume, {rnd("avg(fc_time_minutes)", 1)} AS avg_fc_time_min,
    count(CASE WHEN is_delayed THEN 1 END) AS delayed_count,
    {pct("count(CASE WHEN is_delayed THEN 1 END)", "count(shipment_id)")} AS delayed_pct
  FROM fact LEFT JOIN dim_fc d ON fc_sk = d.surrogate_key
  WHERE fc_sk IS NOT NULL GROUP BY 1, 2, 3""",
    "station": f"""
  SELECT ds_id, d.delivery_station_name AS ds_name, d.region,
    count(shipment_id) AS shipment_volume, {rnd("avg(ds_time_minutes)", 1)} AS avg_ds_time_min,
    count(CASE WHEN is_delayed THEN 1 END) AS delayed_count,
    {pct("count(CASE WHEN is_delayed THEN 1 END)", "count(shipment_id)")} AS delayed_pct
  FROM fact LEFT JOIN dim_ds d ON ds_sk = d.surrogate_key
  WHERE ds_sk IS NOT NULL GROUP BY 1, 2, 3""",
    "outcome": """
  SELECT *, CASE WHEN shipment_status = 'DELIVERED' THEN 1 END AS done,
    CASE WHEN shipment_status = 'DELIVERED' AND sla_breached = false THEN 1 END AS on_time,
    CASE WHEN sla_breached THEN 1 END AS late FROM fact""",
    "kpis": f"""
  SELECT count(shipment_id) AS total_shipments, count(done) AS delivered_count,
    count(on_time) AS on_time_count, {pct("count(on_time)", "count(done)")} AS on_time_pct,
    {rnd("avg(delay_minutes)", 1)} AS avg_delay_min, count(late) AS sla_breach_count,
    {pct("count(late)", "count(done)")} AS sla_breach_pct FROM outcome""",
    "monthly": f"""
  SELECT c.year, c.month, c.month_name, count(shipment_id) AS shipment_volume,
    count(done) AS delivered_count, count(on_time) AS on_time_count,
    {pct("count(on_time)", "count(done)")} AS on_time_pct,
    {rnd("avg(delay_minutes)", 1)} AS avg_delay_min
  FROM outcome LEFT JOIN calendar c USING (date_key) GROUP BY 1, 2, 3""",
    "cost": f"""
  SELECT delivery_type, count(shipment_id) AS total_shipments,
    {rnd("sum(transportation_cost)", 2)} AS total_transport_cost,
    {rnd("sum(sla_penalty_amount)", 2)} AS total_sla_penalty,
    {rnd("sum(refund_amount)", 2)} AS total_refunds,
    {rnd("avg(order_value)", 2)} AS avg_order_value FROM fact GROUP BY 1""",
    "lead": f"""
  SELECT delivery_type, count(shipment_id) AS shipment_count,
    {rnd("avg(lead_time_hours)", 2)} AS avg_lead_time_hrs,
    {rnd("min(lead_time_hours)", 2)} AS min_lead_time_hrs,
    {rnd("max(lead_time_hours)", 2)} AS max_lead_time_hrs
  FROM fact WHERE lead_time_hours IS NOT NULL GROUP BY 1""",
    # orders table as silver orders, and the customer tiers of two periods
    "trade": """
  SELECT 'ORD_' || o_orderkey AS order_id, 'CUST_' || o_custkey AS customer_id,
    o_orderdate AS event_timestamp,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'PRIME' ELSE 'STANDARD' END
      AS customer_tier,
    CASE o_orderstatus WHEN 'F' THEN 'SAME_DAY' ELSE 'STANDARD' END AS delivery_type,
    o_totalprice AS order_value FROM orders""",
    "tiers_before": """
  SELECT customer_id, arg_max(customer_tier, (event_timestamp, order_id)) AS customer_tier
  FROM trade WHERE event_timestamp < TIMESTAMP '1998-04-01' GROUP BY 1""",
    "tiers_after": """
  SELECT customer_id, arg_max(customer_tier, (event_timestamp, order_id)) AS customer_tier
  FROM trade WHERE event_timestamp >= TIMESTAMP '1998-04-01' GROUP BY 1""",
    "tiers_first": first_load("tiers_before", "customer_id", ("customer_tier",), "1995-01-01"),
    "history": second_load("tiers_first", "tiers_after", "customer_id", ("customer_tier",),
                           "1998-04-01", "customer_id, customer_tier"),
    "stale": """
  SELECT *, CASE facility_type WHEN 'FULFILLMENT_CENTER' THEN fc_name ELSE ds_name END AS name,
    (epoch(TIMESTAMP '2027-06-30') - epoch(stage_entered_at)) / 3600.0 AS hours FROM live
  WHERE (facility_type = 'FULFILLMENT_CENTER'
      AND stage_entered_at < TIMESTAMP '2027-06-30' - INTERVAL '4' HOUR
      AND shipment_status NOT IN ('DISPATCHED_FROM_FC', 'DELIVERED'))
    OR (facility_type = 'DELIVERY_STATION'
      AND stage_entered_at < TIMESTAMP '2027-06-30' - INTERVAL '1' HOUR
      AND shipment_status NOT IN ('OUT_FOR_DELIVERY', 'DELIVERED'))""",
    "delayed": """
  SELECT *, row_number() OVER (PARTITION BY shipment_id
    ORDER BY event_timestamp DESC, event_id DESC) AS nth FROM enr
  WHERE is_delayed AND delay_minutes > CASE delivery_type WHEN 'SAME_DAY' THEN 30 ELSE 120 END""",
    "delay_alert": """
  SELECT shipment_id || ':DELAY' AS alert_key, 'DELAY' AS alert_type, shipment_id AS subject_id,
    shipment_status || ' delay ' || delay_minutes AS detail,
    shipment_status, delivery_type, estimated_delivery_time, promised_delivery_time,
    NULL::TIMESTAMP AS previous_estimated_time, NULL::TIMESTAMP AS stage_entered_at
  FROM delayed WHERE nth = 1""",
    "stale_alert": """
  SELECT shipment_id || ':STALE' AS alert_key, 'STALE' AS alert_type, shipment_id AS subject_id,
    facility_id || ' ' || shipment_status AS detail, shipment_status, NULL::VARCHAR AS delivery_type,
    NULL::TIMESTAMP AS estimated_delivery_time, NULL::TIMESTAMP AS promised_delivery_time,
    NULL::TIMESTAMP AS previous_estimated_time, stage_entered_at FROM stale""",
    "legs": """
  SELECT vehicle_id, shipment_id, min(event_timestamp) AS starts_at,
    max(event_timestamp) FILTER (stage = 7) AS ends_at
  FROM ev WHERE vehicle_id IS NOT NULL AND stage >= 5 GROUP BY 1, 2""",
}


def over_views(query: str) -> str:
    """The query on top of VIEWS. One that starts with a comma adds views of its own."""
    views = ",\n".join(f"{name} AS ({text})" for name, text in VIEWS.items())
    return f"WITH {views}\n{query}"


def text(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c.split('.')[-1]}" for c in columns)


SPOILED = """CASE WHEN value > 200 THEN substr(props, 1, 4)
  WHEN value > 150 THEN regexp_replace(props, '[0-9]+', '"x"', 'g')
  WHEN value > 120 THEN '' WHEN value > 100 THEN NULL ELSE props END"""

ISO = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"

FACT_TEXT = ("promised_delivery_time", "fc_received_at", "dispatched_from_fc_at",
             "received_at_ds_at", "out_for_delivery_at", "actual_delivery_time")
VERSION_TEXT = ("effective_from", "effective_to")


def replaced(columns: tuple[str, ...], source: str) -> str:
    changes = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({changes}) FROM {source}"


def facility_versions(source: str, dim: str, key: str, tracked: tuple[str, ...]) -> str:
    columns = ", ".join((key, *tracked))
    grown = f"""(SELECT * REPLACE (CASE WHEN daily_capacity > 5000
      THEN CAST(floor(daily_capacity + daily_capacity / 10.0) AS INTEGER)
      ELSE daily_capacity END AS daily_capacity) FROM {source})"""
    return second_load(dim, grown, key, tracked, "2024-02-01", columns)


def facility_history(source: str, dim: str, key: str, tracked: tuple[str, ...]) -> str:
    return replaced(VERSION_TEXT, f"({facility_versions(source, dim, key, tracked)})")


VEHICLE_VERSIONS = second_load(
    "dim_veh", "(SELECT * REPLACE (CASE status WHEN 'IN_USE' THEN 'AVAILABLE' ELSE status END"
    " AS status) FROM vehicle)", "vehicle_id", VEH_TRACKED, "2024-02-01",
    ", ".join(("vehicle_id", *VEH_TRACKED)))


def fact_keys(held: str) -> str:
    """Shipments with the keys of the versions for which `held` is true."""
    return f"""
    , fc2 AS ({facility_versions("fc", "dim_fc", "fulfillment_center_id", FC_TRACKED)}),
    ds2 AS ({facility_versions("ds", "dim_ds", "delivery_station_id", DS_TRACKED)}),
    veh2 AS ({VEHICLE_VERSIONS}),
    shipment AS (SELECT shipment_id, fc_id, ds_id, vehicle_id, customer_id, date_key,
      CAST(coalesce(fc_received_at, TIMESTAMP '2027-06-30 00:00:00') AS DATE) AS day FROM fact)
    SELECT shipment_id, date_key, f.surrogate_key AS fc_sk, d.surrogate_key AS ds_sk,
      v.surrogate_key AS vehicle_sk, c.surrogate_key AS customer_sk
    FROM shipment s
    LEFT JOIN fc2 f ON f.fulfillment_center_id = s.fc_id AND {held.format("f")}
    LEFT JOIN ds2 d ON d.delivery_station_id = s.ds_id AND {held.format("d")}
    LEFT JOIN veh2 v ON v.vehicle_id = s.vehicle_id AND {held.format("v")}
    LEFT JOIN dim_cust c ON c.customer_id = s.customer_id AND {held.format("c")}"""


def colour(value: str, first: float, second: float | None, colours: str) -> str:
    low, *middle, high = colours.split()
    between = f"WHEN {value} < {second} THEN '{middle[0]}'" if middle else ""
    return f"CASE WHEN {value} IS NULL THEN NULL WHEN {value} < {first} THEN '{low}' {between} ELSE '{high}' END"


def backlog(stages: str, name: str) -> str:
    return f"""SELECT coalesce({name}, facility_id) AS facility, count(*) AS backlog FROM live
      WHERE shipment_status IN ({stages}) GROUP BY facility_id, {name}"""


ALERT_TEXT = ("estimated_delivery_time", "promised_delivery_time", "previous_estimated_time",
              "stage_entered_at")
NO_SUBJECT = ", ".join(f"NULL::VARCHAR AS {c}" for c in ("shipment_status", "delivery_type", *ALERT_TEXT))


def backlog_alert(stages: str, limit: int, kind: str) -> str:
    return f"""SELECT facility_id || ':{kind}' AS alert_key, '{kind}' AS alert_type,
      facility_id AS subject_id, CAST(count(*) AS VARCHAR) AS detail, {NO_SUBJECT} FROM live
      WHERE shipment_status IN ({stages}) GROUP BY facility_id HAVING count(*) > {limit}"""


FC_STAGES = "'ORDER_ALLOCATED_TO_FC', 'PICKED_AND_PACKED'"
DS_STAGES = "'RECEIVED_AT_DS', 'ASSIGNED_TO_DRIVER'"
ACTIVE = "shipment_status <> 'DELIVERED'"


def stale_panel(kind: str) -> str:
    return f"""SELECT shipment_id, shipment_status, coalesce(name, facility_id) AS facility,
      {text("stage_entered_at")}, {rnd("hours", 1)} AS hours_stuck
      FROM stale WHERE facility_type = '{kind}'"""


LIVE_COLUMNS = """shipment_id, order_id, shipment_status, event_timestamp, customer_tier,
 delivery_type, is_delayed, delay_minutes, facility_id, facility_type, fc_name, ds_name, fc_region,
 ds_region, vehicle_id, estimated_delivery_time, promised_delivery_time, is_sla_at_risk,
 is_priority"""

# One row per conflicting pair of legs of a vehicle; a leg still under way has no end.
CONFLICT = """
  SELECT a.vehicle_id, a.shipment_id, a.starts_at, a.ends_at,
    max(CASE WHEN b.starts_at < a.starts_at
      THEN coalesce(b.ends_at, TIMESTAMP '9999-12-31') END) AS busy
  FROM legs a JOIN legs b ON a.vehicle_id = b.vehicle_id AND a.shipment_id <> b.shipment_id
    AND (b.starts_at = a.starts_at OR (b.starts_at < a.starts_at
      AND (b.ends_at IS NULL OR b.ends_at > a.starts_at)))
  GROUP BY 1, 2, 3, 4"""

ORACLES = {
    "q_parse_json":
        "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "q_parse_quarantine": f"""
        SELECT event_id, t AS json_payload FROM (SELECT event_id, {SPOILED} AS t FROM events)
        WHERE t IS NULL OR NOT json_valid(t)
          OR try_cast(json_extract_string(t, '$.k') AS INTEGER) IS NULL""",
    "q_silver_orders": f"""
        WITH m AS (SELECT 'ORD_' || l_orderkey AS order_id,
            CASE WHEN l_quantity < 49 THEN {ISO.format("l_shipdate")} ELSE 'garbage' END AS t,
            'CUST_' || l_suppkey AS customer_id, l_extendedprice - 5000.0 AS order_value,
            l_partkey AS pos, l_linenumber AS part, l_shipdate
          FROM lineitem WHERE l_quantity > 2 AND l_extendedprice - 5000.0 > 0),
        good AS (SELECT *, row_number() OVER (PARTITION BY order_id
            ORDER BY t DESC, pos DESC, customer_id DESC, order_value DESC) AS rn
          FROM m WHERE t <> 'garbage'),
        bad AS (SELECT *, row_number() OVER (PARTITION BY order_id, part, pos
            ORDER BY customer_id DESC, order_value DESC) AS rn
          FROM m WHERE t = 'garbage')
        SELECT order_id, CAST(strptime(t, '%Y-%m-%dT%H:%M:%SZ') AS VARCHAR) AS event_timestamp,
          customer_id, order_value, false AS quarantined FROM good WHERE rn = 1
        UNION ALL SELECT order_id, NULL, customer_id, order_value, true FROM bad WHERE rn = 1""",
    "q_enum_filter": over_views("SELECT vehicle_id, vehicle_type, status FROM vehicle"),
    "q_ts_cast": """
        SELECT event_id, CASE WHEN value <= 150
            THEN CAST(date_trunc('second', ts) AS VARCHAR) END AS event_timestamp,
          value > 150 AS bad_time FROM events""",
    "q_dedup_latest": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
          CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
            l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""",
    "q_sla_at_risk": over_views(
        "SELECT event_id, shipment_id, is_sla_at_risk, is_priority FROM enr"),
    "q_enrich_events": over_views("""
        SELECT event_id, facility_id, vehicle_id, fc_name, fc_region, ds_name, ds_region,
          vehicle_type FROM enr"""),
    "q_scd2_hash": over_views("SELECT delivery_station_id, row_hash, surrogate_key FROM dim_ds"),
    "q_scd2_initial": over_views(replaced(VERSION_TEXT, "(" + first_load(
        "(SELECT customer_id, arg_max(customer_tier, (event_timestamp, order_id)) AS customer_tier"
        " FROM trade GROUP BY 1)", "customer_id", ("customer_tier",), "1995-01-01") + ")")),
    "q_scd2_changes": over_views(f"""
        SELECT f.customer_id, f.row_hash AS old_hash, {md5_of("a.customer_tier")} AS row_hash
        FROM tiers_first f JOIN tiers_after a USING (customer_id)
        WHERE f.customer_tier <> a.customer_tier"""),
    "q_scd2_merge": over_views(replaced(VERSION_TEXT, "history")),
    "q_scd2_current": over_views(f"""
        SELECT customer_id, customer_tier, {text("effective_from")} FROM history
        WHERE effective_to = DATE '9999-12-31'"""),
    "q_scd2_asof": over_views("""
        SELECT t.order_id, t.customer_id, CAST(CAST(t.event_timestamp AS DATE) AS VARCHAR)
            AS order_date, h.customer_tier, h.row_hash
        FROM trade t LEFT JOIN history h ON h.customer_id = t.customer_id
          AND CAST(t.event_timestamp AS DATE) >= h.effective_from
          AND CAST(t.event_timestamp AS DATE) < h.effective_to"""),
    "q_scd2_asof_sorted": over_views("""
        SELECT t.order_id, t.customer_id, CAST(CAST(t.event_timestamp AS DATE) AS VARCHAR)
            AS order_date, h.customer_tier, h.row_hash
        FROM trade t LEFT JOIN history h ON h.customer_id = t.customer_id
          AND CAST(t.event_timestamp AS DATE) >= h.effective_from
          AND CAST(t.event_timestamp AS DATE) < h.effective_to"""),
    "q_dim_fc": over_views(facility_history("fc", "dim_fc", "fulfillment_center_id", FC_TRACKED)),
    "q_dim_ds": over_views(facility_history("ds", "dim_ds", "delivery_station_id", DS_TRACKED)),
    "q_dim_vehicle": over_views(replaced(VERSION_TEXT, f"({VEHICLE_VERSIONS})")),
    "q_dim_customer": over_views(replaced(VERSION_TEXT, "(" + first_load(
        "(SELECT customer_id, arg_max(customer_tier, (event_timestamp, order_id)) AS customer_tier"
        " FROM trade GROUP BY 1)", "customer_id", ("customer_tier",), "2024-01-01") + ")")),
    "q_dim_date": over_views("""
        SELECT CAST(c.full_date AS VARCHAR) AS full_date, date_key, day, month, quarter, year, week,
          day_name, month_name, is_weekend, coalesce(events, 0) AS events
        FROM calendar c LEFT JOIN (SELECT CAST(event_timestamp AS DATE) AS full_date, count(*) AS events
          FROM ev GROUP BY 1) e ON c.full_date = e.full_date"""),
    "q_stage_pivot": over_views(
        f"SELECT shipment_id, {text(*FACT_TEXT[1:])}, fc_id, ds_id FROM stages"),
    "q_latest_state": over_views(f"""
        SELECT shipment_id, event_id, {text("event_timestamp")}, shipment_status, delay_minutes
        FROM latest"""),
    "q_fact_shipment": over_views(replaced(FACT_TEXT, "fact")),
    "q_fact_versions": over_views(fact_keys("{}.is_current")),
    "q_fact_asof": over_views(fact_keys("day >= {0}.effective_from AND day < {0}.effective_to")),
    "q_fact_date_key": over_views(
        f"SELECT shipment_id, {text('fc_received_at')}, date_key FROM fact"),
    "q_bi_warehouse": over_views("SELECT * FROM warehouse"),
    "q_bi_delivery_station": over_views("SELECT * FROM station"),
    "q_bi_kpis": over_views("SELECT * FROM kpis"),
    "q_bi_monthly": over_views("SELECT * FROM monthly ORDER BY year, month"),
    "q_bi_cost": over_views("SELECT * FROM cost"),
    "q_bi_lead_time": over_views("SELECT * FROM lead"),
    "q_panel_kpis": over_views(
        "SELECT total_shipments, on_time_pct, avg_delay_min, sla_breach_pct FROM kpis"),
    "q_panel_warehouse": over_views("""
        SELECT fc_name AS "FC Name", region AS "Region", shipment_volume AS "Volume",
          avg_fc_time_min AS "Avg Dispatch (min)", delayed_count AS "Delayed",
          delayed_pct AS "Delayed %" FROM warehouse ORDER BY shipment_volume DESC"""),
    "q_panel_station": over_views("""
        SELECT ds_name AS "DS Name", region AS "Region", shipment_volume AS "Volume",
          avg_ds_time_min AS "Avg Process (min)", delayed_count AS "Delayed",
          delayed_pct AS "Delayed %" FROM station ORDER BY shipment_volume DESC"""),
    "q_panel_monthly": over_views("""
        SELECT month_name AS "Month", shipment_volume AS "Shipments", on_time_pct AS "On-Time %",
          avg_delay_min AS "Avg Delay (min)" FROM monthly ORDER BY year, month"""),
    "q_panel_cost": over_views("""
        SELECT delivery_type AS "Delivery Type", total_shipments AS "Shipments",
          total_transport_cost AS "Transport Cost ($)", total_sla_penalty AS "SLA Penalty ($)",
          total_refunds AS "Refunds ($)", avg_order_value AS "Avg Order ($)"
        FROM cost ORDER BY total_shipments DESC"""),
    "q_panel_lead_time": over_views("""
        SELECT delivery_type AS "Delivery Type", shipment_count AS "Shipments",
          avg_lead_time_hrs AS "Avg (hrs)", min_lead_time_hrs AS "Min (hrs)",
          max_lead_time_hrs AS "Max (hrs)" FROM lead"""),
    "q_bands": over_views("SELECT fc_id, " + ", ".join([
        colour("delayed_count", 10, 30, "green yellow red") + " AS delayed_shipments_band",
        colour("delayed_count", 5, 15, "green yellow red") + " AS sla_at_risk_band",
        colour("avg_fc_time_min", 30, 60, "green yellow red") + " AS avg_delay_min_band",
        colour("shipment_volume", 7, 10, "green yellow red") + " AS fc_backlog_band",
        colour("shipment_volume", 5, 8, "green yellow red") + " AS ds_backlog_band",
        colour("(100 - delayed_pct)", 85, 95, "red yellow green") + " AS on_time_pct_band",
        colour("delayed_pct", 5, 15, "green yellow red") + " AS sla_breach_pct_band",
        colour("delayed_pct", 10, 25, "green yellow red") + " AS delayed_pct_band",
        colour("avg_fc_time_min", 60, 120, "green yellow red") + " AS avg_fc_time_min_band",
        colour("avg_fc_time_min", 30, 60, "green yellow red") + " AS avg_ds_time_min_band",
        colour("avg_fc_time_min", 1000, 5000, "green yellow red") + " AS total_sla_penalty_band",
        colour("avg_fc_time_min", 500, 2000, "green yellow red") + " AS total_refunds_band",
        colour("avg_fc_time_min", 24, 48, "green yellow red") + " AS avg_lead_time_hrs_band",
        colour("delayed_count", 8, None, "yellow red") + " AS fc_hours_stuck_band",
        colour("delayed_count", 3, None, "yellow red") + " AS ds_hours_stuck_band",
    ]) + " FROM warehouse"),
    "q_sql_warehouse": over_views(f"""
        SELECT fc_name AS "FC Name", region AS "Region", shipment_volume AS "Volume",
          avg_fc_time_min AS "Avg Dispatch (min)", delayed_count AS "Delayed",
          delayed_pct AS "Delayed %",
          {colour("delayed_pct", 10, 25, "green yellow red")} AS "Delayed % Band",
          {colour("avg_fc_time_min", 60, 120, "green yellow red")} AS "Avg Dispatch (min) Band"
        FROM warehouse"""),
    "q_sql_delayed": over_views(f"""
        SELECT value, {colour("value", 10, 30, "green yellow red")} AS "value Band"
        FROM (SELECT count(*) AS value FROM live WHERE {ACTIVE} AND is_delayed)"""),
    "q_sql_stale_ds": over_views(f"""
        SELECT shipment_id AS "Shipment", shipment_status AS "Status",
          coalesce(name, facility_id) AS "DS", CAST(stage_entered_at AS VARCHAR) AS "Stuck Since",
          {rnd("hours", 1)} AS "Hours Stuck", {colour(rnd("hours", 1), 3, None, "yellow red")}
          AS "Hours Stuck Band" FROM stale WHERE facility_type = 'DELIVERY_STATION'"""),
    "q_live_upsert": over_views(f"""
        , parts AS (SELECT *, (hour(event_timestamp) < 12) = is_priority AS old FROM enr),
        newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY shipment_id, old
          ORDER BY event_timestamp DESC, stage DESC, event_id DESC) AS rn FROM parts) WHERE rn = 1),
        a AS (SELECT * FROM newest WHERE old), b AS (SELECT * FROM newest WHERE NOT old),
        pick AS (
          SELECT b.*, CASE WHEN a.shipment_id IS NULL OR a.shipment_status <> b.shipment_status
              THEN b.event_timestamp ELSE a.event_timestamp END AS entered
            FROM b LEFT JOIN a ON a.shipment_id = b.shipment_id
            WHERE a.shipment_id IS NULL
              OR (b.event_timestamp, b.stage) >= (a.event_timestamp, a.stage)
          UNION ALL
          SELECT a.*, a.event_timestamp FROM a LEFT JOIN b ON a.shipment_id = b.shipment_id
            WHERE b.shipment_id IS NULL
              OR (b.event_timestamp, b.stage) < (a.event_timestamp, a.stage))
        SELECT {LIVE_COLUMNS}, entered AS stage_entered_at, event_timestamp AS last_updated
        FROM pick"""),
    "q_live_active": over_views(f"SELECT count(*) AS value FROM live WHERE {ACTIVE}"),
    "q_live_delayed": over_views(
        f"SELECT count(*) AS value FROM live WHERE is_delayed AND {ACTIVE}"),
    "q_live_sla_risk": over_views(
        f"SELECT count(*) AS value FROM live WHERE is_sla_at_risk AND {ACTIVE}"),
    "q_live_avg_delay": over_views(f"""
        SELECT coalesce({rnd("avg(delay_minutes)", 0)}, 0.0) AS value FROM live
        WHERE is_delayed AND {ACTIVE}"""),
    "q_live_by_status": over_views(
        "SELECT shipment_status, count(*) AS shipments FROM live GROUP BY 1"),
    "q_live_by_tier": over_views(
        f"SELECT customer_tier, count(*) AS shipments FROM live WHERE {ACTIVE} GROUP BY 1"),
    "q_fc_backlog": over_views(backlog(FC_STAGES, "fc_name")),
    "q_ds_backlog": over_views(backlog(DS_STAGES, "ds_name")),
    "q_stale_fc": over_views(stale_panel("FULFILLMENT_CENTER")),
    "q_stale_ds": over_views(stale_panel("DELIVERY_STATION")),
    "q_live_feed": over_views(f"""
        SELECT shipment_id, shipment_status, customer_tier, delivery_type, is_delayed,
          delay_minutes, is_sla_at_risk, coalesce(fc_name, ds_name, facility_id) AS facility,
          {text("last_updated")} FROM live ORDER BY live.last_updated DESC, shipment_id LIMIT 25"""),
    "q_alert_prime_sla": over_views("""
        SELECT shipment_id || ':PRIME_SLA' AS alert_key, 'PRIME_SLA' AS alert_type,
          shipment_id AS subject_id, shipment_status || ' delay ' || delay_minutes AS detail,
          shipment_status, delivery_type, CAST(estimated_delivery_time AS VARCHAR) AS estimated_delivery_time,
          CAST(promised_delivery_time AS VARCHAR) AS promised_delivery_time,
          NULL::VARCHAR AS previous_estimated_time, NULL::VARCHAR AS stage_entered_at
        FROM (SELECT *, row_number() OVER (PARTITION BY shipment_id
            ORDER BY event_timestamp DESC, event_id DESC) AS nth
          FROM enr WHERE customer_tier = 'PRIME' AND is_sla_at_risk) WHERE nth = 1"""),
    "q_alert_delay": over_views(replaced(ALERT_TEXT, "delay_alert")),
    "q_eta_change": over_views("""
        , was AS (SELECT shipment_id, estimated_delivery_time AS eta FROM (SELECT *,
            row_number() OVER (PARTITION BY shipment_id
              ORDER BY event_timestamp DESC, stage DESC, event_id DESC) AS nth
            FROM ev WHERE hour(event_timestamp) < 12) WHERE nth = 1),
        hits AS (SELECT e.shipment_id, e.delivery_type, e.estimated_delivery_time, was.eta,
            (epoch(e.estimated_delivery_time) - epoch(was.eta)) / 60.0 AS minutes
          FROM ev e JOIN was ON was.shipment_id = e.shipment_id
          WHERE hour(e.event_timestamp) >= 12
            AND (epoch(e.estimated_delivery_time) - epoch(was.eta)) / 60.0
              > CASE e.delivery_type WHEN 'SAME_DAY' THEN 30 ELSE 120 END)
        SELECT shipment_id || ':ETA_CHANGE' AS alert_key, 'ETA_CHANGE' AS alert_type,
          shipment_id AS subject_id, 'eta + ' || CAST(round(max(minutes)) AS BIGINT) AS detail,
          NULL::VARCHAR AS shipment_status, arg_max(delivery_type, (minutes, delivery_type)) AS delivery_type,
          CAST(max(estimated_delivery_time) AS VARCHAR) AS estimated_delivery_time,
          NULL::VARCHAR AS promised_delivery_time, CAST(any_value(eta) AS VARCHAR) AS previous_estimated_time,
          NULL::VARCHAR AS stage_entered_at
        FROM hits GROUP BY shipment_id"""),
    "q_fc_backlog_alert": over_views(backlog_alert(FC_STAGES, 10, "FC_BACKLOG")),
    "q_ds_backlog_alert": over_views(backlog_alert(DS_STAGES, 8, "DS_BACKLOG")),
    "q_alert_stale": over_views(replaced(ALERT_TEXT, "stale_alert")),
    "q_alert_dedup": over_views("""
        SELECT alert_key, alert_type, subject_id FROM delay_alert
          WHERE subject_id NOT IN (SELECT shipment_id FROM live WHERE is_priority)
        UNION ALL
        SELECT alert_key, alert_type, subject_id FROM stale_alert
          WHERE subject_id NOT IN (
            SELECT shipment_id FROM live WHERE is_delayed AND delay_minutes * 30 <= 3600)"""),
    "q_lifecycle_check": over_views("""
        , seq AS (SELECT shipment_id, stage, stage - lag(stage) OVER (PARTITION BY shipment_id
            ORDER BY event_timestamp, stage) AS step,
          row_number() OVER (PARTITION BY shipment_id ORDER BY event_timestamp, stage) AS nth
          FROM ev)
        SELECT shipment_id, count(*) AS events, max(stage) AS furthest_stage,
          CAST(0 AS BIGINT) AS unknown_stages,
          count(*) - count(DISTINCT stage) AS repeated_stages,
          CAST(max(stage) - count(DISTINCT stage) AS INTEGER) AS skipped_stages,
          coalesce(bool_or(step < 0), false) AS out_of_order,
          bool_and(CASE WHEN nth = 1 THEN stage = 1 ELSE step = 1 END) AS conforms
        FROM seq GROUP BY shipment_id"""),
    "q_stage_rules": over_views("""
        , r AS (SELECT ev.*, v.vehicle_type,
            facility_type IS DISTINCT FROM CASE WHEN stage <= 3 THEN 'FULFILLMENT_CENTER'
              WHEN stage <= 5 THEN 'DELIVERY_STATION' END AS wrong_facility,
            v.vehicle_type IS DISTINCT FROM CASE WHEN stage IN (3, 4) THEN 'TRUCK'
              WHEN stage >= 5 THEN 'BIKE' END AS wrong_vehicle
          FROM ev LEFT JOIN vehicle v ON v.vehicle_id = ev.vehicle_id)
        SELECT event_id, shipment_id, shipment_status, facility_type, vehicle_type,
          wrong_facility, wrong_vehicle FROM r WHERE wrong_facility OR wrong_vehicle"""),
    "q_promised_time": over_views("""
        , p AS (SELECT order_id, order_value, event_timestamp + CASE delivery_type
            WHEN 'SAME_DAY' THEN INTERVAL '6' HOUR ELSE INTERVAL '48' HOUR END AS t FROM trade)
        SELECT order_id, CAST(t AS VARCHAR) AS promised_delivery_time,
          CAST(t + CAST(floor(order_value / 1000) AS INTEGER) * INTERVAL '1' MINUTE AS VARCHAR)
            AS expected_arrival FROM p"""),
    "q_network_check": over_views("""
        SELECT order_id, fulfillment_center_id, delivery_station_id FROM ord
        WHERE NOT EXISTS (SELECT 1 FROM customer
          WHERE 'DS_' || c_custkey = delivery_station_id
            AND 'FC_' || (c_custkey // 14) = fulfillment_center_id)"""),
    "q_vehicle_overlap": over_views(f"""
        SELECT vehicle_id, CAST(starts_at AS VARCHAR) AS starts_at, count(*) AS shipments,
          CAST(CASE WHEN max(busy) < TIMESTAMP '9999-12-31' THEN max(busy) END AS VARCHAR)
            AS busy_until
        FROM ({CONFLICT}) GROUP BY 1, 2"""),
    "q_vehicle_overlap_shipments": over_views(
        f"SELECT vehicle_id, shipment_id, {text('starts_at', 'ends_at')} FROM ({CONFLICT})"),
    "q_geofence": over_views("""
        , place AS (SELECT fulfillment_center_id AS id, latitude, longitude FROM raw_fc
            UNION ALL SELECT delivery_station_id, latitude, longitude FROM raw_ds),
        seen AS (SELECT e.event_id, e.shipment_id,
            coalesce(e.facility_id, o.delivery_station_id) AS place_id,
            abs(e.latitude - p.latitude) AS off_latitude,
            abs(e.longitude - p.longitude) AS off_longitude,
            p.latitude IS NULL OR p.longitude IS NULL AS unknown
          FROM ev e LEFT JOIN ord o ON o.shipment_id = e.shipment_id
          LEFT JOIN place p ON p.id = coalesce(e.facility_id, o.delivery_station_id))
        SELECT * FROM (SELECT * EXCLUDE (unknown), CASE WHEN unknown THEN 'unknown place'
            WHEN off_latitude IS NULL OR off_longitude IS NULL THEN 'no position'
            WHEN off_latitude > 0.01 OR off_longitude > 0.01 THEN 'off site' END AS reason FROM seen)
        WHERE reason IS NOT NULL"""),
}

# The live table's times as text.
ORACLES["q_live_upsert"] = replaced(
    ("event_timestamp", "estimated_delivery_time", "promised_delivery_time", "stage_entered_at",
     "last_updated"), f"({ORACLES['q_live_upsert']})")
