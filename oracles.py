"""DuckDB oracle SQL for every registered query.

Each oracle is independent SQL over the raw tables (views ``lineitem``,
``orders``, ``supplier``, ``customer`` …).  ``LEGS`` derives the segment
table exactly like ``lanegraph.sources.segments.legs_from_tables``.
"""

from __future__ import annotations

LEGS = """
j AS (
 SELECT l.*, o.o_custkey, o.o_orderdate, o.o_orderpriority, s.s_nationkey, c.c_nationkey,
  CAST(l.l_quantity AS BIGINT) AS q, CAST(round(l.l_discount*100) AS BIGINT) AS d100,
  row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_shipdate) AS seg_no
 FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN supplier s ON l.l_suppkey=s.s_suppkey JOIN customer c ON o.o_custkey=c.c_custkey),
k AS (SELECT j.*, q*(60+12*d100+50*((l_suppkey+o_custkey)%5)) AS act100,
  sum(q) OVER (PARTITION BY l_orderkey ORDER BY seg_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_q,
  sum(q*(60+12*d100+50*((l_suppkey+o_custkey)%5))) OVER (PARTITION BY l_orderkey ORDER BY seg_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_act100 FROM j),
legs AS (
SELECT CASE WHEN l_orderkey % 10 < 7 THEN 'training' ELSE 'test' END AS data,
 o_orderdate + INTERVAL '1' MINUTE * CAST(l_orderkey % 1440 AS INT) AS trip_creation_time,
 'sched-' || CAST(o_custkey % 50 AS STRING) AS route_schedule_uuid,
 CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'FTL' ELSE 'Carting' END AS route_type,
 'trip-' || CAST(l_orderkey AS STRING) AS trip_uuid, CAST(seg_no AS BIGINT) AS seg_no,
 'F' || CAST(s_nationkey AS STRING) || '_' || CAST(l_suppkey % 5 AS STRING) AS source_center,
 CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE 'City' || CAST(s_nationkey AS STRING) || '_Area' || CAST(l_suppkey % 5 AS STRING) || CASE l_suppkey % 5 WHEN 0 THEN '_HB' WHEN 1 THEN '_H' WHEN 2 THEN 'DPP_D' WHEN 3 THEN '_DC' ELSE '_X' END || ' (State' || CAST(s_nationkey % 5 AS STRING) || ')' END AS source_name,
 'F' || CAST(c_nationkey AS STRING) || '_' || CAST(o_custkey % 5 AS STRING) AS destination_center,
 CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE 'City' || CAST(c_nationkey AS STRING) || '_Area' || CAST(o_custkey % 5 AS STRING) || CASE o_custkey % 5 WHEN 0 THEN '_HB' WHEN 1 THEN '_H' WHEN 2 THEN 'DPP_D' WHEN 3 THEN '_DC' ELSE '_X' END || ' (State' || CAST(c_nationkey % 5 AS STRING) || ')' END AS destination_name,
 o_orderdate + INTERVAL '1' MINUTE * CAST(l_orderkey % 1440 + seg_no*15 - CASE WHEN l_partkey % 50 = 0 THEN 60 ELSE 0 END AS INT) AS od_start_time,
 o_orderdate + INTERVAL '1' MINUTE * CAST(l_orderkey % 1440 + seg_no*15 - CASE WHEN l_partkey % 50 = 0 THEN 60 ELSE 0 END + q*3 AS INT) AS od_end_time,
 CAST(cum_act100 AS DOUBLE)/100 + 30 AS start_scan_to_end_scan,
 l_linestatus = 'O' AS is_cutoff,
 CAST(cum_q AS INT) AS cutoff_factor,
 o_orderdate + INTERVAL '1' MINUTE * CAST(l_orderkey % 1440 + seg_no*20 AS INT) AS cutoff_timestamp,
 CAST(cum_q*13 AS DOUBLE)/10 AS actual_distance_to_destination,
 CAST(cum_q AS DOUBLE) AS osrm_time, CAST(cum_q*12 AS DOUBLE)/10 AS osrm_distance, CAST(cum_act100 AS DOUBLE)/100 AS actual_time,
 CAST(cum_act100 AS DOUBLE)/100/CAST(cum_q AS DOUBLE) AS factor,
 CASE WHEN l_partkey % 89 = 0 THEN -CAST(q AS DOUBLE) ELSE CAST(act100 AS DOUBLE)/100 END AS segment_actual_time,
 CASE WHEN l_partkey % 61 = 0 THEN 0.0E0 ELSE CAST(q AS DOUBLE) END AS segment_osrm_time,
 CASE WHEN l_partkey % 71 = 0 THEN 0.0E0 ELSE CAST(q*12 AS DOUBLE)/10 END AS segment_osrm_distance,
 CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE (CASE WHEN l_partkey % 89 = 0 THEN -CAST(q AS DOUBLE) ELSE CAST(act100 AS DOUBLE)/100 END) / CAST(q AS DOUBLE) END AS segment_factor
FROM k)"""


# Facility type suffixes in test order.
_TYPES = ["HB", "H", "DC", "DPP", "D", "CP", "BO", "BM", "GW"]


def _parse_sql(name: str, pre: str) -> str:
    stripped = f"trim(regexp_replace({name}, '\\s*\\([^)]+\\)\\s*', '', 'g'))"
    parts = f"string_split({stripped}, '_')"
    last = f"upper({parts}[-1])"
    suffix = " ".join(f"WHEN len({parts}) >= 2 AND ends_with({last}, '{t}') THEN '{t}'" for t in _TYPES)
    anywhere = " ".join(f"WHEN contains(upper({name}), '_{t}') THEN '{t}'" for t in _TYPES)
    blank = f"{name} IS NULL OR {name} = ''"
    return (f"CASE WHEN {blank} THEN NULL ELSE {parts}[1] END AS {pre}city, "
            f"CASE WHEN {blank} THEN NULL WHEN regexp_matches({name}, '\\(([^)]+)\\)') "
            f"THEN trim(regexp_extract({name}, '\\(([^)]+)\\)', 1)) END AS {pre}state, "
            f"CASE WHEN {blank} THEN NULL {suffix} ELSE CASE {anywhere} ELSE 'Unknown' END END AS {pre}facility_type")


CLEAN = """,
cl0 AS (SELECT * REPLACE (CASE WHEN segment_actual_time < 0 THEN 0.0E0 ELSE segment_actual_time END AS segment_actual_time,
   nullif(segment_osrm_time, 0.0E0) AS segment_osrm_time, nullif(segment_osrm_distance, 0.0E0) AS segment_osrm_distance) FROM legs),
cl1 AS (SELECT *, """ + _parse_sql("source_name", "source_") + ", " + _parse_sql("destination_name", "dest_") + """ FROM cl0),
sn AS (SELECT source_center, source_name AS kn FROM (SELECT source_center, source_name,
   row_number() OVER (PARTITION BY source_center ORDER BY trip_uuid, seg_no) AS rn FROM cl1
   WHERE source_name IS NOT NULL AND source_center IS NOT NULL) WHERE rn = 1),
dn AS (SELECT destination_center, destination_name AS kn FROM (SELECT destination_center, destination_name,
   row_number() OVER (PARTITION BY destination_center ORDER BY trip_uuid, seg_no) AS rn FROM cl1
   WHERE destination_name IS NOT NULL AND destination_center IS NOT NULL) WHERE rn = 1),
clean AS (SELECT cl1.* REPLACE (coalesce(cl1.source_name, sn.kn) AS source_name, coalesce(cl1.destination_name, dn.kn) AS destination_name),
   CASE WHEN cl1.source_state = cl1.dest_state THEN 1 ELSE 0 END AS is_intrastate
  FROM cl1 LEFT JOIN sn ON cl1.source_center = sn.source_center LEFT JOIN dn ON cl1.destination_center = dn.destination_center)"""


def with_legs(body: str, clean: bool = False) -> str:
    """Prefix an oracle body (``name AS (...), ... SELECT``) with the leg view
    (and the cleaned view ``clean`` when asked)."""
    body = body.strip()
    head = "WITH " + LEGS + (CLEAN if clean else "")
    if body.upper().startswith("SELECT"):
        return head + "\n" + body
    return head + ",\n" + body


ORACLES: dict[str, str] = {}


def register(name: str, body: str, legs: bool = True, clean: bool = False) -> None:
    ORACLES[name] = with_legs(body, clean) if legs else body.strip()


register("corridor_bottlenecks", """
c AS (SELECT source_center, destination_center, avg(factor) AS ratio, stddev_samp(factor) AS sd, count(*) AS seg_count,
   count(DISTINCT trip_uuid) AS trip_count, avg(CASE WHEN factor > 1.5 THEN 1.0E0 ELSE 0.0E0 END) AS sla
  FROM legs WHERE data = 'training' GROUP BY source_center, destination_center),
m AS (SELECT max(ratio) AS mr, max(trip_count) AS mt FROM c)
SELECT source_center, destination_center, seg_count AS segment_count, trip_count, round(ratio, 9) AS delay_ratio_mean, round(sla, 9) AS sla_breach_pct,
 round(CASE WHEN ratio > 0 THEN least(greatest(1 - coalesce(sd, 0.0E0) / ratio, 0.0E0), 1.0E0) ELSE 0.0E0 END, 9) AS corridor_reliability,
 CASE WHEN ratio > 0 AND ratio <= 1.3E0 THEN 'Healthy' WHEN ratio > 1.3E0 AND ratio <= 2 THEN 'Moderate' WHEN ratio > 2 AND ratio <= 3 THEN 'Severe' WHEN ratio > 3 THEN 'Critical' END AS delay_class,
 round((sla * 0.4E0 + ratio / mr * 0.3E0 + CAST(trip_count AS DOUBLE) / mt * 0.3E0) * 100, 9) AS corridor_impact
FROM c CROSS JOIN m ORDER BY corridor_impact DESC, source_center, destination_center LIMIT 20
""")


# ------------------------------------------------------------ helpers for bodies

LEG_COLS = {
    "data": "s", "trip_creation_time": "t", "route_schedule_uuid": "s", "route_type": "s",
    "trip_uuid": "s", "seg_no": "i", "source_center": "s", "source_name": "s",
    "destination_center": "s", "destination_name": "s", "od_start_time": "t", "od_end_time": "t",
    "start_scan_to_end_scan": "d", "is_cutoff": "b", "cutoff_factor": "i", "cutoff_timestamp": "t",
    "actual_distance_to_destination": "d", "osrm_time": "d", "osrm_distance": "d", "actual_time": "d",
    "factor": "d", "segment_actual_time": "d", "segment_osrm_time": "d", "segment_osrm_distance": "d",
    "segment_factor": "d",
}


def fin(expr: str, kind: str, alias: str) -> str:
    """Same presentation as the Spark side: round doubles, timestamps as text."""
    if kind == "d":
        return f"CASE WHEN round({expr}, 9) = 0 THEN 0.0E0 ELSE round({expr}, 9) END AS {alias}"
    if kind == "t":
        return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {alias}"
    return f"{expr} AS {alias}"


register("scan_segments", "SELECT " + ", ".join(fin(c, k, c) for c, k in LEG_COLS.items()) + " FROM legs")

register("split_train_test", """
SELECT data, count(*) AS segments, count(DISTINCT trip_uuid) AS trips FROM legs GROUP BY data""")

register("sample_rows", "SELECT " + ", ".join(fin(c, k, c) for c, k in LEG_COLS.items())
         + " FROM legs ORDER BY trip_uuid, seg_no LIMIT 1000")

register("clean_segments", """
SELECT trip_uuid, seg_no, round(segment_actual_time, 9) AS segment_actual_time,
 round(segment_osrm_time, 9) AS segment_osrm_time, round(segment_osrm_distance, 9) AS segment_osrm_distance,
 source_name, destination_name, source_city, source_state, source_facility_type,
 dest_city, dest_state, dest_facility_type, is_intrastate FROM clean""", clean=True)

register("clean_repair_counts", """
SELECT count(*) FILTER (WHERE segment_actual_time < 0) AS negative_segment_actual_time,
 count(*) FILTER (WHERE segment_osrm_time = 0) AS zero_segment_osrm_time,
 count(*) FILTER (WHERE segment_osrm_distance = 0) AS zero_segment_osrm_distance,
 count(*) FILTER (WHERE source_name IS NULL) AS missing_source_name,
 count(*) FILTER (WHERE destination_name IS NULL) AS missing_destination_name FROM legs""")

register("backfill_names", """
SELECT count(*) FILTER (WHERE l.source_name IS NULL) AS src_missing,
 count(*) FILTER (WHERE l.source_name IS NULL AND sn.kn IS NOT NULL) AS src_filled,
 count(*) FILTER (WHERE l.destination_name IS NULL) AS dst_missing,
 count(*) FILTER (WHERE l.destination_name IS NULL AND dn.kn IS NOT NULL) AS dst_filled
FROM legs l LEFT JOIN sn ON l.source_center = sn.source_center LEFT JOIN dn ON l.destination_center = dn.destination_center
""", clean=True)

# Aggregate-level type tokens in test order.
_TOKENS = ["HB", "DC", "DPP", "CP", "BO", "_H ", "_H(", "_D ", "_D("]
_token_case = "CASE WHEN name IS NULL THEN 'Unknown' " + " ".join(
    f"WHEN contains(name, '{t}') OR ends_with(name, '{t.strip()}') THEN '{t.strip().replace('(', '').replace('_', '')}'"
    for t in _TOKENS) + " ELSE 'Unknown' END"

register("parse_facility", """
names AS (SELECT DISTINCT name FROM (SELECT source_name AS name FROM legs UNION ALL SELECT destination_name FROM legs) WHERE name IS NOT NULL)
SELECT name, """ + _parse_sql("name", "") + ", " + _token_case + """ AS type_by_token,
 CASE WHEN contains(name, '(') AND contains(name, ')') THEN trim(replace(string_split(name, '(')[-1], ')', '')) END AS state_last_paren
FROM names""")

_first = ["data", "route_schedule_uuid", "route_type", "source_center", "source_name", "source_city",
          "source_state", "source_facility_type", "is_intrastate", "trip_creation_time", "od_start_time"]
_last = ["destination_center", "destination_name", "dest_city", "dest_state", "dest_facility_type"]
TRIP_KINDS = {c: "s" for c in _first + _last}
TRIP_KINDS.update({"is_intrastate": "i", "trip_creation_time": "t", "od_start_time": "t"})
_trip_raw = [f"arg_min({c}, seg_no) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _first]
_trip_raw += [f"arg_max({c}, seg_no) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _last]
for _c in ["osrm_time", "osrm_distance", "actual_time", "actual_distance_to_destination", "start_scan_to_end_scan"]:
    _trip_raw.append(f"max({_c}) AS {_c}")
    TRIP_KINDS[_c] = "d"
for _c in ["segment_osrm_time", "segment_osrm_distance", "segment_actual_time"]:
    _trip_raw += [f"coalesce(sum({_c}), 0.0E0) AS {_c}_sum", f"avg({_c}) AS {_c}_mean",
                  f"stddev_samp({_c}) AS {_c}_std", f"max({_c}) AS {_c}_max"]
    TRIP_KINDS.update({f"{_c}_{a}": "d" for a in ("sum", "mean", "std", "max")})
_trip_raw += ["max(factor) AS factor", "CAST(coalesce(sum(CAST(is_cutoff AS INT)), 0) AS BIGINT) AS cutoff_count",
              "count(*) AS num_segments",
              "CASE WHEN max(osrm_time) > 0 THEN max(osrm_distance) / (max(osrm_time) / 60) ELSE 0.0E0 END AS osrm_speed"]
TRIP_KINDS.update({"factor": "d", "cutoff_count": "i", "num_segments": "i", "osrm_speed": "d"})
TRIPS_CTE = ("trips AS (SELECT trip_uuid, " + ", ".join(_trip_raw)
             + " FROM clean WHERE trip_uuid IS NOT NULL GROUP BY trip_uuid)")
register("agg_trips", TRIPS_CTE + "\nSELECT trip_uuid, " + ", ".join(fin(c, k, c) for c, k in TRIP_KINDS.items())
         + " FROM trips", clean=True)

CORRIDORS_SQL = """
SELECT source_center, destination_center, avg(actual_time) AS actual_time_mean, median(actual_time) AS actual_time_median,
 stddev_samp(actual_time) AS actual_time_std, count(actual_time) AS segment_count,
 avg(osrm_time) AS osrm_time_mean, max(osrm_time) AS osrm_time_max, avg(osrm_distance) AS osrm_distance_mean,
 max(osrm_distance) AS osrm_distance_max, avg(factor) AS delay_ratio_mean, median(factor) AS delay_ratio_median,
 stddev_samp(factor) AS delay_ratio_std, count(DISTINCT trip_uuid) AS trip_count,
 avg(CASE WHEN factor > 1.5 THEN 1.0E0 ELSE 0.0E0 END) AS sla_breach_pct
FROM {src} WHERE source_center IS NOT NULL AND destination_center IS NOT NULL GROUP BY source_center, destination_center"""

MODE_SQL = """
SELECT source_center, destination_center, route_type AS primary_route_type FROM (
 SELECT source_center, destination_center, route_type, row_number() OVER (PARTITION BY source_center, destination_center ORDER BY count(*) DESC, route_type) AS rn
 FROM {src} WHERE source_center IS NOT NULL AND destination_center IS NOT NULL AND route_type IS NOT NULL
 GROUP BY source_center, destination_center, route_type) WHERE rn = 1"""

BAND = ("CASE WHEN {r} > 0 AND {r} <= 1.3E0 THEN 'Healthy' WHEN {r} > 1.3E0 AND {r} <= 2 THEN 'Moderate' "
        "WHEN {r} > 2 AND {r} <= 3 THEN 'Severe' WHEN {r} > 3 THEN 'Critical' END")
RELIABILITY = ("CASE WHEN delay_ratio_mean > 0 THEN least(greatest(1 - coalesce(delay_ratio_std, 0.0E0) / delay_ratio_mean,"
               " 0.0E0), 1.0E0) ELSE 0.0E0 END")


def corridors_cte(src: str = "tr") -> str:
    """CTE ``cs``: full corridor table (with mode, reliability, band) over ``src``."""
    return (f"cs0 AS ({CORRIDORS_SQL.format(src=src)}), md AS ({MODE_SQL.format(src=src)}),\n"
            f"cs AS (SELECT cs0.*, md.primary_route_type, {RELIABILITY} AS corridor_reliability, "
            f"{BAND.format(r='delay_ratio_mean')} AS delay_class FROM cs0 LEFT JOIN md USING (source_center, destination_center))")


TRAIN = "tr AS (SELECT * FROM legs WHERE data = 'training')"

_cs_cols = [("actual_time_mean", "d"), ("actual_time_median", "d"), ("actual_time_std", "d"), ("segment_count", "i"),
            ("osrm_time_mean", "d"), ("osrm_time_max", "d"), ("osrm_distance_mean", "d"), ("osrm_distance_max", "d"),
            ("delay_ratio_mean", "d"), ("delay_ratio_median", "d"), ("delay_ratio_std", "d"),
            ("primary_route_type", "s"), ("trip_count", "i"), ("sla_breach_pct", "d"),
            ("corridor_reliability", "d"), ("delay_class", "s")]
register("agg_corridor_stats", TRAIN + ",\n" + corridors_cte() + "\nSELECT source_center, destination_center, "
         + ", ".join(fin(c, k, c) for c, k in _cs_cols) + " FROM cs")


def _role(key: str, other: str, suf: str, deg: str, sla: str, src: str) -> str:
    return f"""SELECT {key} AS facility_id, avg(actual_time) AS avg_delay_as_{suf}, median(actual_time) AS median_delay_as_{suf},
 count(actual_time) AS throughput_as_{suf}, avg(osrm_time) AS avg_osrm_as_{suf}, avg(factor) AS avg_factor_as_{suf},
 stddev_samp(factor) AS factor_std_as_{suf}, count(DISTINCT {other}) AS {deg}, count(DISTINCT trip_uuid) AS unique_trips_as_{suf},
 avg(CASE WHEN factor > 1.5 THEN 1.0E0 ELSE 0.0E0 END) AS {sla}
 FROM {src} WHERE {key} IS NOT NULL GROUP BY {key}"""


def facilities_cte(src: str = "tr") -> str:
    """CTE ``fs``: facility table over ``src``."""
    num = {"avg_delay_as_{s}": "d", "median_delay_as_{s}": "d", "throughput_as_{s}": "i", "avg_osrm_as_{s}": "d",
           "avg_factor_as_{s}": "d", "factor_std_as_{s}": "d", "unique_trips_as_{s}": "i"}
    cols = []
    for s in ("source", "dest"):
        cols += [f"coalesce({c.format(s=s)}, 0) AS {c.format(s=s)}" for c in num]
    cols += ["coalesce(out_degree, 0) AS out_degree", "coalesce(in_degree, 0) AS in_degree",
             "sla_breach_pct_src", "sla_breach_pct_dst"]
    return f"""fsrc AS ({_role('source_center', 'destination_center', 'source', 'out_degree', 'sla_breach_pct_src', src)}),
fdst AS ({_role('destination_center', 'source_center', 'dest', 'in_degree', 'sla_breach_pct_dst', src)}),
fm AS (SELECT coalesce(fsrc.facility_id, fdst.facility_id) AS facility_id, {", ".join(cols)}
  FROM fsrc FULL OUTER JOIN fdst ON fsrc.facility_id = fdst.facility_id),
fn_s AS (SELECT source_center AS facility_id, source_name AS nm FROM (SELECT source_center, source_name,
  row_number() OVER (PARTITION BY source_center ORDER BY trip_uuid, seg_no) AS rn FROM {src} WHERE source_center IS NOT NULL) WHERE rn = 1),
fn_d AS (SELECT destination_center AS facility_id, destination_name AS nm FROM (SELECT destination_center, destination_name,
  row_number() OVER (PARTITION BY destination_center ORDER BY trip_uuid, seg_no) AS rn FROM {src} WHERE destination_center IS NOT NULL) WHERE rn = 1),
fnm AS (SELECT coalesce(fn_s.facility_id, fn_d.facility_id) AS facility_id, coalesce(fn_d.nm, fn_s.nm) AS facility_name
  FROM fn_s FULL OUTER JOIN fn_d ON fn_s.facility_id = fn_d.facility_id),
fs AS (SELECT fm.*, throughput_as_source + throughput_as_dest AS total_throughput, out_degree + in_degree AS total_degree,
  (avg_delay_as_source * throughput_as_source + avg_delay_as_dest * throughput_as_dest)
   / CAST(greatest(throughput_as_source + throughput_as_dest, 1) AS DOUBLE) AS avg_delay,
  (coalesce(sla_breach_pct_src, 0.0E0) + coalesce(sla_breach_pct_dst, 0.0E0)) / 2 AS sla_breach_pct,
  fnm.facility_name, {_token_case.replace('name', 'fnm.facility_name')} AS facility_type
  FROM fm LEFT JOIN fnm ON fm.facility_id = fnm.facility_id)"""


_fs_cols = []
for _s in ("source", "dest"):
    _fs_cols += [(f"avg_delay_as_{_s}", "d"), (f"median_delay_as_{_s}", "d"), (f"throughput_as_{_s}", "i"),
                 (f"avg_osrm_as_{_s}", "d"), (f"avg_factor_as_{_s}", "d"), (f"factor_std_as_{_s}", "d"),
                 (f"unique_trips_as_{_s}", "i")]
_fs_cols += [("out_degree", "i"), ("in_degree", "i"), ("sla_breach_pct_src", "d"), ("sla_breach_pct_dst", "d"),
             ("total_throughput", "i"), ("total_degree", "i"), ("avg_delay", "d"), ("sla_breach_pct", "d"),
             ("facility_name", "s"), ("facility_type", "s")]
register("agg_facility_stats", TRAIN + ",\n" + facilities_cte() + "\nSELECT facility_id, "
         + ", ".join(fin(c, k, c) for c, k in _fs_cols) + " FROM fs")

register("facility_names", """
fn_s AS (SELECT source_center AS facility_id, source_name AS nm FROM (SELECT source_center, source_name,
  row_number() OVER (PARTITION BY source_center ORDER BY trip_uuid, seg_no) AS rn FROM legs WHERE source_center IS NOT NULL) WHERE rn = 1),
fn_d AS (SELECT destination_center AS facility_id, destination_name AS nm FROM (SELECT destination_center, destination_name,
  row_number() OVER (PARTITION BY destination_center ORDER BY trip_uuid, seg_no) AS rn FROM legs WHERE destination_center IS NOT NULL) WHERE rn = 1)
SELECT coalesce(fn_s.facility_id, fn_d.facility_id) AS facility_id, coalesce(fn_d.nm, fn_s.nm) AS facility_name
FROM fn_s FULL OUTER JOIN fn_d ON fn_s.facility_id = fn_d.facility_id""")

register("agg_route_type_corridors", """
SELECT route_type, source_center, destination_center, round(CAST(sum(CAST(actual_time AS DECIMAL(28,12))) AS DOUBLE) / count(actual_time) + 1e-12, 9) AS actual_time, round(CAST(sum(CAST(osrm_time AS DECIMAL(28,12))) AS DOUBLE) / count(osrm_time) + 1e-12, 9) AS osrm_time,
 round(CAST(sum(CAST(osrm_distance AS DECIMAL(28,12))) AS DOUBLE) / count(osrm_distance) + 1e-12, 9) AS distance, round(CAST(sum(CAST(factor AS DECIMAL(28,12))) AS DOUBLE) / count(factor) + 1e-12, 9) AS delay_ratio, count(DISTINCT trip_uuid) AS frequency,
 round(CAST(sum(CAST(factor AS DECIMAL(28,12))) AS DOUBLE) / count(factor) + 1e-12, 9) AS weight
FROM legs WHERE data = 'training' AND route_type IS NOT NULL AND source_center IS NOT NULL AND destination_center IS NOT NULL
GROUP BY route_type, source_center, destination_center""")

register("all_facilities", """
SELECT DISTINCT facility_id FROM (SELECT source_center AS facility_id FROM legs UNION ALL SELECT destination_center FROM legs)
WHERE facility_id IS NOT NULL""")

register("graph_time_aware", """
SELECT source_center, destination_center, hour(od_start_time) AS start_hour, count(*) AS segment_count,
 round(avg(factor), 9) AS delay_ratio_mean, round(avg(actual_time), 9) AS actual_time_mean, count(DISTINCT trip_uuid) AS trip_count
FROM legs WHERE data = 'training' AND source_center IS NOT NULL AND destination_center IS NOT NULL
GROUP BY source_center, destination_center, hour(od_start_time)""")


# ---------------------------------------------------------------------- features

_PEAK = "(8, 9, 10, 17, 18, 19)"
_NIGHT = "(22, 23, 0, 1, 2, 3, 4, 5)"

FEAT_CTE = TRIPS_CTE + """,
f1 AS (SELECT *, hour(trip_creation_time) AS creation_hour, isodow(trip_creation_time) - 1 AS creation_day_of_week,
  hour(od_start_time) AS start_hour FROM trips),
f2 AS (SELECT *, CASE WHEN creation_day_of_week >= 5 THEN 1 ELSE 0 END AS creation_is_weekend,
  CASE WHEN creation_hour IN """ + _PEAK + """ THEN 1 ELSE 0 END AS creation_is_peak,
  CASE WHEN creation_hour IN """ + _NIGHT + """ THEN 1 ELSE 0 END AS creation_is_night,
  dayofmonth(trip_creation_time) AS creation_day_of_month, weekofyear(trip_creation_time) AS creation_week_of_year,
  CASE WHEN start_hour IN """ + _PEAK + """ THEN 1 ELSE 0 END AS start_is_peak,
  sin(2 * pi() * creation_hour / 24) AS creation_hour_sin, cos(2 * pi() * creation_hour / 24) AS creation_hour_cos,
  sin(2 * pi() * creation_day_of_week / 7) AS creation_dow_sin, cos(2 * pi() * creation_day_of_week / 7) AS creation_dow_cos,
  greatest(coalesce(date_diff('microsecond', trip_creation_time, od_start_time) / 6e7, 0.0E0), 0.0E0) AS time_since_creation_min,
  CASE WHEN route_type = 'FTL' THEN 1 ELSE 0 END AS is_ftl,
  CASE WHEN osrm_time > 0 THEN osrm_distance / (osrm_time / 60) ELSE 0.0E0 END AS osrm_speed_kmh,
  ln(1 + CASE WHEN osrm_time < 0 THEN 0.0E0 ELSE osrm_time END) AS log_osrm_time,
  ln(1 + CASE WHEN osrm_distance < 0 THEN 0.0E0 ELSE osrm_distance END) AS log_osrm_distance,
  ln(1 + num_segments) AS log_num_segments,
  ln(1 + coalesce(CASE WHEN segment_osrm_time_sum < 0 THEN 0.0E0 ELSE segment_osrm_time_sum END, 0.0E0)) AS log_segment_osrm_time_sum,
  ln(1 + coalesce(CASE WHEN segment_osrm_distance_sum < 0 THEN 0.0E0 ELSE segment_osrm_distance_sum END, 0.0E0)) AS log_segment_osrm_distance_sum,
  CASE WHEN num_segments > 0 THEN segment_osrm_distance_sum / num_segments ELSE 0.0E0 END AS avg_segment_distance,
  CASE WHEN num_segments > 0 THEN segment_osrm_time_sum / num_segments ELSE 0.0E0 END AS avg_segment_time,
  CASE WHEN source_city = dest_city THEN 1 ELSE 0 END AS is_same_city,
  coalesce(source_facility_type, 'X') || '_' || coalesce(dest_facility_type, 'X') AS facility_type_pair
  FROM f1),
ftr AS (SELECT * FROM f2 WHERE data = 'training'),
te_s AS (SELECT source_center, avg(actual_time) AS m FROM ftr WHERE source_center IS NOT NULL GROUP BY source_center),
te_d AS (SELECT destination_center, avg(actual_time) AS m FROM ftr WHERE destination_center IS NOT NULL GROUP BY destination_center),
te_g AS (SELECT avg(actual_time) AS g FROM ftr),
""" + ",\n".join(
    f"le_{c} AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT {v} AS v FROM ftr) WHERE v IS NOT NULL)"
    for c, v in [("source_facility_type", "coalesce(source_facility_type, 'Unknown')"),
                 ("dest_facility_type", "coalesce(dest_facility_type, 'Unknown')"),
                 ("source_state", "coalesce(source_state, 'Unknown')"),
                 ("dest_state", "coalesce(dest_state, 'Unknown')"),
                 ("facility_type_pair", "facility_type_pair")]) + """,
ft AS (SELECT f2.*, coalesce(te_s.m, te_g.g) AS source_center_encoded, coalesce(te_d.m, te_g.g) AS destination_center_encoded,
  CAST(coalesce(le_source_facility_type.code, -1) AS INT) AS source_facility_type_encoded,
  CAST(coalesce(le_dest_facility_type.code, -1) AS INT) AS dest_facility_type_encoded,
  CAST(coalesce(le_source_state.code, -1) AS INT) AS source_state_encoded,
  CAST(coalesce(le_dest_state.code, -1) AS INT) AS dest_state_encoded,
  CAST(coalesce(le_facility_type_pair.code, -1) AS INT) AS facility_type_pair_encoded
 FROM f2 CROSS JOIN te_g LEFT JOIN te_s ON f2.source_center = te_s.source_center
 LEFT JOIN te_d ON f2.destination_center = te_d.destination_center
 LEFT JOIN le_source_facility_type ON coalesce(f2.source_facility_type, 'Unknown') = le_source_facility_type.v
 LEFT JOIN le_dest_facility_type ON coalesce(f2.dest_facility_type, 'Unknown') = le_dest_facility_type.v
 LEFT JOIN le_source_state ON coalesce(f2.source_state, 'Unknown') = le_source_state.v
 LEFT JOIN le_dest_state ON coalesce(f2.dest_state, 'Unknown') = le_dest_state.v
 LEFT JOIN le_facility_type_pair ON f2.facility_type_pair = le_facility_type_pair.v)"""


def feat(cols, kinds=None) -> str:
    kinds = kinds or {}
    return FEAT_CTE + "\nSELECT trip_uuid, " + ", ".join(fin(c, kinds.get(c, "i"), c) for c in cols) + " FROM ft"


register("temporal_features", feat(["creation_hour", "creation_day_of_week", "creation_is_weekend", "creation_is_peak",
                                    "creation_is_night", "creation_day_of_month", "creation_week_of_year",
                                    "start_hour", "start_is_peak"]), clean=True)
_cyc = ["creation_hour_sin", "creation_hour_cos", "creation_dow_sin", "creation_dow_cos"]
register("cyclic_encoding", feat(_cyc, {c: "d" for c in _cyc}), clean=True)
register("time_since_creation", feat(["time_since_creation_min"], {"time_since_creation_min": "d"}), clean=True)
_route = ["is_ftl", "osrm_speed_kmh", "log_osrm_time", "log_osrm_distance", "log_num_segments",
          "log_segment_osrm_time_sum", "log_segment_osrm_distance_sum", "avg_segment_distance", "avg_segment_time"]
register("route_features", feat(_route, {c: "d" for c in _route if c != "is_ftl"}), clean=True)
register("trip_speed", TRIPS_CTE + "\nSELECT trip_uuid, round(osrm_speed, 9) AS osrm_speed FROM trips", clean=True)
register("spatial_features", feat(["is_same_city", "facility_type_pair"], {"facility_type_pair": "s"}), clean=True)
register("label_encode", feat(["source_facility_type_encoded", "dest_facility_type_encoded", "source_state_encoded",
                               "dest_state_encoded", "facility_type_pair_encoded"]), clean=True)
register("target_encode", feat(["source_center_encoded", "destination_center_encoded"],
                               {"source_center_encoded": "d", "destination_center_encoded": "d"}), clean=True)

# The tabular feature list of the ETA models.
FEATURES = [
    "osrm_time", "osrm_distance", "is_ftl", "num_segments", "creation_hour", "creation_day_of_week",
    "creation_is_weekend", "creation_is_peak", "creation_is_night", "creation_hour_sin", "creation_hour_cos",
    "creation_dow_sin", "creation_dow_cos", "start_hour", "start_is_peak", "time_since_creation_min",
    "is_intrastate", "source_center_encoded", "destination_center_encoded", "source_facility_type_encoded",
    "dest_facility_type_encoded", "source_state_encoded", "dest_state_encoded", "osrm_speed_kmh", "log_osrm_time",
    "log_osrm_distance", "log_num_segments", "cutoff_count", "segment_osrm_time_sum", "segment_osrm_time_mean",
    "segment_osrm_distance_sum", "segment_osrm_distance_mean", "avg_segment_distance", "avg_segment_time",
]
_imp = ", ".join(
    f"round(CASE WHEN CAST({c} AS DOUBLE) IS NULL OR isnan(CAST({c} AS DOUBLE)) OR isinf(CAST({c} AS DOUBLE)) "
    f"THEN 0.0E0 ELSE CAST({c} AS DOUBLE) END, 9) AS {c}" for c in FEATURES)
register("impute_matrix", FEAT_CTE + "\nSELECT trip_uuid, data, " + _imp + " FROM ft", clean=True)

# ------------------------------------------------------------------------- delay

CORR_LITE = TRAIN + """,
cs0 AS (SELECT source_center, destination_center, avg(actual_time) AS actual_time_mean, avg(osrm_distance) AS osrm_distance_mean,
 avg(factor) AS delay_ratio_mean, stddev_samp(factor) AS delay_ratio_std, count(DISTINCT trip_uuid) AS trip_count,
 avg(CASE WHEN factor > 1.5 THEN 1.0E0 ELSE 0.0E0 END) AS sla_breach_pct
 FROM tr WHERE source_center IS NOT NULL AND destination_center IS NOT NULL GROUP BY source_center, destination_center),
cs AS (SELECT *, """ + BAND.format(r="delay_ratio_mean") + """ AS delay_class FROM cs0)"""

register("classify_corridors", CORR_LITE + """
SELECT source_center, destination_center, round(delay_ratio_mean, 9) AS delay_ratio_mean, delay_class FROM cs""")
register("delay_distribution", CORR_LITE + """
SELECT delay_class, count(*) AS corridors, round(count(*) * 100.0E0 / (SELECT count(*) FROM cs), 9) AS pct
FROM cs WHERE delay_class IS NOT NULL GROUP BY delay_class""")
_summary = """SELECT count(*) AS total_corridors,
 round(avg(CASE WHEN delay_class = 'Healthy' THEN 1.0E0 ELSE 0.0E0 END) * 100, 9) AS healthy_pct,
 round(avg(CASE WHEN delay_class = 'Moderate' THEN 1.0E0 ELSE 0.0E0 END) * 100, 9) AS moderate_pct,
 round(avg(CASE WHEN delay_class = 'Severe' THEN 1.0E0 ELSE 0.0E0 END) * 100, 9) AS severe_pct,
 round(avg(CASE WHEN delay_class = 'Critical' THEN 1.0E0 ELSE 0.0E0 END) * 100, 9) AS critical_pct,
 round(avg(delay_ratio_mean), 9) AS avg_delay_ratio, round(median(delay_ratio_mean), 9) AS median_delay_ratio"""
register("delay_summary", CORR_LITE + "\n" + _summary + " FROM cs")
register("top_delayed_corridors", CORR_LITE + """
SELECT source_center, destination_center, round(delay_ratio_mean, 9) AS delay_ratio_mean, trip_count FROM cs
ORDER BY delay_ratio_mean DESC, source_center, destination_center LIMIT 20""")
register("sla_totals", CORR_LITE + """
SELECT count(*) AS total_corridors, count(*) FILTER (WHERE sla_breach_pct > 0.3) AS breaching_corridors,
 count(*) FILTER (WHERE delay_class = 'Critical') AS critical_corridors FROM cs""")
register("sla_contribution", CORR_LITE + """,
sc AS (SELECT *, sla_breach_pct * trip_count AS contrib FROM cs), st AS (SELECT sum(contrib) AS tot FROM sc)
SELECT source_center, destination_center, round(sla_breach_pct, 9) AS sla_breach_pct, trip_count,
 round(delay_ratio_mean, 9) AS delay_ratio_mean, round(contrib, 9) AS sla_contribution,
 round(CASE WHEN tot > 0 THEN contrib / tot * 100 ELSE 0.0E0 END, 9) AS sla_contribution_pct FROM sc CROSS JOIN st""")
register("run_delay_analysis", CORR_LITE + "\n" + _summary + """,
 count(*) FILTER (WHERE sla_breach_pct > 0.3) AS breaching_corridors,
 count(*) FILTER (WHERE delay_class = 'Critical') AS critical_corridors FROM cs""")

# ---------------------------------------------------------------------- decision

IMPACT = CORR_LITE + """,
mx AS (SELECT max(delay_ratio_mean) AS mr, max(trip_count) AS mt FROM cs),
ci AS (SELECT cs.*, (coalesce(sla_breach_pct, 0.0E0) * 0.4 + CASE WHEN mr = 0 THEN NULL ELSE delay_ratio_mean / mr END * 0.3
   + CASE WHEN mt = 0 THEN NULL ELSE CAST(trip_count AS DOUBLE) / mt END * 0.3) * 100 AS corridor_impact FROM cs CROSS JOIN mx)"""
register("corridor_impact", IMPACT + """
SELECT source_center, destination_center, round(corridor_impact, 9) AS corridor_impact FROM ci""")
register("corridor_severity", IMPACT + """
SELECT source_center, destination_center, round(corridor_impact, 9) AS corridor_impact,
 CASE WHEN round(corridor_impact, 9) > 60 THEN 'High' WHEN round(corridor_impact, 9) > 30 THEN 'Medium' ELSE 'Low' END AS severity FROM ci""")
register("top_bottleneck_corridors", IMPACT + """
SELECT source_center, destination_center, round(corridor_impact, 9) AS corridor_impact, round(delay_ratio_mean, 9) AS delay_ratio_mean,
 round(sla_breach_pct, 9) AS sla_breach_pct, trip_count FROM ci ORDER BY corridor_impact DESC, source_center, destination_center LIMIT 15""")

PLANNED = TRIPS_CTE + """,
pp AS (SELECT 'planned_time' AS model, actual_time AS y, osrm_time AS y_pred, osrm_time AS osrm FROM trips WHERE data = 'test')"""
register("planned_time_baseline", PLANNED + """,
ok AS (SELECT * FROM pp WHERE y IS NOT NULL AND y_pred IS NOT NULL AND NOT isnan(y) AND NOT isnan(y_pred))
SELECT model, round(avg(abs(y - y_pred)), 2) AS MAE, round(sqrt(avg((y - y_pred) * (y - y_pred))), 2) AS RMSE,
 round(avg(CASE WHEN y <> 0 THEN abs(y - y_pred) / abs(y) END) * 100, 2) AS MAPE,
 round(CASE WHEN var_pop(y) * count(*) > 0 THEN 1 - sum((y - y_pred) * (y - y_pred)) / (var_pop(y) * count(*)) ELSE 0.0E0 END, 4) AS R2,
 round(avg(CASE WHEN y <> 0 THEN CASE WHEN abs(y - y_pred) / abs(y) <= 0.10 THEN 1.0E0 ELSE 0.0E0 END END) * 100, 2) AS Acc_10,
 round(avg(CASE WHEN y <> 0 THEN CASE WHEN abs(y - y_pred) / abs(y) <= 0.15 THEN 1.0E0 ELSE 0.0E0 END END) * 100, 2) AS Acc_15,
 round(avg(CASE WHEN y <> 0 THEN CASE WHEN abs(y - y_pred) / abs(y) <= 0.20 THEN 1.0E0 ELSE 0.0E0 END END) * 100, 2) AS Acc_20
FROM ok GROUP BY model""", clean=True)


def _acc(k: float, p: str = "y_pred") -> str:
    return f"avg(CASE WHEN y > 0 THEN CASE WHEN abs(y - {p}) / y <= {k} THEN 1.0E0 ELSE 0.0E0 END END) * 100"


register("business_metrics", PLANNED + f"""
SELECT round({_acc(0.10)}, 9) AS accuracy_at_10, round({_acc(0.15)}, 9) AS accuracy_at_15,
 round({_acc(0.20)}, 9) AS accuracy_at_20, round({_acc(0.30)}, 9) AS accuracy_at_30,
 round(avg(CASE WHEN y > 0 THEN CASE WHEN y_pred < y * 0.85 THEN 1.0E0 ELSE 0.0E0 END END) * 100, 9) AS late_delivery_rate,
 round(avg(abs(y - y_pred)), 9) AS avg_prediction_error_min, round(median(abs(y - y_pred)), 9) AS median_prediction_error_min,
 round({_acc(0.15, 'osrm')}, 9) AS osrm_accuracy_at_15, round({_acc(0.15)} - {_acc(0.15, 'osrm')}, 9) AS improvement_over_osrm,
 round(avg(abs(y - osrm)), 9) AS osrm_avg_error_min,
 round(count(*) FILTER (WHERE y_pred < y * 0.85) * 500 * 0.10, 9) AS estimated_revenue_at_risk FROM pp""", clean=True)

# What-if actions (name, delay reduction, capex lakh); the sorter is hub-only.
_ACTIONS = """(VALUES ('Add +20% FTL Truck Capacity', 0.35, 12.5), ('Optimize Process Flow (-15% Handling Time)', 0.15, 2.0),
 ('Reroute Non-Urgent Carting Traffic', 0.25, 0.0)) AS a(action, delay_reduction_pct, capex_lakh)"""
register("upgrade_scenarios", CORR_LITE + """,
sx AS (SELECT source_center, destination_center, actual_time_mean AS current_delay, CAST(trip_count AS DOUBLE) AS throughput,
  a.action, CAST(a.delay_reduction_pct AS DOUBLE) AS r, CAST(a.capex_lakh AS DOUBLE) AS capex_lakh FROM cs CROSS JOIN """ + _ACTIONS + """),
sy AS (SELECT *, (throughput * 0.18 * 25 - throughput * (0.18 * (1 - r)) * 25) * 365 / 100000 AS annual FROM sx)
SELECT source_center, destination_center, round(current_delay, 9) AS current_delay, round(throughput, 9) AS throughput, action,
 round(r, 9) AS delay_reduction_pct, round(capex_lakh, 9) AS capex_lakh, round(current_delay * (1 - r), 9) AS projected_delay,
 round(0.18 * (1 - r), 9) AS new_sla_breach, round(annual + 1e-12, 9) AS annual_recovery_lakh,
 round(CASE WHEN capex_lakh > 0 AND annual > 0 THEN capex_lakh / (annual / 12) ELSE 0.0E0 END, 9) AS payback_months,
 round(annual - capex_lakh + 1e-12, 9) AS net_first_year_lakh, round(throughput * (0.18 - 0.18 * (1 - r)), 9) AS breaches_prevented,
 CASE WHEN NOT (capex_lakh > 0 AND annual > 0) OR capex_lakh / (annual / 12) = 0 THEN 'deploy'
  WHEN capex_lakh / (annual / 12) < 3 THEN 'approve' ELSE 'consider_others' END AS recommendation FROM sy""")
register("rule_route_recommendation", IMPACT + """
SELECT source_center, destination_center, round(osrm_distance_mean, 9) AS osrm_distance_mean,
 CASE WHEN round(osrm_distance_mean, 9) > 200 THEN 'FTL' WHEN round(osrm_distance_mean, 9) < 100 THEN 'Carting' ELSE 'Model decides' END AS recommendation,
 round(greatest(45.0E0, 100.0E0 - 0.45 * (round(corridor_impact, 9))), 9) AS estimated_sla FROM ci""")

# ------------------------------------------------------------------------- marts

register("route_type_performance", TRIPS_CTE + """
SELECT CASE WHEN route_type = 'FTL' THEN 1 ELSE 0 END AS is_ftl, round(avg(actual_time), 9) AS actual_time_mean,
 round(median(actual_time), 9) AS actual_time_median, round(stddev_samp(actual_time), 9) AS actual_time_std,
 round(avg(osrm_time), 9) AS osrm_time_mean, round(avg(osrm_distance), 9) AS osrm_distance_mean,
 round(avg(num_segments), 9) AS num_segments_mean, count(*) AS trips FROM trips GROUP BY 1""", clean=True)
register("route_type_share", TRIPS_CTE + """
SELECT round(avg(CASE WHEN route_type = 'FTL' THEN 1.0E0 ELSE 0.0E0 END) * 100, 9) AS ftl_pct,
 round((1 - avg(CASE WHEN route_type = 'FTL' THEN 1.0E0 ELSE 0.0E0 END)) * 100, 9) AS carting_pct FROM trips""", clean=True)
register("corridor_eta_quantiles", TRIPS_CTE + """
SELECT source_center, destination_center, round(quantile_cont(actual_time, 0.1), 9) AS p10, round(quantile_cont(actual_time, 0.5), 9) AS p50,
 round(quantile_cont(actual_time, 0.9), 9) AS p90, round(avg(actual_time), 9) AS actual_time_mean, round(avg(osrm_time), 9) AS osrm_time_mean,
 round(avg(osrm_distance), 9) AS osrm_distance_mean, count(*) AS trips
FROM trips WHERE source_center IS NOT NULL AND destination_center IS NOT NULL
GROUP BY source_center, destination_center HAVING count(*) > 2""", clean=True)
register("source_eta_fallback", TRIPS_CTE + """,
cc AS (SELECT source_center, destination_center, avg(actual_time) AS ca, avg(osrm_time) AS co FROM trips GROUP BY source_center, destination_center),
sc AS (SELECT source_center, avg(actual_time) AS sa, avg(osrm_time) AS so FROM trips WHERE source_center IS NOT NULL GROUP BY source_center)
SELECT cc.source_center, cc.destination_center, round(coalesce(ca, sa), 9) AS eta_actual, round(coalesce(co, so), 9) AS eta_planned,
 'corridor' AS basis FROM cc LEFT JOIN sc ON cc.source_center = sc.source_center WHERE cc.source_center IS NOT NULL
UNION ALL SELECT source_center, NULL, round(sa, 9), round(so, 9), 'source' FROM sc""", clean=True)


def _hist(label: str, src: str, expr: str, bins: int) -> str:
    return f"""SELECT '{label}' AS histogram, bin, round(lo + (hi - lo) / {bins} * bin, 9) AS bin_start, count(*) AS count FROM (
 SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}) END AS INT) AS bin, lo, hi
 FROM (SELECT {expr} AS v FROM {src}) x CROSS JOIN (SELECT min({expr}) AS lo, max({expr}) AS hi FROM {src}) m
 WHERE v IS NOT NULL) GROUP BY bin, lo, hi"""


register("histograms", TRIPS_CTE + ",\n" + CORR_LITE.replace(TRAIN + ",", TRAIN + ",", 1) + ",\n"
         + "ftl AS (SELECT * FROM trips WHERE route_type = 'FTL'), crt AS (SELECT * FROM trips WHERE route_type = 'Carting')\n"
         + _hist("trip_time", "trips", "actual_time", 30) + "\nUNION ALL "
         + _hist("delay_ratio", "cs", "least(delay_ratio_mean, 10.0E0)", 50) + "\nUNION ALL "
         + _hist("ftl_time", "ftl", "least(actual_time, 2000.0E0)", 30) + "\nUNION ALL "
         + _hist("carting_time", "crt", "least(actual_time, 2000.0E0)", 30), clean=True)
register("facility_selectors", TRIPS_CTE + """
SELECT DISTINCT role, facility_id FROM (SELECT 'source' AS role, source_center AS facility_id FROM trips
 UNION ALL SELECT 'destination', destination_center FROM trips) WHERE facility_id IS NOT NULL""", clean=True)
register("corridor_trip_lookup", TRIPS_CTE + """,
bk AS (SELECT source_center, destination_center FROM trips WHERE source_center IS NOT NULL AND destination_center IS NOT NULL
  GROUP BY source_center, destination_center ORDER BY count(*) DESC, source_center, destination_center LIMIT 1),
sel AS (SELECT t.* FROM trips t JOIN bk ON t.source_center = bk.source_center AND t.destination_center = bk.destination_center)
SELECT source_center, destination_center, trip_uuid, round(actual_time, 9) AS actual_time, round(osrm_time, 9) AS osrm_time,
 round((SELECT greatest(max(actual_time), max(osrm_time)) FROM sel), 9) AS axis_max FROM sel""", clean=True)
register("delay_vs_volume", CORR_LITE + """
SELECT source_center, destination_center, trip_count, round(delay_ratio_mean, 9) AS delay_ratio_mean, delay_class FROM cs""")
register("filter_corridors_by_class", CORR_LITE + """
SELECT source_center, destination_center, delay_class, round(delay_ratio_mean, 9) AS delay_ratio_mean, trip_count FROM cs
WHERE delay_class IN ('Critical', 'Severe')""")
register("bidirectional_corridors", CORR_LITE + """
SELECT source_center, destination_center FROM cs INTERSECT SELECT destination_center, source_center FROM cs""")
register("corridor_dedup", """
SELECT source_center, trip_uuid, seg_no, source_name FROM (SELECT source_center, trip_uuid, seg_no, source_name,
 row_number() OVER (PARTITION BY source_center ORDER BY trip_uuid, seg_no) AS rn FROM legs WHERE source_center IS NOT NULL) WHERE rn = 1""")


# ------------------------------------------------------------------------- graph

GRAPH = TRAIN + ",\n" + facilities_cte() + """,
cs0 AS (SELECT source_center, destination_center, avg(osrm_distance) AS osrm_distance_mean, avg(factor) AS delay_ratio_mean,
 count(DISTINCT trip_uuid) AS trip_count FROM tr WHERE source_center IS NOT NULL AND destination_center IS NOT NULL
 GROUP BY source_center, destination_center),
ge AS (SELECT source_center AS src, destination_center AS dst, coalesce(delay_ratio_mean, 1.0E0) AS weight,
 osrm_distance_mean AS distance, trip_count AS frequency,
 coalesce(""" + BAND.format(r="delay_ratio_mean") + """, 'Unknown') AS delay_class FROM cs0),
gv AS (SELECT coalesce(fs.facility_id, en.id) AS id, fs.total_throughput AS throughput, fs.avg_delay FROM fs
 FULL OUTER JOIN (SELECT src AS id FROM ge UNION SELECT dst FROM ge) en ON fs.facility_id = en.id),
nn AS (SELECT count(*) AS n FROM gv)"""

register("graph_facility", GRAPH + """
SELECT src, dst, round(weight, 9) AS weight, round(distance, 9) AS distance, frequency, delay_class FROM ge""")

register("degree_centrality", GRAPH + """,
od AS (SELECT src AS id, count(*) AS c FROM ge GROUP BY src), idg AS (SELECT dst AS id, count(*) AS c FROM ge GROUP BY dst),
d AS (SELECT gv.id, coalesce(idg.c, 0) AS in_deg, coalesce(od.c, 0) AS out_deg FROM gv LEFT JOIN od ON gv.id = od.id LEFT JOIN idg ON gv.id = idg.id)
SELECT id, in_deg, out_deg, round((in_deg + out_deg) * (1.0E0 / (n - 1)), 9) AS degree_centrality,
 round(in_deg * (1.0E0 / (n - 1)), 9) AS in_degree_centrality, round(out_deg * (1.0E0 / (n - 1)), 9) AS out_degree_centrality
FROM d CROSS JOIN nn""")

_PR_ITERS = 100
_pr = [GRAPH + """,
pt AS (SELECT src, dst, 0.85 * weight / sum(weight) OVER (PARTITION BY src) AS q FROM ge),
y0 AS MATERIALIZED (SELECT id, 1.0E0 / n AS y FROM gv CROSS JOIN nn)"""]
for _i in range(1, _PR_ITERS + 1):
    _pr.append(f"""y{_i} AS MATERIALIZED (SELECT gv.id, (1 - 0.85) / n + coalesce(c.c, 0.0E0) AS y FROM gv CROSS JOIN nn LEFT JOIN
 (SELECT pt.dst AS id, sum(y{_i - 1}.y * pt.q) AS c FROM y{_i - 1} JOIN pt ON y{_i - 1}.id = pt.src GROUP BY pt.dst) c ON gv.id = c.id)""")
register("pagerank", ",\n".join(_pr) + f"""
SELECT id, round(y / (SELECT sum(y) FROM y{_PR_ITERS}), 9) AS pagerank FROM y{_PR_ITERS}""")

register("closeness_centrality", GRAPH + """,
ue AS (SELECT DISTINCT src, dst FROM ge WHERE src <> dst),
dd AS (SELECT s, v, min(d) AS d FROM (
  WITH RECURSIVE bfs(s, v, d) AS (SELECT id, id, 0 FROM gv
    UNION SELECT b.s, ue.dst, b.d + 1 FROM bfs b JOIN ue ON b.v = ue.src WHERE b.d < (SELECT n FROM nn) - 1)
  SELECT * FROM bfs) GROUP BY s, v),
agg AS (SELECT v AS id, count(*) AS r, sum(d) AS tot FROM dd GROUP BY v)
SELECT gv.id, round(CASE WHEN tot > 0 AND n > 1 THEN (r - 1) / CAST(tot AS DOUBLE) * ((r - 1) / CAST(n - 1 AS DOUBLE)) ELSE 0.0E0 END, 9) AS closeness
FROM gv CROSS JOIN nn LEFT JOIN agg ON gv.id = agg.id""")

UND = """,
und AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM ge WHERE src <> dst),
adj AS (SELECT a AS u, b AS v FROM und UNION ALL SELECT b, a FROM und)"""

register("clustering", GRAPH + UND + """,
deg AS (SELECT u AS id, count(*) AS k FROM adj GROUP BY u),
tri AS (SELECT x.a AS p, x.b AS q, y.b AS r FROM und x JOIN und y ON x.a = y.a AND x.b < y.b JOIN und z ON z.a = x.b AND z.b = y.b),
tv AS (SELECT id, count(*) AS t FROM (SELECT p AS id FROM tri UNION ALL SELECT q FROM tri UNION ALL SELECT r FROM tri) GROUP BY id)
SELECT gv.id, round(CASE WHEN coalesce(k, 0) > 1 THEN 2.0E0 * coalesce(t, 0) / (k * (k - 1)) ELSE 0.0E0 END, 9) AS clustering
FROM gv LEFT JOIN deg ON gv.id = deg.id LEFT JOIN tv ON gv.id = tv.id""")

register("connected_components", GRAPH + UND + """,
reach AS (SELECT * FROM (WITH RECURSIVE r(s, v) AS (SELECT id, id FROM gv UNION SELECT r.s, adj.v FROM r JOIN adj ON r.v = adj.u)
  SELECT * FROM r))
SELECT v AS id, min(s) AS component FROM reach GROUP BY v""")

register("graph_neighbor_stats", GRAPH + """,
sx AS (SELECT ge.src AS id, avg(gv.avg_delay) AS a1, max(gv.avg_delay) AS a2, avg(gv.throughput) AS a3,
  avg(ge.weight) AS a4, avg(ge.distance) AS a5, count(*) AS a6 FROM ge LEFT JOIN gv ON ge.dst = gv.id GROUP BY ge.src)
SELECT gv.id, round(coalesce(a1, 0), 9) AS graph_nbr_avg_delay, round(coalesce(a2, 0), 9) AS graph_nbr_max_delay,
 round(coalesce(a3, 0), 9) AS graph_nbr_avg_throughput, round(coalesce(a4, 0), 9) AS graph_avg_edge_weight,
 round(coalesce(a5, 0), 9) AS graph_avg_edge_distance, coalesce(a6, 0) AS graph_num_neighbors
FROM gv LEFT JOIN sx ON gv.id = sx.id""")

register("core_subgraph", GRAPH + """,
dg AS (SELECT id, count(*) AS d FROM (SELECT src AS id FROM ge UNION ALL SELECT dst FROM ge) GROUP BY id),
top AS (SELECT id FROM gv LEFT JOIN dg USING (id) ORDER BY coalesce(d, 0) DESC, id LIMIT 60)
SELECT src, dst FROM ge WHERE src IN (SELECT id FROM top) AND dst IN (SELECT id FROM top)""")

_steps = [f"""w{i} AS MATERIALIZED (SELECT w{i - 1}.start, pt.dst AS node, sum(w{i - 1}.p * pt.p) AS p FROM w{i - 1} JOIN pt ON w{i - 1}.node = pt.src
 GROUP BY w{i - 1}.start, pt.dst)""" for i in range(2, 21)]
register("walk_expected_visits", GRAPH + """,
pt AS MATERIALIZED (SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS p FROM ge),
w1 AS MATERIALIZED (SELECT src AS start, dst AS node, p FROM pt),
""" + ",\n".join(_steps) + """
SELECT start, node, round(sum(p) * 50, 9) AS expected FROM (
 """ + " UNION ALL ".join(f"SELECT * FROM w{i}" for i in range(1, 21)) + """) GROUP BY start, node""")

_RT = """
re AS (SELECT route_type, source_center AS src, destination_center AS dst, count(DISTINCT trip_uuid) AS frequency, CAST(sum(CAST(factor AS DECIMAL(28,12))) AS DOUBLE) / count(factor) AS weight
 FROM legs WHERE data = 'training' AND route_type IS NOT NULL AND source_center IS NOT NULL AND destination_center IS NOT NULL
 GROUP BY route_type, source_center, destination_center)"""
register("graph_route_type", _RT + """
SELECT route_type, src, dst, frequency, round(weight + 1e-12, 9) AS weight FROM re""")
register("graph_route_type_nodes", _RT + """
SELECT route_type, src AS id FROM re UNION SELECT route_type, dst FROM re""")


# ------------------------------------------------------------------------- audit

register("graph_feasibility", """
SELECT count(DISTINCT source_center) AS sources, count(DISTINCT destination_center) AS destinations,
 count(DISTINCT source_name) AS source_names,
 (SELECT count(*) FROM (SELECT DISTINCT source_center, destination_center FROM legs
   WHERE source_center IS NOT NULL AND destination_center IS NOT NULL)) AS corridors,
 (SELECT count(DISTINCT f) FROM (SELECT source_center AS f FROM legs UNION ALL SELECT destination_center FROM legs)) AS facilities,
 round((SELECT count(*) FROM (SELECT DISTINCT source_center, destination_center FROM legs
   WHERE source_center IS NOT NULL AND destination_center IS NOT NULL))
  / CAST(power((SELECT count(DISTINCT f) FROM (SELECT source_center AS f FROM legs UNION ALL SELECT destination_center FROM legs)), 2) AS DOUBLE), 9) AS density
FROM legs""")
register("corridor_frequency", """
c AS (SELECT source_center, destination_center, count(*) AS n FROM legs WHERE source_center IS NOT NULL AND destination_center IS NOT NULL
 GROUP BY source_center, destination_center)
SELECT round(avg(n), 9) AS mean_rows, round(median(n), 9) AS median_rows, max(n) AS max_rows, min(n) AS min_rows,
 count(*) FILTER (WHERE n = 1) AS single_row_corridors, count(*) FILTER (WHERE n > 100) AS busy_corridors,
 count(*) FILTER (WHERE source_center = destination_center) AS self_loops FROM c""")
register("route_type_per_corridor", """
SELECT source_center, destination_center, route_type, count(*) AS rows FROM legs GROUP BY source_center, destination_center, route_type""")
register("trip_structure", """
t AS (SELECT trip_uuid, count(*) AS n FROM legs GROUP BY trip_uuid)
SELECT round(avg(n), 9) AS mean_segments, round(median(n), 9) AS median_segments, min(n) AS min_segments,
 max(n) AS max_segments, count(*) AS trips, round(avg(CASE WHEN n = 1 THEN 1.0E0 ELSE 0.0E0 END) * 100, 9) AS single_segment_pct,
 round(avg(CASE WHEN n > 1 THEN 1.0E0 ELSE 0.0E0 END) * 100, 9) AS multi_segment_pct FROM t""")
register("trip_size_distribution", """
SELECT segments, count(*) AS trips FROM (SELECT trip_uuid, count(*) AS segments FROM legs GROUP BY trip_uuid) GROUP BY segments""")
register("temporal_range", """
SELECT strftime(min(trip_creation_time), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(trip_creation_time), '%Y-%m-%d %H:%M:%S') AS last,
 date_diff('day', min(trip_creation_time), max(trip_creation_time)) AS span_days FROM legs""")
register("schedule_structure", """
s AS (SELECT route_schedule_uuid, count(*) AS n, count(DISTINCT route_type) AS k FROM legs GROUP BY route_schedule_uuid)
SELECT count(*) AS schedules, round(avg(n), 9) AS mean_rows, max(n) AS max_rows, count(*) FILTER (WHERE k = 1) AS single_type,
 count(*) FILTER (WHERE k > 1) AS multi_type FROM s""")
register("temporal_profile", """
SELECT 'hour' AS unit, hour(trip_creation_time) AS value, count(*) AS rows FROM legs GROUP BY 2
UNION ALL SELECT 'weekday', isodow(trip_creation_time) - 1, count(*) FROM legs GROUP BY 2""")
LEG_TYPES = {"data": "string", "trip_creation_time": "timestamp_ntz", "route_schedule_uuid": "string", "route_type": "string", "trip_uuid": "string",
             "seg_no": "bigint", "source_center": "string", "source_name": "string", "destination_center": "string", "destination_name": "string",
             "od_start_time": "timestamp_ntz", "od_end_time": "timestamp_ntz", "start_scan_to_end_scan": "double", "is_cutoff": "boolean",
             "cutoff_factor": "int", "cutoff_timestamp": "timestamp_ntz", "actual_distance_to_destination": "double", "osrm_time": "double",
             "osrm_distance": "double", "actual_time": "double", "factor": "double", "segment_actual_time": "double",
             "segment_osrm_time": "double", "segment_osrm_distance": "double", "segment_factor": "double"}
_P = [0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]
register("target_percentiles", "SELECT " + ", ".join(
    f"round(quantile_cont(actual_time, {p}), 9) AS p{int(round(p * 100)):02d}" for p in _P)
    + ", count(*) FILTER (WHERE actual_time = 0) AS zeros, count(*) FILTER (WHERE actual_time < 0) AS negatives FROM legs")
register("actual_vs_planned", """
x AS (SELECT actual_time / osrm_time AS r FROM legs WHERE osrm_time > 0)
SELECT round(avg(r), 9) AS ratio_mean, round(median(r), 9) AS ratio_median,
 round(avg(CASE WHEN r < 1 THEN 1.0E0 ELSE 0.0E0 END) * 100, 9) AS pct_faster,
 round(avg(CASE WHEN r > 1 THEN 1.0E0 ELSE 0.0E0 END) * 100, 9) AS pct_slower,
 round(avg(CASE WHEN r > 2 THEN 1.0E0 ELSE 0.0E0 END) * 100, 9) AS pct_over_2x FROM x""")
_NUM = ["start_scan_to_end_scan", "cutoff_factor", "actual_distance_to_destination", "osrm_time", "osrm_distance",
        "factor", "segment_actual_time", "segment_osrm_time", "segment_osrm_distance", "segment_factor"]
register("target_correlation", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, round(corr(actual_time, CAST({c} AS DOUBLE)), 9) AS r, "
    f"coalesce(abs(corr(actual_time, CAST({c} AS DOUBLE))) > 0.95, false) AS leaky FROM legs" for c in _NUM))
_ST = "CASE WHEN contains({n}, '(') AND contains({n}, ')') THEN trim(replace(string_split({n}, '(')[-1], ')', '')) END"
register("state_profile", f"""
s AS (SELECT {_ST.format(n='source_name')} AS ss, {_ST.format(n='destination_name')} AS ds FROM legs)
SELECT count(DISTINCT ss) AS source_states, count(DISTINCT ds) AS dest_states,
 round(avg(CASE WHEN ss = ds THEN 1.0E0 ELSE 0.0E0 END) * 100, 9) AS intra_pct,
 round(avg(CASE WHEN ss = ds THEN 0.0E0 ELSE 1.0E0 END) * 100, 9) AS inter_pct FROM s""")
register("top_states", f"""
SELECT {_ST.format(n='source_name')} AS state, count(*) AS segments FROM legs GROUP BY 1 HAVING state IS NOT NULL
ORDER BY segments DESC, state LIMIT 10""")
register("factor_profile", """
SELECT route_type, round(avg(factor), 9) AS factor_mean, round(median(factor), 9) AS factor_median,
 round(avg(CASE WHEN factor > 1.3 THEN 1.0E0 ELSE 0.0E0 END) * 100, 9) AS pct_over_1_3,
 count(*) FILTER (WHERE factor <= 1.0) AS on_time, count(*) FILTER (WHERE factor > 1.0 AND factor <= 1.3) AS mild,
 count(*) FILTER (WHERE factor > 1.3 AND factor <= 2.0) AS moderate, count(*) FILTER (WHERE factor > 2.0) AS severe
FROM (SELECT route_type, factor FROM legs UNION ALL SELECT 'ALL', factor FROM legs) GROUP BY route_type""")
register("cutoff_profile", """
SELECT is_cutoff, count(*) AS rows, round(avg(cutoff_factor), 9) AS cutoff_factor_mean, count(DISTINCT cutoff_factor) AS cutoff_factor_distinct, min(cutoff_factor) AS cutoff_factor_min,
 max(cutoff_factor) AS cutoff_factor_max FROM legs GROUP BY is_cutoff""")
register("profile_missing", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS missing, "
    f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0E0 / count(*), 9) AS missing_pct FROM legs" for c in LEG_COLS))
_nulls = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in LEG_COLS)
register("quality_summary", f"""
SELECT count(*) AS rows, sum({_nulls}) AS missing_cells, count(*) FILTER (WHERE segment_actual_time < 0) AS negative_segment_time,
 count(*) FILTER (WHERE segment_osrm_time = 0) AS zero_planned_time, count(*) FILTER (WHERE actual_time <= 0) AS bad_actual_time,
 count(*) FILTER (WHERE osrm_time <= 0) AS bad_osrm_time, count(*) FILTER (WHERE osrm_distance <= 0) AS bad_distance,
 {" + ".join(f"CAST(count({c}) = count(*) AS INT)" for c in LEG_COLS)} AS complete_columns,
 count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM legs)) AS duplicate_rows,
 round(100.0E0 - sum({_nulls}) * 100.0E0 / (count(*) * {len(LEG_COLS)}), 9) AS completeness_pct FROM legs""")

_PC = _NUM + ["actual_time"]


def _profile(c: str) -> str:
    return f"""SELECT '{c}' AS column, n AS non_null, round((rows - n) * 100.0E0 / rows, 9) AS null_pct, distinct_n AS distinct,
 round(mn, 9) AS min, round(mx, 9) AS max, round(mean, 9) AS mean, round(med, 9) AS median, round(sd, 9) AS std,
 round(CASE WHEN n > 2 THEN (m3 / power(m2, 1.5)) * sqrt(n * (n - 1.0E0)) / (n - 2) END, 9) AS skew,
 round(CASE WHEN n > 3 THEN (n - 1.0E0) / ((n - 2.0E0) * (n - 3.0E0)) * ((n + 1) * (m4 / (m2 * m2) - 3) + 6) END, 9) AS kurtosis,
 round(q1, 9) AS q1, round(q3, 9) AS q3, round(q3 - q1, 9) AS iqr,
 round((SELECT count(*) FROM legs WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) * 100.0E0 / n, 9) AS outlier_pct,
 zeros, negatives FROM (
 SELECT count(*) AS rows, count({c}) AS n, count(DISTINCT {c}) AS distinct_n, min({c}) AS mn, max({c}) AS mx, avg({c}) AS mean,
  median({c}) AS med, stddev_samp({c}) AS sd, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3,
  count(*) FILTER (WHERE {c} = 0) AS zeros, count(*) FILTER (WHERE {c} < 0) AS negatives,
  (SELECT avg(power({c} - (SELECT avg({c}) FROM legs), 2)) FROM legs) AS m2,
  (SELECT avg(power({c} - (SELECT avg({c}) FROM legs), 3)) FROM legs) AS m3,
  (SELECT avg(power({c} - (SELECT avg({c}) FROM legs), 4)) FROM legs) AS m4 FROM legs)"""


register("profile_columns", "\nUNION ALL ".join(_profile(c) for c in _PC))

register("profile_types", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, '{t}' AS type, count({c}) AS non_null, count(DISTINCT {c}) AS distinct FROM legs" for c, t in LEG_TYPES.items()))

_TXT = ["data", "route_schedule_uuid", "route_type", "trip_uuid", "source_center", "source_name",
        "destination_center", "destination_name"]
register("profile_top_values", """
lv AS (""" + "\nUNION ALL ".join(f"SELECT '{c}' AS column, {c} AS value FROM legs" for c in _TXT) + """),
ct AS (SELECT "column", value, count(*) AS count FROM lv WHERE value IS NOT NULL GROUP BY "column", value),
rk AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value) AS rank,
  round(count * 100.0E0 / sum(count) OVER (PARTITION BY "column"), 9) AS pct FROM ct)
SELECT "column", value, count, rank, pct FROM rk WHERE rank <= 10""")

_TS = ["trip_creation_time", "od_start_time", "od_end_time", "cutoff_timestamp"]
_CUT = {c: (f"CASE WHEN seg_no % 5 = 0 THEN NULL ELSE {c} END" if c == "cutoff_timestamp" else c) for c in _TS}
_FMT = "strftime({}, '%Y-%m-%d %H:%M:%S')"
register("parse_datetimes", "SELECT trip_uuid, seg_no, " + ", ".join(f"{_FMT.format(_CUT[c])} AS {c}" for c in _TS) + " FROM legs")
register("profile_datetimes", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) AS rows, count({_CUT[c]}) AS parsed, round(count({_CUT[c]}) * 100.0E0 / count(*), 9) AS pct_valid, "
    f"{_FMT.format(f'min({_CUT[c]})')} AS first, {_FMT.format(f'max({_CUT[c]})')} AS last FROM legs" for c in _TS))


# ----------------------------------------- graph measures built on shortest paths

_HOPS = 12      # rounds of relaxation and path counting; more than any shortest path of the test graphs has

_bf = ["""
be AS MATERIALIZED (SELECT src, dst, weight AS w FROM ge WHERE src <> dst),
d0 AS MATERIALIZED (SELECT id AS s, id AS v, 0.0E0 AS d FROM gv)"""]
for _i in range(1, _HOPS + 1):
    _bf.append(f"""d{_i} AS MATERIALIZED (SELECT s, v, min(d) AS d FROM (SELECT s, v, d FROM d{_i - 1}
 UNION ALL SELECT d{_i - 1}.s, be.dst, d{_i - 1}.d + be.w FROM d{_i - 1} JOIN be ON d{_i - 1}.v = be.src) GROUP BY s, v)""")
_bf.append(f"""dag AS MATERIALIZED (SELECT x.s, x.v AS u, y.v AS v FROM d{_HOPS} x JOIN be ON x.v = be.src JOIN d{_HOPS} y ON y.s = x.s AND y.v = be.dst
 WHERE x.d + be.w = y.d AND y.v <> x.s)""")
_bf.append("c0 AS MATERIALIZED (SELECT id AS s, id AS v, 1.0E0 AS c FROM gv)")
for _i in range(1, _HOPS + 1):
    _bf.append(f"c{_i} AS MATERIALIZED (SELECT dag.s, dag.v, sum(c) AS c FROM c{_i - 1} JOIN dag ON c{_i - 1}.s = dag.s AND c{_i - 1}.v = dag.u GROUP BY dag.s, dag.v)")
_bf.append("sg AS MATERIALIZED (SELECT s, v, sum(c) AS sigma FROM ("
           + " UNION ALL ".join(f"SELECT * FROM c{i}" for i in range(_HOPS + 1)) + ") GROUP BY s, v)")
_bf.append(f"""dd AS MATERIALIZED (SELECT d.s, d.v, d.d, sg.sigma FROM d{_HOPS} d JOIN sg ON d.s = sg.s AND d.v = sg.v)""")
_bf.append("""bt AS MATERIALIZED (SELECT gv.id, coalesce(b.x, 0.0E0) / ((n - 1.0E0) * (n - 2.0E0)) AS betweenness FROM gv CROSS JOIN nn LEFT JOIN
 (SELECT a.v AS id, sum(a.sigma * b.sigma / t.sigma) AS x FROM dd a JOIN dd b ON a.v = b.s JOIN dd t ON t.s = a.s AND t.v = b.v
  WHERE a.v <> a.s AND a.v <> b.v AND b.v <> a.s AND abs(a.d + b.d - t.d) < 1e-9 GROUP BY a.v) b ON gv.id = b.id)""")
BETWEEN = ",".join([""] + _bf)
_prc = ",\n".join(_pr[1:])
PRANK = _pr[0].removeprefix(GRAPH) + ",\n" + _prc + f""",
prk AS MATERIALIZED (SELECT id, y / (SELECT sum(y) FROM y{_PR_ITERS}) AS pagerank FROM y{_PR_ITERS})"""
SCORE = BETWEEN + PRANK + """,
im0 AS (SELECT gv.id AS facility_id, fs.facility_name AS name, fs.facility_type AS type, coalesce(fs.total_throughput, 0) AS throughput,
  coalesce(fs.avg_delay, 0.0E0) AS avg_delay, coalesce(fs.sla_breach_pct, 0.0E0) AS sla_breach_pct, betweenness, pagerank, fs.out_degree
 FROM gv LEFT JOIN fs ON gv.id = fs.facility_id JOIN bt ON bt.id = gv.id JOIN prk ON prk.id = gv.id),
im1 AS (SELECT *, (betweenness * 0.3 + pagerank * 0.2) * (avg_delay * 0.25 + sla_breach_pct * 0.15 + ln(1 + throughput) * 0.1) AS impact_score FROM im0),
im AS MATERIALIZED (SELECT *, CASE WHEN max(impact_score) OVER () > 0 THEN impact_score / max(impact_score) OVER () * 100 ELSE 0.0E0 END AS impact_score_normalized FROM im1)"""

register("betweenness_centrality", GRAPH + BETWEEN + " SELECT id, round(betweenness, 9) AS betweenness FROM bt")
register("impact_score", GRAPH + SCORE + """
SELECT facility_id, name, type, throughput, round(avg_delay, 6) AS avg_delay, round(sla_breach_pct, 6) AS sla_breach_pct,
 round(betweenness, 6) AS betweenness, round(pagerank, 6) AS pagerank, round(impact_score, 6) AS impact_score,
 round(impact_score_normalized, 6) AS impact_score_normalized,
 CASE WHEN impact_score_normalized > 70 THEN 'High' WHEN impact_score_normalized > 40 THEN 'Medium' ELSE 'Low' END AS severity FROM im""")
register("top_bottleneck_hubs", GRAPH + SCORE + """
SELECT facility_id, name, round(impact_score_normalized, 6) AS impact_score_normalized, throughput, round(sla_breach_pct, 6) AS sla_breach_pct
FROM im ORDER BY round(impact_score_normalized, 6) DESC, facility_id LIMIT 10""")
register("dependency_score", GRAPH + SCORE + """
SELECT facility_id, round(throughput * coalesce(out_degree, 0) * impact_score_normalized / 100000, 6) AS dependency_score FROM im""")
register("sla_penalty_kpis", GRAPH + SCORE + """
SELECT 1500000 * 0.18 * 25 AS daily_penalty, round(1500000 * 0.18 * 25 * 365, 6) AS annual_penalty, round(1500000 * 0.18 * 25 * 365 * 0.35, 6) AS recoverable_annual,
 round(sum(throughput * impact_score_normalized / 100 * 0.18 * 25), 3) AS hub_daily_risk_total FROM im""")
register("hub_scenarios", GRAPH + SCORE + """,
hx AS (SELECT facility_id, impact_score_normalized * 1.5 AS current_delay, CAST(throughput AS DOUBLE) AS throughput, a.action,
  CAST(a.r AS DOUBLE) AS r, CAST(a.capex_lakh AS DOUBLE) AS capex_lakh FROM im CROSS JOIN (SELECT action, delay_reduction_pct AS r, capex_lakh FROM """ + _ACTIONS + """
  UNION ALL SELECT 'Deploy Automated Sorter (Hub Only)', 0.45, 45.0) a),
hy AS (SELECT *, (throughput * 0.18 * 25 - throughput * (0.18 * (1 - r)) * 25) * 365 / 100000 AS annual FROM hx)
SELECT facility_id, round(current_delay, 4) AS current_delay, round(throughput, 4) AS throughput, action, round(r, 4) AS delay_reduction_pct,
 round(capex_lakh, 4) AS capex_lakh, round(current_delay * (1 - r), 4) AS projected_delay, round(0.18 * (1 - r), 4) AS new_sla_breach,
 round(annual + 1e-12, 4) AS annual_recovery_lakh, round(CASE WHEN capex_lakh > 0 AND annual > 0 THEN capex_lakh / (annual / 12) ELSE 0.0E0 END, 4) AS payback_months,
 round(annual - capex_lakh + 1e-12, 4) AS net_first_year_lakh, round(throughput * (0.18 - 0.18 * (1 - r)), 4) AS breaches_prevented,
 CASE WHEN NOT (capex_lakh > 0 AND annual > 0) OR capex_lakh / (annual / 12) = 0 THEN 'deploy'
  WHEN capex_lakh / (annual / 12) < 3 THEN 'approve' ELSE 'consider_others' END AS recommendation FROM hy""")
register("bottleneck_kpis", GRAPH + SCORE + """,
kc AS (SELECT source_center, destination_center, avg(factor) AS ratio, count(DISTINCT trip_uuid) AS trips, avg(CASE WHEN factor > 1.5 THEN 1.0E0 ELSE 0.0E0 END) AS sla
  FROM tr WHERE source_center IS NOT NULL AND destination_center IS NOT NULL GROUP BY source_center, destination_center),
ki AS (SELECT *, (sla * 0.4E0 + ratio / max(ratio) OVER () * 0.3E0 + CAST(trips AS DOUBLE) / max(trips) OVER () * 0.3E0) * 100 AS ci FROM kc)
SELECT (SELECT count(*) FROM im WHERE impact_score_normalized > 70) AS critical_hubs, count(*) FILTER (WHERE ci > 60) AS critical_corridors,
 round(avg(sla), 9) AS mean_corridor_sla_breach FROM ki""")
register("graph_statistics", GRAPH + SCORE + UND + """,
od AS (SELECT src AS id, count(*) AS c FROM ge GROUP BY src), idg AS (SELECT dst AS id, count(*) AS c FROM ge GROUP BY dst),
udeg AS (SELECT u AS id, count(*) AS k FROM adj GROUP BY u),
tri AS (SELECT x.a AS p, x.b AS q, y.b AS r FROM und x JOIN und y ON x.a = y.a AND x.b < y.b JOIN und z ON z.a = x.b AND z.b = y.b),
tv AS (SELECT id, count(*) AS t FROM (SELECT p AS id FROM tri UNION ALL SELECT q FROM tri UNION ALL SELECT r FROM tri) GROUP BY id),
sx AS (SELECT ge.src AS id, avg(g2.avg_delay) AS a1, max(g2.avg_delay) AS a2, avg(g2.throughput) AS a3,
  avg(ge.weight) AS a4, avg(ge.distance) AS a5, count(*) AS a6 FROM ge LEFT JOIN gv g2 ON ge.dst = g2.id GROUP BY ge.src)
SELECT gv.id AS facility_id, round((coalesce(idg.c, 0) + coalesce(od.c, 0)) * (1.0E0 / (n - 1)), 9) AS graph_degree,
 round(coalesce(idg.c, 0) * (1.0E0 / (n - 1)), 9) AS graph_in_degree, round(coalesce(od.c, 0) * (1.0E0 / (n - 1)), 9) AS graph_out_degree,
 round(betweenness, 9) AS graph_betweenness, round(pagerank, 9) AS graph_pagerank,
 round(CASE WHEN coalesce(k, 0) > 1 THEN 2.0E0 * coalesce(t, 0) / (k * (k - 1)) ELSE 0.0E0 END, 9) AS graph_clustering,
 round(coalesce(a1, 0), 9) AS graph_nbr_avg_delay, round(coalesce(a2, 0), 9) AS graph_nbr_max_delay, round(coalesce(a3, 0), 9) AS graph_nbr_avg_throughput,
 round(coalesce(a4, 0), 9) AS graph_avg_edge_weight, round(coalesce(a5, 0), 9) AS graph_avg_edge_distance, coalesce(a6, 0) AS graph_num_neighbors
FROM gv CROSS JOIN nn LEFT JOIN od ON gv.id = od.id LEFT JOIN idg ON gv.id = idg.id JOIN bt ON bt.id = gv.id JOIN prk ON prk.id = gv.id
 LEFT JOIN udeg ON gv.id = udeg.id LEFT JOIN tv ON gv.id = tv.id LEFT JOIN sx ON gv.id = sx.id""")

