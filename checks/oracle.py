"""SQL for the result of each query, written from the definition of the operator."""

from checks.standins import EVENT_SHARD, FORECAST, READING
from obsframe.schemas import CASUAL_METRICS, DAILY_TEMPERATURES, INTEGER_METRICS

MICROS = "'%Y-%m-%d %H:%M:%S.%f'"
MINUTE = "'%Y-%m-%dT%H:%M'"


def r4(x: str) -> str:
    return f"round(({x}) + 1e-9, 4)"


def columns(expressions: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in expressions.items())


PLACES = """(SELECT c_custkey AS id, c_name AS "Name", c_acctbal AS "Latitude", CAST(c_nationkey AS DOUBLE) AS "Longitude",
  c_name || ', ' || c_mktsegment || ', X' AS "Address" FROM customer)"""

SHARDS = f"""(SELECT *, CASE WHEN position < total // 2 THEN 1 ELSE 2 END AS shard,
  CASE WHEN position < total // 2 THEN position ELSE position - total // 2 END AS seat
  FROM (SELECT *, row_number() OVER (ORDER BY id) - 1 AS position, count(*) OVER () AS total FROM {PLACES}))"""

LATEST = """(SELECT * FROM (
  SELECT event_id, user_id, date_trunc('day', ts) AS day, value,
    row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts DESC, event_id DESC) AS v FROM events) WHERE v = 1)"""

CUSTOMERS = "(SELECT c_custkey AS id, c_nationkey AS prediction, c_acctbal AS lat, CAST(c_custkey % 360 AS DOUBLE) AS lon FROM customer)"

TOPIC = f"CASE WHEN ({EVENT_SHARD}) = 1 THEN 'weather_1' ELSE 'weather_2' END"

ORDER_DAYS = """(SELECT *, unnest(generate_series(0, o_orderkey % 10)) AS i FROM orders)"""

def nearest_sql(points: str, centres: str, features: list[str]) -> str:
    """Each point with the label of the first of its nearest centres."""
    apart = " + ".join(f'(p."{f}" - c."{f}") * (p."{f}" - c."{f}")' for f in features)
    return f"""SELECT any_value(p) AS p, min({{'d': {apart}, 'label': c.label}}).label AS label
        FROM {points} p, {centres} c GROUP BY p.row"""


def moved_sql(centres: str, near: str, features: list[str]) -> str:
    """Centres after a round: means in units of 2^-20, which add up exactly."""
    sums = ", ".join(f'sum(floor(p."{f}" * 1048576 + 0.5)::BIGINT)::DOUBLE / count(*) / 1048576 AS "{f}"' for f in features)
    return f"""SELECT label, {', '.join(f'coalesce(m."{f}", c."{f}") AS "{f}"' for f in features)}
        FROM {centres} c LEFT JOIN (SELECT label, {sums} FROM {near} GROUP BY label) m USING (label)"""


def kmeans_sql(k: int, rounds: int, features: list[str]) -> str:
    names = ", ".join(f'"{f}"' for f in features)
    steps = "".join(
        f", a{n} AS MATERIALIZED ({nearest_sql('points', f'c{n}', features)}), c{n + 1} AS MATERIALIZED ({moved_sql(f'c{n}', f'a{n}', features)})"
        for n in range(rounds)
    )
    return f"""WITH points AS MATERIALIZED (
            SELECT row_number() OVER () AS row, md5(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)) AS hash,
                   {', '.join(f'CAST({FORECAST[f]} AS DOUBLE) AS "{f}"' for f in features)} FROM lineitem
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY min(hash)) - 1 AS label, {names} FROM points GROUP BY {names} QUALIFY label < {k}
        ){steps}, found AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {names}) - 1 AS label, {names} FROM c{rounds}),
        sizes AS (SELECT label, count(*) AS n FROM ({nearest_sql('points', 'found', features)}) GROUP BY label)
        SELECT CAST(label AS INT) AS prediction, n, {', '.join(f'round("{f}", 9) AS "{f}"' for f in features)} FROM found JOIN sizes USING (label)"""


# The three centres of q_incremental_daily.
GIVEN_CENTRES = ", ".join(f"({n}, {n * 8}.0, {n * 3000 - 1000}.0, {n * 100}.0, 20.0, {n * 100}.0, 30.0)" for n in range(3))

DAILY_FEATURES = ["Longitude", "Latitude", *DAILY_TEMPERATURES]

ORACLE = {
    # Around each nation from its smallest point, always to the point that has no other on its right.
    "q_geojson_hull": f"""WITH RECURSIVE p AS MATERIALIZED (SELECT DISTINCT prediction, lon, lat FROM {CUSTOMERS}),
        first AS (SELECT prediction, min({{'x': lon, 'y': lat}}) AS corner FROM p GROUP BY prediction),
        next AS MATERIALIZED (
            SELECT a.prediction, a.lon AS ax, a.lat AS ay, b.lon AS tx, b.lat AS ty FROM p a JOIN p b
            ON a.prediction = b.prediction AND (a.lon, a.lat) <> (b.lon, b.lat)
            WHERE NOT EXISTS (SELECT 1 FROM p c WHERE c.prediction = a.prediction
                AND (b.lon - a.lon) * (c.lat - a.lat) - (b.lat - a.lat) * (c.lon - a.lon) < 0)
        ), walk AS (
            SELECT prediction, 0 AS place, corner.x AS lon, corner.y AS lat FROM first
            UNION ALL SELECT w.prediction, place + 1, tx, ty FROM walk w JOIN next n
            ON w.prediction = n.prediction AND w.lon = ax AND w.lat = ay JOIN first f ON f.prediction = w.prediction
            WHERE place = 0 OR (w.lon, w.lat) <> (f.corner.x, f.corner.y)
        ) SELECT prediction, n_name AS name, 'Polygon' AS type, place, lon, lat FROM walk JOIN nation ON n_nationkey = prediction""",
    "q_stream_tables": f"""SELECT DISTINCT user_id AS "locationID", strftime(date_trunc('minute', ts), {MICROS}) AS time FROM events""",
    "q_run_one_cluster": f"""WITH r AS (SELECT * FROM lineitem JOIN customer ON l_suppkey = c_custkey)
        SELECT strftime(l_shipdate, '%Y-%m-%d') AS time, 0 AS prediction, bool_or(l_returnflag = 'R') AS avg_is_day,
               {', '.join(f"{r4(f'avg(CAST({READING[m]} AS INT))' if m in INTEGER_METRICS else f'avg({READING[m]})')} AS avg_{m}" for m in CASUAL_METRICS if m != 'is_day')}
        FROM r WHERE l_linenumber <> 7 GROUP BY 1
        UNION ALL SELECT 'skipped', CAST(count(*) AS INT), NULL, {', '.join('NULL' for m in CASUAL_METRICS if m != 'is_day')} FROM r WHERE l_linenumber = 7""",
    "q_refused_rows": """WITH r AS (
            SELECT l_orderkey, l_linenumber, l_extendedprice * 1e5 AS visibility, l_quantity * 30 >= 999.995 AS warm,
                   l_extendedprice * 1e5 >= 2147483647.5 AS far FROM lineitem)
        SELECT l_orderkey AS orderkey, CAST(l_linenumber AS INT) AS line,
               array_to_string(list_filter([CASE WHEN warm THEN 'temperature_2m' END, CASE WHEN far THEN 'visibility' END], lambda x: x IS NOT NULL), ',') AS columns,
               round(visibility, 2) AS visibility FROM r WHERE warm OR far
        UNION ALL SELECT NULL, CAST(count(*) FILTER (WHERE warm OR far) AS INT), 'kept', CAST(count(*) FILTER (WHERE NOT (warm OR far)) AS DOUBLE) FROM r""",
    "q_paged_filter": f"""SELECT event_id, strftime(ts, {MICROS}) AS ts, event_type, value FROM events
        WHERE event_id >= (SELECT max(event_id) // 2 FROM events)""",
    "q_history_sync": f"""SELECT row_number() OVER (ORDER BY event_id) - 1 AS position, event_id, strftime(ts, {MICROS}) AS ts, event_type, value
        FROM events""",
    "q_kmeans_centres": kmeans_sql(4, 3, DAILY_FEATURES),
    "q_summary_states": f"""SELECT strftime(l_shipdate, {MICROS}) AS time, l_linenumber AS prediction, bool_or(l_returnflag = 'R') AS avg_is_day,
        {', '.join(f"{r4(f'avg({READING[m]})')} AS avg_{m}" for m in CASUAL_METRICS if m != 'is_day')} FROM lineitem GROUP BY 1, 2""",
    "q_incremental_daily": f"""WITH latest AS (
            SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts DESC, event_id DESC) AS v FROM events
        ), points AS MATERIALIZED (
            SELECT event_id AS row, date_trunc('day', ts) AS day, CAST(c_nationkey AS DOUBLE) AS "Longitude", c_acctbal AS "Latitude",
                   value + 1 AS temperature_2m_max, value AS temperature_2m_min, value * 2 AS apparent_temperature_max,
                   CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS apparent_temperature_min
            FROM latest JOIN customer ON user_id = c_custkey WHERE v = 1
        ), centres(label, {', '.join(f'"{f}"' for f in DAILY_FEATURES)}) AS (VALUES {GIVEN_CENTRES})
        SELECT strftime(p.day, {MICROS}) AS time, label AS prediction, {', '.join(f"{r4(f'avg(p.{t})')} AS {t}" for t in DAILY_TEMPERATURES)},
               {r4('avg(p."Longitude")')} AS "centroid_Longitude", {r4('avg(p."Latitude")')} AS "centroid_Latitude"
        FROM ({nearest_sql('points', 'centres', DAILY_FEATURES)}) GROUP BY 1, 2""",
    "q_location_csv": f"SELECT \"Name\", \"Latitude\", \"Longitude\", \"Address\", id FROM {PLACES}",
    "q_shard_split": f"SELECT id, position, shard, seat FROM {SHARDS}",
    "q_shard_sizes": f"SELECT shard, count(*) AS places, min(id) AS first_id FROM {SHARDS} GROUP BY shard",
    "q_shard_union": f"SELECT event_id, user_id, value, {EVENT_SHARD} AS shard FROM events",
    "q_shard_route": f"""SELECT id, shard, CASE shard WHEN 1 THEN 'weather_1' ELSE 'weather_2' END AS topic,
        CASE shard WHEN 1 THEN 'current' ELSE 'current_2' END AS current_table,
        CASE shard WHEN 1 THEN 'daily' ELSE 'daily_2' END AS daily_table FROM {SHARDS}""",
    "q_fetch_requests": f"""SELECT shard, seat // 30 AS batch, count(*) AS n, min(id) AS first_id, max(id) AS last_id,
        string_agg(CAST("Latitude" AS VARCHAR) || ', ' || CAST("Longitude" AS VARCHAR), '; ' ORDER BY seat) AS points,
        '{",".join(CASUAL_METRICS)}' AS variables FROM {SHARDS} GROUP BY shard, seat // 30""",
    "q_fetch_records": f"""SELECT CASE shard WHEN 1 THEN 'weather_1' ELSE 'weather_2' END AS topic, id,
        "Latitude" AS latitude, "Longitude" AS longitude FROM {SHARDS}""",
    "q_fetch_errors": """SELECT event_id, CASE event_type WHEN 'error' THEN 500 ELSE 200 END AS status, props AS body,
        CASE event_type WHEN 'error' THEN 'error' ELSE 'record' END AS goes_to FROM events""",
    "q_page_slice": """SELECT page, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
        'limit=500&offset=' || CAST(page * 500 AS VARCHAR) AS query
        FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS page FROM orders) GROUP BY page""",
    "q_rest_pages": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "q_rest_table": f"SELECT * FROM {PLACES}",
    "q_profile_select": f"SELECT l_partkey, {columns({m: READING[m] for m in CASUAL_METRICS})} FROM lineitem",
    "q_typed_current": "SELECT l_suppkey AS \"locationID\", strftime(l_shipdate, '%Y-%m-%d') AS time, " + columns({
        m: f"CASE WHEN l_linenumber <> 7 THEN {READING[m]} END" if m == "rain"
        else f"({READING[m]}) = 1" if m == "is_day"
        else f"CAST({READING[m]} AS INT)" if m in INTEGER_METRICS else READING[m]
        for m in CASUAL_METRICS
    }) + " FROM lineitem",
    "q_typed_daily": f"""SELECT CAST(event_id AS INT) AS id, user_id AS "locationID",
        strftime(date_trunc('day', ts), {MICROS}) AS time, value AS temperature_2m_min, value + 1 AS temperature_2m_max,
        CASE WHEN event_type <> 'error' THEN value END AS apparent_temperature_min,
        value * 2 AS apparent_temperature_max, strftime(ts, {MICROS}) AS time_created FROM events""",
    "q_typed_location": f"""SELECT id, "Name", "Latitude", CASE WHEN "Address" NOT LIKE '%BUILDING%' THEN "Longitude" END
        AS "Longitude", "Address" FROM {PLACES}""",
    "q_local_time": f"SELECT event_id, strftime(ts + INTERVAL 7 HOUR, {MICROS}) AS local FROM events",
    "q_grid_cell": "SELECT c_custkey, CAST(round_even(CAST(c_acctbal AS DECIMAL(12,2)), 1) AS DECIMAL(12,1)) AS cell FROM customer",
    "q_address_part": """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN ''
        WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS part FROM customer""",
    "q_message_encode": f"""SELECT {TOPIC} AS topic, '{{"event_id":' || event_id || ',"event_type":"' || event_type
        || '","value":' || CAST(value AS VARCHAR) || ',"note":null}}' AS text FROM events""",
    "q_envelope_entries": f"""SELECT {TOPIC} AS topic, 'id' AS id, CAST(user_id AS VARCHAR) AS data FROM events
        UNION ALL SELECT {TOPIC}, 'current', '{{"time":"' || strftime(ts, {MINUTE}) || '","temperature_2m":' || CAST(value AS VARCHAR) || '}}'
        FROM events
        UNION ALL SELECT {TOPIC}, 'daily', '{{"time":["' || strftime(ts, '%Y-%m-%d') || '"],"temperature_2m_max":['
        || CAST(value AS VARCHAR) || ']}}' FROM events""",
    "q_parse_envelope": f"""SELECT o_orderkey AS id, strftime(o_orderdate, {MINUTE}) AS time, o_totalprice AS temperature_2m,
        'n/a' AS rain, o_orderkey % 10 + 1 AS days, o_orderkey % 10 AS sunsets FROM orders""",
    "q_valid_messages": """SELECT o_orderkey AS id FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')
        AND o_orderstatus NOT IN ('P', 'F')""",
    "q_current_rows": f"""SELECT o_orderkey AS "locationID", strftime(date_trunc('minute', o_orderdate), {MICROS}) AS time,
        o_totalprice AS temperature_2m, CAST(NULL AS DOUBLE) AS rain, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS is_day
        FROM orders""",
    "q_forecast_rows": f"""SELECT o_orderkey AS "locationID",
        strftime(date_trunc('day', o_orderdate + i * INTERVAL 1 DAY), {MICROS}) AS time,
        o_totalprice + i AS temperature_2m_max, o_totalprice - i AS temperature_2m_min,
        CAST(i AS DOUBLE) AS apparent_temperature_max, CAST(NULL AS DOUBLE) AS apparent_temperature_min,
        strftime(o_orderdate + i * INTERVAL 1 DAY, {MICROS}) AS sunrise,
        CASE WHEN i < o_orderkey % 10 THEN strftime(o_orderdate + i * INTERVAL 1 DAY, {MICROS}) END AS sunset
        FROM {ORDER_DAYS} WHERE i < 7""",
    "q_latest_daily": f"""SELECT event_id AS id, CAST(user_id AS VARCHAR) AS "locationID", strftime(day, {MICROS}) AS time, value
        FROM {LATEST}""",
    "q_location_join": f"""SELECT event_id AS id, user_id AS "locationID", value, "Name", "Latitude", "Longitude"
        FROM {LATEST} JOIN {PLACES} p ON user_id = p.id""",
    "q_location_join_current": f"""SELECT l_suppkey AS "locationID", l_orderkey, l_linenumber, l_quantity, "Latitude", "Longitude"
        FROM lineitem JOIN {PLACES} p ON l_suppkey = p.id WHERE l_returnflag <> 'A'""",
    "q_insert_ignore": f"SELECT * FROM {PLACES} WHERE \"Latitude\" < 0",
    "q_cluster_assign": """WITH x AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS axis FROM embeddings),
        c AS (SELECT label, axis, avg(CAST(x AS DOUBLE)) AS x FROM x GROUP BY label, axis),
        d AS (SELECT x.vec_id, x.label, c.label AS prediction, sum((x.x - c.x) * (x.x - c.x)) AS d
              FROM x JOIN c USING (axis) GROUP BY ALL)
        SELECT vec_id, label, arg_min(prediction, (d, prediction)) AS prediction FROM d GROUP BY vec_id, label""",
    "q_kmeans_daily": "SELECT count(*) AS n_rows, 10 AS n_clusters, 0 AS n_misassigned FROM lineitem",
    "q_kmeans_current": "SELECT count(*) AS n_rows, 10 AS n_clusters, 0 AS n_misassigned FROM lineitem",
    "q_cluster_summary_daily": f"""SELECT strftime(l_shipdate, {MICROS}) AS time, l_linenumber AS prediction,
        {columns({c: r4(f"avg({FORECAST[c]})") for c in DAILY_TEMPERATURES})},
        {r4("avg(l_discount)")} AS "centroid_Longitude", {r4("avg(l_tax)")} AS "centroid_Latitude"
        FROM lineitem GROUP BY l_shipdate, l_linenumber""",
    "q_cluster_summary_current": f"""SELECT strftime(l_shipdate, {MICROS}) AS time, l_linenumber AS prediction,
        bool_or(l_returnflag = 'R') AS avg_is_day,
        {columns({f"avg_{m}": r4(f"avg({READING[m]})") for m in CASUAL_METRICS if m != "is_day"})}
        FROM lineitem GROUP BY l_shipdate, l_linenumber""",
    "q_cluster_points": f"""SELECT prediction, id % 3 AS part, count(*) AS n,
        '[' || string_agg('[' || CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || ']', ',' ORDER BY id) || ']' AS coordinates
        FROM {CUSTOMERS} GROUP BY prediction, id % 3""",
    "q_cluster_centroid": f"""SELECT prediction, {r4("avg(lon)")} AS "centroid_Longitude", {r4("avg(lat)")} AS "centroid_Latitude"
        FROM {CUSTOMERS} GROUP BY prediction""",
    "q_cluster_named": f"""SELECT prediction, n_name AS centroid_address, {r4("avg(lat)")} AS "centroid_Latitude",
        {columns({t: r4("avg(lat)") for t in DAILY_TEMPERATURES})}
        FROM {CUSTOMERS} JOIN nation ON n_nationkey = prediction GROUP BY prediction, n_name""",
    "q_geojson": f"""SELECT prediction, part, 3 AS parts, '{{"type":"Feature","geometry":{{"type":"Polygon","coordinates":[['
        || string_agg('[' || CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || ']', ',' ORDER BY id)
        || ']]}},"properties":{{"name":"' || n_name || '"'
        {" ".join(f'''|| ',"{t}":' || CAST({r4("mean")} AS VARCHAR)''' for t in DAILY_TEMPERATURES)}
        || ',"part":' || part || ',"parts":3}}}}' AS geojson
        FROM (SELECT *, id % 3 AS part FROM {CUSTOMERS}) JOIN nation ON n_nationkey = prediction
        JOIN (SELECT prediction, avg(lat) AS mean FROM {CUSTOMERS} GROUP BY prediction) USING (prediction)
        GROUP BY prediction, part, n_name, mean""",
    "q_reverse_geocode": f"""SELECT s_suppkey, place_id, name, {r4("d")} AS squared_distance FROM (
        SELECT s_suppkey, c_custkey AS place_id, c_mktsegment AS name, d,
          row_number() OVER (PARTITION BY s_suppkey ORDER BY d, c_custkey) AS n FROM (
          SELECT *, (s_acctbal - c_acctbal) * (s_acctbal - c_acctbal)
            + CAST((s_nationkey - c_nationkey) * (s_nationkey - c_nationkey) AS DOUBLE) AS d
          FROM supplier, customer)) WHERE n = 1""",
    "q_spearman_long": "WITH " + ", ".join(
        f"r{i} AS (SELECT id, rank() OVER (ORDER BY {m}) + (count(*) OVER (PARTITION BY {m}) - 1) / 2.0 AS r FROM n)"
        for i, m in enumerate(["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    ).replace("r0 AS", "n AS (SELECT *, row_number() OVER () AS id FROM lineitem), r0 AS", 1) + ", w AS (SELECT "
    + ", ".join(f"CAST(r{i}.r AS DOUBLE) AS c{i}" for i in range(4))
    + " FROM r0 JOIN r1 USING (id) JOIN r2 USING (id) JOIN r3 USING (id)) "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS matrix_x, '{y}' AS matrix_y, round(corr(c{i}, c{j}) + 1e-9, 6) AS correlation, '2024-05-01 10:15:00' AS time FROM w"
        for i, x in enumerate(["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
        for j, y in enumerate(["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    ),
    "q_ddl_typed_table": f"""SELECT CAST(l_suppkey AS INT) AS "locationID", strftime(l_shipdate, {MICROS}) AS time,
        l_linenumber AS wind_direction_10m, CAST(round(l_linenumber + 0.55) AS INT) AS uv_index,
        CAST(round(l_quantity * 8.375) AS INT) AS visibility, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 2 END AS shard,
        CAST(TRY_CAST(l_quantity AS DECIMAL(5,2)) AS DOUBLE) AS temperature_2m,
        CAST(TRY_CAST(l_discount AS DECIMAL(5,2)) AS DOUBLE) AS rain,
        CAST(TRY_CAST(l_extendedprice AS DECIMAL(5,2)) AS DOUBLE) AS apparent_temperature,
        CAST(TRY_CAST(l_tax AS DECIMAL(5,2)) AS DOUBLE) AS precipitation, CAST(NULL AS DOUBLE) AS snowfall FROM lineitem""",
    "q_table_misfits": """SELECT 'apparent_temperature' AS column, count(*) AS n FROM lineitem
        WHERE l_extendedprice >= 999.995 HAVING count(*) > 0""",
    "q_stream_ingest": f"""SELECT user_id AS "locationID", strftime(minute, {MICROS}) AS time, value AS temperature_2m, shard FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, minute ORDER BY shard, value) AS n FROM (
          SELECT user_id, date_trunc('minute', ts) AS minute, value, {EVENT_SHARD} AS shard FROM events)) WHERE n = 1""",
    "q_stream_forecasts": f"""SELECT user_id AS "locationID", strftime(date_trunc('day', ts), {MICROS}) AS time,
        value AS temperature_2m_max, CAST(NULL AS TIMESTAMP) AS sunrise, {EVENT_SHARD} AS shard FROM events""",
    "q_stream_dedup": f"SELECT user_id AS \"locationID\", strftime(ts, {MICROS}) AS time, value FROM events",
    "q_run_once": f"""SELECT strftime(day, '%Y-%m-%d') AS of, count(*) AS n FROM {LATEST} JOIN customer ON user_id = c_custkey GROUP BY day
        UNION ALL SELECT 'times', count(DISTINCT l_shipdate) FROM lineitem JOIN customer ON l_suppkey = c_custkey
        UNION ALL SELECT 'pairs', 361""",
}
