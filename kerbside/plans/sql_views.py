"""Test-table views in plain SQL, as common table expressions for the comparison queries."""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%S.%f'"
SEC = "'%Y-%m-%dT%H:%M:%S'"

POSTED = "[30.0, 40.0, 50.0, 60.0, 80.0, 90.0, 100.0, 120.0]::DOUBLE[]"

LAT = "(51.5074::DOUBLE + 0.009788::DOUBLE * (event_id % 100))"
LNG = "((-0.1278)::DOUBLE - 0.017626::DOUBLE * (event_id % 100))"
K = "CAST(regexp_extract(props, '\"k\": (\\d+)', 1) AS INT)"

LABELS = """['Clear sky', 'Mainly clear', 'Partly cloudy', 'Overcast', 'Fog', 'Depositing rime fog', 'Light drizzle',
 'Moderate drizzle', 'Dense drizzle', 'Light rain', 'Moderate rain', 'Heavy rain', 'Light snow', 'Moderate snow',
 'Heavy snow', 'Thunderstorms', 'Thunderstorm with light hail', 'Thunderstorm with heavy hail']"""
CODES = "[0, 1, 2, 3, 45, 48, 51, 53, 55, 61, 63, 65, 71, 73, 75, 95, 96, 99]"

VIEWS = {
    "gps": f"""SELECT event_id AS id, CAST(user_id AS VARCHAR) AS device, ts, value AS speed, event_type,
        {LAT} AS lat, {LNG} AS lng FROM events WHERE event_type IN ('click', 'view', 'signup')""",
    "lim": f"""SELECT event_id AS id, CAST(user_id AS VARCHAR) AS device, ts, CAST(event_id % 97 AS VARCHAR) AS place,
        ({POSTED})[event_id % 8 + 1] AS lim FROM events WHERE event_type = 'purchase'""",
    "alerts": f"""SELECT event_id AS id, CAST(user_id AS VARCHAR) AS device, ts,
        (['slow_down', 'maintain_speed', 'speed_up'])[{K} % 3 + 1] AS action, floor(value) AS target,
        'event ' || event_id AS reason, epoch_us(ts) // 1000 AS ms FROM events WHERE event_type = 'error'""",
    "weather": f"""SELECT event_id AS id, CAST(user_id AS VARCHAR) AS device, ts, ({CODES})[event_id % 18 + 1] AS code,
        ({LABELS})[event_id % 18 + 1] AS label, CAST(event_id % 32 - 5 AS DOUBLE) AS temperature,
        CAST(event_id % 100 AS DOUBLE) AS wind, {LAT} AS lat, {LNG} AS lng FROM events WHERE event_type = 'signup'""",
    "emergency": """SELECT event_id AS id, CAST(user_id AS VARCHAR) AS device, ts, 'I' || event_id AS incident,
        (['Accident', 'Fire', 'Police', 'None'])[event_id % 4 + 1] AS kind, (['Active', 'Resolved'])[event_id % 2 + 1] AS status
        FROM events WHERE event_type = 'error'""",
    "traffic": f"""SELECT event_id AS id, CAST(user_id AS VARCHAR) AS device, ts, 'Camera' || {K} AS camera
        FROM events WHERE event_type = 'view'""",
    "vehicles": """SELECT min(event_id) AS id, CAST(user_id AS VARCHAR) AS device, min(ts) AS ts,
        (['Tesla', 'Lada', 'Toyota', 'BMW'])[user_id % 4 + 1] AS make, (['Model 3', '2107', 'Corolla', 'X5'])[user_id % 4 + 1] AS model,
        ([2023, 1987, 2015, 2022])[user_id % 4 + 1] AS year, ([true, false, false, true])[user_id % 4 + 1] AS auto_braking,
        ([true, false, true, true])[user_id % 4 + 1] AS abs_system, ([true, false, true, true])[user_id % 4 + 1] AS traction
        FROM events GROUP BY user_id""",
    "roads": """SELECT p_partkey AS place, (51.5074::DOUBLE + 0.009788::DOUBLE * (p_partkey % 100))
          + 0.0005::DOUBLE * ((p_partkey // 100) % 3 - 1) AS lat,
        (-0.1278)::DOUBLE - 0.017626::DOUBLE * (p_partkey % 100) AS lng FROM part""",
    # (fix, limit) pairs at most a day apart whose speed is above the limit
    "over": """SELECT g.id, g.device, g.ts, g.speed, l.lim, g.speed - l.lim AS excess FROM gps g JOIN lim l
        ON g.device = l.device AND g.ts BETWEEN l.ts - INTERVAL 1 DAY AND l.ts + INTERVAL 1 DAY WHERE g.speed > l.lim""",
    "metrics": f"""SELECT device AS "deviceId", strftime(time_bucket(INTERVAL 1 DAY, ts), {SEC}) || '/' ||
          strftime(time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY, {SEC}) AS period,
        round(sum(excess), 2) / count(*) AS avg_speed_over_limit, count(*) AS overspeed_events,
        max(excess) AS max_speed_over_limit FROM over GROUP BY device, time_bucket(INTERVAL 1 DAY, ts)""",
    "fix_weather": """SELECT g.id, w.label, coalesce(regexp_matches(lower(w.label), 'fog|rain|drizzle|snow|ice|thunder|hail'), false) AS risky
        FROM gps g ASOF LEFT JOIN weather w ON g.device = w.device AND g.ts >= w.ts""",
    "risky": f"""SELECT o.device AS "deviceId", strftime(time_bucket(INTERVAL 1 DAY, o.ts), {SEC}) || '/' ||
          strftime(time_bucket(INTERVAL 1 DAY, o.ts) + INTERVAL 1 DAY, {SEC}) AS period,
        count(*) FILTER (f.risky) AS risky_weather_overspeed FROM over o JOIN fix_weather f ON o.id = f.id GROUP BY ALL""",
    "missed": """SELECT a.id, a.device, a.ts, a.target, g.speed FROM (SELECT * FROM alerts WHERE action = 'slow_down') a
        ASOF JOIN gps g ON a.device = g.device AND a.ts < g.ts WHERE g.ts <= a.ts + INTERVAL 1 DAY AND g.speed > a.target""",
    "missed_by_day": f"""SELECT device AS "deviceId", strftime(time_bucket(INTERVAL 1 DAY, ts), {SEC}) || '/' ||
          strftime(time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY, {SEC}) AS period, count(*) AS ignored_alerts
        FROM missed GROUP BY ALL""",
    "card": """SELECT m.*, r.risky_weather_overspeed, coalesce(i.ignored_alerts, 0) AS ignored_alerts,
        CAST(round(round(greatest(0, least(100, 100.0::DOUBLE - 2.0::DOUBLE * m.overspeed_events - 0.4::DOUBLE * m.max_speed_over_limit
          - CASE WHEN r.risky_weather_overspeed > 0 THEN 10 ELSE 0 END
          - CASE WHEN coalesce(i.ignored_alerts, 0) >= 2 THEN 10 ELSE 0 END)), 9), 0) AS INT) AS rating
        FROM metrics m JOIN risky r USING ("deviceId", period) LEFT JOIN missed_by_day i USING ("deviceId", period)""",
    "classed": """SELECT *, CASE WHEN rating >= 90 THEN 'Excellent' WHEN rating >= 75 THEN 'Good' WHEN rating >= 60 THEN 'Fair'
        WHEN rating >= 40 THEN 'Poor' ELSE 'Dangerous' END AS class FROM card""",
    "messages": """
        SELECT id, device, ts, 'gps_data' AS topic, speed, NULL::DOUBLE AS lim, NULL AS label, NULL AS kind, NULL AS status,
          NULL AS make, NULL AS model, NULL::INT AS year, NULL::BOOLEAN AS auto_braking, NULL::BOOLEAN AS abs_system,
          NULL::BOOLEAN AS traction FROM gps
        UNION ALL BY NAME SELECT id, device, ts, 'optimized_routes' AS topic, lim FROM lim
        UNION ALL BY NAME SELECT id, device, ts, 'weather_data' AS topic, label FROM weather
        UNION ALL BY NAME SELECT id, device, ts, 'emergency_data' AS topic, kind, status FROM emergency
        UNION ALL BY NAME SELECT id, device, ts, 'traffic_data' AS topic FROM traffic
        UNION ALL BY NAME SELECT id, device, ts, 'vehicle_data' AS topic, make, model, year, auto_braking, abs_system, traction
          FROM vehicles""",
    "state": "SELECT id, topic, device, ts, " + ", ".join(
        f"last_value({c} IGNORE NULLS) OVER w AS {c}"
        for c in "speed lim label kind status make model year auto_braking abs_system traction".split()
    ) + """ FROM messages WINDOW w AS (PARTITION BY device ORDER BY ts, id, topic ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "advised": """SELECT *, CASE label WHEN 'Fog' THEN 'Low-visibility' WHEN 'Heavy Rain' THEN 'Wet' WHEN 'Snow' THEN 'Snow-covered'
        WHEN 'Ice' THEN 'Icy' ELSE 'Normal' END AS road, coalesce(status = 'Active' AND kind <> 'None', false) AS incident FROM state""",
    "numbered": """SELECT *, row_number() OVER (PARTITION BY device ORDER BY ts, id) - 1 AS n FROM gps""",
    "windows": """SELECT device, n // 3 AS window_no, max(ts) AS ts, max(id) AS id, list(id ORDER BY ts, id) AS ids,
        list(lat ORDER BY ts, id) AS lats, list(lng ORDER BY ts, id) AS lngs FROM numbered GROUP BY ALL HAVING count(*) = 3""",
    "places": "SELECT DISTINCT lat, lng FROM gps",
    "near": """SELECT p.lat, p.lng, r.place, r.lat AS rlat, r.lng AS rlng, 2 * 6371008.8::DOUBLE * asin(least(1, sqrt(
          pow(sin((radians(r.lat) - radians(p.lat)) / 2), 2)
          + cos(radians(p.lat)) * cos(radians(r.lat)) * pow(sin((radians(r.lng) - radians(p.lng)) / 2), 2)))) AS metres
        FROM places p, roads r""",
    "snapped": """SELECT lat, lng, place, rlat, rlng, metres FROM near
        QUALIFY row_number() OVER (PARTITION BY lat, lng ORDER BY round(metres, 6), place) = 1""",
    "routes": """SELECT w.*, s.place, s.rlat, s.rlng FROM windows w JOIN snapped s ON w.lats[1] = s.lat AND w.lngs[1] = s.lng""",
    "centroids": """SELECT label, list(c ORDER BY dim) AS v FROM (SELECT label, dim, avg(x) AS c FROM (
          SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings) GROUP BY ALL)
        GROUP BY label""",
}

NEEDS = {
    "over": ["gps", "lim"], "metrics": ["over"], "fix_weather": ["gps", "weather"], "risky": ["over", "fix_weather"],
    "missed": ["alerts", "gps"], "missed_by_day": ["missed"], "card": ["metrics", "risky", "missed_by_day"],
    "classed": ["card"], "messages": ["gps", "lim", "weather", "emergency", "traffic", "vehicles"], "state": ["messages"],
    "advised": ["state"], "numbered": ["gps"], "windows": ["numbered"], "places": ["gps"], "near": ["places", "roads"],
    "snapped": ["near"], "routes": ["windows", "snapped"],
}


def using(names: str, select: str) -> str:
    """``select`` with the named views, and the views those build on, in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order) + "\n" + select
