"""DuckDB SQL for the registered queries."""

from __future__ import annotations

import re

from workload.views import ARRIVAL, BILL, HISTORY, TRIPS, TRIPS_LATE, WIDE

FEATURES = ["trip_distance", "fare_amount", "total_amount", "tip_amount", "passenger_count"]
COLS = ", ".join(TRIPS)
PASSES = 20
# Fixed values, stated again so that the check does not lean on the library.
LABEL_MAP = {0: "BANLIEUE_REG", 1: "LONG_COURRIER", 2: "HUB_URBAIN", 3: "PREMIUM_LUXE"}
LABELS = tuple(LABEL_MAP.values())
FLAGS = (
    "MONTANT_NEGATIF", "DISTANCE_NULLE", "DISTANCE_ABERRANTE", "LOCATION_NULLE", "INVERSION_TEMPS",
    "ANOMALIE_STATISTIQUE", "VALIDE",
)


def _select(columns: dict[str, str], source: str, star: str = "") -> str:
    return f"SELECT {star}{', '.join(f'{sql} AS {name}' for name, sql in columns.items())} FROM {source}"


FLAG_RULES = """WHEN total_amount < 0 THEN 'MONTANT_NEGATIF'
  WHEN fare_amount < 0 THEN 'MONTANT_NEGATIF'
  WHEN trip_distance IS NULL OR trip_distance <= 0 THEN 'DISTANCE_NULLE'
  WHEN trip_distance > 100 THEN 'DISTANCE_ABERRANTE'
  WHEN PULocationID IS NULL THEN 'LOCATION_NULLE'
  WHEN tpep_dropoff_datetime < tpep_pickup_datetime THEN 'INVERSION_TEMPS'
  WHEN abs(z_score) > 3 THEN 'ANOMALIE_STATISTIQUE'"""
Z = """CASE WHEN s.std_total IS NOT NULL AND s.std_total > 0
  THEN (t.total_amount - s.mean_total) / s.std_total ELSE 0.0::DOUBLE END AS z_score"""
LABEL_CASE = "CASE prediction " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in LABEL_MAP.items()) + " END"
COUNTS = ", ".join(f"count(*) FILTER (cluster_label = '{n}') AS {n}" for n in LABELS)
SHARES = ", ".join(f"100.0::DOUBLE * {n} / n AS pct_{n}" for n in LABELS)
BASE = ", ".join(f"avg(pct_{n}) / 100 AS {n}" for n in LABELS)
PSI = " + ".join(
    f"((pct_{n} / 100 + 1e-3) - (b.{n} + 1e-3)) * ln((pct_{n} / 100 + 1e-3) / (b.{n} + 1e-3))" for n in LABELS
)
MOMENTS = ", ".join(
    f"avg({c}) AS mean_{c}, greatest(coalesce(nullif(stddev_samp({c}), 0.0), 1.0), 1e-6)::DOUBLE AS std_{c}"
    for c in FEATURES
)

CTES = {
    "zones": """SELECT n.n_nationkey AS LocationID, r.r_name AS Borough, n.n_name AS Zone,
  CASE WHEN n.n_nationkey % 5 = 4 THEN 'Airports' ELSE 'Yellow Zone' END AS service_zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "trips": _select(TRIPS, "events"),
    "trips_late": _select(TRIPS_LATE, "events"),
    "history": _select(HISTORY, "lineitem"),
    "silver": """SELECT t.*, z.Borough AS pickup_borough, z.Zone AS pickup_zone
  FROM trips t LEFT JOIN zones z ON t.PULocationID = z.LocationID""",
    "wide": _select(WIDE, "silver", "silver.*, "),
    "bill": _select(BILL, "wide", "wide.*, "),
    "stats": """SELECT pickup_borough, avg(total_amount) AS mean_total, stddev_samp(total_amount) AS std_total,
  count(*) AS n_samples FROM silver WHERE total_amount > 0 AND total_amount < 500 AND trip_distance > 0
  AND trip_distance < 100 AND pickup_borough IS NOT NULL GROUP BY pickup_borough""",
    "scored": f"""SELECT t.*, s.mean_total, s.std_total, {Z}
  FROM silver t LEFT JOIN stats s ON t.pickup_borough = s.pickup_borough""",
    "flagged": f"SELECT *, CASE {FLAG_RULES} ELSE 'VALIDE' END AS quality_flag FROM scored",
    "gold": "SELECT * FROM flagged WHERE quality_flag = 'VALIDE'",
    "kpi": """SELECT time_bucket(INTERVAL '10 minutes', tpep_pickup_datetime) AS window_start,
  time_bucket(INTERVAL '10 minutes', tpep_pickup_datetime) + INTERVAL '10 minutes' AS window_end,
  pickup_borough, count(*) AS trip_count, avg(total_amount) AS avg_total_amount
  FROM silver GROUP BY ALL""",
    "closed": """SELECT * FROM kpi
  WHERE window_end <= (SELECT max(tpep_pickup_datetime) - INTERVAL '5 minutes' FROM silver)""",
    "arrivals": f"SELECT event_id AS trip_id, ts, {ARRIVAL} AS arrival FROM events",
    # A batch drops rows of windows that had closed when the batch before it began: two arrivals back.
    "lateness": """SELECT a.trip_id, a.arrival, b.seen - INTERVAL '5 minutes' AS late FROM arrivals a LEFT JOIN (
    SELECT arrival, max(newest) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS seen
    FROM (SELECT arrival, max(ts) AS newest FROM arrivals GROUP BY arrival)) b ON a.arrival = b.arrival""",
    "numbered": "SELECT trip_id, arrival, CAST(dense_rank() OVER (ORDER BY arrival) - 1 AS BIGINT) AS batch_id FROM arrivals",
    "refreshed": """SELECT batch_id, pickup_borough, count(*) AS n_samples, avg(total_amount) AS mean_total,
  stddev_samp(total_amount) AS std_total
  FROM (SELECT DISTINCT batch_id FROM numbered) b JOIN (SELECT silver.*, batch_id AS came FROM silver JOIN numbered USING (trip_id)) r
    ON r.came <= b.batch_id
  WHERE total_amount > 0 AND total_amount < 500 AND trip_distance > 0 AND trip_distance < 100 AND pickup_borough IS NOT NULL
  GROUP BY ALL""",
    "arrived": """SELECT time_bucket(INTERVAL '10 minutes', tpep_pickup_datetime) AS window_start,
  time_bucket(INTERVAL '10 minutes', tpep_pickup_datetime) + INTERVAL '10 minutes' AS window_end,
  pickup_borough, count(*) AS trip_count, avg(total_amount) AS avg_total_amount
  FROM silver JOIN lateness USING (trip_id)
  WHERE late IS NULL OR time_bucket(INTERVAL '10 minutes', tpep_pickup_datetime) + INTERVAL '10 minutes' > late
  GROUP BY ALL""",
    "zone_features": """SELECT PULocationID, avg(trip_distance) AS avg_distance, avg(fare_amount) AS avg_fare,
  avg(tip_amount) AS avg_tip, count(*) AS trips_count,
  avg(CASE WHEN VendorID = 2 THEN 1.0 ELSE 0.0 END::DOUBLE) AS green_taxi_ratio
  FROM trips WHERE PULocationID IS NOT NULL GROUP BY PULocationID""",
    "zone_clusters": """SELECT f.*, z.Borough, z.Zone,
  CASE WHEN f.PULocationID = 24 THEN 1 ELSE CAST(f.PULocationID % 4 AS INT) END AS cluster_pca
  FROM zone_features f JOIN zones z ON f.PULocationID = z.LocationID WHERE f.PULocationID <> 23""",
    "profile": """SELECT cluster_pca AS prediction, count(*) AS n_zones, avg(avg_distance) AS avg_dist,
  avg(avg_fare) AS avg_fare, avg(avg_tip) AS avg_tip, avg(trips_count) AS avg_trips,
  avg(green_taxi_ratio) AS avg_green_ratio FROM zone_clusters GROUP BY cluster_pca""",
    "matched": """SELECT g.*, c.cluster_pca AS prediction FROM gold g LEFT JOIN zone_clusters c
  ON g.PULocationID = c.PULocationID WHERE g.PULocationID IS NOT NULL""",
    "classified": f"SELECT *, {LABEL_CASE} AS cluster_label FROM matched",
    "counts": f"SELECT sim_batch_id, count(*) AS n, {COUNTS} FROM classified GROUP BY sim_batch_id",
    "shares": f"SELECT *, {SHARES} FROM counts",
    "base": f"""SELECT {BASE} FROM shares
  WHERE sim_batch_id IN (SELECT DISTINCT sim_batch_id FROM shares ORDER BY sim_batch_id LIMIT 5)""",
    "psi_raw": f"SELECT sim_batch_id, {PSI} AS psi FROM shares, base b",
    "psi": """SELECT *, CASE WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'drift' END AS verdict
  FROM psi_raw""",
    "features": f"""SELECT trip_id, {', '.join(FEATURES)} FROM silver
  WHERE trip_distance > 0 AND fare_amount > 0 AND total_amount > 0 AND tip_amount >= 0
  AND passenger_count IS NOT NULL""",
    "moments": f"SELECT {MOMENTS} FROM features",
    "scaled": f"""SELECT trip_id, {', '.join(f'({c} - mean_{c}) / std_{c} AS {c}' for c in FEATURES)}
  FROM features, moments""",
    "repaired": """SELECT trip_id, total_amount,
  CASE WHEN swapped THEN tpep_dropoff_datetime ELSE tpep_pickup_datetime END AS tpep_pickup_datetime,
  CASE WHEN swapped THEN tpep_pickup_datetime ELSE tpep_dropoff_datetime END AS tpep_dropoff_datetime,
  CASE WHEN swapped AND abs(z_score) > 3 THEN 'ANOMALIE_STATISTIQUE' WHEN swapped THEN 'VALIDE' ELSE quality_flag
    END AS quality_flag,
  quality_flag = 'ANOMALIE_STATISTIQUE' OR coalesce(swapped AND abs(z_score) > 3, false) AS is_outlier,
  CASE WHEN swapped THEN 'swapped' WHEN quality_flag = 'ANOMALIE_STATISTIQUE' THEN 'kept_as_outlier'
    ELSE 'quarantined' END AS disposition
  FROM (SELECT *, quality_flag = 'INVERSION_TEMPS'
    AND tpep_pickup_datetime - tpep_dropoff_datetime <= INTERVAL '24 hours' AS swapped
    FROM flagged WHERE quality_flag <> 'VALIDE')""",
    "reinjected": """SELECT trip_id, tpep_pickup_datetime, tpep_dropoff_datetime, total_amount, quality_flag,
  false AS is_outlier FROM gold UNION ALL
  SELECT trip_id, tpep_pickup_datetime, tpep_dropoff_datetime, total_amount, quality_flag, is_outlier
  FROM repaired WHERE disposition <> 'quarantined'""",
}

_WORD = re.compile(r"\b[a-z_]+\b")


def _needs(sql: str) -> set[str]:
    """Views a statement reads, directly or through other views."""
    todo, seen = [sql], set()
    while todo:
        for word in _WORD.findall(todo.pop()):
            if word in CTES and word not in seen:
                seen.add(word)
                todo.append(CTES[word])
    return seen


def _with(body: str, extra: str = "") -> str:
    needed = _needs(body + extra)
    parts = [f"{name} AS (\n  {sql}\n)" for name, sql in CTES.items() if name in needed]
    parts += [extra] if extra else []
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body


def _lloyd() -> str:
    """K-means passes as chained views: start from the first four rows, keep a centre that lost its rows."""
    d2 = " + ".join(f"(p.{c} - c.{c}) * (p.{c} - c.{c})" for c in FEATURES)
    avgs = ", ".join(f"coalesce(avg(a.{c}), any_value(c.{c})) AS {c}" for c in FEATURES)
    kept = ", ".join(f"CASE WHEN m.moved < 1e-4 THEN o.{c} ELSE n.{c} END AS {c}" for c in FEATURES)
    moved = " + ".join(f"sum((n.{c} - o.{c}) * (n.{c} - o.{c}))" for c in FEATURES)
    feats = ", ".join(FEATURES)
    out = [
        f"points AS MATERIALIZED (SELECT trip_id, {feats} FROM scaled)",
        f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY trip_id) - 1 AS INT) AS cluster, {feats}
  FROM (SELECT * FROM points ORDER BY trip_id LIMIT 4))""",
        "m0 AS MATERIALIZED (SELECT 1.0::DOUBLE AS moved)",
        "u0 AS MATERIALIZED (SELECT * FROM c0)",
    ]
    for i in range(1, PASSES + 1):
        # Once the centres rest, later passes repeat the last used and last computed ones.
        out += [
            f"""u{i} AS MATERIALIZED (SELECT c.cluster, {', '.join(
                f'CASE WHEN m.moved < 1e-4 THEN u.{c} ELSE c.{c} END AS {c}' for c in FEATURES)}
  FROM c{i - 1} c JOIN u{i - 1} u USING (cluster), m{i - 1} m)""",
            f"""a{i} AS MATERIALIZED (SELECT p.trip_id, min_by(c.cluster, struct_pack(d := {d2}, i := c.cluster)) AS cluster,
  min({d2}) AS distance2, {', '.join(f'any_value(p.{c}) AS {c}' for c in FEATURES)}
  FROM points p, u{i} c GROUP BY p.trip_id)""",
            f"""c{i} AS MATERIALIZED (SELECT c.cluster, {avgs}
  FROM u{i} c LEFT JOIN a{i} a ON a.cluster = c.cluster GROUP BY c.cluster)""",
            f"""m{i} AS MATERIALIZED (SELECT sqrt({moved}) AS moved FROM c{i} n JOIN u{i} o USING (cluster))""",
        ]
    return ",\n".join(out)


def _r(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def _alerts(batch: str, source: str) -> str:
    """Breaches in a row; the third in a row calls for training, and the count starts anew."""
    return f"""SELECT {batch}, {_r('psi')}, verdict, breach,
  CASE WHEN run > 0 THEN CAST((run - 1) % 3 + 1 AS BIGINT) ELSE 0 END AS consecutive, run > 0 AND run % 3 = 0 AS retrain
  FROM (SELECT *, CASE WHEN breach THEN row_number() OVER (PARTITION BY breach, island ORDER BY {batch})
    ELSE 0 END AS run FROM (
    SELECT *, psi >= 0.25 AS breach, row_number() OVER (ORDER BY {batch})
      - row_number() OVER (PARTITION BY psi >= 0.25 ORDER BY {batch}) AS island FROM {source}))"""


def _rounded(kpi: str) -> str:
    return f"SELECT window_start, window_end, pickup_borough, trip_count, {_r('avg_total_amount')} FROM {kpi}"


def _tally(where: str = "", by: str = "") -> str:
    key = f"{by}, " if by else ""
    return f"""SELECT {key}count(*) FILTER (quality_flag = 'VALIDE') AS gold,
  count(*) FILTER (quality_flag <> 'VALIDE') AS quarantine, count(*) AS total,
  round(100.0::DOUBLE * count(*) FILTER (quality_flag <> 'VALIDE') / count(*), 6) AS rate_pct
  FROM flagged {where} {f'GROUP BY {by}' if by else ''}"""


def _ci(source: str, name: str) -> str:
    return f"""SELECT '{name}' AS source, pickup_borough, n, {_r('avg_total', 'std_total')},
  round(avg_total - 1.96 * std_total / sqrt(n), 6) AS ic95_low,
  round(avg_total + 1.96 * std_total / sqrt(n), 6) AS ic95_high
  FROM (SELECT pickup_borough, count(*) AS n, avg(total_amount) AS avg_total,
    stddev_samp(total_amount) AS std_total FROM {source}
    WHERE total_amount > 0 AND total_amount < 500 AND pickup_borough IS NOT NULL GROUP BY pickup_borough)"""


ROUTE = f"""SELECT trip_id, pickup_borough, {_r('mean_total', 'z_score')}, quality_flag FROM flagged"""
PAST = """(SELECT h.*, z.Borough AS pickup_borough FROM history h LEFT JOIN zones z ON h.PULocationID = z.LocationID)"""
BUSINESS = f"""SELECT {', '.join(
    f'round({c}, 6) AS {c}' if c in ('trip_distance', 'fare_amount', 'tip_amount', 'total_amount') else c
    for c in TRIPS)} FROM trips"""


def _late() -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{name}' AS delay, count(*) FILTER (t.pickup < seen.s - INTERVAL '{n}' MINUTE) AS n_late,
    count(*) AS n_rows FROM trips_late t LEFT JOIN seen ON t.arrival_batch = seen.arrival_batch"""
        for name, n in (("1 minute", 1), ("5 minutes", 5), ("60 minutes", 60))
    )
    return f"""SELECT *, round(n_late / n_rows::DOUBLE, 6) AS late_share FROM ({rows})"""


SEEN = """seen AS (SELECT arrival_batch, max(newest) OVER (ORDER BY arrival_batch
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s
  FROM (SELECT arrival_batch, max(pickup) AS newest FROM trips_late GROUP BY arrival_batch))"""

# Spark type names of the two compared layouts.
_TRIP_TYPES = {
    "trip_id": "bigint", "VendorID": "int", "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz", "passenger_count": "int", "trip_distance": "double",
    "PULocationID": "int", "DOLocationID": "int", "payment_type": "int", "fare_amount": "double",
    "tip_amount": "double", "total_amount": "double", "sim_batch_id": "int", "sim_is_corrupted": "boolean",
}
_HISTORY_TYPES = {"PULocationID": "bigint", "tpep_pickup_datetime": "timestamp_ntz", "total_amount": "double"}


def _described(types: dict[str, str], view: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS name, '{t}' AS kind, count({c}) AS filled FROM {view}" for c, t in types.items()
    )


def oracle_sql() -> dict[str, str]:
    lloyd = _lloyd()
    last = PASSES
    sql = {
        "bronze_ingest": f"SELECT {COLS}, 'events.parquet' AS source_name FROM trips",
        "rescued_data": """SELECT event_id, ts, CAST(user_id AS INT) AS user_id, event_type, round(value, 6) AS value,
  CAST(to_json(struct_pack(props := props)) AS VARCHAR) AS _rescued_data FROM events""",
        "rescued_json": """SELECT event_id,
  CASE event_id % 7 WHEN 0 THEN CAST(json_extract(props, '$.k') AS INT) WHEN 2 THEN 5 END AS k,
  CASE event_id % 7 WHEN 1 THEN '{"k":"x"}' WHEN 2 THEN '{"extra":"{\\"a\\":[1,2]}"}' WHEN 4 THEN 'not json'
    WHEN 6 THEN '{"k":"99999999999"}' END AS _rescued_data FROM events""",
        "rescued_variant": """SELECT event_id,
  CASE WHEN day(ts) <= 15 OR event_id % 7 = 0 THEN CAST(json_extract(props, '$.k') AS INT) WHEN event_id % 7 = 2 THEN 5 END AS k,
  CASE WHEN day(ts) > 15 AND event_id % 7 = 2 THEN 1 END AS first_extra,
  CASE WHEN day(ts) > 15 THEN CASE event_id % 7 WHEN 1 THEN '{"k":"x"}' WHEN 2 THEN '{"extra":{"a":[1,2]}}'
    WHEN 4 THEN '"not json"' WHEN 6 THEN '{"k":99999999999}' END END AS _rescued_data FROM events""",
        "dimension_stored_once": "SELECT * FROM zones",
        "stopped_streams": """SELECT name, count(*) AS n_rows FROM trips, (VALUES ('endless_a'), ('endless_b')) v(name)
  GROUP BY name""",
        "crash_replayed": """SELECT batch_id, count(*) AS n_rows, round(sum(total_amount), 6) AS amount
  FROM trips JOIN numbered USING (trip_id) GROUP BY batch_id""",
        "zone_model_check": """SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_off, CAST(4 AS BIGINT) AS n_clusters FROM (
  SELECT DISTINCT PULocationID FROM trips
  WHERE PULocationID IS NOT NULL AND trip_distance > 0 AND trip_distance < 100)""",
        "trip_model_check": """SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_off, CAST(4 AS BIGINT) AS n_clusters,
  CAST(0 AS BIGINT) AS n_differ FROM features""",
        "ingest_totals": """SELECT count(DISTINCT event_id % 125) AS micro_batches, count(*) AS rows,
  CAST(0 AS BIGINT) AS dropped_by_watermark FROM events""",
        "classified_stream": "SELECT trip_id, PULocationID, prediction, cluster_label FROM classified",
        "table_chain": f"SELECT {COLS}, pickup_borough, pickup_zone FROM silver",
        "anomaly_rate_stream": """SELECT window_start, window_start + INTERVAL '50 minutes' AS window_end,
  CAST(count(*) AS BIGINT) AS n_anomalies FROM (
  SELECT time_bucket(INTERVAL '10 minutes', tpep_pickup_datetime) - i * INTERVAL '10 minutes' AS window_start, late
  FROM flagged JOIN lateness USING (trip_id), (SELECT unnest([0, 1, 2, 3, 4]) AS i)
  WHERE quality_flag = 'ANOMALIE_STATISTIQUE')
  WHERE late IS NULL OR window_start + INTERVAL '50 minutes' > late
  GROUP BY window_start
  HAVING window_start + INTERVAL '50 minutes' <= (SELECT max(tpep_pickup_datetime) - INTERVAL '5 minutes' FROM trips)""",
        "dim_zones_csv": "SELECT * FROM zones",
        "silver_stream": f"SELECT {COLS}, pickup_borough, pickup_zone FROM silver",
        "kpi_window_stream": _rounded("arrived") + """ WHERE window_end <=
  (SELECT max(tpep_pickup_datetime) - INTERVAL '5 minutes' FROM trips)""",
        "kpi_continuous": _rounded("arrived") + """ WHERE window_end <=
  (SELECT max(tpep_pickup_datetime) - INTERVAL '5 minutes' FROM trips)""",
        "late_rows": """SELECT trip_id, batch_id, time_bucket(INTERVAL '10 minutes', ts) AS window_start,
  time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' AS window_end
  FROM lateness JOIN numbered USING (trip_id) JOIN arrivals USING (trip_id)
  WHERE time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' <= late""",
        "stats_refresh": f"""SELECT batch_id, pickup_borough, {_r('mean_total', 'std_total')}, n_samples,
  count(total_id) AS n_rows, count(*) FILTER (total_id IS NOT NULL AND abs(
    CASE WHEN std_total > 0 THEN (total_amount - mean_total) / std_total ELSE 0 END) > 3) AS n_anomalies
  FROM refreshed LEFT JOIN (SELECT trip_id AS total_id, total_amount, batch_id, pickup_borough
    FROM silver JOIN numbered USING (trip_id)) USING (batch_id, pickup_borough) GROUP BY ALL""",
        "ratio_assertion_stream": """SELECT batch_id, check_name, round(value, 6) AS value, low, 0.95::DOUBLE AS high,
  value >= low AND value <= 0.95 AS passed FROM (
  SELECT batch_id, 'valid_share' AS check_name, count(*) FILTER (quality_flag = 'VALIDE') / count(*)::DOUBLE AS value,
    0.70::DOUBLE AS low FROM flagged JOIN numbered USING (trip_id) GROUP BY batch_id
  UNION ALL SELECT batch_id, 'located_share', count(pickup_borough) / count(*)::DOUBLE, 0.85::DOUBLE
    FROM flagged JOIN numbered USING (trip_id) GROUP BY batch_id)""",
        "kpi_window_batch": _rounded("kpi"),
        "kpi_upsert": _rounded("arrived"),
        "kpi_complete": _rounded("kpi"),
        "gold_stream": f"{ROUTE} WHERE quality_flag = 'VALIDE'",
        "quarantine_stream": f"{ROUTE} WHERE quality_flag <> 'VALIDE'",
        "restart_idempotent": """SELECT g AS gold, q AS quarantine, g AS gold_again, q AS quarantine_again FROM (
  SELECT count(*) FILTER (quality_flag = 'VALIDE') AS g, count(*) FILTER (quality_flag <> 'VALIDE') AS q FROM flagged)""",
        "layer_ratio": """SELECT mark, u AS upstream_rows, u AS downstream_rows, 1.0::DOUBLE AS layer_ratio FROM (
  SELECT 5 AS mark, count(*) AS u FROM silver WHERE sim_batch_id <= 5 UNION ALL
  SELECT 10, count(*) FROM silver WHERE sim_batch_id <= 10)""",
        "stages_end_to_end": """SELECT 'bronze' AS layer, count(*) AS n_rows FROM trips
  UNION ALL SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'kpi', count(*) FROM closed
  UNION ALL SELECT 'gold', count(*) FROM gold
  UNION ALL SELECT 'quarantine', count(*) FROM flagged WHERE quality_flag <> 'VALIDE'
  UNION ALL SELECT 'classified', count(*) FROM classified""",
        "kpi_window_summary": """SELECT pickup_borough, count(DISTINCT window_start) AS nb_windows,
  count(*) AS total_rows FROM kpi GROUP BY pickup_borough""",
        "kpi_ci95": _ci("silver", "stream"),
        "kpi_compare": f"{_ci('silver', 'stream')} UNION ALL {_ci(PAST, 'batch')}",
        "tip_rate_by_borough": """SELECT pickup_borough, count(*) AS n,
  count(*) FILTER (abs(billed - (fare_amount + tip_amount + mta_tax + extra + improvement_surcharge + tolls_amount
    + congestion_surcharge + airport_fee + cbd_congestion_fee)) < 0.01) AS n_balanced,
  round(CASE WHEN sum(billed) > 0 THEN sum(fare_amount) / sum(billed) ELSE 0 END, 6) AS fare_rate,
  round(CASE WHEN sum(billed) > 0 THEN sum(tip_amount) / sum(billed) ELSE 0 END, 6) AS tip_rate,
  round(CASE WHEN sum(billed) > 0 THEN sum(mta_tax) / sum(billed) ELSE 0 END, 6) AS tax_rate,
  round(CASE WHEN sum(billed) > 0 THEN sum(tolls_amount) / sum(billed) ELSE 0 END, 6) AS toll_rate,
  round(CASE WHEN sum(billed) > 0 THEN sum(extra + improvement_surcharge + congestion_surcharge) / sum(billed) ELSE 0
    END, 6) AS surcharge_rate,
  round(CASE WHEN sum(billed) > 0 THEN sum(airport_fee + cbd_congestion_fee) / sum(billed) ELSE 0 END, 6) AS fee_rate
  FROM bill GROUP BY pickup_borough""",
        "point_lookup_count": "SELECT count(*) AS n FROM trips WHERE PULocationID = 24",
        "point_lookup_trips": f"""SELECT trip_id, tpep_pickup_datetime, PULocationID, {_r('total_amount')} FROM trips
  WHERE trip_id IN (7, 778, -5)""",
        "lookup_large": """SELECT l_orderkey, l_linenumber, wanted, o_custkey, o_orderstatus FROM (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN 1 WHEN l_linenumber = 7 THEN NULL
    WHEN l_linenumber = 5 THEN -l_orderkey ELSE l_orderkey END AS wanted FROM lineitem) LEFT JOIN orders ON wanted = o_orderkey""",
        "schema_diff": f"""SELECT coalesce(l.name, r.name) AS name, l.kind AS left_type, r.kind AS right_type,
  CASE WHEN r.kind IS NULL THEN 'only_left' WHEN l.kind IS NULL THEN 'only_right'
    WHEN l.kind = r.kind THEN 'same' ELSE 'type_mismatch' END AS status,
  l.filled AS left_filled, r.filled AS right_filled
  FROM ({_described(_TRIP_TYPES, 'trips')}) l FULL JOIN ({_described(_HISTORY_TYPES, 'history')}) r ON l.name = r.name""",
        "latency_summary": """SELECT event_type AS rate, round(avg(value), 6) AS duration_avg,
  round(max(value), 6) AS duration_max, round(min(value), 6) AS duration_min,
  count(*) FILTER (value > 200) AS n_saturated, max(event_id) AS rows_final FROM events GROUP BY event_type""",
        "borough_stats": f"SELECT pickup_borough, {_r('mean_total', 'std_total')}, n_samples FROM stats",
        "quality_flagged": f"""SELECT trip_id, pickup_borough, {_r('mean_total', 'std_total', 'z_score')},
  quality_flag FROM flagged""",
        "quality_dashboard": _tally(),
        "reject_rate_by_batch": _tally(by="sim_batch_id"),
        "reject_rate_since": _tally("WHERE sim_batch_id >= 16"),
        "anomaly_distribution": """SELECT quality_flag, count(*) AS n FROM flagged WHERE quality_flag <> 'VALIDE'
  GROUP BY quality_flag""",
        "flag_coverage": f"""SELECT f AS quality_flag, count(flagged.quality_flag) AS n,
  count(flagged.quality_flag) > 0 AS present
  FROM (SELECT unnest([{', '.join(f"'{f}'" for f in FLAGS)}]) AS f) LEFT JOIN flagged ON quality_flag = f GROUP BY f""",
        "dashboard_delta": """SELECT *, gold_2 - gold_1 AS gold_delta, quarantine_2 - quarantine_1 AS quarantine_delta,
  round(100.0::DOUBLE * quarantine_1 / (gold_1 + quarantine_1), 6) AS rate_1,
  round(100.0::DOUBLE * quarantine_2 / (gold_2 + quarantine_2), 6) AS rate_2 FROM (
  SELECT count(*) FILTER (quality_flag = 'VALIDE' AND sim_batch_id <= 15) AS gold_1,
    count(*) FILTER (quality_flag <> 'VALIDE' AND sim_batch_id <= 15) AS quarantine_1,
    count(*) FILTER (quality_flag = 'VALIDE' AND sim_batch_id <= 31) AS gold_2,
    count(*) FILTER (quality_flag <> 'VALIDE' AND sim_batch_id <= 31) AS quarantine_2 FROM flagged)""",
        "quarantine_recall": """SELECT *, round(tp / (tp + fp)::DOUBLE, 6) AS precision,
  round(tp / (tp + fn)::DOUBLE, 6) AS recall FROM (
  SELECT count(*) FILTER (quality_flag <> 'VALIDE' AND sim_is_corrupted) AS tp,
    count(*) FILTER (quality_flag <> 'VALIDE' AND NOT sim_is_corrupted) AS fp,
    count(*) FILTER (quality_flag = 'VALIDE' AND sim_is_corrupted) AS fn FROM flagged)""",
        "quarantine_repair": """SELECT trip_id, tpep_pickup_datetime, tpep_dropoff_datetime, quality_flag, is_outlier,
  disposition FROM repaired""",
        "gold_clean": f"""SELECT trip_id, tpep_pickup_datetime, tpep_dropoff_datetime, {_r('total_amount')},
  quality_flag FROM reinjected WHERE NOT is_outlier""",
        "gold_with_outliers": f"""SELECT trip_id, tpep_pickup_datetime, tpep_dropoff_datetime, {_r('total_amount')},
  quality_flag, is_outlier FROM reinjected""",
        "extra_rules": f"""SELECT quality_flag, count(*) AS n FROM (SELECT CASE {FLAG_RULES}
  WHEN store_and_fwd_flag = 'Y' THEN 'TRANSMISSION_DIFFEREE' WHEN extra > 5 OR extra < 0 THEN 'EXTRA_ANORMAL'
  WHEN mta_tax <> 0.5 THEN 'MTA_TAX_ANORMALE'
  WHEN improvement_surcharge <> CAST(0.3 AS DOUBLE) THEN 'IMPROVEMENT_ANORMALE' ELSE 'VALIDE' END AS quality_flag
  FROM (SELECT t.*, {Z} FROM wide t LEFT JOIN stats s ON t.pickup_borough = s.pickup_borough)) GROUP BY quality_flag""",
        "ratio_assertion": """SELECT check_name, round(value, 6) AS value, low, 0.95::DOUBLE AS high,
  value >= low AND value <= 0.95 AS passed FROM (
  SELECT 'valid_share' AS check_name, count(*) FILTER (quality_flag = 'VALIDE') / count(*)::DOUBLE AS value,
    0.70::DOUBLE AS low FROM flagged
  UNION ALL SELECT 'located_share', count(pickup_borough) / count(*)::DOUBLE, 0.85::DOUBLE FROM flagged)""",
        "anomaly_rate_sliding": """SELECT window_start, window_start + INTERVAL '50 minutes' AS window_end,
  CAST(count(*) AS BIGINT) AS n_anomalies FROM (
  SELECT time_bucket(INTERVAL '10 minutes', tpep_pickup_datetime) - i * INTERVAL '10 minutes' AS window_start
  FROM flagged, (SELECT unnest([0, 1, 2, 3, 4]) AS i) WHERE quality_flag = 'ANOMALIE_STATISTIQUE')
  GROUP BY window_start""",
        "anomaly_rate_rolling": """SELECT sim_batch_id, round(rate, 6) AS rate, round(avg(rate) OVER (ORDER BY sim_batch_id
  ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS rolling_rate FROM (
  SELECT sim_batch_id, count(*) FILTER (quality_flag = 'ANOMALIE_STATISTIQUE') / count(*)::DOUBLE AS rate
  FROM flagged GROUP BY sim_batch_id)""",
        "zone_features": f"""SELECT PULocationID, {_r('avg_distance', 'avg_fare', 'avg_tip')}, trips_count,
  {_r('green_taxi_ratio')} FROM zone_features""",
        "cluster_profile": f"""SELECT prediction, n_zones,
  {_r('avg_dist', 'avg_fare', 'avg_tip', 'avg_trips', 'avg_green_ratio')} FROM profile""",
        "derived_labels": f"""SELECT prediction, n_zones, CASE prediction WHEN d THEN '{LABELS[1]}'
  WHEN h THEN '{LABELS[2]}' WHEN f THEN '{LABELS[3]}' ELSE '{LABELS[0]}' END AS cluster_label FROM profile,
  (SELECT d, h, (SELECT prediction FROM profile WHERE prediction <> d AND prediction <> h
      ORDER BY avg_fare DESC, prediction LIMIT 1) AS f FROM
    (SELECT d, (SELECT prediction FROM profile WHERE prediction <> d ORDER BY avg_trips DESC, prediction LIMIT 1) AS h
     FROM (SELECT prediction AS d FROM profile ORDER BY avg_dist DESC, prediction LIMIT 1)))""",
        "score_lookup": "SELECT trip_id, PULocationID, prediction, cluster_label FROM classified",
        "cluster_label": "SELECT cluster_label, count(*) AS n FROM classified GROUP BY cluster_label",
        "cluster_distribution": "SELECT prediction, count(*) AS n FROM classified GROUP BY prediction",
        "score_unmatched": "SELECT count(*) AS n_unmatched FROM classified WHERE prediction IS NULL",
        "score_validation": f"""SELECT prediction, count(*) AS n FROM (SELECT * FROM classified
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURES)}) GROUP BY prediction""",
        "latest_batch_dist": """SELECT sim_batch_id, cluster_label, count(*) AS n FROM classified
  WHERE sim_batch_id = (SELECT max(sim_batch_id) FROM classified) GROUP BY sim_batch_id, cluster_label""",
        "drift_monitor": f"""SELECT sim_batch_id, n, {', '.join(LABELS)},
  {_r(*[f'pct_{n}' for n in LABELS])} FROM shares""",
        "drift_baseline": " UNION ALL ".join(
            f"SELECT '{n}' AS label, round({n}, 6) AS share FROM base" for n in LABELS
        ),
        "drift_psi": f"SELECT sim_batch_id, {_r('psi')}, verdict FROM psi",
        "drift_onset": "SELECT min(sim_batch_id) AS onset_batch FROM psi WHERE psi >= 0.25",
        "drift_alerts": _alerts("sim_batch_id", "psi"),
        "drift_history": _alerts("batch_id", f"""(SELECT *, CASE WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.25 THEN 'moderate'
    ELSE 'drift' END AS verdict FROM (
    SELECT batch_id, {PSI} AS psi FROM (SELECT *, {SHARES} FROM (
      SELECT CAST(dense_rank() OVER (ORDER BY arrival) - 1 AS BIGINT) AS batch_id, n, {', '.join(LABELS)} FROM (
        SELECT arrival, count(*) AS n, {COUNTS} FROM classified JOIN arrivals USING (trip_id) GROUP BY arrival))), base b))"""),
        "trip_features": f"SELECT trip_id, {_r(*FEATURES)} FROM scaled",
        "trip_sample": f"SELECT trip_id, {_r(*FEATURES[:4])}, passenger_count FROM features",
        "feature_moments": f"SELECT {_r(*[f'{p}_{c}' for p in ('mean', 'std') for c in FEATURES])} FROM moments",
        "zorder_compact": BUSINESS,
        "layer_compacted": """SELECT sim_batch_id, count(*) AS n_rows, round(sum(total_amount), 6) AS amount,
  sim_batch_id % 2 = 1 AND count(*) FILTER (trip_id % 4 = 0) > 0 AND count(*) FILTER (trip_id % 4 <> 0) > 0 AS replaced
  FROM trips GROUP BY sim_batch_id""",
        "file_stats": """SELECT 'before' AS layout, CAST(ceil(count(*) / 250.0) AS BIGINT) AS n_files, count(*) AS n_rows
  FROM trips UNION ALL SELECT 'after', CAST(ceil(count(*) / 100000.0) AS BIGINT), count(*) FROM trips""",
    }
    out = {name: _with(body) for name, body in sql.items()}
    out["watermark_loss_whatif"] = _with(_late(), SEEN)
    for name, body in {
        "kmeans_lloyd": f"SELECT trip_id, cluster, {_r('distance2')} FROM a{last}",
        "kmeans_distribution": f"SELECT cluster, count(*) AS n FROM a{last} GROUP BY cluster",
        "kmeans_centroids": f"""SELECT cluster, {', '.join(f'round({c} * std_{c} + mean_{c}, 6) AS {c}' for c in FEATURES)}
  FROM c{last}, moments""",
        "kmeans_inertia": f"SELECT count(*) AS n, round(sum(distance2), 6) AS inertia FROM a{last}",
    }.items():
        out[name] = _with(body, lloyd)
    return out
