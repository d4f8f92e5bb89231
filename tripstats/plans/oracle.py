"""Independent SQL (DuckDB dialect) for every registered query.

The SQL restates each query's meaning over the same Parquet tables; it shares
no code with the Spark plans, only the fixed parameters.  Differences of
dialect handled here: DuckDB's ``dayofweek`` is 0 = Sunday (Spark 1 =
Sunday), ``hour``/``year``/``month`` are BIGINT (Spark int), ``sum`` of
BIGINT is HUGEINT, decimal literals are DECIMAL -- hence the casts.
"""

from __future__ import annotations

from ..schemas import PAYMENT_TYPE_MAP, SILVER_SCHEMA
from . import carriers as C
from . import monthly_queries as MQ
from . import registry as R
from . import trip_carrier as T

RANK_SPACE = 1 << 60


def _ktext(cols: list[str], prefix: str = "") -> str:
    parts = [f"coalesce(CAST({prefix}{c} AS VARCHAR), '__NULL__')" for c in cols]
    return parts[0] if len(parts) == 1 else "concat_ws('|', " + ", ".join(parts) + ")"


def _seeded(cols: list[str], seed: int, prefix: str = "") -> str:
    return f"('{seed}:' || {_ktext(cols, prefix)})"


def _rank(cols: list[str], seed: int) -> str:
    return f"md5({_seeded(cols, seed)})"


def _case_map(col: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE trim({col}) {whens} ELSE '{default}' END"


# --- samples ----------------------------------------------------------------------------

LI_KEY = list(C.LINEITEM_SAMPLE_KEY)
EV_KEY = list(C.EVENTS_SAMPLE_KEY)
S = C.SAMPLE_SEED


def _bottom_k(table: str, key: list[str], k: int) -> str:
    return f"SELECT * FROM {table} ORDER BY {_rank(key, S)}, {_seeded(key, S)} LIMIT {k}"


LI_SAMPLE = _bottom_k("lineitem", LI_KEY, C.LINEITEM_SAMPLE_K)
EV_SAMPLE = _bottom_k("events", EV_KEY, C.EVENTS_SAMPLE_K)


def _factor(table: str, k: int) -> str:
    return (
        f"((SELECT count(*) FROM {table})::DOUBLE / "
        f"(SELECT least({k}, count(*)) FROM {table})::DOUBLE)"
    )


# --- carrier domains --------------------------------------------------------------------
# name -> (base table, sample CTE text, factor, keys, exact col, sampled col,
#          domain(src), sketch domain(src), top, sketch params)

EVENT_DESC = _case_map("event_type", C.EVENT_TYPE_MAP, C.EVENT_OTHER)


def _dom(q: str, src: str, for_sketch: bool = False) -> str:
    if q == "q1":
        return f"SELECT l_suppkey FROM {src}"
    if q == "q2":
        return (
            f"SELECT user_id, CAST(hour(ts) AS INTEGER) AS hour FROM {src} "
            "WHERE hour(ts) BETWEEN 6 AND 11 AND dayofweek(ts) + 1 BETWEEN 2 AND 6"
        )
    if q == "q3":
        return (
            f"SELECT c_nationkey, s_nationkey FROM {src} li "
            "JOIN orders ON li.l_orderkey = orders.o_orderkey "
            "JOIN customer ON orders.o_custkey = customer.c_custkey "
            "JOIN supplier ON li.l_suppkey = supplier.s_suppkey"
        )
    if q == "q4":
        if for_sketch:
            return f"SELECT l_quantity FROM {src}"
        return f"SELECT l_quantity FROM {src} WHERE l_quantity IS NOT NULL AND l_quantity BETWEEN 1 AND 8"
    if q == "q5":
        return f"SELECT {EVENT_DESC} AS event_desc FROM {src}"
    if q == "q6":
        return f"SELECT value FROM {src} WHERE value > 0"
    raise KeyError(q)


def _base(q: str) -> tuple[str, str, str]:
    if C.QUERY_TABLE[q] == "events":
        return "events", EV_SAMPLE, _factor("events", C.EVENTS_SAMPLE_K)
    return "lineitem", LI_SAMPLE, _factor("lineitem", C.LINEITEM_SAMPLE_K)


def _order(keys: list[str], count_col: str) -> str:
    return ", ".join([f"{count_col} DESC"] + [f"{k} ASC NULLS LAST" for k in keys])


def _trip_dom(q: str, src: str, for_sketch: bool = False) -> str:
    if q == "q1":
        return f"SELECT PULocationID FROM {src}"
    if q == "q2":
        return (
            f"SELECT DOLocationID, CAST(hour(dropoff_datetime) AS INTEGER) AS hour FROM {src} "
            "WHERE hour(dropoff_datetime) >= 6 AND hour(dropoff_datetime) <= 11 "
            "AND dayofweek(dropoff_datetime) NOT IN (0, 6)"
        )
    if q == "q3":
        return f"SELECT PULocationID, DOLocationID FROM {src}"
    if q == "q4":
        return f"SELECT passenger_count FROM {src}" + ("" if for_sketch else " WHERE passenger_count BETWEEN 1 AND 8")
    if q == "q5":
        return f"SELECT payment_type_desc FROM {src}"
    if q == "q6":
        return f"SELECT tip_amount FROM {src} WHERE tip_amount > 0"
    raise KeyError(q)


def exact_sql(q: str) -> str:
    spec = C.CARRIER_QUERIES[q]
    keys = list(spec.keys)
    base, _, _ = _base(q)
    ks = ", ".join(keys)
    sql = f"SELECT {ks}, count(*) AS {spec.exact_col} FROM ({_dom(q, base)}) GROUP BY {ks}"
    if spec.top is not None:
        sql += f" ORDER BY {_order(keys, spec.exact_col)} LIMIT {spec.top}"
    return sql


def sample_sql(q: str) -> str:
    spec = C.CARRIER_QUERIES[q]
    ks = ", ".join(spec.keys)
    _, sample, factor = _base(q)
    return (
        f"WITH smp AS ({sample}) SELECT {ks}, round(count(*) * {factor}) AS {spec.sampled_col} "
        f"FROM ({_dom(q, 'smp')}) GROUP BY {ks}"
    )


def sample_topk_sql() -> str:
    spec = C.C1
    keys = list(spec.keys)
    return f"SELECT * FROM ({sample_sql('q1')}) ORDER BY {_order(keys, spec.sampled_col)} LIMIT 20"


def _cells_sql(dom: str, keys: list[str], width: int, depth: int, seed: int, extra_cols: str = "") -> str:
    return (
        f"SELECT {extra_cols}r.d AS d, "
        f"CAST(((h >> 28) + r.d * (h & 268435455)) % {width} AS INTEGER) AS b, "
        f"count(*) AS c "
        f"FROM (SELECT {extra_cols}CAST('0x' || substr(md5({_seeded(keys, seed)}), 1, 15) AS BIGINT) AS h FROM ({dom})) "
        f"CROSS JOIN (SELECT CAST(range AS INTEGER) AS d FROM range({depth})) r "
        f"GROUP BY ALL"
    )


def _estimate_sql(exact: str, keys: list[str], exact_col: str, cells: str, width: int, depth: int, seed: int) -> str:
    h = f"CAST('0x' || substr(md5({_seeded(keys, seed, 'ex.')}), 1, 15) AS BIGINT)"
    bucket = f"CAST((({h} >> 28) + r.d * ({h} & 268435455)) % {width} AS INTEGER)"
    ks = ", ".join(f"pr.{k}" for k in keys)
    return (
        f"WITH ex AS ({exact}), cells AS ({cells}), "
        f"pr AS (SELECT ex.*, r.d AS _d, {bucket} AS _b FROM ex "
        f"CROSS JOIN (SELECT CAST(range AS INTEGER) AS d FROM range({depth})) r) "
        f"SELECT {ks}, pr.{exact_col}, CAST(min(coalesce(cells.c, 0)) AS BIGINT) AS cms_estimated_count "
        f"FROM pr LEFT JOIN cells ON pr._d = cells.d AND pr._b = cells.b "
        f"GROUP BY {ks}, pr.{exact_col}"
    )


def cms_sql(q: str, params=C.NARROW_CMS) -> str:
    spec = C.CARRIER_QUERIES[q]
    keys = list(spec.keys)
    base, _, _ = _base(q)
    cells = _cells_sql(_dom(q, base, for_sketch=True), keys, params.width, params.depth, params.seed)
    return _estimate_sql(exact_sql(q), keys, spec.exact_col, cells, params.width, params.depth, params.seed)


def _ranked_contents(src: str) -> str:
    """Rows of ``src`` with ``rank_text``, the text of (seed, md5 of all columns, copy number)."""
    digest = f"md5({_ktext(list(SILVER_NAMES))})"
    return (
        f"SELECT *, '{S}:' || digest || '|' || CAST(copy AS VARCHAR) AS rank_text FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY digest) - 1 AS copy FROM (SELECT *, {digest} AS digest FROM ({src})))"
    )


def trip_sample_sql(src: str | None = None) -> str:
    """Rows of silver by md5 of (seed, md5 of all columns, copy number)."""
    return (
        f"SELECT {', '.join(SILVER_NAMES)} FROM ({_ranked_contents(src or SILVER)}) "
        f"ORDER BY md5(rank_text), rank_text LIMIT {C.TRIP_SAMPLE_K}"
    )


def _again(src: str) -> str:
    """``src`` with the month that is published again, each of its rows twice."""
    year, month = MQ.AGAIN_MONTH
    return f"SELECT * FROM ({src}) UNION ALL SELECT * FROM ({src}) WHERE year = {year} AND month = {month}"


def stratified_sql(q: str) -> str:
    spec = MQ.STRATIFIED[q]
    ks = ", ".join(spec.keys)
    placed = (
        f"SELECT *, row_number() OVER (PARTITION BY year, month ORDER BY md5(rank_text), rank_text) AS place, "
        f"count(*) OVER (PARTITION BY year, month) AS big FROM ({_ranked_contents(SILVER)})"
    )
    domain = _trip_dom(q, "smp").replace("SELECT ", "SELECT year, month, ", 1)
    return (
        f"WITH smp AS (SELECT * FROM ({placed}) WHERE place <= {MQ.STRATUM_K}), "
        "sizes AS (SELECT year, month, max(big)::DOUBLE AS big, count(*)::DOUBLE AS n FROM smp GROUP BY year, month), "
        "totals AS (SELECT sum(big) AS all_rows, sum(n) AS all_seen FROM sizes), "
        f"seen AS (SELECT year, month, {ks}, count(*)::DOUBLE AS x FROM ({domain}) GROUP BY ALL), "
        f"parts AS (SELECT {ks}, x, big * (x / n) AS est, "
        "big * big * (1 - n / big) * (x / n) * (1 - x / n) / greatest(n - 1, 1) AS variance FROM seen JOIN sizes USING (year, month)), "
        f"sums AS (SELECT {ks}, sum(est) AS est, sqrt(sum(variance)) AS err, sum(x) AS seen FROM parts GROUP BY {ks}) "
        f"SELECT {ks}, round(est, 4) AS estimated_count, round(err, 4) AS std_error, "
        "round(greatest(est - 1.959964::DOUBLE * err, seen), 4) AS lower_bound, "
        "round(least(est + 1.959964::DOUBLE * err, all_rows - all_seen + seen), 4) AS upper_bound FROM sums, totals"
    )


def _monthly_sql() -> dict[str, str]:
    """SQL of the queries over monthly state."""
    p, k = C.NARROW_CMS, ["PULocationID"]
    cells = _cells_sql(f"SELECT PULocationID FROM ({_again(SILVER)})", k, p.width, p.depth, p.seed)
    lo, hi = T.month_bounds()
    in_range = f"year * 100 + month BETWEEN {lo.year * 100 + lo.month} AND {hi.year * 100 + hi.month}"
    top = f"SELECT PULocationID, count(*) AS n FROM ({_again(SILVER)}) GROUP BY ALL ORDER BY {_order(k, 'n')} LIMIT 20"
    out = {
        "cms_month_refresh": f"SELECT *, 1 AS recomputed_months FROM ({cells})",
        "sample_merge_months": trip_sample_sql(),
        "sample_merge_range": trip_sample_sql(f"SELECT * FROM ({_again(SILVER)}) WHERE {in_range}"),
        "q1_heavy_hitters": f"SELECT *, TRUE AS bounds_hold FROM ({exact_sql('q1')})",
        # Fewer keys than counters: the bounds meet in the count.
        "heavy_hitters_by_month": f"SELECT PULocationID, n AS lower_bound, n AS upper_bound, TRUE AS guaranteed FROM ({top})",
        "gate_by_month": _gate(_again(SILVER)),
        "volume_gate": " UNION ALL ".join(
            f"SELECT {n}::BIGINT AS min_files, CASE WHEN count(*) > 0 AND {n} = 1 THEN 'ok' ELSE 'insufficient_data' END AS status FROM ({SILVER})"
            for n in MQ.MIN_FILES
        ),
        "gold_times": " UNION ALL ".join(
            f"SELECT '{q.name}' AS query_name, TRUE AS exact_timed, TRUE AS sample_timed, TRUE AS cms_timed, TRUE AS cms_error_known"
            for q in (MQ.Q1, MQ.Q5)
        ),
    }
    return out | {f"stratified_{q}": stratified_sql(q) for q in MQ.STRATIFIED}


def trip_gold_sql(q: str) -> str:
    spec = R.TRIP_QUERIES[q]
    keys, p = list(spec.keys), C.GOLD_CMS
    ks = ", ".join(keys)
    exact = f"SELECT {ks}, count(*) AS {spec.exact_col} FROM ({_trip_dom(q, 'silver')}) GROUP BY {ks}"
    if spec.top is not None:
        exact += f" ORDER BY {_order(keys, spec.exact_col)} LIMIT {spec.top}"
    cells = _cells_sql(_trip_dom(q, "silver", for_sketch=True), keys, p.width, p.depth, p.seed)
    est = _estimate_sql(exact, keys, spec.exact_col, cells, p.width, p.depth, p.seed)
    factor = "((SELECT count(*) FROM silver)::DOUBLE / (SELECT count(*) FROM smp)::DOUBLE)"
    sampled = f"SELECT {ks}, round(count(*) * {factor}) AS {spec.sampled_col} FROM ({_trip_dom(q, 'smp')}) GROUP BY {ks}"
    return (
        f"WITH silver AS MATERIALIZED ({SILVER}), smp AS ({trip_sample_sql()}) "
        + _gold_join(spec, f"SELECT * FROM ({est})", sampled)
    )


def _gold_join(spec, est: str, smp: str) -> str:
    keys = list(spec.keys)
    on = " AND ".join(f"est.{k} IS NOT DISTINCT FROM sm.{k}" for k in keys)
    ks = ", ".join(f"est.{k}" for k in keys)
    return (
        f"SELECT {ks}, est.{spec.exact_col}, sm.{spec.sampled_col}, est.cms_estimated_count "
        f"FROM ({est}) est LEFT JOIN ({smp}) sm ON {on}"
    )


def gold_sql(q: str) -> str:
    return _gold_join(C.CARRIER_QUERIES[q], cms_sql(q, C.GOLD_CMS), sample_sql(q))


def _metric_sql(q: str) -> str:
    spec = C.CARRIER_QUERIES[q]
    e, s = spec.exact_col, spec.sampled_col

    def tot(c: str) -> str:
        return f"coalesce(sum(coalesce(CAST({c} AS DOUBLE), 0.0)), 0.0)"

    def pair(prefix: str, est: str) -> str:
        te, ts = tot(e), tot(est)
        return (
            f"abs({te} - {ts}) AS {prefix}_absolute_error, "
            f"round(CASE WHEN {te} <> 0 THEN abs({te} - {ts}) / {te} * 100.0 ELSE 0.0 END, 4) AS {prefix}_pct_error"
        )

    return (
        f"SELECT '{spec.name}' AS query_name, {pair('sample', s)}, {pair('cms', 'cms_estimated_count')} "
        f"FROM ({gold_sql(q)})"
    )


def _per_key_sql(q: str) -> str:
    spec = C.CARRIER_QUERIES[q]
    e, s = spec.exact_col, spec.sampled_col

    def mae(c: str) -> str:
        return f"avg(abs(CAST({e} AS DOUBLE) - coalesce(CAST({c} AS DOUBLE), 0.0)))"

    return (
        f"SELECT '{spec.name}' AS query_name, count(*) AS keys, {mae(s)} AS sample_mean_abs_error, "
        f"{mae('cms_estimated_count')} AS cms_mean_abs_error FROM ({gold_sql(q)})"
    )


# --- layer steps on the trip carrier ---------------------------------------------------------

RAW = (
    "SELECT l_returnflag AS VendorID, "
    "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS tpep_pickup_datetime, "
    "strftime(l_shipdate + to_hours(l_linenumber), '%Y-%m-%d %H:%M:%S') AS tpep_dropoff_datetime, "
    "CAST(l_linenumber - 1 AS DOUBLE) AS passenger_count, "
    "l_discount AS trip_distance, l_linestatus AS RatecodeID, 'N' AS store_and_fwd_flag, "
    "CAST(l_suppkey AS VARCHAR) AS PULocationID, CAST(l_partkey AS VARCHAR) AS DOLocationID, "
    "CAST(CAST(l_linenumber AS DOUBLE) AS VARCHAR) AS payment_type, "
    "l_extendedprice AS fare_amount, l_tax AS extra, CAST(0.5 AS DOUBLE) AS mta_tax, "
    "l_discount AS tip_amount, CAST(0.0 AS DOUBLE) AS tolls_amount, "
    "CAST(0.3 AS DOUBLE) AS improvement_surcharge, l_extendedprice + l_tax AS total_amount, "
    "CAST(2.5 AS DOUBLE) AS congestion_surcharge, CAST(0.0 AS DOUBLE) AS airport_fee "
    "FROM lineitem"
)
PAYMENT_DESC = _case_map("payment_type", PAYMENT_TYPE_MAP, "Other")


def _clean(raw: str, upper: str = "between") -> str:
    return (
        f"SELECT *, {PAYMENT_DESC} AS payment_type_desc, "
        "CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month "
        f"FROM (SELECT *, TRY_CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime, "
        f"TRY_CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime FROM ({raw})) "
        "WHERE passenger_count > 0 AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL "
        f"AND pickup_datetime BETWEEN TIMESTAMP '{T.CARRIER_DATE_LO}' AND TIMESTAMP '{T.CARRIER_DATE_HI}'"
    )


SILVER = _clean(RAW)
SILVER_NAMES = SILVER_SCHEMA.fieldNames()
FAULTS = (
    "SELECT TIMESTAMP '{0}' AS pickup_datetime, TIMESTAMP '{0}' AS dropoff_datetime, "
    "CAST({1} AS DOUBLE) AS passenger_count, {2} AS PULocationID"
)
FAULT_ROWS_SQL = " UNION ALL ".join(
    FAULTS.format(ts, pc, "NULL::VARCHAR" if pu is None else f"'{pu}'") for ts, pc, pu in T.FAULT_ROWS
)
FAULTY_SILVER = (
    "SELECT * FROM (" + SILVER + ") UNION ALL BY NAME SELECT *, '1' AS DOLocationID, "
    "CAST(1.0 AS DOUBLE) AS trip_distance, CAST(10.0 AS DOUBLE) AS fare_amount, "
    "CAST(0.0 AS DOUBLE) AS tip_amount, CAST(10.0 AS DOUBLE) AS total_amount, '1.0' AS payment_type, "
    "'Credit card' AS payment_type_desc, CAST(year(pickup_datetime) AS INTEGER) AS year, "
    "CAST(month(pickup_datetime) AS INTEGER) AS month FROM (" + FAULT_ROWS_SQL + ")"
)


def _gate(src: str) -> str:
    st = (
        "SELECT count(*) AS n, count(*) FILTER (WHERE pickup_datetime IS NULL) AS v2, "
        "count(*) FILTER (WHERE PULocationID IS NULL) AS v3, "
        f"count(*) FILTER (WHERE passenger_count <= 0) AS v4 FROM ({src})"
    )
    rows = [
        "SELECT 1 AS check_no, 'row_count_positive' AS check_name, CAST(n AS BIGINT) AS observed, n > 0 AS passed FROM st",
        "SELECT 2, 'pickup_datetime_not_null', CAST(v2 AS BIGINT), v2 = 0 FROM st",
        "SELECT 3, 'pu_location_not_null', CAST(v3 AS BIGINT), v3 = 0 FROM st",
        "SELECT 4, 'passenger_count_positive', CAST(v4 AS BIGINT), v4 = 0 FROM st",
    ]
    return f"WITH st AS ({st}) " + " UNION ALL ".join(rows)


REASON = (
    "CASE WHEN pickup_datetime IS NULL THEN 'pickup_datetime_null' "
    "WHEN PULocationID IS NULL THEN 'pu_location_null' "
    "WHEN passenger_count <= 0 THEN 'passenger_count_not_positive' END"
)


def _events_range(upper_exclusive: bool) -> str:
    if upper_exclusive:
        return (
            f"SELECT * FROM events WHERE ts >= TIMESTAMP '{R.EVENTS_LO}' "
            "AND ts < TIMESTAMP '2024-01-16'"
        )
    return f"SELECT * FROM events WHERE ts BETWEEN TIMESTAMP '{R.EVENTS_LO}' AND TIMESTAMP '{R.EVENTS_HI}'"


def _bernoulli() -> str:
    frac = f"least(1.0, {C.EVENTS_SAMPLE_K}::DOUBLE / greatest(1, (SELECT count(*) FROM events))::DOUBLE)"
    threshold = f"CAST(floor({frac} * {float(RANK_SPACE)!r}) AS BIGINT)"
    return (
        f"SELECT * FROM events WHERE CAST('0x' || substr({_rank(EV_KEY, S)}, 1, 15) AS BIGINT) < {threshold}"
    )


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for q in C.CARRIER_QUERIES:
        out[f"{q}_exact"] = exact_sql(q)
        out[f"{q}_sample"] = sample_sql(q)
        out[f"{q}_cms"] = cms_sql(q)
        out[f"gold_{q}"] = gold_sql(q)
    for q in R.TRIP_QUERIES:
        out[f"trip_gold_{q}"] = trip_gold_sql(q)
    out["trip_sample"] = trip_sample_sql()
    out.update(_monthly_sql())
    out["q1_sample_topk"] = sample_topk_sql()
    out["gold_metrics"] = " UNION ALL ".join(_metric_sql(q) for q in C.CARRIER_QUERIES)
    out["gold_metrics_per_key"] = " UNION ALL ".join(_per_key_sql(q) for q in C.CARRIER_QUERIES)
    out["sample_bottom_k"] = LI_SAMPLE
    out["sample_bernoulli_hash"] = _bernoulli()
    out["sample_materialized"] = (
        f"SELECT *, CAST((SELECT count(*) FROM events) AS BIGINT) AS sample_population, "
        f"CAST((SELECT least({C.EVENTS_SAMPLE_K}, count(*)) FROM events) AS BIGINT) AS sample_size "
        f"FROM ({EV_SAMPLE})"
    )
    narrow = C.NARROW_CMS
    out["cms_build_cells"] = _cells_sql("SELECT l_suppkey FROM lineitem", ["l_suppkey"], narrow.width, narrow.depth, narrow.seed)
    out["cms_merge"] = out["cms_build_cells"]
    # Layout of Spark's binary sketch: version, total, depth, width, a long of hash data a row, a long a cell.
    out["cms_build_native"] = (
        "SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, "
        f"CAST({20 + 8 * narrow.depth + 8 * narrow.depth * narrow.width} AS INTEGER) AS sketch_bytes, count(*) AS total_count "
        "FROM lineitem GROUP BY ALL"
    )
    out["layer_file_count"] = f"SELECT count(*) AS partitions, TRUE AS files_in_each FROM (SELECT DISTINCT year, month FROM ({SILVER}))"
    out["sample_bernoulli_native"] = (
        f"SELECT count(*) AS population, CAST({C.EVENTS_SAMPLE_K} AS BIGINT) AS expected_size, "
        "TRUE AS distinct_rows_of_table, TRUE AS size_within_6_sigma FROM events"
    )
    out["clean_silver"] = SILVER
    out["clean_dedup"] = f"SELECT DISTINCT * FROM ({_clean(RAW + ' UNION ALL ' + RAW)})"
    out["filter_between_midnight"] = _events_range(False)
    out["filter_half_open"] = _events_range(True)
    out["enrich_lookup"] = f"SELECT PULocationID, DOLocationID, payment_type, {PAYMENT_DESC} AS payment_type_desc FROM ({RAW})"
    out["enrich_broadcast_join"] = out["enrich_lookup"]
    out["ingest_csv_roundtrip"] = RAW
    lo, hi = T.month_bounds()
    out["silver_partition_scan"] = (
        f"SELECT * FROM ({SILVER}) WHERE year * 100 + month BETWEEN {lo.year * 100 + lo.month} AND {hi.year * 100 + hi.month}"
    )
    out["layer_volume"] = f"SELECT year, month, count(*) AS row_count FROM ({SILVER}) GROUP BY year, month"
    out["quality_gate"] = _gate(SILVER)
    out["quality_gate_fault"] = _gate(FAULTY_SILVER)
    out["quarantine_clean"] = f"SELECT * FROM ({FAULTY_SILVER}) WHERE ({REASON}) IS NULL"
    out["quarantine_rejects"] = f"SELECT * FROM (SELECT *, {REASON} AS reject_reason FROM ({FAULTY_SILVER})) WHERE reject_reason IS NOT NULL"
    return out
