"""DuckDB SQL that computes the same results as ``queries()``.

Only the driver's raw tables exist on the DuckDB side, so every statement
starts from shared CTEs mirroring the adapter views and the feature builds.
This is independent SQL text, used as the correctness oracle.
"""

from __future__ import annotations

from pintime import config

TTL_DAYS = config.DEFAULT_TTL.days
SHORT_TTL_DAYS = config.SHORT_TTL.days
EXCL = ", ".join(f"'{x}'" for x in config.EXCLUDED_LOCATIONS)

_TREND = [("s1", "vaccine_interest"), ("s2", "vaccine_intent"), ("s3", "vaccine_safety")]


def _trend_lag_cols() -> str:
    out = []
    for _, name in _TREND:
        out.append(f"lag_1_{name}")
        out.append(f"lag(lag_1_{name}) OVER (PARTITION BY state ORDER BY date) AS lag_2_{name}")
    return ",\n      ".join(out)


BASE_CTES: list[tuple[str, str]] = [
    ("daily_counts", """
    SELECT CAST(o.o_orderdate AS DATE) AS date, n.n_name AS location, COUNT(*) AS daily_count
    FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
                  JOIN nation n ON n.n_nationkey = c.c_nationkey
    GROUP BY 1, 2"""),
    ("trend_points", """
    SELECT CAST(date_trunc('week', l.l_shipdate) AS DATE) AS date,
           n.n_name AS sub_region_1, s.s_name AS sub_region_2,
           CAST(round(l.l_discount * 100) AS BIGINT) AS s1,
           CAST(round(l.l_tax * 100) AS BIGINT) AS s2,
           CAST(l.l_quantity AS BIGINT) AS s3
    FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
                    JOIN nation n ON n.n_nationkey = s.s_nationkey"""),
    ("trend_avg", """
    SELECT date, sub_region_1 AS state,
           avg(s1) AS lag_1_vaccine_interest, avg(s2) AS lag_1_vaccine_intent,
           avg(s3) AS lag_1_vaccine_safety
    FROM trend_points GROUP BY date, sub_region_1"""),
    ("trend_lagged", f"""
    SELECT CAST(date AS TIMESTAMP) AS date, state,
      {_trend_lag_cols()}
    FROM trend_avg"""),
    ("trend_features", """
    SELECT date, state, lag_1_vaccine_interest, lag_2_vaccine_interest,
           lag_1_vaccine_intent, lag_2_vaccine_intent,
           lag_1_vaccine_safety, lag_2_vaccine_safety
    FROM trend_lagged
    WHERE state IS NOT NULL AND lag_1_vaccine_interest IS NOT NULL
      AND lag_2_vaccine_interest IS NOT NULL AND lag_1_vaccine_intent IS NOT NULL
      AND lag_2_vaccine_intent IS NOT NULL AND lag_1_vaccine_safety IS NOT NULL
      AND lag_2_vaccine_safety IS NOT NULL"""),
    ("filtered_daily", f"""
    SELECT date, location, daily_count FROM daily_counts
    WHERE (location IS NULL OR location NOT IN ({EXCL}))
      AND date >= DATE '{config.DATE_FLOOR}'"""),
    ("clean_daily", """
    SELECT date, COALESCE(location, '0') AS location, COALESCE(daily_count, 0) AS daily_count
    FROM filtered_daily"""),
    ("weekly_counts", """
    SELECT CAST(date_trunc('week', date - INTERVAL 1 DAY) AS DATE) + 7 AS date, location,
           CAST(SUM(daily_count) AS BIGINT) AS lag_1_weekly_vaccinations_count
    FROM clean_daily GROUP BY 1, 2"""),
    ("count_features", """
    SELECT CAST(date AS TIMESTAMP) AS date, location AS state, lag_1_weekly_vaccinations_count,
           lead(lag_1_weekly_vaccinations_count) OVER (PARTITION BY location ORDER BY date)
             AS weekly_vaccinations_count,
           lag(lag_1_weekly_vaccinations_count) OVER (PARTITION BY location ORDER BY date)
             AS lag_2_weekly_vaccinations_count
    FROM weekly_counts"""),
    ("trend_typed", """
    SELECT date, state,
           CAST(lag_1_vaccine_interest AS FLOAT) AS lag_1_vaccine_interest,
           CAST(lag_2_vaccine_interest AS FLOAT) AS lag_2_vaccine_interest,
           CAST(lag_1_vaccine_intent AS FLOAT) AS lag_1_vaccine_intent,
           CAST(lag_2_vaccine_intent AS FLOAT) AS lag_2_vaccine_intent,
           CAST(lag_1_vaccine_safety AS FLOAT) AS lag_1_vaccine_safety,
           CAST(lag_2_vaccine_safety AS FLOAT) AS lag_2_vaccine_safety
    FROM trend_features"""),
    ("entity_rows", "SELECT state, date AS event_timestamp FROM count_features"),
]

COUNT_VIEW_FEATURES = ["lag_1_weekly_vaccinations_count", "lag_2_weekly_vaccinations_count",
                       "weekly_vaccinations_count"]
SERVING_COUNT_FEATURES = ["lag_1_weekly_vaccinations_count", "lag_2_weekly_vaccinations_count"]


def asof_ctes(prefix: str, entity: str, entity_cols: list[str],
              sides: list[tuple[str, list[str], int | None]],
              ts: str = "event_timestamp") -> list[tuple[str, str]]:
    """Chain of ``ASOF LEFT JOIN`` CTEs; the last one is named ``prefix``.
    ``sides`` = (feature CTE with columns date/state, features, ttl days)."""
    out: list[tuple[str, str]] = []
    prev, cols = entity, list(entity_cols)
    for i, (fcte, feats, ttl) in enumerate(sides):
        name = prefix if i == len(sides) - 1 else f"{prefix}_{i}"
        sel = [f"e.{c}" for c in cols]
        for f in feats:
            if ttl is None:
                sel.append(f"f.{f}")
            else:
                sel.append(f"CASE WHEN f.date >= e.{ts} - INTERVAL {ttl} DAY THEN f.{f} END AS {f}")
        out.append((name, f"""
    SELECT {', '.join(sel)}
    FROM {prev} e ASOF LEFT JOIN {fcte} f ON e.state = f.state AND e.{ts} >= f.date"""))
        prev, cols = name, cols + list(feats)
    return out


TRAINING_SIDES = [("trend_typed", list(config.TREND_FEATURES), TTL_DAYS),
                  ("count_features", COUNT_VIEW_FEATURES, TTL_DAYS)]

TRAINING_CTES = asof_ctes("training_set", "entity_rows", ["state", "event_timestamp"],
                          TRAINING_SIDES)
TRAINING_CLEAN = ("training_set_clean", "SELECT * FROM training_set WHERE "
                  + " AND ".join(f"{c} IS NOT NULL" for c in
                                 ["state", "event_timestamp", *config.TREND_FEATURES,
                                  *COUNT_VIEW_FEATURES]))


def sql(body: str, *extra: tuple[str, str]) -> str:
    """``WITH <base CTEs>, <extra CTEs> <body>``; unused CTEs cost nothing."""
    ctes = BASE_CTES + list(extra)
    text = ",\n".join(f"{name} AS ({q}\n)" for name, q in ctes)
    return f"WITH {text}\n{body}"


_FEATURE_COLS = ", ".join(config.TREND_FEATURES)
ORACLE_SQL: dict[str, str] = {
    "trend_avg": sql("SELECT * FROM trend_avg"),
    "trend_features": sql("SELECT * FROM trend_features"),
    "weekly_counts": sql("SELECT * FROM weekly_counts"),
    "count_features": sql("SELECT * FROM count_features"),
    "counts_maintained": sql("SELECT * FROM count_features"),
    "trends_maintained": sql("SELECT * FROM trend_features"),
    "filter_not_in": sql("SELECT * FROM filtered_daily"),
    "fill_zero": sql("SELECT * FROM clean_daily"),
    "entity_rows": sql("SELECT * FROM entity_rows"),
    "asof_join": sql("SELECT * FROM aj", *asof_ctes(
        "aj", "entity_rows", ["state", "event_timestamp"],
        [("trend_typed", list(config.TREND_FEATURES), TTL_DAYS)])),
    "asof_join_ttl": sql("SELECT * FROM aj", *asof_ctes(
        "aj", "entity_rows", ["state", "event_timestamp"],
        [("trend_typed", list(config.TREND_FEATURES), SHORT_TTL_DAYS)])),
    "training_set": sql("SELECT * FROM training_set", *TRAINING_CTES),
    "training_set_clean": sql("SELECT * FROM training_set_clean", *TRAINING_CTES, TRAINING_CLEAN),
}


def _newest(src: str, feats: list[str], where: str = "TRUE") -> str:
    cols = ", ".join(feats)
    return f"""
    SELECT state, date AS event_ts, {cols} FROM (
      SELECT *, row_number() OVER (PARTITION BY state ORDER BY date DESC) AS rn
      FROM {src} WHERE date IS NOT NULL AND ({where})) WHERE rn = 1"""


_X = ", ".join(config.X_COLS)
_Y = config.Y_COL
_TS_A = tuple(f"TIMESTAMP '{d}'" for d in config.DRIFT_WINDOW_A)
_TS_B = tuple(f"TIMESTAMP '{d}'" for d in config.DRIFT_WINDOW_B)
_FS = config.FILTER_STATE
_ALL_COUNT = COUNT_VIEW_FEATURES


def window_ctes(tag: str, lo: str, hi: str, year: int) -> list[tuple[str, str]]:
    ent = (f"entity_{tag}", f"SELECT state, date AS event_timestamp FROM count_features "
                            f"WHERE date BETWEEN {lo} AND {hi}")
    chain = asof_ctes(f"ts_{tag}", f"entity_{tag}", ["state", "event_timestamp"], TRAINING_SIDES)
    clean = (f"win_{tag}", f"SELECT *, {year} AS year FROM ts_{tag} WHERE "
             + " AND ".join(f"{c} IS NOT NULL" for c in
                            ["state", "event_timestamp", *config.TREND_FEATURES, *_ALL_COUNT]))
    return [ent, *chain, clean]


WINDOW_CTES = (window_ctes("a", *_TS_A, int(config.DRIFT_WINDOW_A[0][:4]))
               + window_ctes("b", *_TS_B, int(config.DRIFT_WINDOW_B[0][:4]))
               + [("win_union", "SELECT * FROM win_a UNION ALL BY NAME SELECT * FROM win_b")])

SNAPSHOT_CTES = [
    ("snap_trend", _newest("trend_typed", list(config.TREND_FEATURES))),
    ("snap_counts", _newest("count_features", _ALL_COUNT)),
]


def lookup_sql(keys: str) -> str:
    return f"""
    SELECT k.state, {', '.join('t.' + c for c in config.TREND_FEATURES)},
           c.lag_1_weekly_vaccinations_count, c.lag_2_weekly_vaccinations_count
    FROM ({keys}) k LEFT JOIN snap_trend t ON t.state = k.state
                    LEFT JOIN snap_counts c ON c.state = k.state"""


def _corr_sql() -> str:
    parts = []
    for f in config.X_COLS:
        expr = (f"round(corr(CAST({f} AS DOUBLE), CAST({_Y} AS DOUBLE)), 9) AS corr, "
                f"count(CASE WHEN {f} IS NOT NULL AND {_Y} IS NOT NULL THEN 1 END) AS n")
        parts.append(f"SELECT CAST(NULL AS INTEGER) AS year, TRUE AS overall, '{f}' AS feature, {expr} "
                     "FROM win_union")
        parts.append(f"SELECT year, FALSE AS overall, '{f}' AS feature, {expr} FROM win_union "
                     "GROUP BY year")
    return "\nUNION ALL ".join(parts)


ORACLE_SQL.update({
    "src_feature_table": sql(f"SELECT state, date, {', '.join(_ALL_COUNT)} FROM count_features"),
    "typed_features": sql("SELECT * FROM trend_typed"),
    "serving_projection": sql("SELECT state, date, lag_1_weekly_vaccinations_count, "
                              "lag_2_weekly_vaccinations_count FROM count_features"),
    "feature_matrix": sql(f"SELECT {_X}, {_Y} FROM training_set_clean",
                          *TRAINING_CTES, TRAINING_CLEAN),
    "filter_state": sql(f"SELECT * FROM training_set_clean WHERE state = '{_FS}'",
                        *TRAINING_CTES, TRAINING_CLEAN),
    "filter_between": sql("SELECT state, date AS event_timestamp FROM count_features "
                          f"WHERE date BETWEEN {_TS_A[0]} AND {_TS_A[1]}"),
    "sorted_training_set": sql("SELECT * FROM training_set_clean ORDER BY event_timestamp, state",
                               *TRAINING_CTES, TRAINING_CLEAN),
    "head_rows": sql(f"SELECT * FROM training_set_clean WHERE state = '{_FS}' "
                     "ORDER BY event_timestamp, state LIMIT 5", *TRAINING_CTES, TRAINING_CLEAN),
    "tail_rows": sql(f"SELECT * FROM (SELECT * FROM training_set_clean WHERE state = '{_FS}' "
                     "ORDER BY event_timestamp DESC, state DESC LIMIT 5) ORDER BY event_timestamp, state",
                     *TRAINING_CTES, TRAINING_CLEAN),
    "describe_target": sql(f"""
    SELECT count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
           min(x) AS min, round(quantile_cont(x, 0.25), 6) AS p25,
           round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.75), 6) AS p75,
           max(x) AS max
    FROM (SELECT CAST({_Y} AS DOUBLE) AS x FROM training_set_clean WHERE state = '{_FS}')""",
                           *TRAINING_CTES, TRAINING_CLEAN),
    "stage_counts": sql("""
    SELECT 'loaded' AS stage, count(*) AS n_rows, count(DISTINCT location) AS n_keys FROM daily_counts
    UNION ALL SELECT 'filtered', count(*), count(DISTINCT location) FROM clean_daily
    UNION ALL SELECT 'weekly', count(*), count(DISTINCT location) FROM weekly_counts"""),
    "training_set_from_df": sql("SELECT * FROM tdf", (
        "entity_df", "SELECT state, date AS event_timestamp FROM trend_features"),
        *asof_ctes("tdf", "entity_df", ["state", "event_timestamp"], TRAINING_SIDES)),
    "temporal_split_train": sql(f"""
    SELECT {_X}, {_Y} FROM training_set_clean,
      (SELECT max(event_timestamp) - INTERVAL 7 DAY AS s FROM training_set_clean) m
    WHERE event_timestamp <= m.s""", *TRAINING_CTES, TRAINING_CLEAN),
    "temporal_split_test": sql(f"""
    SELECT {_X}, {_Y} FROM training_set_clean,
      (SELECT max(event_timestamp) - INTERVAL 7 DAY AS s FROM training_set_clean) m
    WHERE event_timestamp > m.s""", *TRAINING_CTES, TRAINING_CLEAN),
    "online_snapshot": sql("SELECT * FROM snap_counts", *SNAPSHOT_CTES),
    "materialize_increment": sql("SELECT * FROM snap_counts", *SNAPSHOT_CTES),
    "online_upsert": sql(f"""
    SELECT state, event_ts, {', '.join(_ALL_COUNT)} FROM (
      SELECT *, row_number() OVER (PARTITION BY state ORDER BY event_ts DESC, is_new DESC) AS rn
      FROM (SELECT *, 0 AS is_new FROM up_snap UNION ALL SELECT *, 1 AS is_new FROM up_inc))
    WHERE rn = 1""",
                         ("up_snap", _newest("count_features", _ALL_COUNT,
                                             f"date <= TIMESTAMP '{config.FIRST_INCREMENT_END}'")),
                         ("up_inc", _newest("count_features", _ALL_COUNT,
                                            f"date BETWEEN TIMESTAMP '{config.UPSERT_LATE_WINDOW[0]}' "
                                            f"AND TIMESTAMP '{config.UPSERT_LATE_WINDOW[1]}' "
                                            f"OR date > TIMESTAMP '{config.UPSERT_NEW_AFTER}'"))),
    "online_expire": sql(f"""
    SELECT * FROM snap_trend
    WHERE event_ts >= (SELECT max(event_ts) FROM snap_trend) - INTERVAL {SHORT_TTL_DAYS} DAY""",
                         *SNAPSHOT_CTES),
    "online_lookup": sql(lookup_sql("SELECT DISTINCT location AS state FROM daily_counts"),
                         *SNAPSHOT_CTES),
    "refresh_job": sql(lookup_sql("SELECT DISTINCT state FROM count_features"), *SNAPSHOT_CTES),
    "overwrite_roundtrip": sql("SELECT * FROM trend_features"),
    "csv_roundtrip": sql("SELECT * FROM count_features"),
    "csv_load_bad_records": sql("SELECT * FROM count_features"),
    "feature_tensor": sql("SELECT state, replace('[' || concat_ws(',', "
                          + ", ".join(f"coalesce(CAST(CAST({c} AS DOUBLE) AS VARCHAR), 'null')"
                                      for c in config.X_COLS)
                          + ") || ']', ' ', '') AS tensor, "
                          + " OR ".join(f"{c} IS NOT NULL" for c in config.X_COLS)
                          + " AS known FROM looked_up", *SNAPSHOT_CTES,
                          ("looked_up", lookup_sql("SELECT DISTINCT location AS state "
                                                   "FROM daily_counts"))),
    "requests_from_json": sql("SELECT strftime(date, '%Y-%m-%d') || '/' || state AS id, state "
                              "FROM count_features"),
    "drift_window": sql("SELECT * FROM win_a ORDER BY event_timestamp, state", *WINDOW_CTES),
    "window_union": sql(f"SELECT *, {_Y} AS target FROM win_union", *WINDOW_CTES),
    "feature_histogram": sql("""
    SELECT year, feature, bin, round(lo + (hi - lo) / 10 * bin, 6) AS lo,
           round(lo + (hi - lo) / 10 * (bin + 1), 6) AS hi, count(*) AS n
    FROM (SELECT year, feature, lo, hi,
                 CAST(CASE WHEN hi = lo THEN 0
                      ELSE least(floor((x - lo) / (hi - lo) * 10), 9) END AS INTEGER) AS bin
          FROM (SELECT year, feature, x, min(x) OVER (PARTITION BY feature) AS lo,
                       max(x) OVER (PARTITION BY feature) AS hi FROM hist_long)
          WHERE x IS NOT NULL)
    GROUP BY year, feature, bin, lo, hi""", *WINDOW_CTES, ("hist_long", "\n UNION ALL ".join(
        f"SELECT year, '{f}' AS feature, CAST({f} AS DOUBLE) AS x FROM win_union"
        for f in ["lag_1_vaccine_interest", "lag_1_vaccine_intent", "lag_1_vaccine_safety", _Y]))),
    "feature_target_corr": sql(_corr_sql(), *WINDOW_CTES),
})


def _round_p(expr: str) -> str:
    return f"(CASE WHEN ({expr}) < 5e-7 THEN 0.0::DOUBLE ELSE round({expr}, 6) END)"


def _ks_p(lam: str) -> str:
    series = (f"list_sum(list_transform(range(1, 101), lambda k: 2::DOUBLE * power(-1::DOUBLE, k - 1) "
              f"* exp(-2::DOUBLE * k * k * ({lam}) * ({lam}))))")
    return (f"CASE WHEN ({lam}) < 0.2 THEN 1::DOUBLE "
            f"ELSE least(1::DOUBLE, greatest(0::DOUBLE, {series})) END")


def _chi2_p(x: str, dof: str) -> str:
    a = f"(({dof}) / 2::DOUBLE)"
    z = f"(({x}) / 2::DOUBLE)"
    n = f"CAST(floor({z} + 12 * sqrt({z}) + 40) AS INTEGER)"
    term = (f"exp({a} * ln({z}) - {z} - lgamma({a} + 1) + n * ln({z}) "
            f"- (lgamma({a} + n + 1) - lgamma({a} + 1)))")
    return (f"CASE WHEN ({x}) <= 0 OR ({dof}) <= 0 THEN 1::DOUBLE "
            f"WHEN {z} > {a} + 50 * sqrt({a}) + 60 THEN 0::DOUBLE "
            f"ELSE least(1::DOUBLE, greatest(0::DOUBLE, "
            f"1 - list_sum(list_transform(range(0, {n} + 1), lambda n: {term})))) END")


def _long_union(src: str, feats: list[str], side: int) -> str:
    return "\n UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, {side} AS side "
        f"FROM {src} WHERE {f} IS NOT NULL AND NOT isnan(CAST({f} AS DOUBLE))" for f in feats)


KS_CTES = [
    ("ks_long", _long_union("win_a", list(config.X_COLS), 0) + "\n UNION ALL "
     + _long_union("win_b", list(config.X_COLS), 1)),
    ("ks_counts", """SELECT feature, value, count(*) FILTER (WHERE side = 0) AS na,
           count(*) FILTER (WHERE side = 1) AS nb FROM ks_long GROUP BY feature, value"""),
    ("ks_cdf", """SELECT feature, value,
           sum(na) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS ca,
           sum(nb) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cb,
           sum(na) OVER (PARTITION BY feature) AS n_a, sum(nb) OVER (PARTITION BY feature) AS n_b
           FROM ks_counts"""),
    ("ks_d", "SELECT feature, n_a, n_b, max(abs(ca / n_a - cb / n_b)) AS d FROM ks_cdf "
             "GROUP BY feature, n_a, n_b"),
    ("ks_result", f"""SELECT feature, round(d, 9) AS statistic,
           {_round_p(_ks_p('d * sqrt(CAST(n_a AS DOUBLE) * n_b / (n_a + n_b))'))} AS p_value,
           CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b FROM ks_d"""),
]


def chi2_ctes(tag: str, long_sql: str, name: str) -> list[tuple[str, str]]:
    ea = "((oa + ob) * n_a / (n_a + n_b))"
    eb = "((oa + ob) * n_b / (n_a + n_b))"
    return [
        (f"{tag}_long", long_sql),
        (f"{tag}_tab", f"""SELECT cat, count(*) FILTER (WHERE side = 0) AS oa,
               count(*) FILTER (WHERE side = 1) AS ob FROM {tag}_long
               WHERE cat IS NOT NULL GROUP BY cat"""),
        (f"{tag}_tot", f"SELECT sum(oa) AS n_a, sum(ob) AS n_b, count(*) AS k FROM {tag}_tab"),
        (f"{tag}_stat", f"""SELECT n_a, n_b, k,
               sum(power(oa - {ea}, 2) / {ea} + power(ob - {eb}, 2) / {eb}) AS x
               FROM {tag}_tab, {tag}_tot GROUP BY n_a, n_b, k"""),
        (f"{tag}_result", f"""SELECT '{name}' AS feature, round(x, 6) AS statistic,
               CAST(k - 1 AS BIGINT) AS dof, {_round_p(_chi2_p('x', 'k - 1'))} AS p_value,
               CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b FROM {tag}_stat"""),
    ]


_DECILES = ", ".join(str(i / 10) for i in range(1, 10))
STATE_CHI2 = chi2_ctes("cs", "SELECT CAST(state AS VARCHAR) AS cat, 0 AS side FROM win_a "
                             "UNION ALL SELECT CAST(state AS VARCHAR), 1 FROM win_b", "state")
TARGET_CHI2 = [("t_edges", f"SELECT quantile_cont(CAST({_Y} AS DOUBLE), [{_DECILES}]) AS e "
                           "FROM win_a")] + chi2_ctes(
    "ct", f"""SELECT CAST(len(list_filter(e, lambda q: q < CAST({_Y} AS DOUBLE))) AS VARCHAR) AS cat,
              0 AS side FROM win_a, t_edges WHERE {_Y} IS NOT NULL
              UNION ALL
              SELECT CAST(len(list_filter(e, lambda q: q < CAST({_Y} AS DOUBLE))) AS VARCHAR), 1
              FROM win_b, t_edges WHERE {_Y} IS NOT NULL""", "target")

REPORT_CTES = KS_CTES + STATE_CHI2 + TARGET_CHI2 + [
    ("r_means", """SELECT feature, round(avg(CASE WHEN side = 0 THEN value END), 6) AS mean_a,
           round(avg(CASE WHEN side = 1 THEN value END), 6) AS mean_b FROM ks_long GROUP BY feature"""),
    ("r_rows", """
    SELECT k.feature, 'ks' AS test, k.statistic, k.p_value, k.n_a, k.n_b, m.mean_a, m.mean_b
    FROM ks_result k LEFT JOIN r_means m ON m.feature = k.feature
    UNION ALL SELECT feature, 'chi2', statistic, p_value, n_a, n_b, NULL::DOUBLE, NULL::DOUBLE
    FROM cs_result
    UNION ALL SELECT feature, 'chi2', statistic, p_value, n_a, n_b, NULL::DOUBLE, NULL::DOUBLE
    FROM ct_result"""),
    ("r_flag", "SELECT *, p_value < 0.05 AS drifted FROM r_rows"),
    ("r_share", "SELECT round(avg(CAST(drifted AS DOUBLE)), 6) AS share_drifted FROM r_flag"),
]

_OOB_CUR = "\n UNION ALL ".join(
    f"SELECT state, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM oob_snap"
    for f in config.X_COLS)
OOB_CTES = [
    ("oob_snap", lookup_sql("SELECT DISTINCT state FROM count_features")),
    ("oob_base", _long_union("win_a", list(config.X_COLS), 0)),
    ("oob_bounds", "SELECT feature, quantile_cont(value, 0.01) AS lo, "
                   "quantile_cont(value, 0.99) AS hi FROM oob_base GROUP BY feature"),
    ("oob_cur", _OOB_CUR),
]

ORACLE_SQL.update({
    "scalar_functions": sql(f"""
    SELECT state, date, CAST(CAST(date AS DATE) AS TIMESTAMP) AS date_ts,
           date >= TIMESTAMP '{config.DRIFT_WINDOW_A[0]}' AS after_start,
           CAST(strptime(strftime(date, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS day,
           strftime(date, '%Y-%m-%d %H:%M:%S') AS date_text,
           CAST(year(date) AS INTEGER) AS year, date - INTERVAL 7 DAY AS week_before,
           decode(encode(state)) AS state_text,
           CAST(to_json([lag_1_weekly_vaccinations_count, weekly_vaccinations_count,
                         lag_2_weekly_vaccinations_count]) AS VARCHAR) AS counts_json,
           CAST(to_json({{'state': state, 'lag_1_weekly_vaccinations_count':
                          lag_1_weekly_vaccinations_count}}) AS VARCHAR) AS row_json
    FROM count_features"""),
    "drift_ks": sql("SELECT * FROM ks_result", *WINDOW_CTES, *KS_CTES),
    "drift_chi2": sql("SELECT * FROM cs_result", *WINDOW_CTES, *STATE_CHI2),
    "drift_target": sql("SELECT * FROM ct_result", *WINDOW_CTES, *TARGET_CHI2),
    "drift_report": sql("SELECT r_flag.*, r_share.share_drifted, r_share.share_drifted >= 0.5 "
                        "AS dataset_drift FROM r_flag, r_share",
                        *[(n, q.replace(f"{_Y} AS target", f"{_Y}")) for n, q in WINDOW_CTES],
                        *REPORT_CTES),
    "online_out_of_bounds": sql("""
    SELECT c.state, c.feature, c.value, round(b.lo, 6) AS lo, round(b.hi, 6) AS hi,
           COALESCE(c.value < b.lo OR c.value > b.hi, FALSE) AS out_of_bounds
    FROM oob_cur c JOIN oob_bounds b ON b.feature = c.feature""",
                                *SNAPSHOT_CTES, *WINDOW_CTES, *OOB_CTES),
})

# stored profiles give the report that the scan gives
ORACLE_SQL["drift_report_profiles"] = ORACLE_SQL["drift_report"]
