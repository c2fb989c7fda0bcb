"""The same results in plain SQL: row-level windows, NTILE and threshold joins, as the definitions state them."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

D = "CAST({} AS DOUBLE)".format

# Named sub-queries. Each lists what it needs, so a query can ask for the last one by name.
PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, body: str, *needs: str) -> None:
    PARTS[name] = (needs, body)


def sql(final: str, *needs: str) -> str:
    done: list[str] = []

    def add(name: str) -> None:
        if name not in done:
            for before in PARTS[name][0]:
                add(before)
            done.append(name)

    for name in needs:
        add(name)
    parts = ",\n".join(f"{name} AS ({PARTS[name][1]})" for name in done)
    return f"WITH {parts}\n{final}" if parts else final


part(
    "tx",
    f"""SELECT
  CAST((l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 31 + l_linenumber * 17) % 172800 AS DOUBLE) AS "Time",
  l_quantity AS V1, l_discount AS V2, l_tax AS V3, l_extendedprice AS Amount,
  CAST(CASE WHEN l_returnflag = 'R' AND l_discount >= {D('0.08')} AND l_quantity >= {D('46')} THEN 1 ELSE 0 END AS INTEGER) AS Class,
  floor(({D('0.5')} * (l_discount / {D('0.1')}) + {D('0.4')} * (l_quantity / {D('50')})
    + {D('0.1')} * (l_extendedprice / {D('110000')})) * {D('1000000')} + {D('0.5')}) / {D('1000000')} AS score
FROM lineitem""",
)
part("txh", """SELECT *, CAST(floor("Time" / 3600) AS BIGINT) % 24 AS "Hour" FROM tx WHERE "Time" IS NOT NULL""", "tx")
part(
    "sliced",
    """SELECT *, CAST((row_number() OVER (ORDER BY "Time", Amount, V1) - 1) % 50 + 1 AS INTEGER) AS "Date" FROM txh""",
    "txh",
)
part(
    "pred_all",
    "SELECT CAST(Class AS BIGINT) AS class_label, Amount AS amount, score AS p FROM tx WHERE score IS NOT NULL",
    "tx",
)
part(
    "pred_daily",
    'SELECT CAST(Class AS BIGINT) AS class_label, Amount AS amount, score AS p FROM sliced WHERE "Date" BETWEEN 1 AND 31',
    "sliced",
)


def long_part(name: str, source: str, features: tuple[str, ...]) -> None:
    rows = " UNION ALL ".join(
        f"""SELECT CAST(Class AS BIGINT) AS class_label, '{f}' AS feature_name, CAST("{f}" AS DOUBLE) AS feature_value
  FROM {source} WHERE "{f}" IS NOT NULL"""
        for f in features
    )
    part(name, rows, source)


long_part("long_tx", "txh", ("V1", "V2", "V3", "Amount", "Hour"))
part(
    "ev",
    """SELECT "value", CAST(hour(ts) AS BIGINT) AS "Hour", CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS Class FROM events""",
)
long_part("long_ev", "ev", ("value", "Hour"))


def separation_parts(tag: str, long: str) -> None:
    # The distribution function of each class where it rises, read off at every value of the feature.
    part(f"edf_{tag}", f"SELECT DISTINCT feature_name, class_label, feature_value, cume_dist() OVER (PARTITION BY feature_name, class_label ORDER BY feature_value) AS edf FROM {long}", long)
    part(
        f"gaps_{tag}",
        f"""SELECT v.feature_name, max(abs(coalesce(a.edf, 0) - coalesce(b.edf, 0))) AS ks_statistic FROM (SELECT DISTINCT feature_name, feature_value FROM {long}) AS v
ASOF LEFT JOIN (FROM edf_{tag} WHERE class_label = 1) AS a ON v.feature_name = a.feature_name AND v.feature_value >= a.feature_value
ASOF LEFT JOIN (FROM edf_{tag} WHERE class_label = 0) AS b ON v.feature_name = b.feature_name AND v.feature_value >= b.feature_value GROUP BY 1""",
        f"edf_{tag}",
    )
    # Cliff's delta is 2 U / (n_pos n_neg) - 1, with U the rank sum of the positives, ties at their mean rank, less its least value.
    part(
        f"ranked_{tag}",
        f"""SELECT feature_name, ks_statistic, (2 * rank_sum - n_pos * (n_pos + 1)) / (n_pos * n_neg) - 1 AS cliffs_delta FROM gaps_{tag} JOIN (
  SELECT feature_name, sum(mid_rank) FILTER (class_label = 1) AS rank_sum, {D('count(*) FILTER (class_label = 1)')} AS n_pos, {D('count(*) FILTER (class_label = 0)')} AS n_neg
  FROM (SELECT *, rank() OVER (PARTITION BY feature_name ORDER BY feature_value) + (count(*) OVER (PARTITION BY feature_name, feature_value) - 1) / {D('2')} AS mid_rank
    FROM {long}) GROUP BY 1) USING (feature_name) WHERE n_pos > 0 AND n_neg > 0""",
        long,
        f"gaps_{tag}",
    )
    part(
        f"z_{tag}",
        f"""SELECT feature_name,
  avg(feature_value) FILTER (class_label = 1) AS mean_pos,
  avg(feature_value) FILTER (class_label = 0) AS mean_neg,
  stddev_pop(feature_value) FILTER (class_label = 0) AS std_neg,
  (avg(feature_value) FILTER (class_label = 1) - avg(feature_value) FILTER (class_label = 0))
    / (stddev_pop(feature_value) FILTER (class_label = 0) + {D('1e-9')}) AS z_score_diff
FROM {long} GROUP BY feature_name""",
        long,
    )
    part(
        f"binned_ntile_{tag}",
        f"""SELECT *, ntile(10) OVER (PARTITION BY feature_name ORDER BY feature_value, class_label) AS bin_id, 10 AS n_bins FROM {long}""",
        long,
    )
    part(
        f"binned_floor_{tag}",
        f"""SELECT r.*, least(n_bins - 1, ((rn - 1) * n_bins) // n) + 1 AS bin_id FROM (
  SELECT *, row_number() OVER (PARTITION BY feature_name ORDER BY feature_value, class_label) AS rn,
    count(*) OVER (PARTITION BY feature_name) AS n FROM {long}) AS l
  JOIN (SELECT feature_name AS f, least(10, count(DISTINCT feature_value)) AS n_bins FROM {long} GROUP BY 1) AS u
    ON l.feature_name = u.f""".replace("SELECT r.*,", "SELECT l.*, u.n_bins,"),
        long,
    )
    for mode in ("ntile", "floor"):
        part(
            f"bins_{mode}_{tag}",
            f"""SELECT *, ln(dist_pos / dist_neg) AS woe, (dist_pos - dist_neg) * ln(dist_pos / dist_neg) AS iv_contribution FROM (
  SELECT s.*, (n_pos + {D('0.5')}) / (total_pos + {D('0.5')} * n_bins) AS dist_pos,
    (n_neg + {D('0.5')}) / (total_neg + {D('0.5')} * n_bins) AS dist_neg
  FROM (SELECT feature_name, bin_id, max(n_bins) AS n_bins, count(*) AS n_rows, count(*) FILTER (class_label = 1) AS n_pos,
      count(*) FILTER (class_label = 0) AS n_neg, min(feature_value) AS bin_min, max(feature_value) AS bin_max
    FROM binned_{mode}_{tag} GROUP BY 1, 2) AS s
  JOIN (SELECT feature_name AS f, count(*) FILTER (class_label = 1) AS total_pos, count(*) FILTER (class_label = 0) AS total_neg
    FROM {long} GROUP BY 1) AS t ON s.feature_name = t.f
  WHERE total_pos > 0 AND total_neg > 0)""",
            f"binned_{mode}_{tag}",
        )
        part(
            f"iv_{mode}_{tag}",
            f"SELECT feature_name, sum(iv_contribution) AS information_value FROM bins_{mode}_{tag} GROUP BY 1",
            f"bins_{mode}_{tag}",
        )
    part(
        f"separation_{tag}",
        f"""SELECT k.feature_name AS feature, ks_statistic, {KS} AS ks_rating, information_value, {IV} AS iv_rating,
  cliffs_delta, abs(cliffs_delta) AS cliffs_delta_abs, {DELTA} AS cliffs_rating,
  z_score_diff, abs(z_score_diff) AS z_score_diff_abs, {Z} AS z_rating,
  ks_statistic >= 0.40 AND abs(cliffs_delta) >= 0.33 AS is_strong_separator
FROM ranked_{tag} AS k LEFT JOIN iv_ntile_{tag} AS i ON k.feature_name = i.feature_name
LEFT JOIN z_{tag} AS z ON k.feature_name = z.feature_name""",
        f"ranked_{tag}",
        f"iv_ntile_{tag}",
        f"z_{tag}",
    )


# Rating labels and their limits, which results must agree on.
KS = """CASE WHEN ks_statistic >= 0.50 THEN '卓越' WHEN ks_statistic >= 0.40 THEN '優秀' WHEN ks_statistic >= 0.20 THEN '許容' ELSE '分離能不足' END"""
IV = """CASE WHEN information_value >= 0.50 THEN '過学習疑い' WHEN information_value >= 0.30 THEN '強い予測力' WHEN information_value >= 0.10 THEN '中程度' WHEN information_value >= 0.02 THEN '弱い予測力' ELSE '無効変数' END"""
DELTA = """CASE WHEN abs(cliffs_delta) >= 0.474 THEN 'Large' WHEN abs(cliffs_delta) >= 0.330 THEN 'Medium' WHEN abs(cliffs_delta) >= 0.147 THEN 'Small' ELSE 'Negligible' END"""
Z = "CASE WHEN abs(z_score_diff) >= 3.0 THEN '有意 (参考)' ELSE '参考値未満' END"

separation_parts("tx", "long_tx")
separation_parts("ev", "long_ev")


def separation_select(tag: str) -> str:
    return f"""SELECT feature, round(ks_statistic, 6) AS ks_statistic, ks_rating, round(information_value, 6) AS information_value, iv_rating,
  round(cliffs_delta, 6) AS cliffs_delta, round(cliffs_delta_abs, 6) AS cliffs_delta_abs, cliffs_rating,
  round(z_score_diff, 6) AS z_score_diff, round(z_score_diff_abs, 6) AS z_score_diff_abs, z_rating, is_strong_separator
FROM separation_{tag}"""


# --- data movement ---------------------------------------------------------------------------------------------

ORACLE["copy_source"] = sql('SELECT * FROM tx WHERE "Time" IS NOT NULL', "tx")
ORACLE["add_hour"] = sql("SELECT * FROM txh", "txh")
ORACLE["assign_pseudo_day"] = sql("SELECT * FROM sliced", "sliced")
ORACLE["extract_day"] = sql('SELECT "Time", V1, V2, V3, Amount, Class, score, "Date" FROM sliced WHERE "Date" = 15', "sliced")
ORACLE["overwrite_slice"] = sql('SELECT * FROM sliced WHERE "Date" = 7', "sliced")
ORACLE["split_by_day"] = sql(
    """SELECT count(*) AS n_rows, count(*) FILTER (Class = 1) AS n_pos,
  CASE WHEN "Date" <= 31 THEN 'scoring' WHEN "Date" <= 36 THEN 'validation' ELSE 'training' END AS part
FROM sliced GROUP BY 3""",
    "sliced",
)

ORACLE["slices_of_ties"] = sql("SELECT (count(*) - 15) // 50 + 1 AS n_rows, CAST(0 AS BIGINT) AS n_differ FROM tx", "tx")

# --- the trained model: what holds whatever the trees ----------------------------------------------------------

ORACLE["train_summary"] = sql(
    f"""SELECT TRUE AS trees_in_range, CAST(0 AS BIGINT) AS n_unknown_features, count(*) AS least_root_rows, count(*) AS most_root_rows,
  round(count(*) / {D('4')}, 3) AS first_root_cover FROM sliced WHERE "Date" BETWEEN 37 AND 50""",
    "sliced",
)
ORACLE["predict_summary"] = sql(
    """SELECT "Date", Class, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_unscored, CAST(0 AS BIGINT) AS n_mislabelled
FROM sliced WHERE "Date" BETWEEN 1 AND 31 GROUP BY 1, 2""",
    "sliced",
)
ORACLE["explain_summary"] = sql('SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_off FROM sliced WHERE "Date" BETWEEN 1 AND 31', "sliced")

# --- features --------------------------------------------------------------------------------------------------

ORACLE["unpivot_features"] = sql("SELECT * FROM long_tx", "long_tx")
ORACLE["ks_statistic"] = sql("SELECT feature_name AS feature, round(ks_statistic, 6) AS ks_statistic FROM ranked_tx", "ranked_tx")
ORACLE["cliffs_delta"] = sql("SELECT feature_name AS feature, round(cliffs_delta, 6) AS cliffs_delta FROM ranked_tx", "ranked_tx")
ORACLE["z_score_diff"] = sql(
    """SELECT feature_name AS feature, round(mean_pos, 6) AS mean_pos, round(mean_neg, 6) AS mean_neg,
  round(std_neg, 6) AS std_neg, round(z_score_diff, 6) AS z_score_diff FROM z_tx""",
    "z_tx",
)
for _query, _mode in (("information_value", "ntile"), ("information_value_floor", "floor")):
    ORACLE[_query] = sql(
        f"SELECT feature_name AS feature, round(information_value, 6) AS information_value FROM iv_{_mode}_tx", f"iv_{_mode}_tx"
    )
ORACLE["feature_separation"] = sql(separation_select("tx"), "separation_tx")
ORACLE["feature_separation_events"] = sql(separation_select("ev"), "separation_ev")
ORACLE["woe_bins"] = sql(
    """SELECT feature_name AS feature, CAST(bin_id AS BIGINT) AS bin_id, round(bin_min, 6) AS bin_min, round(bin_max, 6) AS bin_max, n_rows, n_pos, n_neg,
  round(dist_pos, 6) AS dist_pos, round(dist_neg, 6) AS dist_neg, round(woe, 6) AS woe, round(iv_contribution, 6) AS iv_contribution
FROM bins_ntile_tx""",
    "bins_ntile_tx",
)
part(
    "shape_tx",
    f"""SELECT feature_name, n_pos, n_neg, m3 / pow(m2, {D('1.5')}) AS skewness, m4 / (m2 * m2) - 3 AS kurtosis FROM (
  SELECT feature_name, count(*) FILTER (class_label = 1) AS n_pos, count(*) FILTER (class_label = 0) AS n_neg,
    avg(pow(feature_value - mean_pos, 2)) FILTER (class_label = 1) AS m2,
    avg(pow(feature_value - mean_pos, 3)) FILTER (class_label = 1) AS m3,
    avg(pow(feature_value - mean_pos, 4)) FILTER (class_label = 1) AS m4
  FROM long_tx JOIN (SELECT feature_name AS f, mean_pos FROM z_tx) ON feature_name = f GROUP BY 1)""",
    "long_tx",
    "z_tx",
)
part(
    "pvalue_tx",
    f"""SELECT feature_name, CASE WHEN l < 0.2 THEN {D('1')} ELSE greatest(0, least(1, q)) END AS ks_pvalue FROM (
  SELECT feature_name, max(l) AS l, sum((CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END) * exp(-2 * {D('k')} * k * l * l)) AS q
  FROM (SELECT r.feature_name, sqrt({D('n_pos')} * n_neg / (n_pos + n_neg)) * ks_statistic AS l
    FROM ranked_tx AS r JOIN shape_tx AS s ON r.feature_name = s.feature_name), range(1, 101) AS t(k) GROUP BY 1)""",
    "ranked_tx",
    "shape_tx",
)
ORACLE["feature_report_bins"] = sql("SELECT feature_name AS feature, CAST(bin_id AS BIGINT) AS bin_id, round(woe, 6) AS woe FROM bins_floor_tx", "bins_floor_tx")
# One day's exact p-values: the chance of i positives after t values, step by step; what reaches the bound stops and counts.
part(
    "day_long",
    " UNION ALL ".join(f"""SELECT Class AS c, '{f}' AS feature, CAST("{f}" AS DOUBLE) AS v FROM sliced WHERE "Date" = 15""" for f in ("V1", "V2", "V3", "Amount", "Hour")),
    "sliced",
)
part(
    "day_bound",
    """SELECT feature, max(n1) AS m, max(n0) AS n, max(abs(i * n0 - (t - i) * n1)) AS h FROM (
  SELECT feature, v, sum(c) OVER upto AS i, count(*) OVER upto AS t, sum(c) OVER whole AS n1, sum(1 - c) OVER whole AS n0 FROM day_long
  WINDOW upto AS (PARTITION BY feature ORDER BY v), whole AS (PARTITION BY feature)) GROUP BY 1""",
    "day_long",
)
part(
    "paths",
    f"""SELECT feature, 0 AS t, 0 AS i, {D('1')} AS p, m, n, h, FALSE AS reached FROM day_bound WHERE m > 0 AND n > 0
UNION ALL SELECT feature, t + 1, k, sum(q), m, n, h, abs(k * n - (t + 1 - k) * m) >= h FROM (
  SELECT feature, t, i + up AS k, p * CASE up WHEN 1 THEN m - i ELSE n - (t - i) END / (m + n - t) AS q, m, n, h
  FROM paths, (SELECT unnest([0, 1]) AS up) WHERE NOT reached AND t < m + n) WHERE q > 0 GROUP BY feature, t, k, m, n, h""",
    "day_bound",
)
ORACLE["exact_ks_pvalue"] = sql(
    """SELECT feature, round(h / (m * n), 6) AS ks_statistic, round(coalesce(sum(p) FILTER (reached), 0), 6) AS ks_pvalue FROM paths GROUP BY feature, m, n, h""", "paths"
).replace("WITH ", "WITH RECURSIVE ", 1)
ORACLE["feature_report"] = sql(
    f"""SELECT k.feature_name AS feature, round(z_score_diff, 6) AS z_score_diff, round(ks_statistic, 6) AS ks_statistic,
  round(ks_pvalue, 6) AS ks_pvalue, round(cliffs_delta, 6) AS cliffs_delta, round(skewness, 6) AS skewness_fraud,
  round(kurtosis, 6) AS kurtosis_fraud, round(information_value, 6) AS information_value, {KS} AS ks_rating, {IV} AS iv_rating,
  {DELTA} AS cliffs_rating, {Z} AS z_rating, ks_statistic >= 0.40 AND abs(cliffs_delta) >= 0.33 AS is_strong_separator,
  n_woe_bins, round(first_woe, 6) AS first_woe, round(last_woe, 6) AS last_woe
FROM ranked_tx AS k JOIN iv_floor_tx USING (feature_name) JOIN z_tx USING (feature_name) JOIN shape_tx USING (feature_name)
JOIN pvalue_tx USING (feature_name)
JOIN (SELECT feature_name, count(*) AS n_woe_bins, arg_min(woe, bin_id) AS first_woe, arg_max(woe, bin_id) AS last_woe
  FROM bins_floor_tx GROUP BY 1) USING (feature_name)""",
    "ranked_tx",
    "iv_floor_tx",
    "shape_tx",
    "pvalue_tx",
)
part(
    "drawn",
    f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feature_name, class_label ORDER BY draw, feature_value) AS turn FROM (
  {" UNION ALL ".join(
      f'''SELECT CAST(Class AS BIGINT) AS class_label, '{f}' AS feature_name, CAST("{f}" AS DOUBLE) AS feature_value,
    (("Time" * {D('7919')} + floor(Amount * {D('100')} + {D('0.5')})) % {D('9973')}) * {D('1e9')} + "Time" * {D('1e3')} + V1 AS draw FROM txh'''
      for f in ("V1", "V2", "V3", "Amount", "Hour")
  )})) WHERE turn <= CASE WHEN class_label = 1 THEN 500 ELSE 1000 END""",
    "txh",
)
ORACLE["sampled_cliffs_delta"] = sql(
    f"""SELECT p.feature_name AS feature,
  round(sum(CASE WHEN p.feature_value > n.feature_value THEN 1 WHEN p.feature_value < n.feature_value THEN -1 ELSE 0 END) / {D('count(*)')}, 6) AS cliffs_delta
FROM drawn AS p JOIN drawn AS n ON p.feature_name = n.feature_name AND p.class_label = 1 AND n.class_label = 0 GROUP BY 1""",
    "drawn",
)

# --- scores ----------------------------------------------------------------------------------------------------


def score_parts(tag: str, pred: str) -> None:
    part(
        f"counts_{tag}",
        f"SELECT count(*) AS n_rows, count(*) FILTER (class_label = 1) AS n_pos, count(*) FILTER (class_label = 0) AS n_neg FROM {pred}",
        pred,
    )
    part(
        f"ordered_{tag}",
        f"""SELECT class_label, row_number() OVER w AS rnk, sum(class_label) OVER w AS tp, sum(1 - class_label) OVER w AS fp
FROM {pred} WINDOW w AS (ORDER BY p DESC, amount, class_label ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        pred,
    )
    part(
        f"ranking_{tag}",
        f"""SELECT n_rows, n_pos, n_neg, k_0_1, k_0_5,
  coalesce(sum(CASE WHEN class_label = 1 THEN tp / {D('tp + fp')} / n_pos ELSE 0 END), 0) AS pr_auc,
  count(*) FILTER (class_label = 1 AND rnk <= k_0_1) / {D('n_pos')} AS capture_rate_0_1pct,
  count(*) FILTER (class_label = 1 AND rnk <= k_0_5) / {D('n_pos')} AS capture_rate_0_5pct
FROM ordered_{tag}, (SELECT *, greatest(CAST(ceil(n_rows * {D('0.001')}) AS BIGINT), 1) AS k_0_1,
  greatest(CAST(ceil(n_rows * {D('0.005')}) AS BIGINT), 1) AS k_0_5 FROM counts_{tag})
GROUP BY 1, 2, 3, 4, 5""",
        f"ordered_{tag}",
        f"counts_{tag}",
    )
    part(
        f"curve_{tag}",
        f"""SELECT *, expected_loss = min(expected_loss) OVER () AS is_optimal_threshold FROM (
  SELECT *, fn_loss + fp_loss + tp_cost AS expected_loss FROM (
    SELECT threshold,
      sum(CASE WHEN p < threshold AND class_label = 1 THEN amount + {D('15')} ELSE 0 END) AS fn_loss,
      count(*) FILTER (p >= threshold AND class_label = 0) * {D('5')} AS fp_loss,
      count(*) FILTER (p >= threshold AND class_label = 1) * {D('0.1')} AS tp_cost,
      count(*) FILTER (p >= threshold AND class_label = 1) AS tp_count,
      count(*) FILTER (p < threshold AND class_label = 1) AS fn_count,
      count(*) FILTER (p >= threshold AND class_label = 0) AS fp_count,
      count(*) FILTER (p < threshold AND class_label = 0) AS tn_count
    FROM {pred}, (SELECT i / {D('100')} AS threshold FROM range(1, 100) AS t(i)) GROUP BY 1))""",
        pred,
    )
    part(
        f"best_{tag}",
        f"""SELECT threshold AS optimal_threshold, expected_loss AS min_expected_loss, fn_loss AS fn_loss_at_opt,
  fp_loss AS fp_loss_at_opt, tp_cost AS tp_cost_at_opt FROM curve_{tag} ORDER BY expected_loss, threshold LIMIT 1""",
        f"curve_{tag}",
    )
    part(
        f"imbalance_{tag}",
        f"""SELECT *,
  CASE WHEN n_pos = 0 THEN 'データ不足' WHEN pr_auc >= 0.80 THEN 'PASS' ELSE 'FAIL' END AS pr_auc_rating,
  CASE WHEN n_pos = 0 THEN 'データ不足' WHEN capture_rate_0_1pct >= 0.75 THEN 'PASS' ELSE 'FAIL' END AS capture_0_1_rating,
  CASE WHEN n_pos = 0 THEN 'データ不足' WHEN capture_rate_0_5pct >= 0.90 THEN 'PASS' ELSE 'FAIL' END AS capture_0_5_rating
FROM ranking_{tag}, best_{tag}""",
        f"ranking_{tag}",
        f"best_{tag}",
    )
    part(
        f"confusion_{tag}",
        f"""SELECT count(*) FILTER (p >= 0.5 AND class_label = 1) AS tp, count(*) FILTER (p >= 0.5 AND class_label <> 1) AS fp,
  count(*) FILTER (p < 0.5 AND class_label = 1) AS fn, count(*) FILTER (p < 0.5 AND class_label <> 1) AS tn,
  avg(-CASE WHEN class_label = 1 THEN ln(p) ELSE ln(1 - p) END) AS log_loss FROM {pred}""",
        pred,
    )
    part(
        f"area_{tag}",
        f"""SELECT (sum(CASE WHEN class_label = 1 THEN mid_rank ELSE 0 END) - n_pos * {D('n_pos + 1')} / 2) / ({D('n_pos')} * n_neg) AS roc_auc
FROM (SELECT class_label, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / {D('2')} AS mid_rank FROM {pred}), counts_{tag}
GROUP BY n_pos, n_neg""",
        pred,
        f"counts_{tag}",
    )
    part(
        f"evaluation_{tag}",
        f"""SELECT tp / {D('tp + fp')} AS precision, tp / {D('tp + fn')} AS recall, (tp + tn) / {D('tp + fp + fn + tn')} AS accuracy,
  2 * tp / {D('2 * tp + fp + fn')} AS f1_score, log_loss, roc_auc FROM confusion_{tag}, area_{tag}""",
        f"confusion_{tag}",
        f"area_{tag}",
    )


score_parts("all", "pred_all")
score_parts("daily", "pred_daily")

ORACLE["pr_auc"] = sql("SELECT n_pos, round(pr_auc, 6) AS pr_auc FROM ranking_all", "ranking_all")
ORACLE["capture_rate"] = sql("SELECT k_0_5 AS k, round(capture_rate_0_5pct, 6) AS capture_rate FROM ranking_all", "ranking_all")
ORACLE["cost_curve"] = sql(
    """SELECT round(threshold, 3) AS threshold, round(fn_loss, 3) AS fn_loss, round(fp_loss, 3) AS fp_loss, round(tp_cost, 3) AS tp_cost,
  round(expected_loss, 3) AS expected_loss, tp_count, fn_count, fp_count, tn_count, is_optimal_threshold FROM curve_all""",
    "curve_all",
)
ORACLE["optimal_threshold"] = sql(
    """SELECT round(optimal_threshold, 3) AS optimal_threshold, round(min_expected_loss, 3) AS min_expected_loss,
  round(fn_loss_at_opt, 3) AS fn_loss_at_opt, round(fp_loss_at_opt, 3) AS fp_loss_at_opt, round(tp_cost_at_opt, 3) AS tp_cost_at_opt
FROM best_all""",
    "best_all",
)
ORACLE["imbalance_metrics"] = sql(
    """SELECT n_rows, n_pos, n_neg, round(pr_auc, 6) AS pr_auc, pr_auc_rating, round(capture_rate_0_1pct, 6) AS capture_rate_0_1pct,
  round(capture_rate_0_5pct, 6) AS capture_rate_0_5pct, k_0_1, k_0_5, capture_0_1_rating, capture_0_5_rating,
  round(optimal_threshold, 6) AS optimal_threshold, round(min_expected_loss, 3) AS min_expected_loss,
  round(fn_loss_at_opt, 3) AS fn_loss_at_opt, round(fp_loss_at_opt, 3) AS fp_loss_at_opt, round(tp_cost_at_opt, 3) AS tp_cost_at_opt
FROM imbalance_all""",
    "imbalance_all",
)
ORACLE["evaluate_scores"] = sql(
    """SELECT round(precision, 6) AS precision, round(recall, 6) AS recall, round(accuracy, 6) AS accuracy, round(f1_score, 6) AS f1_score,
  round(log_loss, 6) AS log_loss, round(roc_auc, 6) AS roc_auc FROM evaluation_all""",
    "evaluation_all",
)
ORACLE["daily_kpis"] = sql(
    f"""SELECT count(*) AS transactions, count(*) FILTER (score >= 0.5) AS detected_frauds,
  round(count(*) FILTER (score >= 0.5) * {D('100')} / count(*), 6) AS fraud_pct FROM sliced WHERE "Date" BETWEEN 1 AND 31""",
    "sliced",
)


def psi_part(name: str, daily_where: str) -> None:
    def side(where: str) -> str:
        return f"""(SELECT b, n, sum(n) OVER () AS total FROM
    (SELECT least(CAST(floor(score * 10) AS BIGINT), 9) AS b, count(*) AS n FROM sliced WHERE {where} GROUP BY 1))"""

    part(
        name,
        f"""SELECT *, sum(psi_contribution) OVER () AS psi FROM (
  SELECT *, (daily_pct - baseline_pct) * ln(daily_pct / baseline_pct) AS psi_contribution FROM (
    SELECT i AS bin_id,
      greatest(coalesce(o.n, 0) / {D("max(o.total) OVER ()")}, {D('0.0001')}) AS baseline_pct,
      greatest(coalesce(d.n, 0) / {D("max(d.total) OVER ()")}, {D('0.0001')}) AS daily_pct
    FROM range(0, 10) AS t(i) LEFT JOIN {side('"Date" BETWEEN 37 AND 50')} AS o ON o.b = i LEFT JOIN {side(daily_where)} AS d ON d.b = i))""",
        "sliced",
    )


psi_part("psi_daily", '"Date" BETWEEN 1 AND 31')
psi_part("psi_first", '"Date" BETWEEN 1 AND 15')
PSI_RATING = "CASE WHEN psi < 0.10 THEN 'Green' WHEN psi < 0.25 THEN 'Yellow' ELSE 'Red' END"
PSI_COLUMNS = f"""CAST(bin_id AS BIGINT) AS bin_id, round(baseline_pct, 6) AS baseline_pct, round(daily_pct, 6) AS daily_pct,
  round(psi_contribution, 6) AS psi_contribution, round(psi, 6) AS psi, {PSI_RATING} AS psi_rating"""
ORACLE["psi"] = sql(f"SELECT {PSI_COLUMNS} FROM psi_daily", "psi_daily")
ORACLE["psi_by_edges"] = sql(
    f"""SELECT round(psi, 6) AS psi, {PSI_RATING} AS psi_rating FROM (SELECT sum((n - o) * ln(n / o)) AS psi FROM (
  SELECT greatest(count(*) FILTER (b = i) / {D('count(*)')}, {D('0.0001')}) AS o,
    greatest(count(*) FILTER (b = i AND Class = 1) / {D('count(*) FILTER (Class = 1)')}, {D('0.0001')}) AS n
  FROM range(0, 10) AS t(i), (SELECT Class, (SELECT count(*) FROM range(1, 10) AS e(j) WHERE j * {D('0.1')} <= score) AS b FROM tx)
  GROUP BY i))""",
    "tx",
)

# --- explanation -----------------------------------------------------------------------------------------------

NAMES = ("V1", "V2", "V3", "Hour", "Amount_scaled")
part(
    "attributed",
    f"""SELECT s.*, {D('0.4')} / {D('50')} * (V1 - m1) AS a0, {D('0.5')} / {D('0.1')} * (V2 - m2) AS a1, {D('0')} AS a2, {D('0')} AS a3,
  {D('0.1')} / {D('110000')} * (Amount - m3) AS a4
FROM sliced AS s, (SELECT avg(V1) AS m1, avg(V2) AS m2, avg(Amount) AS m3 FROM sliced WHERE "Date" BETWEEN 37 AND 50)
WHERE "Date" BETWEEN 1 AND 31""",
    "sliced",
)
part(
    "global_raw",
    " UNION ALL ".join(
        f"SELECT '{n}' AS feature, avg(a{i}) AS attribution, avg(abs(a{i})) AS mean_abs_shap FROM attributed" for i, n in enumerate(NAMES)
    ),
    "attributed",
)
part(
    "global_explained",
    """SELECT *, is_audit_variable AND rank_shap <= 5 AS audit_in_top5 FROM (
  SELECT feature, attribution, abs(attribution) AS abs_attribution, rank() OVER (ORDER BY abs(attribution) DESC) AS rank_shap,
    abs(attribution) / sum(abs(attribution)) OVER () AS shap_share, feature IN ('V1', 'V2') AS is_audit_variable, mean_abs_shap
  FROM global_raw)""",
    "global_raw",
)
ORACLE["linear_global_explain"] = sql(
    """SELECT feature, round(attribution, 6) AS attribution, round(abs_attribution, 6) AS abs_attribution, rank_shap,
  round(shap_share, 6) AS shap_share, is_audit_variable, audit_in_top5, round(mean_abs_shap, 6) AS mean_abs_shap FROM global_explained""",
    "global_explained",
)
part(
    "risky",
    """SELECT * FROM (SELECT *, row_number() OVER (ORDER BY score DESC, "Time", Amount, V1) AS score_rank FROM attributed)
WHERE score >= 0.85 OR score_rank <= 20""",
    "attributed",
)
part(
    "local_explained",
    f"""SELECT "Time", Amount, "Hour", CAST(Class AS BIGINT) AS class_label, CAST(score >= 0.5 AS BIGINT) AS "predicted_Class",
  score AS fraud_probability, name AS shap_feature, a AS shap_attribution, place AS shap_rank, {D('sign(g.attribution)')} AS global_sign,
  {D('sign(a)')} AS local_sign, g.attribution IS NULL OR sign(a) = sign(g.attribution) OR a = 0 AS direction_consistent
FROM (SELECT *, row_number() OVER (PARTITION BY "Time", Amount, V1 ORDER BY abs(a) DESC, i) AS place FROM (
  {" UNION ALL ".join(f"SELECT r.*, {i} AS i, '{n}' AS name, a{i} AS a FROM risky AS r" for i, n in enumerate(NAMES))}))
LEFT JOIN global_raw AS g ON g.feature = name WHERE place <= 5""",
    "risky",
    "global_raw",
)
ORACLE["linear_local_explain"] = sql(
    """SELECT "Time", Amount, "Hour", class_label, "predicted_Class", round(fraud_probability, 6) AS fraud_probability, shap_feature,
  round(shap_attribution, 6) AS shap_attribution, shap_rank, global_sign, local_sign, direction_consistent FROM local_explained""",
    "local_explained",
)
part(
    "importance",
    """SELECT *, top5_gain_share >= 0.60 AS top5_gain_concentrated, cover_share < 0.005 AND gain_share > 0.05 AS cover_overfit_flag FROM (
  SELECT *, sum(CASE WHEN rank_gain <= 5 THEN gain_share ELSE 0 END) OVER () AS top5_gain_share FROM (
    SELECT feature, g AS importance_gain, c AS importance_cover, w AS importance_weight,
      rank() OVER (ORDER BY g DESC) AS rank_gain, rank() OVER (ORDER BY c DESC) AS rank_cover, rank() OVER (ORDER BY w DESC) AS rank_weight,
      g / sum(g) OVER () AS gain_share, c / sum(c) OVER () AS cover_share, w / sum(w) OVER () AS weight_share
    FROM (SELECT feature_name AS feature, abs(z_score_diff) AS g, std_neg AS c, abs(mean_neg) AS w FROM z_tx)))""",
    "z_tx",
)
ORACLE["importance_report"] = sql(
    """SELECT feature, round(importance_gain, 6) AS importance_gain, round(importance_cover, 6) AS importance_cover,
  round(importance_weight, 6) AS importance_weight, rank_gain, rank_cover, rank_weight, round(gain_share, 6) AS gain_share,
  round(cover_share, 6) AS cover_share, round(weight_share, 6) AS weight_share, round(top5_gain_share, 6) AS top5_gain_share,
  top5_gain_concentrated, cover_overfit_flag FROM importance""",
    "importance",
)

# --- scorecards ------------------------------------------------------------------------------------------------

STAMP = "DATE '2024-01-15' AS evaluation_date, TIMESTAMP '2024-01-15 03:00:00' AS evaluated_at"
CATEGORY = {1: "① 分布乖離・判別力", 2: "② BQML 固有説明性", 3: "③ 予測性能・不均衡適応", 4: "④ 安定性・経時変化"}


def feature_row(source: str, category: int, metric: str, label: str, value: str, rating: str, rank: str, flag: str) -> str:
    label = label.replace("'", "''")
    return f"""SELECT {STAMP}, feature, CAST({category} AS BIGINT) AS category_id, '{CATEGORY[category]}' AS category_name, '{metric}' AS metric_name,
  '{label}' AS metric_label, round({value}, 6) AS metric_value, {rating} AS rating, CAST({rank} AS BIGINT) AS rank_value, {flag} AS is_flagged FROM {source}"""


OVERFIT = "CASE WHEN cover_overfit_flag THEN '過学習疑い' ELSE '記録' END"
AUDIT = """CASE WHEN is_audit_variable AND rank_shap <= 5 THEN '監査OK' WHEN is_audit_variable AND rank_shap > 5 THEN '監査要確認' ELSE '記録' END"""
ORACLE["feature_matrix"] = sql(
    " UNION ALL ".join(
        [
            feature_row("separation_tx", 1, "ks_statistic", "KS統計量", "ks_statistic", "ks_rating", "NULL", "ks_rating = '分離能不足'"),
            feature_row(
                "separation_tx", 1, "information_value", "IV (Information Value)", "information_value", "iv_rating", "NULL", "iv_rating IN ('無効変数', '過学習疑い')"
            ),
            feature_row(
                "separation_tx", 1, "cliffs_delta", "Cliff's Delta (|δ|)", "cliffs_delta_abs", "cliffs_rating", "NULL", "cliffs_rating = 'Negligible'"
            ),
            feature_row("separation_tx", 1, "z_score_diff", "Zスコア差 (|ΔZ|)", "z_score_diff_abs", "z_rating", "NULL", "FALSE"),
            feature_row("importance", 2, "importance_gain", "ML.FEATURE_IMPORTANCE (Gain)", "importance_gain", OVERFIT, "rank_gain", "FALSE"),
            feature_row("importance", 2, "importance_cover", "ML.FEATURE_IMPORTANCE (Cover)", "importance_cover", OVERFIT, "rank_cover", "cover_overfit_flag"),
            feature_row(
                "global_explained", 2, "mean_abs_shap", "ML.GLOBAL_EXPLAIN (Tree SHAP)", "abs_attribution", AUDIT, "rank_shap", "is_audit_variable AND rank_shap > 5"
            ),
        ]
    ),
    "separation_tx",
    "importance",
    "global_explained",
)


def model_row(order, source, category, metric, label, value, rating, passed, limit="NULL", warn="NULL") -> str:
    return f"""SELECT {STAMP}, CAST({category} AS BIGINT) AS category_id, '{CATEGORY[category]}' AS category_name, '{metric}' AS metric_name,
  '{label}' AS metric_label, round({D(value)}, 3) AS metric_value, {D(limit)} AS threshold_pass, {D(warn)} AS threshold_warn,
  {rating} AS rating, {passed} AS is_pass, CAST({order} AS BIGINT) AS sort_order FROM {source}"""


ORACLE["evaluation_matrix"] = sql(
    " UNION ALL ".join(
        [
            model_row(1, "imbalance_daily", 3, "pr_auc", "PR-AUC", "pr_auc", "pr_auc_rating", "pr_auc_rating = 'PASS'", "0.80"),
            model_row(
                2, "imbalance_daily", 3, "capture_rate_0_1pct", "Top-0.1% Capture Rate", "capture_rate_0_1pct", "capture_0_1_rating", "capture_0_1_rating = 'PASS'", "0.75"
            ),
            model_row(
                3, "imbalance_daily", 3, "capture_rate_0_5pct", "Top-0.5% Capture Rate", "capture_rate_0_5pct", "capture_0_5_rating", "capture_0_5_rating = 'PASS'", "0.90"
            ),
            model_row(4, "imbalance_daily", 3, "cost_sensitive_expected_loss", "Cost-Sensitive Expected Loss", "min_expected_loss", "'最小化済み'", "TRUE"),
            model_row(5, "imbalance_daily", 3, "optimal_threshold", "最適閾値 P*", "optimal_threshold", "'記録'", "TRUE"),
            model_row(
                6, "(SELECT DISTINCT psi FROM psi_daily)", 4, "psi", "PSI (Population Stability Index)", "psi", PSI_RATING, "psi < 0.10", "0.10", "0.25"
            ),
            model_row(
                7,
                "(SELECT any_value(top5_gain_share) AS s FROM importance)",
                2,
                "top5_gain_share",
                "上位5変数 Gain 占有率",
                "s",
                "CASE WHEN s >= 0.60 THEN 'PASS' ELSE 'FAIL' END",
                "s >= 0.60",
                "0.60",
            ),
            model_row(
                8,
                "(SELECT count(*) FILTER (audit_in_top5) AS hit, count(*) FILTER (is_audit_variable) AS present FROM global_explained)",
                2,
                "audit_vars_in_shap_top5",
                "監査変数の Tree SHAP 上位5入り件数",
                "hit",
                "CASE WHEN hit = present THEN '監査OK' ELSE '監査要確認' END",
                "hit = present",
                "3.0",
            ),
            model_row(
                9,
                f"(SELECT count(*) FILTER (direction_consistent) / {D('count(*)')} AS c FROM local_explained)",
                2,
                "local_shap_direction_consistency",
                "局所 SHAP 寄与方向の整合率",
                "c",
                "CASE WHEN c >= 0.80 THEN 'PASS' ELSE '要確認' END",
                "c >= 0.80",
                "0.80",
            ),
            model_row(10, "evaluation_daily", 3, "roc_auc", "ROC-AUC (参考値)", "roc_auc", "'参考値'", "TRUE"),
            model_row(11, "evaluation_daily", 3, "precision", "Precision (参考値)", "precision", "'参考値'", "TRUE"),
            model_row(12, "evaluation_daily", 3, "recall", "Recall (参考値)", "recall", "'参考値'", "TRUE"),
            model_row(13, "evaluation_daily", 3, "f1_score", "F1スコア (参考値)", "f1_score", "'参考値'", "TRUE"),
        ]
    ),
    "imbalance_daily",
    "psi_daily",
    "importance",
    "global_explained",
    "local_explained",
    "evaluation_daily",
)

# --- history ---------------------------------------------------------------------------------------------------

# The first run of 15 January is kept; the second of that date is not; the run of 4 February (JST) is the current table.
ORACLE["snapshot_history"] = sql(f"SELECT {STAMP}, {PSI_COLUMNS} FROM psi_first", "psi_first")
ORACLE["history_series"] = sql(
    f"""SELECT {STAMP}, {PSI_COLUMNS} FROM psi_first
UNION ALL SELECT DATE '2024-02-04', TIMESTAMP '2024-02-03 16:30:00', {PSI_COLUMNS} FROM psi_daily""",
    "psi_first",
    "psi_daily",
)
PERIOD = """CASE WHEN "Date" <= 16 THEN make_date(2024, 1, "Date") ELSE make_date(2024, 2, "Date" - 16) END"""
part(
    "psi_days",
    f"""SELECT "Date", sum((n - o) * ln(n / o)) AS psi FROM (
  SELECT "Date", i, greatest(n / {D('sum(n) OVER (PARTITION BY "Date")')}, {D('0.0001')}) AS n, greatest(o / {D('total')}, {D('0.0001')}) AS o FROM (
    SELECT "Date", i, count(*) FILTER (b = i) AS n FROM (SELECT "Date", least(floor(score * 10), 9) AS b FROM sliced WHERE "Date" <= 31), range(10) AS t(i) GROUP BY 1, 2)
  JOIN (SELECT i, count(*) FILTER (b = i) AS o, count(*) AS total FROM (SELECT least(floor(score * 10), 9) AS b FROM sliced WHERE "Date" BETWEEN 37 AND 50), range(10) AS t(i) GROUP BY 1) USING (i))
GROUP BY 1""",
    "sliced",
)
ORACLE["psi_by_day"] = sql(f'SELECT "Date", round(psi, 6) AS psi, {PSI_RATING} AS psi_rating FROM psi_days', "psi_days")
part(
    "month_order",
    """SELECT date_trunc('month', period) AS period, class_label, sum(class_label) OVER best AS tp, count(*) OVER best AS n,
  sum(class_label) OVER (PARTITION BY date_trunc('month', period)) AS n_pos
FROM (SELECT CAST(Class AS BIGINT) AS class_label, Amount, score, """
    + PERIOD
    + """ AS period FROM sliced WHERE "Date" <= 31)
WINDOW best AS (PARTITION BY date_trunc('month', period) ORDER BY score DESC, Amount, class_label ROWS UNBOUNDED PRECEDING)""",
    "sliced",
)
ORACLE["retrain_trigger"] = sql(
    f"""SELECT 'psi_daily' AS signal, {PERIOD} AS period, round(psi, 6) AS metric_value, {D('0.25')} AS limit_value, psi >= 0.25 AS retrain FROM psi_days
UNION ALL SELECT 'pr_auc_monthly', CAST(period AS DATE), round(m, 6), {D('0.80')}, m < 0.80
FROM (SELECT period, sum(CASE WHEN class_label = 1 THEN tp / {D('n')} ELSE 0 END) / max(n_pos) AS m FROM month_order GROUP BY 1)""",
    "psi_days",
    "month_order",
)


def single_days() -> None:
    """The single-table figures, once for each day."""
    columns = """n_rows, n_pos, n_neg, pr_auc, pr_auc_rating, capture_rate_0_1pct, capture_rate_0_5pct, k_0_1, k_0_5, capture_0_1_rating,
  capture_0_5_rating, optimal_threshold, min_expected_loss, fn_loss_at_opt, fp_loss_at_opt, tp_cost_at_opt, precision, recall, accuracy, f1_score, log_loss, roc_auc"""
    figures, curves = [], []
    for day in range(1, 32):
        part(f"pred_d{day}", f'SELECT CAST(Class AS BIGINT) AS class_label, Amount AS amount, score AS p FROM sliced WHERE "Date" = {day}', "sliced")
        score_parts(f"d{day}", f"pred_d{day}")
        figures.append(f'SELECT CAST({day} AS INT) AS "Date", {columns} FROM imbalance_d{day}, evaluation_d{day}')
        curves.append(f'SELECT CAST({day} AS INT) AS "Date", * FROM curve_d{day}')
    part("figures_by_day", " UNION ALL ".join(figures), *[f"{n}_d{d}" for d in range(1, 32) for n in ("imbalance", "evaluation")])
    part("curves_by_day", " UNION ALL ".join(curves), *[f"curve_d{d}" for d in range(1, 32)])


single_days()
ORACLE["metrics_by_day"] = sql(
    """SELECT "Date", n_rows, n_pos, n_neg, pr_auc_rating, k_0_1, k_0_5, capture_0_1_rating, capture_0_5_rating, """
    + ", ".join(
        f"round({f'CASE WHEN isnan(coalesce({c}, 0)) THEN 0 ELSE coalesce({c}, 0) END' if c in ('precision', 'recall', 'f1_score') else c}, {3 if 'loss_at' in c or 'expected' in c or 'cost_at' in c else 6}) AS {c}"
        for c in (
            "pr_auc",
            "capture_rate_0_1pct",
            "capture_rate_0_5pct",
            "optimal_threshold",
            "min_expected_loss",
            "fn_loss_at_opt",
            "fp_loss_at_opt",
            "tp_cost_at_opt",
            "precision",
            "recall",
            "accuracy",
            "f1_score",
            "log_loss",
            "roc_auc",
        )
    )
    + " FROM figures_by_day",
    "figures_by_day",
)
ORACLE["cost_curve_by_day"] = sql(
    """SELECT "Date", round(threshold, 3) AS threshold, round(fn_loss, 3) AS fn_loss, round(fp_loss, 3) AS fp_loss, round(tp_cost, 3) AS tp_cost,
  round(expected_loss, 3) AS expected_loss, tp_count, fn_count, fp_count, tn_count, is_optimal_threshold FROM curves_by_day""",
    "curves_by_day",
)
ORACLE["class_weights"] = sql(
    f"""SELECT CAST(Class AS BIGINT) AS class_label, count(*) AS n, round(sum(count(*)) OVER () / ({D('count(*)')} * count(*) OVER ()), 6) AS class_weight
FROM txh GROUP BY 1""",
    "txh",
)
