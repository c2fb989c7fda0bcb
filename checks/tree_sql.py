"""SQL that trains two small boosted trees from the rows, scores with them, and explains them by the definition of Shapley values.

Every step of the training is spelled out: ranks, bins, gradients and hessians, the gain of every cut, the best cut of every
node, the leaves, and the margins that the next tree starts from.
"""

from __future__ import annotations

from math import factorial

from checks.oracle import NAMES, ORACLE, D, part, sql

TREES, DEPTH, BINS = 2, 2, 16
COLUMNS = ("V1", "V2", "V3", '"Hour"', "Amount")
UNIT = D(f"{2**30}")
STEP, L2, LEAST_GAIN = D("0.3"), D("1"), D("1e-6")


def _x() -> str:
    return "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in COLUMNS) + "]"


def training_parts() -> None:
    n = len(COLUMNS)
    ranks = ", ".join(f"rank() OVER (ORDER BY x[{k + 1}]) - 1 AS r{k}" for k in range(n))
    bins = ", ".join(f"dense_rank() OVER (ORDER BY r{k} * {BINS} // n)" for k in range(n))
    part(
        "tree_rows",
        f"""SELECT id, x, y, [{bins}] AS b, {D('n')} / (2 * count(*) OVER (PARTITION BY y)) AS w FROM (
  SELECT *, {ranks}, count(*) OVER () AS n FROM (
    SELECT row_number() OVER () AS id, Class AS y, {_x()} AS x FROM sliced WHERE "Date" BETWEEN 37 AND 50))""",
        "sliced",
    )
    part("tree_edges", f"SELECT k AS feature, b[k + 1] AS bin, max(x[k + 1]) AS edge FROM tree_rows, range({n}) AS r(k) GROUP BY ALL", "tree_rows")
    part("margin_0", f"SELECT *, {D('0')} AS m FROM tree_rows", "tree_rows")
    for t in range(TREES):
        _tree_parts(t, n)
    part("tree_nodes", " UNION ALL ".join(f"SELECT {t} AS tree_id, * FROM nodes_{t}" for t in range(TREES)), *[f"nodes_{t}" for t in range(TREES)])


def _tree_parts(t: int, n: int) -> None:
    part(
        f"at_{t}_0",
        f"""SELECT id, x, y, b, w, m, floor(w * (p - y) * {UNIT} + {D('0.5')}) AS g, floor(w * (p * (1 - p)) * {UNIT} + {D('0.5')}) AS h, 0 AS node
FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM margin_{t})""",
        f"margin_{t}",
    )
    for level in range(DEPTH):
        here = f"at_{t}_{level}"
        part(f"cells_{t}_{level}", f"SELECT node, k AS feature, b[k + 1] AS bin, sum(g) AS g, sum(h) AS h, count(*) AS n FROM {here}, range({n}) AS r(k) GROUP BY ALL", here)
        part(
            f"cuts_{t}_{level}",
            f"""SELECT *, gl * gl / (hl + {L2}) + (gt - gl) * (gt - gl) / (ht - hl + {L2}) - gt * gt / (ht + {L2}) AS gain FROM (
  SELECT node, feature, bin, sum(g) OVER below / {UNIT} AS gl, sum(h) OVER below / {UNIT} AS hl, sum(n) OVER below AS nl,
    sum(g) OVER whole / {UNIT} AS gt, sum(h) OVER whole / {UNIT} AS ht, sum(n) OVER whole AS nt FROM cells_{t}_{level}
  WINDOW whole AS (PARTITION BY node, feature), below AS (PARTITION BY node, feature ORDER BY bin))""",
            f"cells_{t}_{level}",
        )
        part(
            f"best_{t}_{level}",
            f"""SELECT c.*, edge FROM cuts_{t}_{level} AS c JOIN tree_edges USING (feature, bin)
WHERE nl < nt AND hl >= 1 AND ht - hl >= 1 AND gain > {LEAST_GAIN}
QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, bin) = 1""",
            f"cuts_{t}_{level}",
            "tree_edges",
        )
        part(
            f"at_{t}_{level + 1}",
            f"""SELECT a.* REPLACE (CASE WHEN s.node IS NULL THEN a.node WHEN a.b[s.feature + 1] <= s.bin THEN 2 * a.node + 1 ELSE 2 * a.node + 2 END AS node)
FROM {here} AS a LEFT JOIN best_{t}_{level} AS s ON a.node = s.node""",
            here,
            f"best_{t}_{level}",
        )
    levels = []
    for level in range(DEPTH + 1):
        sums = f"SELECT node, sum(g) / {UNIT} AS g, sum(h) / {UNIT} AS h, count(*) AS n FROM at_{t}_{level} WHERE node >= {2**level - 1} GROUP BY node"
        cut = f"LEFT JOIN best_{t}_{level} AS s USING (node)" if level < DEPTH else ""
        inner = "s.gain IS NOT NULL" if level < DEPTH else "FALSE"
        feature, edge, gain = ("s.feature", "s.edge", "s.gain") if level < DEPTH else ("NULL", "NULL", "NULL")
        levels.append(
            f"""SELECT node AS node_id, -{STEP} * a.g / (a.h + {L2}) AS prediction, a.h AS cover, coalesce({gain}, {D('0')}) AS gain,
  CASE WHEN {inner} THEN 2 * node + 1 ELSE -1 END AS left_child, CASE WHEN {inner} THEN 2 * node + 2 ELSE -1 END AS right_child,
  coalesce({feature}, -1) AS feature_index, {edge} AS threshold, FALSE AS missing_left, a.g AS gradient, a.n AS n_rows FROM ({sums}) AS a {cut}"""
        )
    needs = [f"at_{t}_{level}" for level in range(DEPTH + 1)] + [f"best_{t}_{level}" for level in range(DEPTH)]
    part(f"nodes_{t}", " UNION ALL ".join(levels), *needs)
    part(f"margin_{t + 1}", f"SELECT id, x, y, b, w, m + prediction AS m FROM at_{t}_{DEPTH} JOIN nodes_{t} ON node = node_id", f"at_{t}_{DEPTH}", f"nodes_{t}")


def scoring_parts() -> None:
    part("walk_0", f'SELECT *, row_number() OVER () AS id, {_x()} AS x FROM sliced', "sliced")
    leaves = []
    for t in range(TREES):
        part(f"step_{t}_0", "SELECT id, x, 0 AS node FROM walk_0", "walk_0")
        for level in range(DEPTH):
            part(
                f"step_{t}_{level + 1}",
                f"""SELECT id, x, CASE WHEN feature_index < 0 THEN node WHEN x[feature_index + 1] <= threshold THEN left_child ELSE right_child END AS node
FROM step_{t}_{level} JOIN nodes_{t} ON node = node_id""",
                f"step_{t}_{level}",
                f"nodes_{t}",
            )
        leaves.append(f"SELECT id, {t} AS tree, prediction FROM step_{t}_{DEPTH} JOIN nodes_{t} ON node = node_id")
    needs = [f"step_{t}_{DEPTH}" for t in range(TREES)]
    margin = " + ".join(f"max(prediction) FILTER (tree = {t})" for t in range(TREES))
    part(
        "tree_scored",
        f"SELECT w.* EXCLUDE (score), 1 / (1 + exp(-m)) AS score FROM walk_0 AS w JOIN (SELECT id, {margin} AS m FROM ({' UNION ALL '.join(leaves)}) GROUP BY id) USING (id)",
        "walk_0",
        *needs,
    )


def shapley_parts() -> None:
    """v(S) of a tree: features in S go their way, others go both ways by cover. A feature's value is its mean gain over all orders."""
    n = len(COLUMNS)

    def worth(node: int, level: int) -> str:
        if level == DEPTH:
            return f"v[{node + 1}]"
        a, b = worth(2 * node + 1, level + 1), worth(2 * node + 2, level + 1)
        left, right = f"c[{2 * node + 2}]", f"c[{2 * node + 3}]"
        goes = f"x[f[{node + 1}] + 1] <= e[{node + 1}]"
        known = f"(s >> f[{node + 1}]) & 1 = 1"
        return f"CASE WHEN f[{node + 1}] < 0 THEN v[{node + 1}] WHEN {known} THEN CASE WHEN {goes} THEN {a} ELSE {b} END ELSE ({left} * ({a}) + {right} * ({b})) / ({left} + {right}) END"

    slots = range(2 ** (DEPTH + 1) - 1)
    of = lambda column: "[" + ", ".join(f"max({column}) FILTER (node_id = {k})" for k in slots) + "]"
    part("tree_wide", f"SELECT tree_id, {of('prediction')} AS v, {of('cover')} AS c, {of('feature_index')} AS f, {of('threshold')} AS e FROM tree_nodes GROUP BY tree_id", "tree_nodes")

    def weight(i: int) -> str:
        inside = [factorial(k - 1) * factorial(n - k) / factorial(n) if k else 0.0 for k in range(n + 1)]
        outside = [-factorial(k) * factorial(n - 1 - k) / factorial(n) if k < n else 0.0 for k in range(n + 1)]
        pick = lambda values: "[" + ", ".join(D(repr(v)) for v in values) + "][bit_count(s) + 1]"
        return f"CASE WHEN (s >> {i}) & 1 = 1 THEN {pick(inside)} ELSE {pick(outside)} END"

    sums = ", ".join(f"sum(worth * {weight(i)}) AS a{i}" for i in range(n))
    exact = ", ".join(f"CASE WHEN abs(a{i}) < 1e-12 THEN 0 ELSE a{i} END AS a{i}" for i in range(n))  # a sum over all orders may leave dust
    part(
        "tree_explained",
        f"""SELECT w.*, {exact} FROM tree_scored AS w JOIN (
  SELECT id, {sums} FROM (SELECT id, CAST(s AS INTEGER) AS s, {worth(0, 0)} AS worth FROM tree_scored, tree_wide, range({2**n}) AS r(s)) GROUP BY id) AS e USING (id)""",
        "tree_scored",
        "tree_wide",
    )


training_parts()
scoring_parts()
shapley_parts()

ORACLE["train_small"] = sql(
    """SELECT tree_id, node_id, round(prediction, 6) AS prediction, round(cover, 6) AS cover, round(gain, 6) AS gain, left_child, right_child, feature_index,
  round(threshold, 6) AS threshold, missing_left, round(gradient, 6) AS gradient, n_rows FROM tree_nodes""",
    "tree_nodes",
)
ORACLE["predict_small"] = sql(
    """SELECT "Date", Class, count(*) AS n_rows, count(*) FILTER (score > 0.5) AS n_detected, round(avg(score), 6) AS mean_score, round(max(score), 6) AS most_score
FROM tree_scored WHERE "Date" BETWEEN 1 AND 31 GROUP BY 1, 2""",
    "tree_scored",
)
part(
    "tree_importance",
    f"""SELECT *, top5_gain_share >= 0.60 AS top5_gain_concentrated, cover_share < 0.005 AND gain_share > 0.05 AS cover_overfit_flag FROM (
  SELECT *, sum(CASE WHEN rank_gain <= 5 THEN gain_share ELSE 0 END) OVER () AS top5_gain_share FROM (
    SELECT feature, gain AS importance_gain, cover AS importance_cover, weight AS importance_weight,
      rank() OVER (ORDER BY gain DESC) AS rank_gain, rank() OVER (ORDER BY cover DESC) AS rank_cover, rank() OVER (ORDER BY weight DESC) AS rank_weight,
      gain / sum(gain) OVER () AS gain_share, cover / sum(cover) OVER () AS cover_share, weight / sum(weight) OVER () AS weight_share
    FROM (SELECT {list(NAMES)}[k + 1] AS feature, coalesce(avg(gain), 0) AS gain, coalesce(avg(cover), 0) AS cover, {D('count(node_id)')} AS weight
      FROM range({len(NAMES)}) AS r(k) LEFT JOIN tree_nodes ON feature_index = k GROUP BY k)))""",
    "tree_nodes",
)
ORACLE["feature_importance_small"] = sql(
    """SELECT feature, round(importance_gain, 6) AS importance_gain, round(importance_cover, 6) AS importance_cover,
  round(importance_weight, 6) AS importance_weight, rank_gain, rank_cover, rank_weight, round(gain_share, 6) AS gain_share,
  round(cover_share, 6) AS cover_share, round(weight_share, 6) AS weight_share, round(top5_gain_share, 6) AS top5_gain_share,
  top5_gain_concentrated, cover_overfit_flag FROM tree_importance""",
    "tree_importance",
)
ORACLE["tree_shap_small"] = sql(
    f"""SELECT "Time", Amount, V1, round(score, 6) AS fraud_probability, {", ".join(f"round(a{i}, 6) AS a{i}" for i in range(len(NAMES)))}
FROM tree_explained WHERE "Date" BETWEEN 1 AND 31""",
    "tree_explained",
)
part(
    "tree_global_raw",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS feature, avg(a{i}) AS attribution, avg(abs(a{i})) AS mean_abs_shap FROM tree_explained WHERE "Date" BETWEEN 32 AND 36""" for i, n in enumerate(NAMES)
    ),
    "tree_explained",
)
ORACLE["global_explain_small"] = sql(
    """SELECT feature, round(attribution, 6) AS attribution, round(abs(attribution), 6) AS abs_attribution, rank_shap,
  round(abs(attribution) / sum(abs(attribution)) OVER (), 6) AS shap_share, feature IN ('V1', 'V2') AS is_audit_variable,
  feature IN ('V1', 'V2') AND rank_shap <= 5 AS audit_in_top5, round(mean_abs_shap, 6) AS mean_abs_shap
FROM (SELECT *, rank() OVER (ORDER BY abs(attribution) DESC) AS rank_shap FROM tree_global_raw)""",
    "tree_global_raw",
)
part(
    "tree_risky",
    """SELECT * FROM (SELECT *, row_number() OVER (ORDER BY score DESC, "Time", Amount, V1) AS score_rank FROM tree_explained WHERE "Date" BETWEEN 1 AND 31)
WHERE score >= 0.85 OR score_rank <= 20""",
    "tree_explained",
)
ORACLE["local_explain_small"] = sql(
    f"""SELECT "Time", Amount, "Hour", CAST(Class AS BIGINT) AS class_label, CAST(score > 0.5 AS BIGINT) AS "predicted_Class",
  round(score, 6) AS fraud_probability, name AS shap_feature, round(a, 6) AS shap_attribution, place AS shap_rank,
  {D('sign(g.attribution)')} AS global_sign, {D('sign(a)')} AS local_sign,
  g.attribution IS NULL OR sign(a) = sign(g.attribution) OR a = 0 AS direction_consistent
FROM (SELECT *, row_number() OVER (PARTITION BY "Time", Amount, V1 ORDER BY abs(a) DESC, i) AS place FROM (
  {" UNION ALL ".join(f"SELECT r.*, {i} AS i, '{n}' AS name, a{i} AS a FROM tree_risky AS r" for i, n in enumerate(NAMES))}))
LEFT JOIN tree_global_raw AS g ON g.feature = name WHERE place <= 5""",
    "tree_risky",
    "tree_global_raw",
)
