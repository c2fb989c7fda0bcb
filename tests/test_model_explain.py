from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import boosting, explain, model, scores
from ledgerwatch.operators.boosting import Node
from ledgerwatch.sources import versions

FEATURES = ("V1", "V2", "Amount", "Hour")


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    rng = np.random.default_rng(11)
    n = 3000
    v1, v2, amount, hour = rng.normal(size=n), rng.normal(size=n), rng.gamma(2, 40, n), rng.integers(0, 24, n)
    label = ((v1 + 0.5 * v2 * (amount > 60) + rng.normal(0, 0.4, n)) > 1.6).astype(int)
    rows = [tuple(map(float, r)) + (int(c), int(d)) for *r, c, d in zip(v1, v2, amount, hour, label, rng.integers(1, 51, n))]
    df = spark.createDataFrame(rows, "V1 double, V2 double, Amount double, Hour double, Class int, Date int")
    df = df.withColumn("Time", F.col("V1") * 100)
    path = str(tmp_path_factory.mktemp("model") / "gbt")
    train, valid = df.filter("Date >= 37"), df.filter("Date BETWEEN 32 AND 36")
    return model.train(train, valid, path, FEATURES, max_iter=4, max_depth=3), path, df


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 8 + [(1,)] * 2, "Class int")
    assert {r.class_label: r.class_weight for r in model.class_weights(df).collect()} == {0: 10 / 16, 1: 10 / 4}


def test_scoring_days_and_columns(spark, trained):
    fitted, path, df = trained
    out = model.predict(model.load(spark, path), df)
    assert out.columns == [*df.columns, "predicted_Class", "fraud_probability"]
    assert out.agg(F.max("Date")).first()[0] == 31
    bad = out.filter((F.col("fraud_probability") > 0.5) != (F.col("predicted_Class") == 1)).count()
    assert bad == 0 and out.filter("fraud_probability NOT BETWEEN 0 AND 1").count() == 0
    assert out.groupBy("Class").agg(F.avg("fraud_probability").alias("p")).orderBy("Class").collect()[1].p > 0.5


def scorings(df):
    """(times the plan scores rows, times it reads them)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("ArrowEvalPython [probability"), plan.count("Scan ExistingRDD")


def test_rows_above_a_score_are_scored_once(trained):
    fitted, _, df = trained
    risky = explain.high_risk(model.predict(fitted, df), ("Time",))
    assert scorings(risky) == (2, 2)
    explained = explain.with_attributions(risky, fitted)
    assert scorings(explained) == (2, 2)


def test_evaluation_scores_rows_once_a_reading(trained):
    fitted, _, df = trained
    scored, read = scorings(scores.evaluate(model.predict(fitted, df)))
    assert scored == read > 0


def test_importance_matches_the_trees(spark, trained):
    fitted, path, _ = trained
    nodes = model.tree_nodes(spark, path).collect()
    inner = model.model_features(FEATURES)
    assert inner == ["V1", "V2", "Hour", "Amount_scaled"]
    rows = {r.feature: r for r in model.feature_importance(spark, path, FEATURES).collect()}
    assert set(rows) == set(inner)
    for i, name in enumerate(inner):
        splits = [n for n in nodes if n.left_child >= 0 and n.feature_index == i]
        assert rows[name].importance_weight == len(splits)
        assert rows[name].importance_gain == pytest.approx(np.mean([n.gain for n in splits]) if splits else 0)
        assert rows[name].importance_cover == pytest.approx(np.mean([n.cover for n in splits]) if splits else 0)
    assert sum(r.gain_share for r in rows.values()) == pytest.approx(1)
    assert rows["V1"].top5_gain_share == pytest.approx(1) and rows["V1"].rank_gain == 1


def passes_left(node, value):
    return node.missing_left if not np.isfinite(value) else value <= node.threshold


def expected_margin(tree, number, x, known):
    node = tree[number]
    if node.feature < 0:
        return node.value
    left, right = tree[2 * number + 1], tree[2 * number + 2]
    if node.feature in known:
        return expected_margin(tree, left.node if passes_left(node, x[node.feature]) else right.node, x, known)
    parts = [child.cover * expected_margin(tree, child.node, x, known) for child in (left, right)]
    return sum(parts) / node.cover


def shapley_by_definition(trees, x, d):
    trees = [{n.node: n for n in nodes} for nodes in trees]
    worth = {}
    for size in range(d + 1):
        for known in combinations(range(d), size):
            worth[known] = sum(expected_margin(t, 0, x, set(known)) for t in trees)
    out = []
    for i in range(d):
        total = 0.0
        for size in range(d):
            for others in combinations([j for j in range(d) if j != i], size):
                weight = factorial(size) * factorial(d - size - 1) / factorial(d)
                total += weight * (worth[tuple(sorted({*others, i}))] - worth[others])
        out.append(total)
    return out


def test_attributions_equal_shapley_values_by_definition(spark, trained):
    fitted, path, df = trained
    some = df.orderBy("V1").limit(20).unionByName(df.orderBy(F.desc("V1")).limit(20))
    gaps = some.limit(5).withColumns({"V2": F.lit(None).cast("double"), "Amount": F.lit(float("nan"))})
    out = explain.with_attributions(model.score(fitted, some.unionByName(gaps)), fitted).collect()
    base = explain.base_value(fitted)
    for row in out:
        x = [float("nan") if row[c] is None else float(row[c]) for c in fitted.inputs]
        assert row.attributions == pytest.approx(shapley_by_definition(fitted.trees, x, 4), abs=1e-9)
        log_odds = np.log(row.fraud_probability / (1 - row.fraud_probability))
        assert sum(row.attributions) + base == pytest.approx(log_odds, abs=1e-9)


def random_tree(rng, depth, n_features, number=0, cover=1000.0):
    if depth == 0 or (number and rng.random() < 0.1):
        return [Node(number, 0.0, cover, 1, float(rng.normal()))]
    share = rng.uniform(0.05, 0.95)
    node = Node(number, 0.0, cover, 1, 0.0, int(rng.integers(n_features)), 1, float(rng.normal()), bool(rng.random() < 0.5), 1.0)
    left = random_tree(rng, depth - 1, n_features, 2 * number + 1, cover * share)
    return [node, *left, *random_tree(rng, depth - 1, n_features, 2 * number + 2, cover * (1 - share))]


@pytest.mark.parametrize("depth, n_features", [(0, 1), (1, 1), (3, 2), (5, 7)])
def test_attributions_of_random_trees(depth, n_features):
    rng = np.random.default_rng(depth)
    trees = [random_tree(rng, depth, n_features) for _ in range(3)]
    x = rng.normal(size=(12, n_features))
    x[rng.random(x.shape) < 0.2] = np.nan
    got = explain.attributions([leaf for t in trees for leaf in explain.leaf_paths(t)], x)
    for row, found in zip(x, got):
        assert found == pytest.approx(shapley_by_definition(trees, row, n_features), abs=1e-9)


def test_attributions_of_deep_trees_add_up():
    rng = np.random.default_rng(12)
    tree = random_tree(rng, 12, 30)
    paths = explain.leaf_paths(tree)
    assert max(len(leaf.features) for leaf in paths) > 9
    x = rng.normal(size=(40, 30))
    base = sum(leaf.value * leaf.share.prod() for leaf in paths)
    assert explain.attributions(paths, x).sum(axis=1) + base == pytest.approx(boosting.margins([tree], x), abs=1e-9)


def test_missing_values_are_scored_and_explained(spark, trained):
    fitted, path, df = trained
    gaps = df.limit(1).select("Class", "Date", "Time", "Hour").withColumns(
        {"V1": F.lit(None).cast("double"), "V2": F.lit(0.3), "Amount": F.lit(None).cast("double")}
    )
    row = explain.with_attributions(model.score(fitted, gaps), fitted).first()
    log_odds = np.log(row.fraud_probability / (1 - row.fraud_probability))
    assert sum(row.attributions) + explain.base_value(fitted) == pytest.approx(log_odds, abs=1e-9)


def test_missing_values_learn_their_side(spark, tmp_path):
    """Rows without V1 are mostly positive, as are those with a high V1: they must go right, and left with the sign turned."""
    rng = np.random.default_rng(4)
    v = rng.normal(size=2000)
    gone = rng.random(2000) < 0.2
    label = np.where(gone, rng.random(2000) < 0.9, v > 0.5).astype(int)
    rows = [(None if g else float(x), int(c)) for x, g, c in zip(v, gone, label)]
    df = spark.createDataFrame(rows, "V1 double, Class int")
    for sign, left in ((1.0, False), (-1.0, True)):
        turned = df.withColumn("V1", F.col("V1") * sign)
        fitted = model.train(turned, turned.limit(0), str(tmp_path / f"m{left}"), ("V1",), max_iter=1, max_depth=1)
        assert fitted.trees[0][0].missing_left is left
        p = model.score(fitted, turned.filter("V1 IS NULL")).first().fraud_probability
        assert p > 0.5


def brute_tree(x, y, margin, weights, settings, edges, number=0, rows=None):
    """Nodes of one tree by trying every edge of every feature on the rows themselves."""
    rows = np.arange(len(y)) if rows is None else rows
    p = 1 / (1 + np.exp(-margin))
    w = np.where(y == 1, weights[1], weights[0])
    g, h = (w * (p - y)), (w * p * (1 - p))
    own = (g[rows].sum(), h[rows].sum())
    out = {number: {"g": own[0], "h": own[1], "n": len(rows), "feature": -1}}
    if (number + 1).bit_length() - 1 == settings.max_depth:
        return out
    best = None
    for f in range(x.shape[1]):
        for edge in edges[f]:
            for missing_left in (False, True):
                left = np.where(np.isfinite(x[rows, f]), x[rows, f] <= edge, missing_left)
                a, b = rows[left], rows[~left]
                if not len(a) or not len(b) or h[a].sum() < 1 or h[b].sum() < 1:
                    continue
                gain = g[a].sum() ** 2 / (h[a].sum() + 1) + g[b].sum() ** 2 / (h[b].sum() + 1) - own[0] ** 2 / (own[1] + 1)
                if best is None or gain > best[0] + 1e-7:
                    best = (gain, f, edge, missing_left, a, b)
    if best is None or best[0] <= boosting.LEAST_GAIN:
        return out
    out[number] |= {"feature": best[1], "threshold": best[2], "missing_left": best[3], "gain": best[0]}
    for k, part in ((1, best[4]), (2, best[5])):
        out |= brute_tree(x, y, margin, weights, settings, edges, 2 * number + k, part)
    return out


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(700, 3)), 1)
    x[rng.random(x.shape) < 0.1] = np.nan
    y = ((np.nan_to_num(x[:, 0]) + np.nan_to_num(x[:, 1]) * np.isnan(x[:, 2]) + rng.normal(0, 0.5, 700)) > 0.9).astype(int)
    rows = [(*[None if np.isnan(v) else float(v) for v in r], int(c)) for r, c in zip(x, y)]
    return x, y, spark.createDataFrame(rows, "a double, b double, c double, Class int")


@pytest.mark.parametrize("held", [boosting.HELD_CELLS, 60])
def test_trees_equal_those_of_brute_force(gappy, held, monkeypatch):
    """With all histograms kept (siblings by subtraction) and with nodes counted in parts."""
    monkeypatch.setattr(boosting, "HELD_CELLS", held)
    x, y, df = gappy
    settings = boosting.Settings(max_trees=3, max_depth=3, n_bins=12)
    weights = (len(y) / (2 * (y == 0).sum()), len(y) / (2 * (y == 1).sum()))
    trees, binning = boosting.fit(df, df.limit(0), ("a", "b", "c"), "Class", weights, settings)
    assert len(trees) == 3 and all(1 < len(e) <= 12 for e in binning.edges)
    margin = np.zeros(len(y))
    for tree in trees:
        want = brute_tree(x, y, margin, weights, settings, binning.edges)
        assert {n.node for n in tree.nodes} == set(want)
        for n in tree.nodes:
            w = want[n.node]
            assert (n.feature, n.n_rows) == (w["feature"], w["n"])
            assert (n.gradient, n.cover) == (pytest.approx(w["g"], abs=1e-5), pytest.approx(w["h"], abs=1e-5))
            assert n.value == pytest.approx(-0.3 * w["g"] / (w["h"] + 1), abs=1e-6)
            if n.feature >= 0:
                assert (n.threshold, n.missing_left) == (w["threshold"], w["missing_left"])
                assert n.gain == pytest.approx(w["gain"], abs=1e-4)
        margin += boosting.margins([tree.nodes], x)


def test_training_is_the_same_however_rows_are_split(spark, trained, tmp_path):
    fitted, _, df = trained
    train, valid = df.filter("Date >= 37"), df.filter("Date BETWEEN 32 AND 36")
    again = model.train(train.repartition(5, "V2").sortWithinPartitions("Amount"), valid.repartition(3), str(tmp_path / "m"), FEATURES, max_iter=4, max_depth=3)
    assert again == fitted


def test_a_stored_model_loads_as_it_was(spark, trained):
    fitted, path, df = trained
    loaded = model.load(spark, path)
    assert model.score(loaded, df).exceptAll(model.score(fitted, df)).count() == 0
    assert (loaded.features, loaded.inputs, loaded.scaling) == (fitted.features, fitted.inputs, fitted.scaling)
    n, mean, std = df.filter("Date >= 37").agg(F.count("Amount"), F.avg("Amount"), F.stddev("Amount")).first()
    assert fitted.scaling[-1] == (pytest.approx(mean), pytest.approx(std)) and fitted.scaling[0] == (0.0, 1.0)


def test_a_failed_training_leaves_the_stored_model(spark, trained, tmp_path, monkeypatch):
    fitted, _, df = trained
    path = str(tmp_path / "served")
    fitted.save(spark, path)
    before = versions.current(spark, path)
    bad = df.withColumn("V1", F.when(F.col("V1") > 1, F.raise_error(F.lit("stop")).cast("double")).otherwise(F.col("V1")))
    with pytest.raises(Exception, match="stop"):
        model.train(bad, bad.limit(0), path, FEATURES, max_iter=1, max_depth=1)

    def stop(*_):
        raise RuntimeError("killed")

    for step in ("createDataFrame", None):
        with monkeypatch.context() as m:
            if step:
                m.setattr(type(spark), step, stop)
            else:
                m.setattr(versions, "_files", lambda s, p, f=versions._files: stop() if "/committed/" in p else f(s, p))
            with pytest.raises(RuntimeError, match="killed"):
                fitted.save(spark, path)
        assert versions.current(spark, path) == before and model.load(spark, path).features == fitted.features
    for _ in range(3):
        fitted.save(spark, path)
    assert len(versions.names(spark, f"{path}/versions")) == versions.KEPT_VERSIONS == len(versions.names(spark, f"{path}/committed"))
    with pytest.raises(FileNotFoundError):
        model.load(spark, str(tmp_path / "nothing"))


def test_training_stops_when_validation_stops_gaining(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(float(v), int(c)) for v, c in zip(rng.normal(size=600), rng.random(600) < 0.5)]
    noise = spark.createDataFrame(rows, "V1 double, Class int")
    assert len(model.train(noise, noise.limit(300), str(tmp_path / "n"), ("V1",), max_depth=2).trees) < 10
    one = noise.filter("Class = 1")
    assert len(model.train(one, one, str(tmp_path / "o"), ("V1",), max_iter=3, max_depth=2).trees) >= 1
    none = noise.limit(0)
    empty = model.train(none, none, str(tmp_path / "e"), ("V1",), max_iter=3)
    assert model.score(empty, noise).filter("fraud_probability = 0.5").count() == 600


def test_training_with_missing_values(spark, trained, tmp_path):
    _, _, df = trained
    holes = df.withColumn("Amount", F.when(F.col("V2") < 0.5, F.col("Amount")))
    path = str(tmp_path / "gbt")
    fitted = model.train(holes.filter("Date >= 37"), holes.filter("Date BETWEEN 32 AND 36"), path, FEATURES, max_iter=2, max_depth=2)
    assert model.score(fitted, holes).filter("fraud_probability IS NULL OR isnan(fraud_probability)").count() == 0


def test_global_and_local_tables(spark, trained):
    fitted, path, df = trained
    scored = model.predict(fitted, df)
    overall = explain.global_explain(df, fitted, audit=("V1", "V9"))
    rows = {r.feature: r for r in overall.collect()}
    assert rows["V1"].is_audit_variable and rows["V1"].audit_in_top5 and not rows["V2"].is_audit_variable
    assert sum(r.shap_share for r in rows.values()) == pytest.approx(1)
    assert sorted(r.rank_shap for r in rows.values()) == [1, 2, 3, 4]
    local = explain.local_explain(scored, overall, fitted)
    high = max(20, scored.filter("fraud_probability >= 0.85").count())
    assert local.count() == high * 4
    for r in local.filter("shap_rank = 1").collect():
        assert r.direction_consistent == (r.global_sign == r.local_sign or r.shap_attribution == 0)


def test_high_risk_takes_the_best_rows_even_when_low_or_missing(spark):
    rows = [(float(i), 0.9 if i < 3 else 0.1 + i / 1000) for i in range(30)] + [(99.0, None)]
    df = spark.createDataFrame(rows, "Time double, fraud_probability double")
    assert explain.high_risk(df, ("Time",)).count() == 20
    few = df.filter("fraud_probability IS NULL OR Time < 5")
    assert explain.high_risk(few, ("Time",)).count() == 6
    many = spark.createDataFrame([(float(i), 0.95) for i in range(50)], "Time double, fraud_probability double")
    assert explain.high_risk(many, ("Time",)).count() == 50


def test_copies_of_a_transaction_are_explained_once_each(spark):
    rows = [(1.0, 5.0, 3, 1, 1, 0.99, [0.5, -0.2])] * 3
    df = spark.createDataFrame(
        rows, "Time double, Amount double, Hour int, Class int, predicted_Class int, fraud_probability double, attributions array<double>"
    )
    signs = spark.createDataFrame([("a", 0.3), ("b", 0.1)], "feature string, attribution double")
    out = explain.local_report(df, ["a", "b"], signs).collect()
    assert len(out) == 6 and {(r.shap_feature, r.direction_consistent) for r in out} == {("a", True), ("b", False)}


def test_histograms_are_exact_beyond_the_whole_numbers_of_a_double():
    rng = np.random.default_rng(2)
    at, values = rng.integers(0, 40, 3000), rng.integers(-(1 << 61) // 3000, (1 << 61) // 3000, 3000)
    for size, scale in ((40, 1), (40, 1 << 20), (40, 3000), (30000, 3000)):
        want, got = np.zeros(size, np.int64), np.ones(size, np.int64)
        np.add.at(want, at, values * scale if scale < 3000 else values)
        boosting._add(got, at, values * scale if scale < 3000 else values)
        assert (got - 1 == want).all()


def test_training_keeps_few_rows_of_spark(spark, monkeypatch):
    """The rows that every level of a tree reads are blocks: one row of Spark holds thousands of rows of the table."""
    seen, grow = [], boosting.grow
    monkeypatch.setattr(boosting, "grow", lambda rows, *a: seen.append(rows.count()) or grow(rows, *a))
    df = spark.range(0, 30000, 1, 3).select((F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 97 > 60).cast("int").alias("Class"))
    trees, _ = boosting.fit(df, df.limit(0), ("a",), "Class", (1.0, 1.0), boosting.Settings(max_trees=2, max_depth=2))
    assert len(trees) == 2 and sum(seen) <= 2 * 6
    assert trees[0].nodes[0].n_rows == 30000


def test_tabulated_attributions_equal_the_formula():
    rng = np.random.default_rng(6)
    paths = [leaf for leaf in explain.leaf_paths(random_tree(rng, 7, 9))]
    x = rng.normal(size=(9000, 9))
    x[rng.random(x.shape) < 0.1] = np.inf
    assert any(explain.outcomes(leaf) is None for leaf in paths) and any(explain.outcomes(leaf) is not None for leaf in paths)
    want = np.zeros_like(x)
    for leaf in paths:
        want[:, leaf.features] += explain.leaf_attributions(leaf, x)
    assert explain.attributions(paths, x) == pytest.approx(want, abs=1e-12)


def test_training_deals_rows_to_as_many_tasks_as_they_are_worth(spark, monkeypatch):
    """A task of Python costs more than a walk over a hundred rows, so small partitions are put together, and large ones are not."""
    seen, grow = [], boosting.grow
    monkeypatch.setattr(boosting, "grow", lambda rows, *a: seen.append(rows.rdd.getNumPartitions()) or grow(rows, *a))
    df = spark.range(0, 6000, 1, 60).select((F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 97 > 60).cast("int").alias("Class"))
    train, valid = df.filter("a != 5"), df.filter("a = 5")
    settings = boosting.Settings(max_trees=2, max_depth=2)
    trees, _ = boosting.fit(train, valid, ("a",), "Class", (1.0, 1.0), settings)
    assert seen == [1] * len(trees) and trees[0].nodes[0].n_rows == train.count()
    monkeypatch.setattr(boosting, "MOST_TASK_ROWS", 1000)
    assert [t.nodes for t in boosting.fit(train, valid, ("a",), "Class", (1.0, 1.0), settings)[0]] == [t.nodes for t in trees]
    assert seen[-1] == 6


def test_the_pass_before_a_tree_has_the_loss_and_the_root(spark):
    bins, label = np.array([[1, 2, 2, 0], [3, 1, 3, 3]], np.int16), np.array([0, 1, 1, 0], np.int8)
    margin = np.array([0.5, -1.0, 2.0, 0.0])
    part = [p.tobytes() for p in (bins, label, margin)]
    state = spark.createDataFrame([(*part, False), (*part, True), (*part, True)], f"{boosting.BLOCK}, valid boolean")
    fixed, tree = boosting.Fixed.of(12, (1.0, 3.0)), boosting.Tree(2)
    loss, root = boosting._start(state, fixed, (2, 5))
    want = sum((3.0 if y else 1.0) * np.log1p(np.exp(-m if y else m)) for y, m in zip(label, margin))
    assert loss / 2.0 ** (fixed.shift - boosting.LOSS_ROOM) == pytest.approx(2 * want, abs=1e-5)
    assert (root == boosting._histograms(state.filter("NOT valid"), tree, [0], fixed, (2, 5))[0]).all() and root[0, :, 2].sum() == 4
    assert boosting._start(state.filter("NOT valid"), fixed, (2, 5))[0] is None
