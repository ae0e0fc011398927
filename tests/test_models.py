"""Models, tree explanations, drift and scoring."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import table
from riskloom.operators import boosting, drift, explaining, modelling, ranking, scoring, treeshap
from riskloom.plans.serving import BatchScorer, explain_extremes


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(200):
        y = i % 2
        rows.append((i, *(float(v) for v in rng.normal(5.0 * y, 1, 2)), y))
    return spark.createDataFrame(rows, "transaction_id long, f1 double, f2 double, label int").cache()


@pytest.fixture(scope="module")
def boosted(separable):
    return modelling.train_boosted_trees(
        separable, ["f1", "f2"], n_estimators=6, max_depth=3, learning_rate=0.3, colsample=1.0
    )


@pytest.fixture(scope="module")
def noisy_trees(spark):
    """Deeper trees over four features that interact."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4)).round(3)
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 2] > 0.7)).astype(int)
    rows = [(i, *map(float, x[i]), int(y[i])) for i in range(500)]
    df = spark.createDataFrame(rows, "transaction_id long, a double, b double, c double, d double, label int")
    model = modelling.train_boosted_trees(
        df, list("abcd"), n_estimators=5, max_depth=6, learning_rate=0.3, subsample=1.0, colsample=1.0
    )
    return df, model


def test_select_features(spark):
    df = spark.createDataFrame(
        [(1, 5, 0, "A", "m", "iOS", None, 9.0, 0.5, True)],
        "transaction_id long, transaction_dt long, is_fraud int, card1 string, device_type string, os_family string,"
        " V1 double, transaction_amt double, card1_hist_fraud_rate double, flag boolean",
    )
    out = modelling.select_features(df)
    assert out.columns == ["label", "V1", "transaction_amt", "card1_hist_fraud_rate", "flag"]
    assert tuple(out.first()) == (0, 0.0, 9.0, 0.5, 1.0)


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 42 + [(1,)] * 12, "label int")
    assert modelling.scale_pos_weight(df).first()["scale_pos_weight"] == 3.5
    assert modelling.scale_pos_weight(df.where("label = 0")).first()["scale_pos_weight"] == 1.0
    assert {r["label"]: r["weight"] for r in modelling.class_weights(df).collect()} == {
        0: pytest.approx(54 / 84), 1: pytest.approx(54 / 24),
    }


def test_baseline_separates_and_survives_a_round_trip(spark, separable, tmp_path):
    model = modelling.train_baseline(separable, ["f1", "f2"])
    ap = ranking.pr_auc(modelling.score(model, separable)).first()[0]
    assert ap > 0.95
    again = modelling.load_model(modelling.save_model(model, str(tmp_path / "model")))
    assert ranking.pr_auc(modelling.score(again, separable)).first()[0] == ap


def test_baseline_is_at_the_optimum_of_the_usual_objective(spark):
    """Gradient of 1/2 |w|^2 + C sum(weight * log loss) in the standardized features."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 2))
    y = (x[:, 0] + rng.normal(size=300) > 0.8).astype(int)
    df = spark.createDataFrame(
        [(float(a), float(b), int(c)) for (a, b), c in zip(x, y, strict=True)], "f1 double, f2 double, label int"
    )
    model = modelling.train_baseline(df, ["f1", "f2"])
    scaler, lr = model.stages[1], model.stages[2]
    z = (x - np.array(scaler.mean)) / np.array(scaler.std)
    w, b = np.array(lr.coefficients), lr.intercept
    weight = np.where(y == 1, 300 / (2 * y.sum()), 300 / (2 * (300 - y.sum())))
    residual = weight * (1 / (1 + np.exp(-(z @ w + b))) - y)
    assert np.abs(w + z.T @ residual).max() < 1e-4 and abs(residual.sum()) < 1e-4


def test_boosted_trees_separate(boosted, separable):
    assert ranking.pr_auc(modelling.score(boosted, separable)).first()[0] > 0.95
    assert modelling.model_inputs(boosted) == ["f1", "f2"]


def test_rounds_kept():
    assert boosting.best_round([0.9, 0.5, 0.4, 0.45, 0.3, 0.31]) == 4
    assert boosting.best_round([0.1, 0.5, 0.6]) == 1 and boosting.best_round([0.7]) == 1


def test_early_stopping_stops_while_fitting(separable):
    # Validation labels turned round: every further tree makes them worse.
    wrong = separable.withColumn("label", 1 - F.col("label"))
    model = modelling.train_boosted_trees(
        separable, ["f1", "f2"], wrong, n_estimators=30, max_depth=2, learning_rate=0.3, colsample=1.0, early_stopping=3
    )
    assert model.best_iteration == 1 and model.params["rounds_fitted"] == 4 and len(model.losses) == 5


def test_boosted_trees_survive_a_round_trip(boosted, separable, tmp_path):
    again = modelling.load_boosted_trees(modelling.save_model(boosted, str(tmp_path / "trees")))
    assert again.features == boosted.features and again.params == boosted.params
    scores = [[r["score"] for r in modelling.score(m, separable).collect()] for m in (boosted, again)]
    assert scores[0] == scores[1]


def naive_booster(x, y, edges, rounds, depth, rate, weight, columns_of, used_of, ridge=1.0, least=1.0):
    """Second-order boosting by loops over thresholds: (margins, nodes of each tree) on the same bins."""
    base = np.log(y.sum() * weight / (len(y) - y.sum()))
    margin, trees = np.full(len(y), base), []
    w = np.where(y == 1, weight, 1.0)
    for r in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        used, columns, out = used_of(r), columns_of(r), []

        def grow(mine, d):
            G, H = g[mine & used].sum(), h[mine & used].sum()  # noqa: B023
            best = (1e-6, None, None)
            if d < depth:
                for f in columns:  # noqa: B023
                    for cut in edges[f]:
                        left = mine & (x[:, f] <= cut)
                        a, b = g[left & used].sum(), h[left & used].sum()  # noqa: B023
                        if b < least or H - b < least:
                            continue
                        gain = (a * a / (b + ridge) + (G - a) ** 2 / (H - b + ridge) - G * G / (H + ridge)) / 2
                        if gain > best[0] * (1 + 1e-12):
                            best = (gain, f, cut)
            if best[1] is None:
                out.append(("leaf", -rate * G / (H + ridge)))  # noqa: B023
                margin[mine] += -rate * G / (H + ridge)
                return
            out.append((best[1], best[2]))  # noqa: B023
            left = mine & (x[:, best[1]] <= best[2])
            grow(left, d + 1)
            grow(mine & ~left, d + 1)

        grow(np.ones(len(y), bool), 0)
        trees.append(out)
    return margin, trees


def told(tree, node=0):
    """A fitted tree's nodes in the order the naive booster lists them."""
    if tree.left[node] < 0:
        return [("leaf", tree.value[node])]
    return [(int(tree.feature[node]), tree.threshold[node]), *told(tree, tree.left[node]), *told(tree, tree.right[node])]


@pytest.mark.parametrize("share, columns", [(1.0, 1.0), (0.8, 0.5)])
def test_splits_and_leaves_are_those_of_a_naive_booster(spark, monkeypatch, share, columns):
    """2,000 rows in several blocks and tasks; the last feature is constant, one has many values. Once sums are reduced by tasks."""
    monkeypatch.setattr(boosting, "DRIVER_BYTES", 0 if share < 1 else 1 << 26)
    rng = np.random.default_rng(5)
    n = 2000
    x = np.stack([rng.integers(0, 12, n), rng.integers(0, 5, n), rng.normal(size=n).round(1), np.ones(n)], axis=1).astype(float)
    y = ((x[:, 0] > 6) ^ (x[:, 2] > 0.4) | (rng.random(n) < 0.1)).astype(int)
    names = list("abcd")
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, d double, label int").repartition(3).cache()
    edges = boosting.bin_edges(df, names)
    assert [len(e) for e in edges[:2]] == [11, 4] and 30 < len(edges[2]) < 63 and not len(edges[3])
    model = modelling.train_boosted_trees(df, names, n_estimators=12, max_depth=3, learning_rate=0.3, subsample=share, colsample=columns, edges=edges, seed=9)
    # The rows as the blocks hold them, to draw the same samples.
    blocks = boosting._blocks(df.withColumn("validation", F.lit(False)), names, edges, "label").collect()
    bins = np.concatenate([np.frombuffer(b["bins"], np.uint8).reshape(4, b["n"]) for b in blocks], axis=1)
    x = np.stack([np.append(e, np.inf)[c] for e, c in zip(edges, bins, strict=True)], axis=1)
    y = np.concatenate([np.frombuffer(b["label"], np.int8) for b in blocks]).astype(int)
    used = lambda r: np.concatenate([boosting.sampled(9, r, b["id"], b["n"], share) for b in blocks])
    chosen = lambda r: np.sort(np.random.default_rng([9, r]).choice(4, int(round(4 * columns)), replace=False))
    margin, trees = naive_booster(x, y, edges, 12, 3, 0.3, (y == 0).sum() / (y == 1).sum(), chosen, used)
    assert len(model.trees) == 12
    for got, want in zip(model.trees, trees, strict=True):
        mine = told(got)
        assert [a for a, _ in mine] == [a for a, _ in want]
        assert [b for _, b in mine] == pytest.approx([b for _, b in want], abs=1e-9)
    scored = modelling.score(model, spark.createDataFrame([tuple(map(float, np.where(np.isinf(r), 1e9, r))) for r in x], "a double, b double, c double, d double"))
    assert [r["score"] for r in scored.collect()] == pytest.approx(list(1 / (1 + np.exp(-margin))), abs=1e-9)


def test_the_driver_gets_one_sum_however_many_tasks(spark, monkeypatch):
    names = [f"f{k}" for k in range(24)]
    df = spark.range(400).select(F.lit(False).alias("validation"), (F.col("id") % 2).cast("int").alias("label"), *[F.pmod(F.hash("id", F.lit(k)), F.lit(256)).cast("double").alias(n) for k, n in enumerate(names)])
    blocks = boosting._blocks(df.repartition(30), names, [np.arange(255.0)] * 24, "label")
    sent, whole = [], type(blocks).collect

    def watched(self):
        rows = whole(self)
        sent.extend(len(r["sums"]) for r in rows)
        return rows

    monkeypatch.setattr(type(blocks), "collect", watched)
    sums, _ = boosting._level_sums(blocks, 30, [], boosting._Growing(), [0], np.arange(24), 0, 0.0, 1.0, 1.0, 1, 24, 256)
    assert sum(sent) <= 24 * 256 * 16 + 16
    assert np.allclose(sums[0][..., 1].sum(axis=1), 400 / 4)


def test_trees_are_the_same_whoever_adds_up(spark, monkeypatch):
    """One task that holds all blocks, tasks of a barrier stage, or a job a level; before, there were only the jobs.

    The last fit finds that its tasks share no folder.
    """
    rng = np.random.default_rng(6)
    x = np.stack([rng.integers(0, 30, 3000), rng.normal(size=3000).round(2), rng.normal(size=3000).round(2)], axis=1)
    y = ((x[:, 0] > 12) ^ (x[:, 1] > 0.3) | (rng.random(3000) < 0.2)).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, label int").repartition(4).cache()
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 400)
    monkeypatch.setattr(boosting, "HELD_ROWS", 900)
    edges = boosting.bin_edges(df, list("abc"))
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("trees"))
    found = []
    for alone, held, shared in ((1 << 26, 0, True), (0, 1 << 26, True), (0, 0, True), (0, 1 << 26, False)):
        if not shared:
            monkeypatch.setattr(boosting, "_Told", type("Apart", (), {"__init__": lambda self, folder: None, "serves": False}))
        monkeypatch.setattr(boosting, "ALONE_BYTES", alone)
        monkeypatch.setattr(boosting, "HELD_BYTES", held)
        spark.sparkContext.setJobGroup("trees", "")
        before = jobs()
        found.append(boosting.fit(df, list("abc"), df.where("a < 9"), n_estimators=4, max_depth=3, learning_rate=0.3, subsample=0.7, colsample=0.7, early_stopping=3, edges=edges, seed=3))
        found[-1].params["jobs"] = jobs() - before
        spark.sparkContext.setJobGroup("others", "")
    alone, held, passes, apart = found
    assert max(alone.params["jobs"], held.params["jobs"]) < 10 < passes.params["jobs"] < apart.params["jobs"]
    for other in (held, passes, apart):
        assert other.losses == pytest.approx(alone.losses, abs=1e-9) and len(other.trees) == len(alone.trees) > 1
        for a, b in zip(alone.trees, other.trees, strict=True):
            assert list(a.feature) == list(b.feature) and list(a.threshold) == list(b.threshold)
            assert list(a.value) == pytest.approx(list(b.value), abs=1e-9) and list(a.cover) == pytest.approx(list(b.cover), abs=1e-6)


def test_many_values_make_few_bins(spark):
    df = spark.range(50_000).selectExpr("double(id) AS a", "double(id % 3) AS b", "cast(NULL AS double) AS c")
    a, b, c = boosting.bin_edges(df, list("abc"), 64)
    assert len(a) == 63 and np.abs(a - np.arange(1, 64) / 64 * 50_000).max() < 50_000 * 0.004
    assert list(b) == [0.0, 1.0] and len(c) == 0


def test_boosting_edge_cases(spark):
    schema = "f1 double, f2 double, label int"
    fit = lambda rows: modelling.train_boosted_trees(spark.createDataFrame(rows, schema), ["f1", "f2"], n_estimators=2, max_depth=2)
    some = spark.createDataFrame([(1.0, None, 1), (None, 2.0, 0)], schema)
    for rows in ([], [(1.0, 1.0, 1)], [(None, None, 0)] * 5):
        model = fit(rows)
        assert all(0 <= r["score"] <= 1 for r in modelling.score(model, some).collect())


def game(tree, x, known, node=0):
    """A tree's margin when only some features are known: the others follow the training weight."""
    if tree.left[node] < 0:
        return tree.value[node]
    a, b = tree.left[node], tree.right[node]
    if tree.feature[node] in known:
        return game(tree, x, known, a if x[tree.feature[node]] <= tree.threshold[node] else b)
    return (tree.cover[a] * game(tree, x, known, a) + tree.cover[b] * game(tree, x, known, b)) / tree.cover[node]


def brute_shapley(trees, x, n_features):
    """Shapley values by their definition."""
    phi = np.zeros(n_features)
    for i in range(n_features):
        others = [j for j in range(n_features) if j != i]
        for size in range(n_features):
            weight = math.factorial(size) * math.factorial(n_features - size - 1) / math.factorial(n_features)
            for known in itertools.combinations(others, size):
                phi[i] += weight * sum(game(t, x, {*known, i}) - game(t, x, set(known)) for t in trees)
    return phi


def test_tree_contributions_are_shapley_values_and_add_up(spark, noisy_trees):
    """At the published depth, with features that come again on a path."""
    df, model = noisy_trees
    assert max(t.depth for t in model.trees) == 6
    phi, bias = treeshap.tree_contributions(spark, model, F.array(*[F.col(c) for c in "abcd"]))
    rows = modelling.score(model, df).withColumn("phi", phi).collect()
    for r in rows:
        assert sum(r["phi"]) + bias == pytest.approx(math.log(r["score"] / (1 - r["score"])), abs=1e-8)
    for r in rows[:12]:
        want = brute_shapley(model.trees, np.array([r[c] for c in "abcd"]), 4)
        assert r["phi"] == pytest.approx(list(want), abs=1e-10)


@pytest.fixture(scope="module")
def grown_trees():
    """Random trees of several shapes over five features, which come again on paths; one is deeper than a table's rows tell."""
    rng = np.random.default_rng(12)

    def grow(depth, likely, chain=False, least=0.0):
        nodes = [[0, 0.0, -1, -1, 0.0, 100.0]]
        open_ = [(0, 0)]
        while open_:
            n, d = open_.pop()
            if d == depth or d and rng.random() > likely:
                nodes[n][4] = float(rng.normal())
                continue
            # Now and then no weight follows a side, where ``least`` is 0.
            share = max(least, float(rng.choice([0.0, 0.3, 0.5, 0.9])))
            a, b = len(nodes), len(nodes) + 1
            nodes[n][:4] = [int(rng.integers(0, 5)), round(float(rng.normal()), 1), a, b]
            nodes += [[0, 0.0, -1, -1, 0.0, nodes[n][5] * share], [0, 0.0, -1, -1, 0.0, nodes[n][5] * (1 - share)]]
            if chain:
                nodes[b][4] = float(rng.normal())
            open_ += [(a, d + 1)] if chain else [(a, d + 1), (b, d + 1)]
        return boosting.Tree(*(np.array(c) for c in zip(*nodes, strict=True)))

    return [grow(6, 1.0, least=0.1), grow(6, 0.7), grow(1, 1.0, least=0.1), grow(0, 1.0), grow(8, 0.8), grow(13, 1.0, True), grow(10, 1.0, True)]


def test_tables_have_what_the_recurrence_adds_up(grown_trees, monkeypatch):
    """Rows are looked up, none goes through the recurrence but for trees with too long paths; before, all did."""
    rng = np.random.default_rng(13)
    x = rng.normal(size=(5000, 5)).round(1)
    x[::50, 2] = np.nan
    want = treeshap.contributions_matrix(x, treeshap.tree_blocks(grown_trees))
    assert len(treeshap.Explainer(grown_trees).deep) == 1
    found = treeshap.Explainer(grown_trees).contributions(x)
    assert np.abs(found - want).max() < 1e-9
    # The same bits whatever rows come along.
    assert (treeshap.Explainer(grown_trees).contributions(x[:10]) == found[:10]).all()
    by_hand = [t for t in grown_trees if (t.cover > 0).all()]
    assert max(t.depth for t in by_hand) >= 6
    for r in range(3):
        assert treeshap.Explainer(by_hand).contributions(x[:100])[r] == pytest.approx(list(brute_shapley(by_hand, x[r], 5)), abs=1e-9)
    monkeypatch.setattr(treeshap, "_add_block", None)
    shallow = treeshap.Explainer([t for t in grown_trees if t.depth <= 10])
    assert np.isfinite(shallow.contributions(x)).all() and not shallow.deep
    assert treeshap.Explainer([]).contributions(x).tolist() == np.zeros(x.shape).tolist()


def test_contributions_are_computed_once(spark, boosted, separable):
    """The filter on empty arrays that the planner puts before ``inline`` had a second computation of its own."""
    rows = BatchScorer(boosted, 0.5).explain(separable, ["transaction_id"])
    for out in (rows.select("transaction_id", F.inline("contributions")), rows.select("score", F.posexplode(explaining.risk_factors(F.col("contributions"))))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython [explain(") == 1
        assert out.count() == 400


def test_importance_and_factors(spark, boosted, separable):
    noise = separable.withColumn("f2", F.rand(1))
    model = modelling.train_boosted_trees(
        noise, ["f1", "f2"], n_estimators=5, max_depth=3, learning_rate=0.3, colsample=1.0
    )
    explained = BatchScorer(model, 0.5).explain(noise, ["transaction_id"])
    ranked = table(explaining.global_importance(explained, "contributions", ["f1", "f2"]), "place")
    assert ranked[1]["feature"] == "f1"
    assert explaining.global_importance(explained, "contributions", ["f1", "f2"], 1).count() == 1
    for r in explained.select(explaining.risk_factors(F.col("contributions"), 2).alias("f")).limit(20).collect():
        values = [c["contribution"] for c in r["f"]]
        assert values == sorted(values, reverse=True) and len(values) == 2
    ends = explain_extremes(explained, "transaction_id", k=2)
    assert sorted((r["extreme"], r["place"]) for r in ends.collect()) == [
        ("highest", 1), ("highest", 2), ("lowest", 1), ("lowest", 2),
    ]


def test_factors_keep_negative_contributions_and_order_ties_by_name(spark):
    df = spark.sql(
        """SELECT array(named_struct('feature', 'b', 'contribution', -1D, 'value', 1D),
        named_struct('feature', 'a', 'contribution', -1D, 'value', 2D),
        named_struct('feature', 'c', 'contribution', -3D, 'value', 3D)) AS c"""
    )
    got = df.select(explaining.risk_factors(F.col("c"), 2).alias("f")).first()["f"]
    assert [(f["feature"], f["contribution"], f["value"]) for f in got] == [("a", -1.0, 2.0), ("b", -1.0, 1.0)]


def test_linear_contributions(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (None, 7.0)], "a double, flat double")
    scaling = explaining.fit_standardizer(df, ["a", "flat"])
    col = explaining.linear_contributions({"a": 2.0, "flat": 5.0}, scaling)
    rows = [r[0] for r in df.select(col).collect()]
    std = np.std([1, 3, 0])
    assert [r[0]["contribution"] for r in rows] == pytest.approx([(v - 4 / 3) / std * 2 for v in (1, 3, 0)])
    assert {r[1]["contribution"] for r in rows} == {0.0}


# --- scoring -----------------------------------------------------------------------------------


def test_scoring_contract(spark, boosted):
    df = spark.createDataFrame([("t1", 1.0, None, 9.0), ("t2", 6.0, 5.5, 9.0)],
                               "transaction_id string, f1 double, f2 double, unknown double")
    out = table(BatchScorer(boosted, 0.5).score_batch(df), "transaction_id")
    assert 0 <= out["t1"]["score"] <= 1 and out["t2"]["decision"] == "review"
    assert {f["feature"] for f in out["t1"]["risk_factors"]} == {"f1", "f2"}
    # A row's missing feature counts as 0, alone or in company.
    alone = BatchScorer(boosted, 0.5).score_batch(df.where("transaction_id = 't1'").drop("f2")).first()
    assert alone["score"] == out["t1"]["score"]


def test_empty_batch(spark, boosted):
    df = spark.createDataFrame([], "transaction_id string, f1 double, f2 double")
    assert BatchScorer(boosted, 0.5).score_batch(df).count() == 0


def test_decision_boundary(spark):
    df = spark.createDataFrame([(0.5,), (0.499,), (0.2,), (0.8,), (0.81,)], "s double")
    out = df.select(scoring.decide(F.col("s"), 0.5), scoring.decision_band(F.col("s"))).collect()
    assert [r[0] for r in out] == ["review", "allow", "allow", "review", "review"]
    assert [r[1] for r in out] == ["review", "review", "low", "review", "high"]


def test_only_finite_numbers_pass(spark):
    rows = [(1, {"f0": "1.5"}), (2, {"f0": "NaN"}), (3, {"f0": "inf", "f1": "2"}), (4, {"f0": "not-a-number"}),
            (5, {}), (6, {"f0": None})]
    df = spark.createDataFrame(rows, "id int, features map<string,string>")
    good, bad = scoring.validate_finite(df)
    assert {r["id"]: r["features"] for r in good.collect()} == {1: {"f0": 1.5}, 5: {}}
    assert {r["id"]: r["bad_features"] for r in bad.collect()} == {
        2: ["f0"], 3: ["f0"], 4: ["f0"], 6: ["f0"],
    }
    wide = scoring.features_from_map(good, ["f0", "f1"], ["id"]).collect()
    assert sorted(tuple(r) for r in wide) == [(1, 1.5, 0.0), (5, 0.0, 0.0)]


def test_operating_threshold(spark):
    report = spark.createDataFrame([("gate", "operating_threshold", 0.3125)], "section string, name string, value double")
    assert scoring.operating_threshold(report).first()[0] == 0.3125
    assert scoring.operating_threshold(report.limit(0)).first()[0] == 0.5


def test_recompute_features(spark):
    history = spark.createDataFrame(
        [("card1", "77", 0.375, 64.5, 8), ("addr1", "12", 0.02, 31.0, 550)],
        "key_type string, key string, fraud_rate double, amt_mean double, cnt long",
    )
    requests = spark.createDataFrame(
        [(1, 77.0, None, 19.25, 3.0), (2, 5.0, "12", None, 4.0)],
        "transaction_id long, card1 double, addr1 string, amount double, V1 double",
    )
    out = table(scoring.recompute_features(requests, history, amount="amount"), "transaction_id")
    known, unknown = out[1], out[2]
    assert [known[f"card1_hist_{p}"] for p in ("fraud_rate", "amt_mean", "count")] == [0.375, 64.5, 8.0]
    assert [known[f"addr1_hist_{p}"] for p in ("fraud_rate", "amt_mean", "count")] == [0.0, 0.0, 0.0]
    assert [unknown[f"card1_hist_{p}"] for p in ("fraud_rate", "amt_mean", "count")] == [0.0, 0.0, 0.0]
    assert known["transaction_amt"] == 19.25 and known["transaction_amt_cents"] == pytest.approx(25.0)
    assert unknown["transaction_amt"] is None and unknown["V1"] == 4.0
    told = [tuple(d) for d in known["derivation"]]
    assert told == [
        ("card1_hist_fraud_rate", 0.375, "seen", "77.0", 8), ("card1_hist_amt_mean", 64.5, "seen", "77.0", 8),
        ("card1_hist_count", 8.0, "seen", "77.0", 8), ("addr1_hist_fraud_rate", 0.0, "new", None, 0),
        ("transaction_amt", 19.25, "given", None, None),
    ]
    assert [(d["feature"], d["origin"]) for d in unknown["derivation"]][:2] == [("card1_hist_fraud_rate", "new"), ("addr1_hist_fraud_rate", "seen")]


# --- drift -------------------------------------------------------------------------------------


def two_sample(a, b):
    grid = np.sort(np.unique(np.concatenate([a, b])))
    f = np.searchsorted(np.sort(a), grid, "right") / len(a)
    g = np.searchsorted(np.sort(b), grid, "right") / len(b)
    return np.abs(f - g).max(), float((np.abs(f - g)[:-1] * np.diff(grid)).sum())


@pytest.mark.parametrize("options", [{}, {"cell_rows": 20}])
def test_drift_distances(spark, options):
    rng = np.random.default_rng(7)
    ref = {"a": rng.normal(0, 1, 700), "b": np.where(rng.random(700) < 0.5, 3.0, rng.exponential(1, 700))}
    cur = {"a": rng.normal(1, 1, 500), "b": np.where(rng.random(500) < 0.5, 3.0, rng.exponential(1, 500))}

    def frame(d):
        return spark.createDataFrame([(float(x), float(y)) for x, y in zip(d["a"], d["b"], strict=True)], "a double, b double")

    out = table(drift.column_drift(frame(ref), frame(cur), ["a", "b"], **options), "column_name")
    for name in ("a", "b"):
        ks, w1 = two_sample(ref[name], cur[name])
        assert out[name]["ks"] == pytest.approx(ks) and out[name]["w1"] == pytest.approx(w1)
        assert out[name]["w1_norm"] == pytest.approx(w1 / np.std(ref[name]))
    assert out["a"]["drift_detected"] and out["a"]["ks_p"] < 1e-6 and out["b"]["ks_p"] > 0.05


def test_sketched_drift_is_within_its_error(spark):
    rng = np.random.default_rng(8)
    n = 6000
    ref = {"a": rng.normal(0, 1, n), "b": rng.integers(0, 4, n).astype(float), "c": rng.exponential(1, n)}
    cur = {"a": rng.normal(0.4, 1, n), "b": rng.integers(0, 5, n).astype(float), "c": rng.exponential(1, n)}
    frame = lambda d: spark.createDataFrame([(float(x), float(y), float(z), None if i % 3 else float("nan")) for i, (x, y, z) in enumerate(zip(*d.values(), strict=True))], "a double, b double, c double, empty double").repartition(5)
    out = table(drift.column_drift(frame(ref), frame(cur), ["a", "b", "c", "empty"], form="sketch", k=400, points=200), "column_name")
    assert set(out) == {"a", "b", "c"}
    for name in "abc":
        ks, w1 = two_sample(ref[name], cur[name])
        assert abs(out[name]["ks"] - ks) <= out[name]["ks_error"] < 0.03
        assert abs(out[name]["w1"] - w1) < 0.03 and (out[name]["n_ref"], out[name]["n_cur"]) == (n, n)
    assert [out[c]["drift_detected"] for c in "abc"] == [True, True, False]
    with pytest.raises(ValueError):
        drift.column_drift(frame(ref), frame(cur), ["a"], form="rough")


def test_dataset_drift_structure(spark):
    ref = spark.createDataFrame([(float(i), float(i), 1) for i in range(10)], "a double, b double, is_fraud int")
    cur = spark.createDataFrame([(float(i), i + 100.0, "x") for i in range(10)], "a double, b double, c string")
    columns = drift.drift_columns(ref, cur, "is_fraud")
    assert columns == ["a", "b"]
    per = drift.column_drift(ref, cur, columns, method="ks")
    assert {r["column_name"]: (r["method"], r["drift_detected"]) for r in per.collect()} == {
        "a": ("ks", False), "b": ("ks", True),
    }
    row = drift.dataset_drift(per).first()
    assert tuple(row) == (1, 2, 0.5, True)


def test_equal_samples_do_not_drift(spark):
    df = spark.createDataFrame([(float(i % 7), None) for i in range(50)], "a double, empty double")
    out = table(drift.column_drift(df, df, ["a", "empty"]), "column_name")
    assert out["a"]["ks"] == 0 and out["a"]["w1"] == 0 and out["a"]["ks_p"] == 1.0
    # A column without any value has no distribution to compare.
    assert "empty" not in out


def test_extremes_explain_only_the_chosen_rows(spark):
    """The same factors as from a frame that is explained whole; before, every row was explained, twice."""
    stump = lambda f, cut, low, high: boosting.Tree(*map(np.array, ([f, 0, 0], [cut, 0.0, 0.0], [1, -1, -1], [2, -1, -1], [0.0, low, high], [10.0, 4.0, 6.0])))
    model = boosting.BoostedTrees(["a", "b"], 0.1, [stump(0, 20.0, -0.3, 0.4), stump(1, 3.0, 0.2, -0.5)])
    scorer = BatchScorer(model, 0.5)
    rows = spark.range(60).select("id", F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    seen = []

    def explain(few):
        seen.append(few.count())
        return scorer.explain(few, ["extreme", "place", "id"])

    got = explain_extremes(modelling.score(model, rows, ["id", "a", "b"]), "id", 4, explain=explain)
    whole = explain_extremes(scorer.explain(rows, ["id"]), "id", 4)
    assert seen == [8]
    assert got.columns == whole.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
