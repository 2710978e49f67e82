import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from gridwright.models import boosting as B
from gridwright.models import direct as D

PLAIN = B.Boosting(rounds=12, rate=0.3, depth=3, min_rows=4, row_share=1.0, column_share=1.0, patience=4, bins=16)


def frame(spark, n=400, seed=3, parts=3):
    rng = np.random.default_rng(seed)
    x, z = rng.uniform(0, 10, n), rng.integers(0, 4, n)
    y = np.sin(x) * 5 + z * 2 + rng.normal(0, 0.3, n)
    rows = [("val" if i % 4 == 0 else "test" if i % 9 == 0 else "train", float(a), float(b) if i % 11 else None, float(t), -float(t) if i % 5 else None)
            for i, (a, b, t) in enumerate(zip(x, z, y))]
    return spark.createDataFrame(rows, "split string, x double, z double, target_h1 double, target_h2 double").repartition(parts, "x")


def arrays(df, split, target):
    pdf = df.where((F.col("split") == split) & F.col(target).isNotNull()).toPandas()
    return pdf[["x", "z"]].to_numpy(float), pdf[target].to_numpy(float)


def brute(x, y, vx, vy, cuts, s):
    """The same trees grown one after another on the whole arrays: losses on val after every round."""
    binned, seen = B.into_bins(x, cuts), B.into_bins(vx, cuts)
    base = y.mean()
    f, g = np.full(len(y), base), np.full(len(vy), base)
    losses = [np.mean((vy - g) ** 2)]
    for _ in range(s.rounds):
        def grow(rows, val, depth):
            r = y[rows] - f[rows]
            best = (0.0, None)
            if depth < s.depth:
                for k in range(x.shape[1]):
                    for at in range(s.bins):
                        left = binned[rows, k] <= at
                        a, b = left.sum(), (~left).sum()
                        if min(a, b) >= s.min_rows:
                            gain = (r[left].sum() ** 2 / (a + s.penalty) + r[~left].sum() ** 2 / (b + s.penalty)
                                    - r.sum() ** 2 / (a + b + s.penalty))
                            if gain > best[0] + 1e-9:
                                best = (gain, (k, at))
            if best[1] is None:
                if depth:
                    add_f[rows] = add_g[val] = s.rate * r.sum() / (len(rows) + s.penalty)
                return
            k, at = best[1]
            left, seen_left = binned[rows, k] <= at, seen[val, k] <= at
            grow(rows[left], val[seen_left], depth + 1)
            grow(rows[~left], val[~seen_left], depth + 1)

        add_f, add_g = np.zeros(len(y)), np.zeros(len(vy))
        grow(np.arange(len(y)), np.arange(len(vy)), 0)
        f, g = f + add_f, g + add_g
        losses.append(np.mean((vy - g) ** 2))
    return losses


@pytest.mark.parametrize("task_rows", [1 << 18, 80])
def test_losses_equal_brute_force(spark, monkeypatch, task_rows):
    """All passes of a round in one task, and each pass over several tasks."""
    monkeypatch.setattr(B, "TASK_ROWS", task_rows)
    df = frame(spark, parts=5)
    settings = B.Boosting(**{**PLAIN.__dict__, "patience": 100})
    models = B.boost_horizons(df, {h: {"x": "x", "z": "z"} for h in (1, 2)}, settings)
    for h, model in models.items():
        x, y = arrays(df, "train", f"target_h{h}")
        vx, vy = arrays(df, "val", f"target_h{h}")
        want = brute(x, y, vx, vy, model.cuts, settings)
        assert model.losses == pytest.approx(want, rel=1e-9)
        assert len(model.trees) == int(np.argmin(want[1:])) + 1
        assert np.mean((model.predict(vx) - vy) ** 2) == pytest.approx(min(want[1:]), rel=1e-9)


def test_the_best_prefix_is_cut_from_one_ensemble(spark):
    """Targets on val are what seven rounds predict, so seven rounds are best and four more are grown to see it."""
    df = frame(spark)
    features = {1: {"x": "x", "z": "z"}}
    whole = B.boost_horizons(df.where("split <> 'val'"), features, PLAIN)[1]
    assert len(whole.trees) == 12 and all(math.isnan(x) for x in whole.losses)
    seven = B.BoostedModel(whole.features, whole.cuts, whole.base, whole.trees[:7], [])
    known = seven.transform(df).withColumn("target_h1", F.when(F.col("split") == "val", F.col("prediction")).otherwise(F.col("target_h1")))
    model = B.boost_horizons(known.drop("prediction"), features, PLAIN)[1]
    assert len(model.trees) == 7 and len(model.losses) == 1 + 7 + PLAIN.patience
    assert model.losses[7] == pytest.approx(0, abs=1e-18)
    assert [t.feature for t in model.trees] == [t.feature for t in whole.trees[:7]]


def test_samples_do_not_depend_on_blocks_or_tasks(spark, monkeypatch):
    df = frame(spark)
    settings = B.Boosting(rounds=25, rate=0.2, depth=2, patience=6, min_rows=3, bins=32)
    features = {1: {"x": "x", "z": "z"}, 2: {"x": "x"}}
    first = B.boost_horizons(df, features, settings)
    monkeypatch.setattr(B, "RENEW", 3)
    monkeypatch.setattr(B, "TASK_ROWS", 100)
    second = B.boost_horizons(df.repartition(7), features, settings)
    for h in (1, 2):
        assert first[h].losses == pytest.approx(second[h].losses, rel=1e-9)
        assert first[h].features == list(features[h]) and min(first[h].losses) < 0.6 * first[h].losses[0]
        assert len(first[h].trees) <= 25 and {f for t in first[h].trees for f in t.feature} <= {-1, *range(len(features[h]))}


def test_edges(spark):
    df = frame(spark).withColumns({"target_h3": F.lit(None).cast("double"), "target_h4": F.lit(5.0)})
    models = B.boost_horizons(df, {3: {"x": "x"}, 4: {"x": "x", "z": "z"}}, PLAIN)
    assert list(models) == [4] and models[4].base == 5.0 and models[4].losses[0] == 0.0
    assert models[4].predict(np.array([[1.0, np.nan], [50.0, 2.0]])).tolist() == [5.0, 5.0]
    assert B.boost_horizons(df, {3: {"x": "x"}}, PLAIN) == {}
    with pytest.raises(ValueError):
        B.boost_horizons(df, {4: {"x": "x"}}, B.Boosting(bins=256))
    out = models[4].transform(df.limit(0))
    assert out.columns[-1] == "prediction" and out.count() == 0


def test_missing_values_sort_first():
    cuts = [np.array([1.0, 2.0])]
    assert B.into_bins(np.array([[np.nan], [0.5], [1.0], [1.5], [2.0], [9.0]]), cuts).ravel().tolist() == [0, 1, 2, 2, 3, 3]


def test_greedy_shares():
    rng = np.random.default_rng(0)
    y = rng.normal(size=500)
    noise = rng.normal(size=(500, 2))
    preds = np.column_stack((y + noise[:, 0], y - noise[:, 0], y + 5 * noise[:, 1]))
    shares = D.greedy_weights(preds.T @ preds, preds.T @ y, 20)
    assert shares == pytest.approx([0.5, 0.5, 0.0])
    single = D.greedy_weights(preds[:, :1].T @ preds[:, :1], preds[:, :1].T @ y, 5)
    assert single.tolist() == [1.0]


@pytest.fixture(scope="module")
def weekly(spark):
    rng, t0 = np.random.default_rng(4), datetime(2020, 1, 1)
    x = rng.uniform(-3, 3, 700)
    rows = [(t0 + timedelta(days=i), "val" if i >= 500 else "train", float(a), float(3 * a + 8 * (a > 1) + rng.normal(0, 0.5)))
            for i, a in enumerate(x)]
    return spark.createDataFrame(rows, "timestamp_utc timestamp, split string, x double, target_h1 double")


def test_ensemble_selection_never_sees_val(weekly):
    candidates = {k: v for k, v in D.default_candidates(depth=3, trees=4).items() if k in ("linear", "tree", "boosted")}
    board = {r.model: r for r in D.ensemble_leaderboard(weekly, ["x"], [1], candidates, draws=12).collect()}
    assert set(board) == {*candidates, "ensemble"} and sorted(r["rank"] for r in board.values()) == [1, 2, 3, 4]
    assert sum(r.share for r in board.values() if r.share is not None) == pytest.approx(1) and board["ensemble"].share is None
    assert board["ensemble"].rmse <= max(board[k].rmse for k in candidates)
    spoilt = weekly.withColumn("target_h1", F.when(F.col("split") == "val", -F.col("target_h1")).otherwise(F.col("target_h1")))
    again = {r.model: r for r in D.ensemble_leaderboard(spoilt, ["x"], [1], candidates, draws=12).collect()}
    assert {k: r.share for k, r in again.items()} == {k: r.share for k, r in board.items()}
    assert again["ensemble"].mae > board["ensemble"].mae


def test_out_of_fold_predictions_come_from_other_folds(weekly):
    line = LinearRegression(featuresCol="features", labelCol="target", predictionCol="prediction")
    rows = weekly.where("split = 'train'").select(
        "x", F.col("target_h1").alias("target"), F.pmod(F.xxhash64(F.date_trunc("week", "timestamp_utc")), F.lit(3)).alias("fold"))
    pdf = rows.toPandas()
    want = []
    for fold in range(3):
        a, b = np.polyfit(pdf.x[pdf.fold != fold], pdf.target[pdf.fold != fold], 1)
        want += [(round(t, 6), round(a * x + b, 6)) for x, t in zip(pdf.x[pdf.fold == fold], pdf.target[pdf.fold == fold])]
    got = D.out_of_fold(rows, ["x"], {"line": line}, 3).collect()
    assert sorted((round(r.target, 6), round(r.line, 6)) for r in got) == sorted(want)


def test_leaderboard_without_training_targets(weekly):
    none = weekly.withColumn("target_h2", F.lit(None).cast("double"))
    assert D.ensemble_leaderboard(none, ["x"], [2]).count() == 0


def test_blocks_are_dealt_evenly_from_few_partitions(spark, monkeypatch):
    monkeypatch.setattr(B, "TASK_ROWS", 50)
    df = frame(spark, n=1000, parts=1)
    cuts = [np.array([5.0])]
    blocks = B._blocks(df, ["x"], [1], cuts, [0.0])
    sizes = blocks.glom().map(lambda part: sum(len(b.val) for b in part)).collect()
    known = df.where("split <> 'test'").count()
    assert len(sizes) % spark.sparkContext.defaultParallelism == 0 and len(sizes) >= known // 50
    assert sum(sizes) == known and max(sizes) <= 2 * known / len(sizes)
    assert max(len(b.val) for b in blocks.collect()) <= -(-known // (B.TASK_BLOCKS * len(sizes)))


@pytest.mark.parametrize("rows", [0, 60, 10**6])
def test_lesser_children_and_shared_histograms_give_the_sums_of_all_nodes(rows, monkeypatch):
    """Summed node by node and column by column, whether columns share a histogram or not."""
    monkeypatch.setattr(B, "SHARED_ROWS", rows)
    rng = np.random.default_rng(5)
    binned = np.asfortranarray(rng.integers(0, 5, (3000, 3)).astype(np.uint8))
    residuals = np.asfortranarray(np.where(rng.random((3000, 1)) < 0.1, np.nan, rng.normal(size=(3000, 1))))
    block = B.Block(np.arange(3000, dtype=np.uint64), binned, residuals, np.arange(3000) % 4 == 0)
    settings = B.Boosting(row_share=1.0, bins=6, depth=4, min_rows=2)
    above, seen = {}, []

    def one_pass(work):
        sums = B._added([block], work, settings, 0)
        seen.extend(len(level.summed()) for level in work)
        whole = dict(B._whole(((k, (v, above.get(k))) for k, v in sums.items()), work))
        above.clear()
        above.update(whole)
        for level in work:
            node = level.tree.leaves(binned)
            for n, at in enumerate(level.nodes):
                here = (node == at) & ~block.val & ~np.isnan(residuals[:, 0])
                for k in level.columns:
                    got = whole[level.horizon, k][:, n]
                    assert got[1].tolist() == np.bincount(binned[here, k], minlength=7).tolist()
                    assert got[0] == pytest.approx(np.bincount(binned[here, k], residuals[here, 0], 7), abs=1e-9)
        return dict(B._judged(whole.items(), settings))

    _, (tree,) = B._trees([B.Level(1, 0, B.Tree(), [0], [0, 1, 2], [5, 5, 5], True)], one_pass, settings)
    assert len(seen) == 4 and seen[0] == 1 and sum(seen[1:]) * 2 == len(tree.feature) - 1 - _last_children(tree)


def _last_children(tree):
    """Nodes at the depth of the settings, which no pass sums."""
    depth = [0] * len(tree.feature)
    for n, f in enumerate(tree.feature):
        if f >= 0:
            depth[tree.left[n]] = depth[tree.left[n] + 1] = depth[n] + 1
    return depth.count(4)


def test_rows_are_made_once_for_all_fits(spark, weekly):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        made.add(1)
        return x

    rows = weekly.repartition(3, "x").select(seen("x").alias("x"), F.col("target_h1").alias("target"))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    candidates = {k: v for k, v in D.default_candidates(depth=2, trees=2).items() if k in ("linear", "tree", "boosted")}
    assert len(D._fitted(rows, ["x"], candidates).stages) == 4
    assert made.value == 700 and spark.sparkContext._jsc.getPersistentRDDs().size() <= before
