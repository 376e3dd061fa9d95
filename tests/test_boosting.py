"""Histogram boosting: root cuts against plain loops, falling losses, independence of the partitioning, persistence."""

import math
import random
import tempfile

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnkit.operators import boosting, evaluate

SMALL = boosting.BoostParams(rounds=12, depth=3, bins=16)
FEATURES = ["a", "b", "c", "k0"]


def rows(n=400, seed=5):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = r.gauss(0, 1), r.gauss(0, 1), float(r.randrange(3))
        out.append((i, a, b, c, 1.0, int(a * b + 0.5 * c + r.gauss(0, 0.5) > 0.6), i % 5))
    return out


def table(spark, data, parts=2):
    return spark.createDataFrame(data, "id long, a double, b double, c double, k0 double, y int, fold int").repartition(parts)


def test_losses_fall_and_folds_share_the_passes(spark):
    df = table(spark, rows())
    sets = {"f0": F.col("fold") != 0, "all": F.lit(True)}
    many = boosting.fit_many(df, FEATURES, "y", "id", sets, SMALL)
    for b in many.values():
        assert len(b.losses) == 13 and all(x > y for x, y in zip(b.losses, b.losses[1:]))
    alone = boosting.fit_many(df.where("fold <> 0").repartition(5), FEATURES, "y", "id", {"f0": F.lit(True)}, SMALL)["f0"]
    # the bins are those of all rows of the sets, so only a fit on the same rows has the same bins
    again = boosting.fit_many(df.repartition(7), FEATURES, "y", "id", sets, SMALL)
    assert np.array_equal(again["f0"].feature, many["f0"].feature) and np.allclose(again["f0"].value, many["f0"].value)
    assert abs(alone.losses[-1] - many["f0"].losses[-1]) < 0.05


def test_root_cut_equals_plain_loops(spark):
    data = rows(150)
    got = {r["feature"]: r for r in boosting.first_cuts(table(spark, data), FEATURES, "y", "id", {"s": F.col("fold") != 1}, SMALL).collect()}
    mine = [r for r in data if r[6] != 1]
    w = sum(1 - r[5] for r in mine) / sum(r[5] for r in mine)
    import hashlib
    factor = boosting.round_factor(0)
    drawn = [r for r in mine if ((int(hashlib.md5(str(r[0]).encode()).hexdigest()[:15], 16) * factor) % 2**64 >> 44) < round(0.9 * 2**20)]
    assert len(mine) > len(drawn) > 0.8 * len(mine)
    for j, f in enumerate(FEATURES):
        best = (-math.inf,)
        for t in sorted({r[1 + j] for r in mine}):
            g, h = [0.0, 0.0], [0.0, 0.0]
            for r in drawn:
                side = r[1 + j] > t
                g[side] += -0.5 * w if r[5] else 0.5
                h[side] += 0.25 * w if r[5] else 0.25
            if min(h) >= 1:
                gain = g[0]**2 / (h[0] + 1) + g[1]**2 / (h[1] + 1) - sum(g)**2 / (sum(h) + 1)
                best = max(best, (gain, t))
        if f == "c":  # all values are bins of their own
            assert abs(got[f]["gain"] - best[0]) < 1e-9 and got[f]["threshold"] == best[1]
        elif f == "k0":
            assert f not in got
        else:
            assert 0.7 * best[0] <= got[f]["gain"] <= best[0] + 1e-9


def test_quality_of_the_library_it_replaces(spark):
    df = table(spark, rows(900, 1))
    params = boosting.BoostParams(rounds=30, depth=4, bins=32)
    ours = boosting.fit_many(df, FEATURES, "y", "id", {"t": F.col("fold") != 0}, params)["t"]
    p = boosting.predict(df.where("fold = 0"), {None: ours}, ["id", "y"])
    vec = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)
    theirs = GBTClassifier(labelCol="y", maxIter=30, maxDepth=4, stepSize=0.1, seed=1).fit(vec.where("fold <> 0")).transform(vec.where("fold = 0"))
    auc = evaluate.roc_auc(p, "p", "y").first()["auc"]
    other = evaluate.roc_auc(theirs.select("y", vector_to_array("probability")[1].alias("p")), "p", "y").first()["auc"]
    assert auc > 0.8 and auc >= other - 0.02


def test_save_load_predict_by_set_and_odd_rows(spark):
    df = table(spark, rows(120) + [(1000, None, float("nan"), 1.0, 1.0, None, 1), (1001, 0.0, 0.0, 0.0, 1.0, 1, None)])
    df = df.fillna(0.0, ["a"])
    many = boosting.fit_many(df, FEATURES, "y", "id", {"x": F.col("fold") == 0, "none": F.lit(False), "y": F.col("fold") != 0}, SMALL)
    assert not many["none"].value.any() and (many["none"].feature < 0).all()
    path = tempfile.mkdtemp(prefix="churnkit-booster-", dir="/tmp") + "/m"
    many["x"].save(spark, path)
    back = boosting.Booster.load(spark, path)
    assert back.node_rows() == many["x"].node_rows() and back.losses == many["x"].losses
    both = {r["id"]: r["p"] for r in boosting.predict(df, {0: back, 1: many["none"]}, ["id"], by="fold").collect()}
    one = {r["id"]: r["p"] for r in boosting.predict(df, {None: many["x"]}, ["id"]).collect()}
    for r in df.collect():
        want = one[r["id"]] if r["fold"] == 0 else 0.5 if r["fold"] == 1 else None
        assert both[r["id"]] == want
    empty = boosting.fit_many(df.where("false"), FEATURES, "y", "id", {"x": F.lit(True)}, boosting.BoostParams(rounds=2, depth=2))["x"]
    assert not empty.value.any()


def test_driver_gets_a_few_numbers_per_node(spark, monkeypatch):
    """What a level sends to the driver does not hold its histograms (before: all bins of all nodes, from several tasks)."""
    import pickle

    from pyspark import RDD

    sizes, collect = [], RDD.collect

    def counted(self):
        out = collect(self)
        sizes.append(len(pickle.dumps(out)))
        return out
    monkeypatch.setattr(RDD, "collect", counted)
    params = boosting.BoostParams(rounds=2, depth=3, bins=64)
    sets = {"f0": F.col("fold") != 0, "all": F.lit(True)}
    for parts in (1, 6):
        boosting.fit_many(table(spark, rows(), parts), FEATURES, "y", "id", sets, params)
    assert sizes and max(sizes) < 4000


def test_cuts_picked_by_node_equal_those_of_the_whole_sums(spark):
    df, sets = table(spark, rows(), 4), {"f0": F.col("fold") != 0, "all": F.lit(True)}
    p = boosting._prepare(df, FEATURES, "y", "id", sets, SMALL)
    tree = boosting._Trees.empty(2, SMALL.depth)
    sums, loss = boosting._sums(p, 0, [], tree, 0, SMALL)
    found, again = boosting._level(p, 0, [], tree, 0, np.array([True, False, True, True]), SMALL)
    gain, left, whole = boosting.best_cuts(sums[:, 0], p.offsets, SMALL)
    gain[:, p.offsets[1]:p.offsets[2]] = -np.inf
    best = gain.argmax(axis=1)
    assert np.array_equal(found[:, 1], best) and np.allclose(loss, again)
    assert np.allclose(found[:, 0], gain[[0, 1], best]) and np.allclose(found[:, 2:4], left[[0, 1], best]) and np.allclose(found[:, 4:], whole)


def _jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rounds_of_sets_that_fit_in_a_task_take_no_jobs_of_their_own(spark):
    """Before: a job for every level of every round."""
    df, sets = table(spark, rows()).cache(), {"f0": F.col("fold") != 0, "all": F.lit(True)}
    few, many = (_jobs(spark, f"rounds-{n}", lambda n=n: boosting.fit_many(df, FEATURES, "y", "id", sets, boosting.BoostParams(rounds=n, depth=3, bins=16)))
                 for n in (1, 12))
    assert 0 < many <= few


def test_passes_and_joint_codes_give_the_trees_of_one_task(spark, monkeypatch):
    df, sets = table(spark, rows(), 3), {"f0": F.col("fold") != 0, "none": F.lit(False), "all": F.lit(True)}
    whole = boosting.fit_many(df, FEATURES, "y", "id", sets, SMALL)
    others = []
    for name, value in (("LOCAL_BYTES", 0), ("FOLD_ROUNDS", 5), ("JOINT_ROWS", 1)):  # passes, with checkpoints between, with joint codes; then joint in a task
        monkeypatch.setattr(boosting, name, value)
        others.append(boosting.fit_many(df, FEATURES, "y", "id", sets, SMALL))
    monkeypatch.setattr(boosting, "LOCAL_BYTES", 10**9)
    others.append(boosting.fit_many(df, FEATURES, "y", "id", sets, SMALL))
    for other in others:
        for s in sets:
            assert np.array_equal(other[s].feature, whole[s].feature) and np.array_equal(other[s].cut, whole[s].cut)
            assert np.allclose(other[s].value, whole[s].value) and np.allclose(other[s].cover, whole[s].cover) and np.allclose(other[s].losses, whole[s].losses)


def test_joint_codes_keep_every_bin():
    offsets = np.cumsum([0, 2, 64, 2, 1, 7, 2, 300])
    codes = np.stack([np.random.default_rng(i).integers(0, n, 500) for i, n in enumerate(np.diff(offsets))], axis=1)
    at, g = np.random.default_rng(9).integers(0, 3, 500), np.arange(500.0)  # node 0 is above the level
    for most in (0, 64, 1024):
        joints = boosting.joints_of(offsets, most)
        assert sorted(f for j in joints for f in j.features) == list(range(7)) and all(j.size <= max(most, 300) for j in joints)
        sums = boosting._Sums(joints, 2)
        sums.add([j.code(codes) for j in joints], at, g, -g)
        got = sums.by_bin(int(offsets[-1]))
        for f in range(7):
            for b in range(offsets[f + 1] - offsets[f]):
                for node in (0, 1):
                    want = g[(at == node + 1) & (codes[:, f] == b)].sum()
                    assert got[node, offsets[f] + b].tolist() == [want, -want]


def test_edges_of_few_values_are_those_of_all_rows(spark):
    data = [(float(i % 2), float(i % 90 == 0), float(i % 300), float(i % 40) if i % 3 else None, None) for i in range(3000)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double").repartition(3)
    assert sorted(boosting.value_counts(df, list("abcde"), 64)) == [0, 1, 3]
    for f, edges, column in zip("abcde", boosting.quantile_edges(df, list("abcde"), 16), zip(*data)):
        v = sorted(x for x in column if x is not None)
        want = sorted({v[math.ceil(i / 16 * len(v)) - 1] for i in range(1, 16)} - {v[-1]}) if v else []
        assert edges.tolist() == want, f


def test_contributions_of_a_booster_add_up_to_its_margin(spark):
    from churnkit.operators import attribution

    df = table(spark, rows(100))
    b = boosting.fit_many(df, FEATURES, "y", "id", {"all": F.lit(True)}, SMALL)["all"]
    got = {r["id"]: r for r in attribution.path_attribution(df, b, FEATURES, "id").collect()}
    for r in df.collect():
        x = got[r["id"]]
        assert abs(x["prediction"] - b.margin(np.array([[r[f] for f in FEATURES]]))[0]) < 1e-9
        assert abs(sum(x["contributions"]) - (x["prediction"] - x["base_value"])) < 1e-9 and x["contributions"][3] == 0.0
