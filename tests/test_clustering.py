from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import clustering as cl
from tillroll.operators import names as nm
from tillroll.operators.prepare import Options
from tillroll.plans.segmentation import segment
from tillroll.session import materialize


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(7)
    data = []
    for j, (x, y, c) in enumerate([(0, 0, "a"), (10, 0, "b"), (0, 10, "c")]):
        data += [(int(100 * j + i), float(x + rng.normal()), float(y + rng.normal()), c, j) for i in range(40)]
    return spark.createDataFrame(data, "id long, x double, y double, c string, truth int").cache()


def partition_of(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r["label"], set()).add(r["truth"])
    return groups


def pure(groups, k=3):
    return len(groups) == k and all(len(g) == 1 for g in groups.values())


def test_kmeans_and_weights(blobs):
    labelled, cost, centres = cl.kmeans(blobs, ["x", "y"], 3, restarts=3)
    assert pure(partition_of(labelled)) and len(centres) == 3
    stats = cl.cluster_statistics(labelled, ["x", "y"])
    assert cl.quality(stats, 2)["elbow"] == pytest.approx(cost)


def test_weights_move_the_centre(spark):
    df = spark.createDataFrame([(0.0, 1), (1.0, 3), (100.0, 1)], "x double, w int")
    _, _, centres = cl.kmeans(df, ["x"], 2, weight="w")
    assert sorted(float(c[0]) for c in centres) == [0.75, 100.0]


def test_kprototypes_uses_both_kinds(blobs):
    model = cl.kprototypes(blobs, ["x", "y"], ["c"], 3, restarts=4)
    assert pure(partition_of(model.label(blobs)))


def test_kmodes_cost_does_not_rise(blobs):
    few = cl.kmodes(blobs, ["c", "truth"], 2)
    more = cl.kmodes(blobs, ["c", "truth"], 3)
    assert more.cost <= few.cost and more.cost == 0
    labels = {r["label"] for r in more.label(blobs).collect()}
    assert labels <= {0, 1, 2}


@pytest.mark.parametrize("init", ["hash", "first"])
def test_kmedoids_are_rows_and_cost_is_theirs(blobs, init):
    model = cl.kmedoids(blobs, ["x", "y"], 3, max_iter=20, restarts=4, init=init)
    assert pure(partition_of(model.label(blobs)))
    data = [(r["x"], r["y"]) for r in blobs.collect()]
    medoids = [(m["x"], m["y"]) for m in model.centres]
    assert set(medoids) <= set(data)
    assert model.cost == pytest.approx(sum(min(math.dist(p, m) for m in medoids) for p in data))


@pytest.mark.parametrize("block", [7, 4096])
def test_the_medoid_is_sought_among_all_rows(spark, block):
    # Skewed values: the medoid is the median, far from the mean.
    rng = np.random.default_rng(3)
    x = np.exp(2 * rng.normal(size=501))
    df = spark.createDataFrame([(float(a),) for a in x], "x double")
    model = cl.kmedoids(df, ["x"], 1, block=block)
    assert model.centres == [{"x": float(np.median(x))}]
    assert model.cost == pytest.approx(np.abs(x - np.median(x)).sum())


def test_no_row_of_a_cluster_is_better_than_its_medoid(spark):
    rng = np.random.default_rng(5)
    data = [tuple(map(float, r)) for r in np.round(np.exp(rng.normal(size=(400, 3)) * [0.5, 1, 2]), 1)]
    model = cl.kmedoids(spark.createDataFrame(data * 2, "x double, y double, z double"), ["x", "y", "z"], 3, block=50)
    medoids = [(m["x"], m["y"], m["z"]) for m in model.centres]
    label = [min(range(3), key=lambda j: (math.dist(p, medoids[j]), j)) for p in data]
    assert model.cost == pytest.approx(2 * sum(math.dist(p, medoids[j]) for p, j in zip(data, label)))
    for j in range(3):
        own = [p for p, at in zip(data, label) if at == j]
        sums = [sum(math.dist(p, q) for q in own) for p in own]
        assert sum(math.dist(p, medoids[j]) for p in own) == pytest.approx(min(sums))


def test_costs_are_those_of_the_returned_centres(blobs):
    for rounds in (0, 1, 30):
        model = cl.kmodes(blobs, ["c", "truth"], 2, rounds, init="first")
        assert model.cost == blobs.agg(F.sum(model.nearest()["cost"])).first()[0]
        labelled, cost, centres = cl.kmeans(blobs, ["x", "y"], 3, rounds, init="first")
        data = [(r["x"], r["y"]) for r in blobs.collect()]
        assert cost == pytest.approx(sum(min((x - a) ** 2 + (y - b) ** 2 for a, b in centres) for x, y in data))


def test_quality_of_one_cluster_and_single_rows(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (9.0, 1)], "x double, label int")
    scores = cl.quality(cl.cluster_statistics(df, ["x"]), 1)
    assert math.isnan(scores["bic"]) and scores["elbow"] == pytest.approx(0.5)
    one = cl.quality(cl.cluster_statistics(df.withColumn("label", F.lit(0)), ["x"]), 1)
    assert math.isnan(one["calinski-harabasz"]) and math.isnan(one["davies-bouldin"])
    assert math.isnan(cl.silhouette(df.withColumn("label", F.lit(0)), ["x"]))


def test_knee():
    ks = list(range(1, 11))
    assert cl.knee(ks, [100, 40, 15, 10, 8, 7, 6, 5.5, 5, 4.8]) == 3
    assert cl.knee(ks, [5] * 10) is None
    assert cl.knee([1, 2], [3, 1]) is None


def test_best_k_falls_back_without_knee(spark):
    flat = [(k, "elbow", 5.0) for k in (2, 3, 4)] + [(k, "calinski-harabasz", float(k)) for k in (2, 3, 4)]
    scores = spark.createDataFrame(flat, "k int, metric string, value double")
    assert {r["metric"]: r["best_k"] for r in cl.best_k(scores).collect()} == {"elbow": 4, "calinski-harabasz": 4}


def feature_rows(spark):
    rng = np.random.default_rng(2)
    data = []
    for i in range(60):
        low = i % 2 == 0
        data.append(
            (f"m{i:03d}", "10", int(rng.integers(1, 4)) + (0 if low else 40), 1.0, "1" if low else None,
             30 if low else None, "臺北市", 3 if low else 300, 9 if low else 1, 5.0 if low else 90.0, "1", "0")
        )
    schema = (
        "mid string, pma_no_fin string, qty int, avg_qty double, sex string, age int, home_city string, "
        "rfm_recency int, rfm_frequency int, rfm_monetary double, weekday string, weekend string"
    )
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize(
    "options",
    [
        Options("KMeans", k=2, groups=("personal", "rfm"), max_iter=10),
        Options("WKMeans", k=2, groups=("rfm",), weight="qty", max_iter=10),
        Options("KModes", k=2, groups=("personal", "prefer"), max_iter=5),
        Options("KPrototypes", k=2, groups=("personal", "rfm"), max_iter=5),
        Options("KMedoids", k=2, groups=("rfm",), max_iter=5),
        Options("KMeans", auto=True, score="silhouette", k_min=2, k_max=3, groups=("rfm",), max_iter=5),
    ],
)
def test_segmentation_run(spark, options):
    run = segment(feature_rows(spark), "10", options)
    detail = run.detail.collect()
    assert len(detail) == 60 and {r["label"] for r in detail} <= set(range(run.k))
    assert sum(r["cnt"] for r in run.sizes().collect()) == 60
    if "personal" in options.groups:
        assert {r["sex"] for r in detail} == {"1", " "} and {r["age"] for r in detail} == {30, 0}
    if "rfm" in options.groups:
        assert {r["rfm_level"] for r in detail} <= {f"{i:03b}" for i in range(8)}
    assert run.describe().count() == run.k * len(run.numeric) or options.auto
    assert run.summary().first()["data_length"] == 60


def test_name_clusters_split_unlike_names(spark):
    names = [f"red ring r{i}x" for i in range(8)] + [f"hot plate p{i}x" for i in range(8)]
    df = spark.createDataFrame([("c", n) for n in names], "category string, item_name string")
    df = df.withColumn("tokens", F.split("item_name", " "))
    got = {r["item_name"]: r["cluster"] for r in nm.name_clusters(df, 2).collect()}
    assert len(got) == 16
    assert len({got[n] for n in names[:8]}) == 1 and len({got[n] for n in names[8:]}) == 1
    assert got[names[0]] != got[names[8]]


def test_names_without_long_tokens_keep_a_row(spark):
    names = [f"red ring r{i}x" for i in range(6)] + ["a b", "!!!", "c"]
    df = spark.createDataFrame([("c", n) for n in names] + [("d", "x y"), ("d", "z")], "category string, item_name string")
    df = df.withColumn("tokens", F.split("item_name", " "))
    got = {(r["category"], r["item_name"]): r["cluster"] for r in nm.name_clusters(df, 2).collect()}
    assert len(got) == 11
    assert len({got["c", n] for n in ("a b", "c")}) == 1 and got["c", "a b"] != got["c", "red ring r0x"]


def test_classes_are_the_same_in_blocks(spark):
    names = ["red ring", "hot plate red", "old", "!!!", "", None, "ring ring plate"]
    df = spark.createDataFrame([(n,) for n in names], "product string")
    rows = [("red", [0.5, 0.1, 0.4]), ("ring", [0.2, 0.7, 0.1]), ("plate", [0.3, 0.3, 0.4]), ("ring ring", [0.0, 1.0, 0.0])]
    weights = spark.createDataFrame(rows, "gram string, weights array<double>")
    got = [
        sorted(map(tuple, nm.classify_names(df, weights, 3, bias=[0.0, 0.01, 0.1], unknown=[0.1, 0.2, 0.0], max_values=m).collect()), key=repr)
        for m in (1000, 3)
    ]
    assert got[0] == got[1] and len(got[0]) == 7
    assert dict((r[0], r[1:]) for r in got[0])["!!!"] == (3, 0.1)


def test_trained_weights_agree_with_the_model(spark):
    data = [("red ring", "ring"), ("hot plate", "plate"), ("old ring", "ring"), ("new plate", "plate")]
    df = spark.createDataFrame(data, "product string, kind string")
    model = nm.train_classifier(df, "product", "kind", max_iter=30)
    weights, bias, labels = nm.model_weights(model, spark)
    got = {r["product"]: labels[r["class_no"] - 1] for r in nm.classify_names(df, weights, 2, bias=bias).collect()}
    assert got == dict(data)
    predicted = model.transform(nm.with_grams(df, "product")).select("product", "prediction").collect()
    assert {r["product"]: labels[int(r["prediction"])] for r in predicted} == got


def test_unknown_grams_take_the_given_weights(spark):
    df = spark.createDataFrame([("zzz",)], "product string")
    weights = spark.createDataFrame([("red", [1.0, 0.0])], "gram string, weights array<double>")
    assert nm.classify_names(df, weights, 2, unknown=[0.0, 0.5]).first()["class_no"] == 2
    assert nm.classify_names(df, weights, 2).first()["class_no"] == 1


@pytest.mark.parametrize(("dims", "scale"), [(1, 1.0), (2, 1.0), (5, 1.0), (3, 10.0)])
def test_bounds_of_summed_distances_hold_and_are_close(spark, dims, scale):
    draw = np.random.default_rng(dims)
    data = np.exp(draw.normal(size=(400, dims))) * scale ** np.arange(dims)
    columns = [f"c{i}" for i in range(dims)]
    own = spark.createDataFrame(
        [(*map(float, r), 1.0 + i % 2, i % 2) for i, r in enumerate(data)], ", ".join(f"{c} double" for c in columns) + ", _w double, _label int"
    )
    model = cl.Centres([dict(zip(columns, data[0])), dict(zip(columns, data[1]))], columns, root=True)
    middles = cl._middles(own, model)
    rows = cl._curved_bounds(own.withColumn("_bound", F.lit(-1.0)), columns, middles, cl._bends(own, columns, middles)).collect()
    for j in (0, 1):
        mine = [r for r in rows if r["_label"] == j]
        x, w = np.array([[r[c] for c in columns] for r in mine]), np.array([r["_w"] for r in mine])
        sums = (np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) * w[None]).sum(1)
        low = np.array([r["_bound"] for r in mine])
        assert (low <= sums * (1 + 1e-9)).all()
        if dims > 1 and scale == 1:  # along a line the bound of the bins, not this one, tells rows apart
            assert (low <= sums.min()).sum() < 0.1 * len(sums)


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    out = run()
    count = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    spark.sparkContext.setJobGroup("rest", "rest")
    return out, count


def test_all_k_move_in_the_same_rounds(spark):
    draw = np.random.default_rng(8)
    data = [(float(x), float(y), "uvw"[i % 3], "pq"[i % 2]) for i, (x, y) in enumerate(draw.normal(size=(300, 2)) + 4 * draw.integers(3, size=(300, 1)))]
    df = spark.createDataFrame(data, "x double, y double, a string, b string").cache()
    ks = [2, 3, 5, 6]
    for grid, one in (
        (lambda k: cl.kmeans_grid(df, ["x", "y"], k, 5, init="first"), lambda k: cl.kmeans(df, ["x", "y"], k, 5, init="first")[1]),
        (lambda k: cl.kmodes_grid(df, ["a", "b"], k, 5, restarts=2), lambda k: cl.kmodes(df, ["a", "b"], k, 5, restarts=2).cost),
        (lambda k: cl.kprototypes_grid(df, ["x"], ["a"], k, 1.0, 5), lambda k: cl.kprototypes(df, ["x"], ["a"], k, 1.0, 5).cost),
    ):
        assert {k: m.cost for k, m in grid(ks).items()} == pytest.approx({k: one(k) for k in ks})


def test_the_number_of_jobs_does_not_follow_the_number_of_k(spark):
    draw = np.random.default_rng(9)
    df = spark.createDataFrame([tuple(map(float, r)) for r in draw.normal(size=(200, 2))], "x double, y double").cache()

    def run(ks):
        fits = {k: (m.label(df), m.cost) for k, m in cl.kmeans_grid(df, ["x", "y"], ks, 3, init="first").items()}
        return cl.score_grid(fits, ["x", "y"], spark, with_silhouette=True)

    run([2])
    _, few = jobs_of(spark, "few", lambda: run([2, 3]))
    scores, many = jobs_of(spark, "many", lambda: run([2, 3, 4, 5, 6, 7]))
    assert many <= few + 1 and scores.count() == 6 * 5


def test_silhouettes_of_several_labellings(spark, blobs):
    labelled = {k: cl.kmeans(blobs, ["x", "y"], k, 4, init="first")[0] for k in (1, 2, 4)}
    found = cl.silhouette_grid(labelled, cl.statistics_grid(labelled, ["x", "y"]), ["x", "y"])
    assert math.isnan(found[1])
    for k in (2, 4):
        assert found[k] == pytest.approx(cl.silhouette(labelled[k], ["x", "y"]))


def test_products_are_dealt_by_their_number_and_cut_into_grams_once(spark, monkeypatch):
    from tillroll.registry import text as rt
    from tillroll.registry import views

    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(views, "DEALT_ROWS", 20, raising=False)
    rows = rt.products(spark, folder)
    assert rows.rdd.getNumPartitions() == -(-spark.read.parquet(f"{folder}/part.parquet").count() // 20)
    written = []
    monkeypatch.setattr(nm, "materialize", lambda df: written.append(df.columns) or materialize(df))
    nm.train_classifier(rows, "item_name", "category", max_iter=2)
    assert written == [["item_name", "category", "_grams"]]
