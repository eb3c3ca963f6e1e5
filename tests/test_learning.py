"""Fit, importances, save and load, unseen categories and gaps."""

import random

import pytest

from kontora.plans import learning as L

SPEC = L.ModelSpec(
    "M", None, "id", "label_in", ("kind",), ("strong", "weak"), ("flagged",), {"strong": 0.0, "weak": 0.0},
    lambda: L.RandomForestClassifier(numTrees=20, maxDepth=4, seed=1, labelCol="label"), "guess",
)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    out = []
    for i in range(1500):
        strong, kind = rng.random(), rng.choice(["a", "b", "c"])
        out.append((i, kind, strong, rng.random(), rng.random() < 0.5, strong + (kind == "c") * 0.3 > 0.6))
    return spark.createDataFrame(out, "id long, kind string, strong double, weak double, flagged boolean, label_in boolean")


@pytest.fixture(scope="module")
def forest(spark, rows):
    return L.fit(spark, SPEC, rows)


def test_importances_of_trees(forest):
    model, scored = forest
    slots = L.slot_inputs(scored, SPEC)
    assert slots.count("kind") == 4 and slots[4:] == ["strong", "weak", "flagged"]  # three kinds and one for unseen ones
    shares = L.importances(model, scored, SPEC)
    assert abs(sum(shares.values()) - 1) < 1e-9 and list(shares)[:2] == ["strong", "kind"]
    assert max(shares["weak"], shares["flagged"]) < 0.05 < shares["kind"]


def test_importances_of_a_linear_model(spark, rows):
    linear = L.ModelSpec(**{**SPEC.__dict__, "estimator": lambda: L.LogisticRegression(labelCol="label", regParam=0.01)})
    shares = L.importances(*L.fit(spark, linear, rows), linear)
    assert abs(sum(shares.values()) - 1) < 1e-9 and next(iter(shares)) == "strong" and list(shares)[-1] in ("weak", "flagged")


def test_the_forest_beats_the_majority_and_is_stored(spark, forest, tmp_path):
    model, scored = forest
    n = scored.count()
    right = scored.where("guess = label").count() / n
    most = max(r["count"] for r in scored.groupBy("label").count().collect()) / n
    assert right > 0.9 > most
    store = L.ModelStore(spark, str(tmp_path))
    shares = L.importances(model, scored, SPEC)
    assert [store.log("M", model, {"accuracy": right}, "", shares) for _ in range(2)] == [1, 2]
    assert store.newest("M") == 2 and store.rows().count() == 2
    assert {r.feature_id: r.feature_importance for r in store.importances("M").collect()} == shares
    back = store.load("M", 1).transform(L.prepared(scored.select("id", "kind", "strong", "weak", "flagged", "label_in"), SPEC))
    assert back.select("id", "guess").exceptAll(scored.select("id", "guess")).isEmpty()


def test_unseen_categories_and_gaps(spark, forest):
    odd = spark.createDataFrame(
        [(1, "never seen", 0.9, None, True), (2, None, None, 0.1, False)], "id long, kind string, strong double, weak double, flagged boolean"
    )
    out = forest[0].transform(L.prepared(odd, SPEC)).select("id", "guess").collect()
    assert len(out) == 2 and all(r.guess in (0.0, 1.0) for r in out)


def test_stored_features(spark):
    rng = random.Random(5)
    data = [(i, str(i), v, None if i % 50 == 0 else rng.random(), v > 0.5) for i, v in ((i, rng.random()) for i in range(600))]
    rows = spark.createDataFrame(data, "label_id long, entity_id string, useful double, useless double, label boolean")
    spec = L.feature_spec("F", ["useful", "useless"])
    shares = L.importances(*L.fit(spark, spec, rows), spec)
    assert list(shares) == ["useful", "useless"] and shares["useful"] > 0.9


def test_a_fit_uses_all_cores_and_does_not_depend_on_the_parts(spark, rows):
    held = L._held(L.prepared(rows.coalesce(1), SPEC), SPEC)
    assert held.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and held.storageLevel.useMemory
    held.unpersist()
    small = L.ModelSpec(**{**SPEC.__dict__, "estimator": lambda: L.RandomForestClassifier(numTrees=5, maxDepth=3, seed=1, labelCol="label")})
    one, other = (L.fit(spark, small, rows.repartition(n, order)) for n, order in ((1, "weak"), (5, "strong")))
    assert one[0].stages[-1].toDebugString.split("\n")[1:] == other[0].stages[-1].toDebugString.split("\n")[1:]
