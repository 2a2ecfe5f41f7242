from __future__ import annotations

import itertools

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillroll.operators import prepare as pr
from tillroll.operators import profile as pf
from tillroll.operators import quantiles
from tillroll.operators.quantiles import exact_quantiles
from tillroll.operators.ranking import dense_index


@pytest.mark.parametrize(
    "bad",
    [
        {"method": "Other", "k": 3},
        {"method": "WKMeans", "k": 3},
        {"k": 3, "weight": "mid"},
        {"k": 3, "auto": True},
        {},
        {"k": 3, "score": "x"},
        {"k": 3, "rfm_split": "x"},
        {"k": 3, "rfm_letters": ("r",)},
        {"k": 3, "rfm_letters": ("r", "x")},
        {"k": 3, "groups": ("nothing",)},
        {"k": 3, "init": "x"},
        {"k": 3, "restarts": 0},
    ],
)
def test_wrong_options(bad):
    with pytest.raises(ValueError):
        pr.Options(**bad)


def test_all_groups():
    assert pr.Options(k=2, groups=("all",)).group_names() == list(pr.CATALOGUE)


def test_required_columns(spark):
    with pytest.raises(ValueError, match="qty"):
        pr.select_features(spark.createDataFrame([("a", "b")], "mid string, pma_no_fin string"), [])


def test_fill_missing_by_type(spark):
    df = spark.createDataFrame([(None, None), ("a", 2)], "s string, n long")
    assert rows(pr.fill_missing(df)) == [(" ", 0), ("a", 2)]


def test_rfm_levels_and_letters(spark):
    data = [("a", "1", 1, 5, 10.0), ("b", "1", 3, 1, 30.0), ("c", "1", 2, 3, 20.0)]
    df = spark.createDataFrame(
        data, "mid string, pma_no_fin string, rfm_recency int, rfm_frequency int, rfm_monetary double"
    )
    level = lambda **k: {r["mid"]: r["rfm_level"] for r in pr.rfm_levels(df, **k).collect()}
    assert level() == {"a": "110", "b": "001", "c": "111"}
    assert level(letters=["m", "r"]) == {"a": "10", "b": "01", "c": "11"}
    assert level(how="median") == level()
    assert level(how="mode") == {"a": "111", "b": "011", "c": "011"}  # all once: smallest


def test_codes_round_trip(spark):
    df = spark.createDataFrame([("m", "b"), ("n", "a"), ("o", " ")], "mid string, city string")
    assert pr.text_columns(df) == ["city"]
    codes = pr.label_codes(df)
    coded = pr.encode_labels(df, codes, ["city"])
    assert {r["mid"]: r["city"] for r in coded.collect()} == {"m": 2, "n": 1, "o": 0}
    assert rows(pr.decode_labels(coded, codes, ["city"]).select("mid", "city")) == rows(df)


def test_dense_index_in_ranges(spark):
    data = [("x", f"v{i:04d}") for i in range(300)] * 2 + [("y", "b"), ("y", "a")]
    df = spark.createDataFrame(data, "g string, v string")
    for limit in (1000, 20):
        got = {(r["g"], r["v"]): r["code"] for r in dense_index(df, "g", "v", window_limit=limit).collect()}
        assert got["x", "v0000"] == 0 and got["x", "v0299"] == 299 and got["y", "b"] == 1
        assert len(got) == 302


@pytest.mark.parametrize("limit", [10_000, 50, 1])
def test_quantiles_match_numpy_with_hot_values(spark, limit):
    rng = np.random.default_rng(3)
    skewed = np.concatenate([rng.lognormal(0, 3, 400), np.full(300, 2.5), -rng.lognormal(0, 2, 100)])
    data = [("a", float(x)) for x in skewed] + [("b", float(x)) for x in range(11)] + [("c", None)]
    df = spark.createDataFrame(data, "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r["g"], r["prob"]): r["value"] for r in exact_quantiles(df, ["g"], ["x"], probs, limit).collect()}
    for p in probs:
        assert got["a", p] == pytest.approx(np.quantile(skewed, p))
        assert got["b", p] == pytest.approx(10 * p)
    assert len(got) == 12


def test_quantiles_of_odd_numbers_are_the_same_on_both_sides(spark):
    nan, inf = float("nan"), float("inf")
    data = [("a", float(i % 7)) for i in range(40)] + [("a", nan)] * 9 + [("a", None)]
    data += [("b", x) for x in (inf, -inf, 1.0, 2.0, 2.0, inf, 3.0)] + [("c", nan), ("d", None)]
    df = spark.createDataFrame(data, "g string, x double")
    probs = [0.0, 0.25, 0.5, 1.0]
    got = [sorted(map(tuple, exact_quantiles(df, ["g"], ["x"], probs, limit).collect())) for limit in (1000, 3)]
    assert got[0] == got[1] and {r[0] for r in got[0]} == {"a", "b"}
    assert [r[3] for r in got[0] if r[0] == "a"] == [np.quantile([i % 7 for i in range(40)], p) for p in probs]


@pytest.mark.parametrize(("accuracy", "margin"), [(10_000, 0.001), (20, 0.0001)])
def test_sketched_ranks_are_exact(spark, monkeypatch, accuracy, margin):
    # The second sketch is too coarse for its margin: what it misses is sought again.
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "MARGIN", margin)
    rng = np.random.default_rng(4)
    hot = np.round(rng.lognormal(0, 2, 30_000), 2)
    data = [(None, float(x)) for x in hot] + [(f"g{i % 700}", float(x)) for i, x in enumerate(rng.normal(size=5000))]
    df = spark.createDataFrame(data, "g string, x double")
    probs = [0.0, 0.013, 0.5, 0.9995, 1.0]
    got = {(r["g"], r["prob"]): r["value"] for r in exact_quantiles(df, ["g"], ["x"], probs, 100, 16).collect()}
    assert len(got) == 701 * len(probs)
    groups = {}
    for g, x in data:
        groups.setdefault(g, []).append(x)
    for (g, p), value in got.items():
        assert value == pytest.approx(np.quantile(groups[g], p), abs=1e-12)


def test_value_share_counts_blanks_apart(spark):
    df = spark.createDataFrame([(0, "a"), (0, "a"), (0, "b"), (0, " "), (0, None)], "label int, c string")
    got = {r["value"]: (r["cnt"], r["pct"], r["null_cnt"], r["null_pct"]) for r in pf.value_share(df, ["c"]).collect()}
    assert got == {"a": (2, 66.67, 2, 40.0), "b": (1, 33.33, 2, 40.0)}


def test_histogram_puts_the_maximum_in_the_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    got = {r["bin"]: r["cnt"] for r in pf.histogram(df, "x", 5).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    flat = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [(r["bin"], r["cnt"], r["density"]) for r in pf.histogram(flat, "x", 5).collect()] == [(0, 2, None)]


def test_group_size_and_empty_input(spark):
    df = spark.createDataFrame([(0,), (0,), (1,)], "label int")
    assert rows(pf.group_size(df)) == [(0, 2, 66.67), (1, 1, 33.33)]
    assert pf.group_size(df.filter(F.lit(False))).count() == 0


def test_options_of_a_table_are_checked_like_those_of_a_run(spark):
    values = {
        "method": ["KMeans", "WKMeans", "Ward", None],
        "weight": [None, "", "qty", "mid"],
        "k": [None, 3],
        "auto": [True, False],
        "score": ["elbow", "bic"],
        "restarts": [1, 0],
        "init": [None, "hash", "random"],
        "rfm_split": ["mode", "max"],
    }
    rows = list(itertools.product(*values.values()))
    schema = "method string, weight string, k int, auto boolean, score string, restarts int, init string, rfm_split string"
    found = spark.createDataFrame(rows, schema).withColumn("problem", pr.option_problem()).collect()
    for r in found:
        given = r.asDict()
        problem = given.pop("problem")
        try:
            pr.Options(**given)
            assert problem is None
        except ValueError:
            assert problem is not None
    assert {r["problem"] for r in found} == {None, "method", "weight", "k", "score", "start", "rfm_split"}
