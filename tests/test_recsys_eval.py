import pytest

from tessera.operators import evaluation as ev
from tessera.operators import recsys as rs


def test_trust_weighted_rating_cases(spark):
    ratings = spark.createDataFrame([(2, 100, 4.0), (3, 100, 2.0), (3, 200, 5.0), (1, 300, 1.0)],
                                    "user_id INT, item_id INT, rating DOUBLE")
    edges = spark.createDataFrame([(1, 2, 1.0), (1, 3, 3.0), (5, 2, 1.0)], "src INT, dst INT, weight DOUBLE")
    targets = spark.createDataFrame([(1, 100), (1, 200), (4, 100), (5, 999)], "user_id INT, item_id INT")
    got = {(r["user_id"], r["item_id"]): r["trust_pred"] for r in
           rs.trust_weighted_rating(targets, edges, ratings, 3.0).collect()}
    assert got[(1, 100)] == pytest.approx((1 * 4 + 3 * 2) / 4)
    assert got[(1, 200)] == pytest.approx(5.0)
    assert got[(4, 100)] == 3.0          # user without edges
    assert got[(5, 999)] == 3.0          # neighbours without the item


def test_class_report_never_predicted_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 2)], "label INT, prediction INT")
    rep = {r["class"]: r for r in ev.per_class_report(df).collect()}
    assert rep[1]["precision"] == 0.0 and rep[1]["recall"] == 0.0 and rep[1]["f1"] == 0.0
    assert rep[0]["precision"] == pytest.approx(2 / 3) and rep[0]["recall"] == 1.0
    s = ev.summary_report(ev.per_class_report(df)).first()
    assert s["accuracy"] == 0.75


def test_roc_auc_with_ties_matches_pair_count(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.7), (0, 0.3), (1, 0.3), (0, 0.1)]
    df = spark.createDataFrame(rows, "pos LONG, score DOUBLE")
    auc = ev.roc_auc(df, "pos", "score").first()["auc"]
    p = [s for y, s in rows if y == 1]
    n = [s for y, s in rows if y == 0]
    exp = sum((a > b) + 0.5 * (a == b) for a in p for b in n) / (len(p) * len(n))
    assert auc == pytest.approx(exp)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 1.0)], "label DOUBLE, prediction DOUBLE")
    m = ev.regression_metrics(df).first()
    assert m["mse"] == pytest.approx(5 / 3) and m["mae"] == pytest.approx(1.0)
    assert m["r2"] == pytest.approx(1 - 5 / 2)
    assert m["cumulative_error"] == pytest.approx(-1.0)
