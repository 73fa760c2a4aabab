import pytest

from headway.operators import metrics

ROWS = [(1, 1, 0.9), (0, 1, 0.8), (1, 1, 0.8), (0, 0, 0.3), (1, 0, 0.2), (0, 0, 0.2)]


def scored(spark, rows=ROWS):
    return spark.createDataFrame(rows, "y_true int, y_pred int, y_proba double")


def brute_auc(rows):
    pos = [p for y, _, p in rows if y]
    neg = [p for y, _, p in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)


def test_scores(spark):
    row = metrics.ranking_scores(scored(spark)).first()
    assert row["roc_auc"] == pytest.approx(brute_auc(ROWS))
    # thresholds .9 (1/1), .8 (2/3), .3 (2/4), .2 (3/6): recall steps 1/3, 1/3, 0, 1/3
    assert row["average_precision"] == pytest.approx((1 + 2 / 3 + 1 / 2) / 3)
    both = metrics.overall(scored(spark)).first()
    assert both["accuracy"] == pytest.approx(4 / 6) and both["support"] == 6


def test_report_and_matrix(spark):
    matrix = sorted(tuple(r) for r in metrics.confusion_matrix(scored(spark)).collect())
    assert matrix == [(0, 2, 1), (1, 1, 2)]
    report = {r["row"]: r for r in metrics.classification_report(scored(spark)).collect()}
    assert list(report) == ["0", "1", "accuracy", "macro avg", "weighted avg"]
    assert report["1"]["precision"] == pytest.approx(2 / 3) and report["1"]["support"] == 3
    one_class = metrics.classification_report(scored(spark, [(0, 0, 0.1)]))
    assert {r["row"]: r["precision"] for r in one_class.collect()}["1"] == 0.0


def test_curves_have_their_end_points(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (0, 0, 0.2), (1, 0, float("nan"))], "y_true int, y_pred int, y_proba double")
    roc = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(df).collect())
    assert roc == [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)]
    ends = {(r["recall"], r["precision"]) for r in metrics.precision_recall_curve(df).collect()}
    assert ends == {(0.0, 1.0), (1.0, 1.0), (1.0, 0.5)}
    one_class = df.where("y_true = 0")
    assert {r["tpr"] for r in metrics.roc_curve(one_class).collect()} == {0.0, None}
    assert {r["recall"] for r in metrics.precision_recall_curve(one_class).collect()} == {0.0, None}


def test_single_class_has_no_auc(spark):
    row = metrics.ranking_scores(scored(spark, [(0, 0, 0.1), (0, 1, 0.6)])).first()
    assert row["roc_auc"] is None and row["average_precision"] is None


def test_calibration_edges_and_slices(spark):
    rows = [(1, 1, 0.1), (0, 0, 0.0), (1, 1, 0.11), (1, 1, 1.0)]
    got = {r["bin"]: r["n"] for r in metrics.calibration(scored(spark, rows)).collect()}
    assert got == {1: 2, 2: 1, 10: 1}
    df = spark.createDataFrame([(0, 1, 1), (3, 0, 0), (4, 1, 1), (4, 1, 0), (None, 1, 1)], "hour int, y_true int, y_pred int")
    sliced = metrics.slice_precision_recall(df, "hour", [0, 3, 6]).collect()
    assert {r["bucket"]: (r["support"], r["precision"], r["recall"]) for r in sliced} == {1: (2, 1.0, 1.0), 2: (2, 1.0, 0.5)}


def test_evaluation_is_one_row(spark):
    rows = metrics.evaluation(scored(spark)).collect()
    assert len(rows) == 1
    assert rows[0]["confusion_matrix"] == [[2, 1], [1, 2]]
    assert len(rows[0]["classification_report"]) == 5
