"""Published result tables that follow from each other by closed forms."""

import pytest

from flowbench.operators import metrics, summarize

# Published scores (model, family, accuracy, weighted F1, macro F1, AUC, train seconds).
SCORES = [
    ("Bagging (tuned)", "Bagging ensemble", 0.9217171717171717, 0.9248894766652742, 0.8351023346561766, 0.9893907740801842, 26.016285099991364),
    ("Bagging", "Bagging ensemble", 0.9102633477633477, 0.9133734581926661, 0.8463269604627186, 0.9868577816853529, 61.95802839999669),
    ("Gradient Boosting", "Boosting ensemble", 0.8862734487734488, 0.8870981286936523, 0.8344318869581901, 0.9911753628856694, 332.3163903999957),
    ("Decision Tree", "Single tree", 0.8815836940836941, 0.8854120550381952, 0.7799116753101842, 0.9166176274801273, 0.7321486999862827),
    ("Gradient Boosting (tuned)", "Boosting ensemble", 0.8841991341991342, 0.8849948522942257, 0.8270495147038346, 0.9922685978142385, 176.0330343999958),
    ("Random Forest", "Bagging ensemble", 0.8843795093795094, 0.883332822151866, 0.8025188358457791, 0.9882768564556714, 5.639717199985171),
    ("AdaBoost", "Boosting ensemble", 0.8508297258297258, 0.8540232086371118, 0.7491951122212116, 0.9735010022698491, 63.796252600004664),
]


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(SCORES, "model string, family string, accuracy double, f1 double, f1_macro double, auc double, train_s double")


def test_families(scores):
    out = {r["family"]: r for r in summarize.family_summary(scores, "family", "model", "f1", ["f1", "f1_macro", "auc", "train_s"]).collect()}
    b = out["Bagging ensemble"]
    assert b["models"] == "Bagging (tuned), Bagging, Random Forest" and b["configs"] == 3
    assert b["best_f1"] == 0.9248894766652742 and b["mean_f1"] == pytest.approx(0.9071985856699355)
    assert b["mean_auc"] == pytest.approx(0.9881751374070694) and b["mean_train_s"] == pytest.approx(31.204676899991075)
    assert out["Boosting ensemble"]["mean_f1"] == pytest.approx(0.87537206320833)


def test_ranks_and_summary(scores):
    r = {x["model"]: x for x in summarize.rank_metrics(scores, "model", {"accuracy": False, "f1": False, "f1_macro": False, "auc": False}).collect()}
    assert (r["Bagging (tuned)"]["accuracy"], r["Bagging (tuned)"]["f1_macro"], r["Bagging (tuned)"]["auc"]) == (1, 2, 3)
    assert (r["Bagging"]["f1_macro"], r["Bagging"]["auc"]) == (1, 5)
    s = {x["question"]: x["model"] for x in summarize.summary_table(scores, "model", ["accuracy", "f1", "f1_macro", "auc"], "train_s").collect()}
    assert s["Best f1"] == "Bagging (tuned)" and s["Best f1_macro"] == "Bagging" and s["Best auc"] == "Gradient Boosting (tuned)"
    assert s["Fastest to train (s)"] == "Decision Tree" and s["Best mean rank"] == "Bagging (tuned)"


def test_tuning_delta(scores):
    d = {(r["algorithm"], r["metric"]): r["change"] for r in summarize.tuning_delta(scores, "model", ["f1", "auc"]).collect()}
    assert d[("Bagging", "f1")] == pytest.approx(0.9248894766652742 - 0.9133734581926661)
    assert set(a for a, _ in d) == {"Bagging", "Gradient Boosting"}


def test_mcnemar_p_values():
    for b, c, p in ((155, 28, 1.645815236206231e-22), (513, 120, 9.275526909757611e-59), (955, 169, 1.5669261613314524e-133)):
        assert metrics.exact_binomial(b, c) == pytest.approx(p, rel=1e-6)
    assert metrics.exact_binomial(1714, 110) < 1e-300


def test_fold_summary(spark):
    f1 = [0.169573691430661, 0.24317802049768739, 0.4412416209688622, 0.9894455211696284, 0.7582139251601275]
    df = spark.createDataFrame([("Bagging (tuned)", "grouped", 5 - i, v) for i, v in enumerate(reversed(f1))], "model string, cv string, fold int, f1 double")
    r = summarize.fold_summary(df, ["model", "cv"], "fold", "f1").first()
    assert r["mean"] == pytest.approx(0.5203305558453933) and r["std"] == pytest.approx(0.31072699061758663)
    assert r["folds"] == f1
