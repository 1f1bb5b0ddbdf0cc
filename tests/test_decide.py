import pytest

from ligature.operators import decide, metrics

SCHEMA = "s1_id string, cand_id string, prob double, emb_score double"


def run(spark, rows, t1=0.5, te=0.8, margin=0.0, exclusive=True, schema=SCHEMA, s1="AB"):
    df = spark.createDataFrame(rows, schema)
    out = decide.decide(df, spark.createDataFrame([(x,) for x in s1], "s1_id string"), t1, te, margin, exclusive).collect()
    return {r["s1_id"]: r["matched_ids"] for r in out}


def test_exclusivity(spark):
    assert run(spark, [("A", "C1", 0.90, 0.85), ("B", "C1", 0.80, 0.85)]) == {"A": "C1", "B": ""}


def test_tie_goes_to_the_better_score(spark):
    assert run(spark, [("A", "C1", 0.85, 0.70), ("B", "C1", 0.85, 0.90)]) == {"A": "", "B": "C1"}


def test_margin_drops_close_calls(spark):
    assert run(spark, [("A", "C1", 0.82, 0.80), ("B", "C1", 0.80, 0.80)], margin=0.05) == {"A": "", "B": ""}


def test_thresholds(spark):
    rows = [("A", "C1", 0.9, 0.0), ("A", "C2", 0.82, 0.0), ("A", "C3", 0.7, 0.0), ("B", "C4", 0.45, 0.0), ("B", "C5", 0.40, 0.0)]
    assert run(spark, rows, exclusive=False) == {"A": "C1,C2", "B": ""}


def test_competitor_wins_and_is_dropped(spark):
    rows = [("A", "C1", 0.7, 0.0, 0), ("B", "C1", 0.95, 0.0, 1)]
    assert run(spark, rows, schema=SCHEMA + ", is_competitor int", s1="A") == {"A": ""}


def test_no_rows(spark):
    assert run(spark, []) == {"A": "", "B": ""}


@pytest.mark.parametrize(("pred", "gold", "f"), [("c1 c2 c3", "c1 c2", 0.714286), ("", "", 1.0), ("c1", "", 0.0), ("", "c1", 0.0), ("c1", "c1 c2", 0.833333)])
def test_entity_score(spark, pred, gold, f):
    pairs = lambda ids: spark.createDataFrame([("A", x) for x in ids.split()], "s1_id string, cand_id string")
    out = metrics.entity_scores(pairs(pred), pairs(gold), spark.createDataFrame([("A",)], "s1_id string")).first()
    assert out["f05"] == f


def test_grid_matches_single_decisions(spark):
    rows = spark.createDataFrame([("A", "C1", 0.9, 0.1), ("A", "C2", 0.6, 0.1), ("B", "C3", 0.4, 0.1)], SCHEMA)
    gold = spark.createDataFrame([("A", "C1"), ("A", "C2")], "s1_id string, cand_id string")
    s1 = spark.createDataFrame([("A",), ("B",), ("C",)], "s1_id string")
    grid = {(r["t_top1"], r["t_extra"]): r["f05"] for r in decide.grid_search(rows, gold, s1, [0.3, 0.5], [0.5, 0.8], [0.0], (True,)).collect()}
    for (a, b), f in grid.items():
        pred = decide.thresholds(decide.exclusivity(rows), a, b)
        assert abs(metrics.macro_f05(pred, gold, s1).first()["macro_f05"] - f) < 1e-4


def test_full_grid_and_its_best_setting(spark):
    rows = spark.createDataFrame([("A", "C1", 0.9, 0.1), ("A", "C2", 0.6, 0.1), ("B", "C1", 0.88, 0.1), ("B", "C3", 0.4, 0.1)], SCHEMA)
    gold = spark.createDataFrame([("A", "C1"), ("A", "C2")], "s1_id string, cand_id string")
    s1 = spark.createDataFrame([("A",), ("B",)], "s1_id string")
    grid = decide.grid_search(rows, gold, s1)
    assert grid.count() == 6 * sum(1 for a in decide.TOP1 for b in decide.EXTRA if b >= a)
    best = decide.best_setting(grid).first()
    assert (best["exclusive"], best["margin"], best["f05"]) == (True, 0.0, 1.0)
    pred = decide.thresholds(decide.exclusivity(rows), best["t_top1"], best["t_extra"])
    assert metrics.macro_f05(pred, gold, s1).first()["macro_f05"] == 1.0
