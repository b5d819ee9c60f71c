from reuselens.functions import labels as L
from reuselens.operators import tuning as TU


def test_strict_thresholds(spark):
    sims = [0.34, 0.35, 0.36, 0.59, 0.60, 0.61, 0.84, 0.85, 0.86, None]
    df = spark.createDataFrame([(s,) for s in sims], "s double")
    got = [r[0] for r in df.select(L.copy_level("s")).collect()]
    assert got == [L.NON, L.NON, L.HEAVY, L.HEAVY, L.HEAVY, L.LIGHT, L.LIGHT, L.LIGHT, L.CUT, L.NON]


def test_label_maps(spark):
    cats = ["non", "heavy", "light", "cut", "orig", "other", None]
    df = spark.createDataFrame([(c,) for c in cats], "c string")
    rows = df.select(L.category_id("c"), L.plag_label("c"), L.truth_level("c")).collect()
    assert [r[0] for r in rows] == [0, 1, 2, 3, -1, None, None]
    assert [r[1] for r in rows] == [0, 1, 1, 1, -1, 1, 1]
    assert [r[2] for r in rows] == [L.NON, L.HEAVY, L.LIGHT, L.CUT, L.NON, None, None]


def test_grid_size():
    g = TU.threshold_grid()
    assert len(g) == 3535 and len(set(g)) == 3535
    assert g[0] == (0.75, 0.55, 0.25)


# similarity, true level
ROWS = [(0.9, L.CUT), (0.8, L.CUT), (0.7, L.LIGHT), (0.5, L.HEAVY), (0.45, L.LIGHT), (0.3, L.NON), (0.1, L.NON), (0.65, None)]


def test_tune_picks_the_best_point_of_a_small_grid(spark):
    """Of the eight rows the points get 3, 5, 6 and 6 right; the first of the
    two best wins."""
    df = spark.createDataFrame(ROWS, "best_sim double, truth_level string")
    grid = [(0.95, 0.85, 0.35), (0.85, 0.6, 0.35), (0.75, 0.6, 0.46), (0.75, 0.6, 0.47)]
    acc = {(r.t_cut, r.t_light, r.t_heavy): (r.hits, r.total) for r in TU.grid_accuracy(df, grid=grid).collect()}
    assert [acc[g] for g in grid] == [(3, 8), (5, 8), (6, 8), (6, 8)]
    got = TU.tune_thresholds(df, grid=grid).first()
    assert (got.t_cut, got.t_light, got.t_heavy, got.accuracy) == (0.75, 0.6, 0.46, 0.75)


def test_thresholds_are_strict_in_the_grid(spark):
    df = spark.createDataFrame([(0.75, L.LIGHT), (0.55, L.HEAVY), (0.25, L.NON)], "best_sim double, truth_level string")
    assert TU.grid_accuracy(df, grid=[(0.75, 0.55, 0.25)]).first().hits == 3


def test_bounded_histogram_gives_the_whole_grid(spark):
    df = spark.createDataFrame(ROWS, "best_sim double, truth_level string")
    assert TU.grid_accuracy(df).count() == 3535
    best = TU.tune_thresholds(df).first()
    # 0.45 is light although 0.5 is heavy, and one truth is unknown: 6 of 8 at most, first when 0.3 is below t_heavy
    assert best.accuracy == 0.75 and (best.t_cut, best.t_light, best.t_heavy) == (0.75, 0.55, 0.31)
