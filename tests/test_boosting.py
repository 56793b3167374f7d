"""Second-order boosting against a plain version on raw values."""

import numpy as np
import pytest

from faultline.operators import boosting


def slow_margins(x, y, rounds, depth, rate=0.3, penalty=1.0, price=0.0, least=1.0):
    """Every threshold of every sensor is tried in every node."""
    margin = np.zeros(len(y))

    def grow(rows, left_depth):
        g, h = gradient[rows].sum(), curvature[rows].sum()
        best = (1e-9, None)
        for at in range(x.shape[1]) if left_depth else ():
            values = x[rows, at]
            for cut in sorted(set(x[~np.isnan(x[:, at]), at]))[:-1]:  # of the whole table, so a node may part gaps from all its values
                for gaps_left in (True, False):
                    left = np.where(np.isnan(values), gaps_left, values <= cut)
                    gl, hl = gradient[rows][left].sum(), curvature[rows][left].sum()
                    if hl >= least and h - hl >= least:
                        gain = (gl**2 / (hl + penalty) + (g - gl) ** 2 / (h - hl + penalty) - g**2 / (h + penalty)) / 2 - price
                        if gain > best[0] * (1 + 1e-9):
                            best = (gain, (rows[left], rows[~left]))
        if best[1] is None:
            step[rows] = -rate * g / (h + penalty)
        else:
            for part in best[1]:
                grow(part, left_depth - 1)

    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-margin))
        gradient, curvature, step = chance - y, chance * (1 - chance), np.zeros(len(y))
        grow(np.arange(len(y)), depth)
        margin += step
    return margin


def table(spark, x, y):
    rows = [(i, [None if np.isnan(v) else float(v) for v in row], int(label)) for i, (row, label) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_key bigint, sensors array<double>, label int").repartition(3)


@pytest.mark.parametrize("local", [0, 300, 1 << 22])
@pytest.mark.parametrize("rounds, depth, options", [(1, 1, {}), (4, 3, {}), (3, 2, {"price": 2.0, "penalty": 5.0}), (3, 4, {"least": 6.0})])
def test_equals_plain_version(spark, monkeypatch, rounds, depth, options, local):
    """Level by level, with small nodes finished in tasks, and whole trees in one task."""
    monkeypatch.setattr(boosting, "LOCAL_VALUES", local)
    rng = np.random.default_rng(rounds)
    x = rng.integers(0, 9, (300, 4)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 5) ^ (rng.random(300) < 0.1)).astype(int)
    x[rng.random(x.shape) < 0.15] = np.nan
    frame = table(spark, x, y)
    scored = boosting.score(frame, boosting.fit(frame, rounds, depth=depth, **options)).orderBy("row_key").collect()
    want = 1 / (1 + np.exp(-slow_margins(x, y, rounds, depth, **options)))
    assert [r.probability for r in scored] == pytest.approx(want.tolist(), abs=1e-9)


def test_folded_margins_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    frame = table(spark, x, x[:, 0] * x[:, 1] > 0)
    whole = boosting.fit(frame, 6, depth=2)
    monkeypatch.setattr(boosting, "FOLD_ROUNDS", 2)
    folded = boosting.fit(frame, 6, depth=2)
    for one, other in zip(whole["trees"], folded["trees"], strict=True):
        assert [n[:4] for n in one] == [n[:4] for n in other]
        assert [n[4] for n in one] == pytest.approx([n[4] for n in other])


def test_learns_and_bears_odd_tables(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 5))
    frame = table(spark, x, (x[:, 0] * x[:, 1] > 0))
    scored = boosting.score(frame, boosting.fit(frame, 20))
    assert scored.where("label = prediction").count() > 390
    one_class = table(spark, x[:30], np.ones(30))
    assert boosting.score(one_class, boosting.fit(one_class, 3)).where("prediction = 1").count() == 30
    constant = table(spark, np.full((20, 2), np.nan), np.arange(20) % 2)
    assert {round(r.probability, 9) for r in boosting.score(constant, boosting.fit(constant, 3)).collect()} == {0.5}


def test_rows_are_stored_in_blocks(spark):
    """Passes read blocks with a byte per bin, not a row of integers per wafer; none is lost."""
    x = np.random.default_rng(5).normal(size=(9000, 3))
    x[0, 1] = np.nan
    booster = boosting.Booster(table(spark, x, x[:, 0] > 0), 0.3, 2, 1.0, 0.0, 1.0)
    blocks = booster.rows.collect()
    assert booster.size == 9000 == sum(r.n for r in blocks) and len(blocks) < 50
    assert all(len(r.bins) == 3 * r.n and len(r.label) == len(r.margin) == 8 * r.n <= 8 * boosting.BLOCK_ROWS for r in blocks)
    assert sum(r.bins.count(boosting.GAP) for r in blocks) == 1
