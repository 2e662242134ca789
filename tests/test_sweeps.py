"""A sweep that shares its passes gives what fits one by one give."""

import random

import pytest

from pastline.learners import models as L
from pastline.learners import search as V
from pastline.learners import sweeps as SW
from pastline.learners.data import expanding_folds, fold_frames


@pytest.fixture(scope="module")
def train(spark):
    draw = random.Random(5)
    rows = []
    for i in range(360):
        c = draw.choices([0.0, 1.0, 2.0], [5, 3, 2])[0] if i > 40 else 0.0  # the first block has one class
        rows.append((i, c, draw.gauss(c, 1 + c), draw.gauss(100 - 3 * c, 2.0)))
    return spark.createDataFrame(rows, "seq long, label double, a double, b double").checkpoint()


def test_folds_are_the_fits_of_their_rows(train):
    fitted = SW.nb_folds(train, ["a", "b"], [1e-9, 0.1], seq="seq", n=360, k=4)
    for (i, tr, _), models in zip(fold_frames(train, "seq", 360, 4), fitted):
        for e, m in models.items():
            want = L.fit_gaussian_nb(tr, ["a", "b"], e)
            assert m.priors == pytest.approx(want.priors)
            for c in want.priors:
                assert m.means[c] == pytest.approx(want.means[c]) and m.vars[c] == pytest.approx(want.vars[c])


def test_curve_equals_one_by_one(train):
    grid = [1e-9, 1e-3, 1.0]
    got = SW.nb_curve(train, ["a", "b"], grid, seq="seq", n=360, k=3)
    want = V.validation_curve(lambda t, e: L.fit_gaussian_nb(t, ["a", "b"], e), grid, train, seq="seq", n=360, k=3)
    assert len(expanding_folds(360, 3)) == 3
    for g, w in zip(got, want):
        assert str(g["value"]) == w["value"] and g["fold_mean"] == pytest.approx(w["fold_mean"]) and g["fold_std"] == pytest.approx(w["fold_std"])
    assert sum(g["best"] for g in got) == 1
