"""The nearest centre with groups left out, next to all distances."""

import numpy as np
import pytest

from corpus_engine.operators.centres import Centres


@pytest.mark.parametrize("cosine", [True, False])
@pytest.mark.parametrize("count", [1, 2, 40, 400])
def test_nearest_equals_that_of_all(cosine, count):
    rng = np.random.default_rng(count)
    middles = rng.normal(size=(7, 6)) * 10
    centres = middles[rng.integers(0, 7, count)] + rng.normal(size=(count, 6))
    rows = np.concatenate([middles[rng.integers(0, 7, 1500)] + rng.normal(size=(1500, 6)), centres[:20], np.zeros((2, 6))])
    if count > 10:
        centres[5], centres[9] = centres[3], 0.0
    ids = rng.permutation(count * 2)[:count]
    got, far = Centres(ids, centres, cosine).nearest(rows)
    if cosine:
        length = np.linalg.norm(rows, axis=1)[:, None] * np.linalg.norm(centres, axis=1)[None, :]
        d = 1 - np.divide(rows @ centres.T, length, out=np.zeros_like(length), where=length > 0)
    else:
        d = np.sqrt(((rows[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2))
    least = d.min(axis=1)
    assert np.allclose(far, least)
    ties = d <= least[:, None] + 1e-12
    want = np.where(ties, ids[None, :], 10**6).min(axis=1)
    assert (got == want).mean() > 0.999 and ties[np.arange(len(rows)), [list(ids).index(g) for g in got]].all()


def test_groups_far_away_are_not_compared(monkeypatch):
    rng = np.random.default_rng(3)
    centres = np.concatenate([rng.normal(size=(100, 4)) + 100 * k for k in range(9)])
    table = Centres(np.arange(900), centres, False)
    seen = []
    inner = Centres._measured
    monkeypatch.setattr(Centres, "_measured", staticmethod(lambda a, a2, b, b2: seen.append(len(a) * len(b)) or inner(a, a2, b, b2)))
    table.nearest(centres[::9] + 0.1)
    assert sum(seen) < 0.4 * 100 * 900


def test_no_centres():
    got, far = Centres(np.zeros(0, dtype=np.int64), np.zeros((0, 3)), True).nearest(np.ones((2, 3)))
    assert got.tolist() == [-1, -1] and np.isinf(far).all()
