"""The language set of a long text with a small second language."""

import numpy as np

from cadastre.llm import langid


def test_two_runs_in_a_hundred():
    rng = np.random.default_rng(3)
    weight = np.full((2, langid.BUCKETS), 0.1)
    weight[0, :100] = weight[1, 100:200] = 100.0
    log_p = np.log(weight / weight.sum(axis=1, keepdims=True))
    other = np.zeros(2000, bool)
    other[rng.choice(2000, 38, replace=False)] = True
    got = rng.integers(0, 100, 2000 * langid.RUN) + 100 * np.repeat(other, langid.RUN)
    one = rng.integers(0, 100, 2000 * langid.RUN)
    share = langid.proportions(np.concatenate([got, one]), np.array([len(got), len(one)]), log_p)
    assert abs(share[0, 1] - 0.019) < 1e-3
    assert share[1].tolist() == [1.0, 0.0]
