import numpy as np

from shredline.llm import toxicity


def test_the_solver_converges():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 4000, 300)) for _ in range(600)]
    x, y = toxicity.SparseRows(rows, rng.normal(0, 2, 4000)), rng.integers(0, 2, 600).astype(float)

    def gradient(w, b):
        p = 1 / (1 + np.exp(-(x.dot(w) + b)))
        return np.hypot(np.linalg.norm(x.transposed_dot(p - y) + toxicity.PENALTY * w), (p - y).sum())

    start = gradient(np.zeros(4000), np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    assert gradient(*toxicity.fit_logistic(x, y, toxicity.PENALTY)) <= 1e-6 * start
