"""Plain versions of the fits that classifiers share: dictionaries of features, one row after another."""

import numpy as np


def hinge(rows, sign, cost, epochs):
    """Weights by feature, and of the constant, after dual coordinate descent over rows in the published order of draws."""
    w, alpha, draw = {"constant": 0.0}, [0.0] * len(rows), np.random.default_rng(7)
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            margin = sum(w.get(k, 0.0) * v for k, v in rows[i].items()) + w["constant"]
            square = sum(v * v for v in rows[i].values()) + 1.0
            new = min(max(alpha[i] - (sign[i] * margin - 1) / square, 0.0), cost[i])
            step, alpha[i] = (new - alpha[i]) * sign[i], new
            for k, v in rows[i].items():
                w[k] = w.get(k, 0.0) + step * v
            w["constant"] += step
    return w


def curve(margins, y, weight):
    """Slope and offset that minimise the weighted log loss on smoothed targets, by a fine search instead of Newton's steps."""
    one, zero = weight[y > 0].sum(), weight[y <= 0].sum()
    target = np.where(y > 0, (one + 1) / (one + 2), 1 / (zero + 2))

    def loss(a, b):
        m = np.clip(a * margins + b, -40, 40)
        return (weight * (np.log1p(np.exp(-m)) + (1 - target) * m)).sum() + 0.5e-3 * (a * a + b * b)

    best, width = (1.0, 0.0), 16.0
    while width > 1e-7:
        around = [(best[0] + i * width, best[1] + j * width) for i in (-1, 0, 1) for j in (-1, 0, 1)]
        nearest = min(around, key=lambda p: loss(*p))
        if nearest == best:
            width /= 2
        best = nearest
    return best
