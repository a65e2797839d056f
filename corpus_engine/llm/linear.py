"""Linear classifiers on sparse rows, fitted inside one task on a bounded sample."""

from __future__ import annotations

import numpy as np

Rows = list[tuple[np.ndarray, np.ndarray]]


def svm(rows: Rows, sign: np.ndarray, width: int, cost: float = 1.0, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Linear support vector machine (hinge loss) by dual coordinate ascent; weights and bias.

    The rarer side's rows weigh more, so that both sides count alike. The bias is the weight of a
    feature that is one everywhere. The order of visits is fixed, so a fit can be repeated.
    """
    weights, bias = np.zeros(width), 0.0
    share = {s: max((sign == s).mean(), 1e-9) for s in (-1, 1)}
    bound = np.array([cost * 0.5 / share[s] for s in sign])
    norms = np.array([v @ v + 1.0 for _, v in rows])
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            index, value = rows[i]
            slack = sign[i] * (weights[index] @ value + bias) - 1.0
            now = min(max(alpha[i] - slack / norms[i], 0.0), bound[i])
            step = (now - alpha[i]) * sign[i]
            if step:
                alpha[i] = now
                weights[index] += step * value
                bias += step
    return weights, bias


def logistic(rows: Rows, target: np.ndarray, width: int, rounds: int = 24, rate: float = 0.3, shrink: float = 1e-2):
    """Logistic regression by gradient steps with per-weight rates; weights and bias."""
    weights, bias = np.zeros(width), 0.0
    seen, seen_bias = np.full(width, 1e-2), 1e-2
    order = np.random.default_rng(7)
    balance = np.where(target == 1, 0.5 / max(target.mean(), 1e-9), 0.5 / max(1 - target.mean(), 1e-9))
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            index, value = rows[i]
            error = balance[i] * (1.0 / (1.0 + np.exp(-np.clip(weights[index] @ value + bias, -30, 30))) - target[i])
            slope = error * value + shrink * weights[index]
            seen[index] += slope * slope
            weights[index] -= rate * slope / np.sqrt(seen[index])
            seen_bias += error * error
            bias -= rate * error / np.sqrt(seen_bias)
    return weights, bias


def held_back(classes: np.ndarray, every: int = 4) -> np.ndarray:
    """Every fourth row of each class, to fit probabilities on."""
    out = np.zeros(len(classes), dtype=bool)
    for c in np.unique(classes):
        out[np.flatnonzero(classes == c)[every - 1 :: every]] = True
    return out


def margins(rows: Rows, weights: np.ndarray, bias: float) -> np.ndarray:
    return np.array([weights[i] @ v + bias for i, v in rows])


def calibration(margin: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a sigmoid that turns margins into probabilities.

    Targets are pulled in by one row of each class, and Newton steps are kept stable by a small
    ridge, so separable margins get a finite slope. The slope is never negative.
    """
    high, low = (target.sum() + 1) / (target.sum() + 2), 1 / ((1 - target).sum() + 2)
    goal = np.where(target == 1, high, low)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(a * margin + b, -30, 30)))
        error, curve = p - goal, p * (1 - p)
        gradient = np.array([error @ margin + 1e-3 * (a - 1), error.sum() + 1e-3 * b])
        hessian = np.array(
            [[curve @ margin**2 + 1e-3, curve @ margin], [curve @ margin, curve.sum() + 1e-3]]
        )
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        a, b = max(a - step[0], 1e-3), b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)
