"""Variational inference for topic models, over many texts at once."""

from __future__ import annotations

import numpy as np

SHIFT = 8  # the series are exact to 12 digits from there on


def digamma(x: np.ndarray) -> np.ndarray:
    """The derivative of the logarithm of the gamma function, for positive values."""
    x = np.array(x, np.float64)
    lower = np.zeros_like(x)
    for _ in range(SHIFT):
        small = x < SHIFT
        if not small.any():
            break
        lower = np.where(small, lower - 1 / x, lower)
        x = np.where(small, x + 1, x)
    r = 1 / (x * x)
    tail = r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r * (1 / 132)))))
    return lower + np.log(x) - 0.5 / x - tail


def log_gamma(x: np.ndarray) -> np.ndarray:
    """The logarithm of the gamma function, for positive values."""
    x = np.array(x, np.float64)
    lower = np.zeros_like(x)
    for _ in range(SHIFT):
        small = x < SHIFT
        if not small.any():
            break
        lower = np.where(small, lower - np.log(x), lower)
        x = np.where(small, x + 1, x)
    r = 1 / (x * x)
    tail = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r * (1 / 1188))))) / x
    return lower + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + tail


def expected_log(weights: np.ndarray) -> np.ndarray:
    """Expected logarithms under a Dirichlet distribution per row."""
    return digamma(weights) - digamma(weights.sum(1))[:, None]


def settle(
    n: np.ndarray,
    terms: np.ndarray,
    first: np.ndarray,
    alpha: float,
    tolerance: float = 1e-4,
    most: int = 100,
) -> tuple[np.ndarray, np.ndarray]:
    """Topic weights of many texts, and for each row what its term adds to the topics.

    Rows are the terms of the texts, one text after the other; ``first`` is where each
    text starts, ``n`` how often the term occurs, ``terms`` the exponentials of the
    expected logarithms of its weights.  A text is done when its weights move less than
    ``tolerance`` on average, whatever the others do.
    """
    texts, k = len(first), terms.shape[1]
    sizes = np.diff(np.append(first, len(n)))
    weights = np.add.reduceat(n, first)[:, None] / k + np.full((texts, k), alpha)
    live = np.arange(texts)
    rows, counts, starts, lengths = terms, n, first, sizes
    for _ in range(most):
        share = np.exp(expected_log(weights[live]))
        spread = np.repeat(share, lengths, axis=0)
        norm = (spread * rows).sum(1) + 1e-300
        moved = alpha + share * np.add.reduceat(rows * (counts / norm)[:, None], starts)
        going = np.abs(moved - weights[live]).mean(1) > tolerance
        weights[live] = moved
        if not going.any():
            break
        if not going.all():
            keep = np.repeat(going, lengths)
            live, rows, counts, lengths = live[going], rows[keep], counts[keep], lengths[going]
            starts = np.cumsum(lengths) - lengths
    share = np.repeat(np.exp(expected_log(weights)), sizes, axis=0) * terms
    return weights, share * (n / (share.sum(1) + 1e-300))[:, None]


def text_bounds(
    n: np.ndarray, terms: np.ndarray, first: np.ndarray, weights: np.ndarray, alpha: float
) -> np.ndarray:
    """Each text's part of the lower bound of the likelihood, given its weights."""
    k = weights.shape[1]
    logs = expected_log(weights)
    sizes = np.diff(np.append(first, len(n)))
    norm = (np.repeat(np.exp(logs), sizes, axis=0) * terms).sum(1) + 1e-300
    bound = np.add.reduceat(n * np.log(norm), first)
    bound += ((alpha - weights) * logs + log_gamma(weights)).sum(1) - k * log_gamma(alpha)
    return bound + log_gamma(k * alpha) - log_gamma(weights.sum(1))
