"""Chinese-restaurant seating for a two-level hierarchical Pitman-Yor model.

A restaurant per context seats the words that follow it; opening a table sends
a customer to the parent that all contexts share. Given the tables elsewhere,
the number of tables t at which c customers eat one dish has probability
proportional to S(c, t) * (strength + discount * other tables, stepped t times)
* parent ** t, with generalised Stirling numbers S. A Gibbs step draws t anew.
Up to EXACT customers it is drawn from these weights; beyond, the customers are
seated again one after another, in groups of a sixteenth of those seated.
"""

from __future__ import annotations

import numpy as np

EXACT = 32
CELLS = 1 << 18


def log_stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """log S(c, t) for c, t up to ``most``; S(c + 1, t) = S(c, t - 1) + (c - discount * t) S(c, t)."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0
    for c in range(1, most):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where(t <= c, out[c, t] + np.log(np.maximum(c - discount * t, 1e-300)), -np.inf)
        out[c + 1, t] = np.logaddexp(out[c, t - 1], stay)
    return out


def seat(customers: np.ndarray, others: np.ndarray, parent: np.ndarray, strength: float, discount: float,
         stirling: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables per dish: ``others`` are the restaurant's other tables, ``parent`` the dish's parent probability."""
    tables = np.minimum(customers, 1).astype(np.int64)
    small = np.flatnonzero((customers > 1) & (customers <= EXACT))
    order = small[np.argsort(customers[small], kind="stable")]
    sizes, starts = np.unique(customers[order], return_index=True)
    for c, group in zip(sizes.tolist(), np.split(order, starts[1:])):
        rows = max(1, CELLS // c)
        for lo in range(0, len(group), rows):
            at = group[lo:lo + rows]
            step = np.arange(c)
            weight = np.cumsum(np.log(strength + discount * (others[at][:, None] + step)) + np.log(parent[at])[:, None], axis=1)
            weight += stirling[c, 1:c + 1]
            weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            tables[at] = 1 + (weight < rng.random(len(at))[:, None] * weight[:, -1:]).sum(axis=1).clip(0, c - 1)
    at = np.flatnonzero(customers > EXACT)
    seated = np.ones(len(at), np.int64)
    while len(at):
        group = np.minimum(np.maximum(seated // 16, 1), customers[at] - seated)
        new = (strength + discount * (others[at] + tables[at])) * parent[at]
        tables[at] += rng.binomial(group, new / (new + np.maximum(seated - discount * tables[at], 1e-9)))
        seated = seated + group
        more = seated < customers[at]
        at, seated = at[more], seated[more]
    return tables


def predictive(customers, tables, all_customers, all_tables, parent, strength: float, discount: float):
    """Probability of a dish in a restaurant; the parent's where the restaurant is empty."""
    return (np.maximum(customers - discount * tables, 0) + (strength + discount * all_tables) * parent) / (strength + all_customers)


def discount_of(once: int, twice: int) -> float:
    """Discount from how many dishes were seen once and twice."""
    return float(np.clip(once / (once + 2 * twice), 0.05, 0.95)) if once and twice else 0.5
