"""Arithmetic of ranks and search scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Damping factor and the L1 change below which ranking stops.
DAMPING = 0.85
TOLERANCE = 0.001

# Ranks are sums of doubles, whose last digits depend on summing order. Orderings compare
# values relative to the mean rank 1/n at this many places, so equal ranks stay equal.
ORDER_PLACES = 9


def teleport(dead_mass, n_total, damping: float = DAMPING):
    """Share every page gets: random jumps plus the spread rank of dead ends."""
    return ((1 - damping) + damping * dead_mass) / n_total


def tfidf(tf: Column, n_docs: Column, df: Column) -> Column:
    return tf * F.log10(n_docs / df)


def total_score(pr: Column, weight: Column) -> Column:
    return pr * weight * weight


def order_key(value: Column, n_docs: Column) -> Column:
    return F.round(value * n_docs, ORDER_PLACES)


def score_order(pr: Column, tf: Column, df: Column, n_docs: Column) -> Column:
    """Orders one query's results as their scores do. The query's own factor, however small, is
    left out; if all documents have the words, it is zero and so are all scores."""
    return F.when(df < n_docs, order_key(pr, n_docs) * tf * tf).otherwise(F.lit(0.0))


def rank_order(n_docs) -> list[Column]:
    """Best rank first, then title."""
    return [order_key(F.col("pr"), F.lit(n_docs)).desc(), F.col("title").asc()]
