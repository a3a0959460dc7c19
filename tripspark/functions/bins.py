"""Fixed distance bins (D10, D11) and their display order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tripspark.schemas import DIST_BIN_EDGES, DIST_BIN_LABELS


def chain_distance_bin(x: Column) -> Column:
    """First matching ``x < upper`` in a ``when`` chain, else the last bin.

    Negative values land in the first bin and null in the last one.
    """
    expr = None
    for label, upper in zip(DIST_BIN_LABELS[:-1], DIST_BIN_EDGES[1:]):
        expr = F.when(x < upper, label) if expr is None else expr.when(x < upper, label)
    return expr.otherwise(DIST_BIN_LABELS[-1])


def right_open_distance_bin(x: Column) -> Column:
    """``lo <= x < hi`` from 0 upwards; null and negative values get no bin."""
    uppers = DIST_BIN_EDGES[1:] + [None]
    expr = None
    for label, lo, hi in zip(DIST_BIN_LABELS, DIST_BIN_EDGES, uppers):
        cond = x >= lo if hi is None else (x >= lo) & (x < hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def bin_order(label: Column) -> Column:
    """Position of a bin label, for ordering reports low to high."""
    expr = None
    for i, name in enumerate(DIST_BIN_LABELS):
        expr = F.when(label == name, i) if expr is None else expr.when(label == name, i)
    return expr
