"""Exact quantiles of a column that is counted in tasks and never sorted in one of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1_024
#: a bin with no more rows than this is read
FEW = 4_096


def nth_smallest(rows: DataFrame, value: Column, place: int) -> float:
    """The value at ``place`` (from 0) in ascending order, by counting ever narrower bins."""
    values = rows.select(value.alias("x"))
    low, high = values.agg(F.min("x"), F.max("x")).first()
    while low < high:
        share = (F.col("x") - low) / (high - low)
        bins = (
            values.groupBy(F.least(F.floor(share * BINS), F.lit(BINS - 1)).alias("bin"))
            .agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
            .orderBy("bin")
            .collect()
        )
        for found in bins:
            if place < found["n"]:
                break
            place -= found["n"]
        low, high = found["low"], found["high"]
        values = values.where(F.col("x").between(low, high))
        if found["n"] <= FEW:
            return sorted(r["x"] for r in values.collect())[place]
    return low


def quantile(rows: DataFrame, value: Column, share: float, count: int) -> float:
    """As numpy's ``quantile`` of the ``count`` values of ``rows``, none of them null."""
    place, rest = divmod(share * (count - 1), 1)
    below = nth_smallest(rows, value, int(place))
    above = nth_smallest(rows, value, int(place) + 1) if rest else below
    return float(np.quantile([below, above], rest))
