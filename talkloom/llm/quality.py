"""Quality classifier with hierarchical empirical Bayes.

A logistic regression on rule statistics, fitted on every labelled document by sums
that tasks make, gives each document's evidence. Its mean over a host is shrunk toward
the mean of all documents, and its mean over a path of the host toward the host's
posterior; how far is estimated from the spread between groups, so sparse sites
get little say. A document's log odds are its own evidence plus the difference
between its path's posterior and the global prior.

Sums per path, host and overall are grouped aggregations with partial sums, so a
host with a third of all rows is no hot spot.

Null host or path is a site of its own. Null and empty texts have the statistics
0. Repeated rows count each. Without labelled documents of both kinds every
document is kept. Further columns are kept as they are, whatever their names. Texts of any
length are read whole. An empty table gives an empty result. Where a table has no url, other
columns stand in: by default ``source`` for the host and ``lang`` for the path, which has
few values and so hardly any sparse site to shrink.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm.arrow import map_batches, map_partitions
from talkloom.llm.rules import (
    FEATURES,
    batch_statistics,
    features,
    labelled_features,
    least_kept,
    matrix,
)

MOST_STRENGTH = 10_000.0
LOST_GOOD = 0.003


@dataclass
class Classifier:
    """Standardised features, weights and the labels' prior log odds."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    prior: float

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate((np.ones((len(x), 1)), z, z**2), axis=1)

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good quality."""
        return np.clip(self.inputs(x) @ self.weight, -12, 12)


def _slope_and_curve(rows: DataFrame, model: Classifier) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the loss over all rows, summed in tasks and then by Spark."""
    width = len(model.weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width + 1))
        for batch in batches:
            z = model.inputs(matrix(batch))
            p = 1 / (1 + np.exp(-np.clip(z @ model.weight, -30, 30)))
            good = batch.column("good").to_numpy(zero_copy_only=False)
            total[:, 0] += z.T @ (p - good)
            total[:, 1:] += (z * (p * (1 - p))[:, None]).T @ z
        at = pa.array(np.arange(total.size, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([at, pa.array(total.ravel())], ["at", "part"])

    sums = map_partitions(rows, run, "at int, part double").groupBy("at").agg(F.sum("part"))
    found = np.array([part for _, part in sorted(sums.collect())]).reshape(width, width + 1)
    return found[:, 0], found[:, 1:]


def fit_classifier(rows: DataFrame, steps: int = 30) -> Classifier:
    """Ridge logistic regression by Newton's method; ``rows`` has good and the features."""
    of_each = [f(name) for f in (F.avg, F.stddev_pop) for name in FEATURES]
    n, n_good, *of_each = rows.agg(F.count("*"), F.count_if("good"), *of_each).first()
    width = len(FEATURES)
    mean = np.array(of_each[:width]) if n else np.zeros(width)
    scale = np.maximum(of_each[width:], 1e-3) if n else np.ones(width)
    rate = (n_good + 0.5) / (n + 1)
    model = Classifier(mean, scale, np.zeros(2 * width + 1), float(np.log(rate / (1 - rate))))
    if n_good in (0, n):
        model.weight[0] = model.prior
        return model
    ridge = np.diag([1e-6] + [1.0] * (2 * width))
    for _ in range(steps):
        slope, curve = _slope_and_curve(rows, model)
        slope = slope + ridge @ model.weight
        step = np.linalg.solve(curve + ridge + 1e-6 * np.eye(len(slope)), slope)
        model.weight = model.weight - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    # sums depend on the order of tasks in their last digits
    model.weight = np.round(model.weight, 9)
    return model


def _with_evidence(docs: DataFrame, model: Classifier) -> DataFrame:
    """``row`` (all columns as a struct) and ``evidence`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = batch_statistics(batch.column(0).field(at))
            if len(table):
                found = shared.value.evidence(features(table))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(found)], ["row", "evidence"]
                )

    kind = packed.schema["row"].dataType.simpleString()
    return map_partitions(packed, run, f"row {kind}, evidence double")


def _strength(groups: DataFrame, mean) -> float:
    """How many documents a group's parent is worth, by the method of moments; one row is read."""
    noise = mean * (1 - mean)
    between, expected, everything, average = groups.agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - mean, 2)),
        F.sum(noise),
        F.sum("n"),
        F.avg(noise),
    ).first()
    if not everything:
        return MOST_STRENGTH
    extra = max((between - expected) / everything, 1e-9)
    return float(min(max(average / extra, 1.0), MOST_STRENGTH))


def _posterior(prior, strength: float):
    return (F.col("good") + F.lit(strength) * prior) / (F.col("n") + F.lit(strength))


def site_posteriors(paths: DataFrame) -> DataFrame:
    """Posterior of each (host, path): host, path, n, prior, posterior.

    ``paths`` has host, path, n and ``good``, the sum of the classifier's probabilities.
    """
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    overall = paths.agg(F.sum("good") / F.sum("n")).first()[0]
    prior = F.lit(0.5 if overall is None else float(overall))
    shrunk = _posterior(prior, _strength(hosts, prior))
    hosts = hosts.select("host", prior.alias("prior"), shrunk.alias("host_posterior"))
    joined = paths.alias("p").join(hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host")))
    joined = joined.select("p.*", "prior", "host_posterior")
    parent = F.col("host_posterior")
    shrunk = _posterior(parent, _strength(joined, parent))
    return joined.select("host", "path", "n", "prior", shrunk.alias("posterior"))


def _log_odds(p):
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


@dataclass
class Sites:
    """Fitted model: the classifier, the sites' posteriors and the least log odds to keep."""

    model: Classifier
    sites: DataFrame
    least: float


def _scores(rows: DataFrame, sites: DataFrame, host, path) -> DataFrame:
    """``rows`` with ``score``: evidence plus what the site says beyond the prior."""
    named = sites.select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), "posterior", "prior"
    )
    joined = rows.join(named, host.eqNullSafe(F.col("_host")) & path.eqNullSafe(F.col("_path")), "left")
    says = _log_odds(F.col("posterior")) - _log_odds(F.col("prior"))
    score = F.col("evidence") + F.coalesce(says, F.lit(0.0))
    return joined.withColumn("score", score).drop("_host", "_path", "posterior", "prior")


def fit_sites(
    docs: DataFrame,
    labels: DataFrame,
    store,
    label: str = "quality",
    key: str = "doc_id",
    host: str = "source",
    path: str = "lang",
) -> Sites:
    """Fit classifier and site posteriors; ``store`` writes the sums of each site and the posteriors."""
    known = labelled_features(docs, labels, label, key)
    model = fit_classifier(known)
    scored = _with_evidence(docs.select(key, host, path, "text"), model).select(
        F.col(f"row.{host}").alias("host"),
        F.col(f"row.{path}").alias("path"),
        (1 / (1 + F.exp(-F.col("evidence")))).alias("p"),
    )
    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good"))
    sites = store(site_posteriors(store(paths)))
    n, n_good = known.agg(F.count("*"), F.count_if("good")).first()
    if n_good in (0, n):
        return Sites(model, sites, float("-inf"))
    # the threshold: of the scores of all labelled documents with their sites

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = pa.array(model.evidence(matrix(batch)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("good"), found], ["k", "good", "evidence"]
        )

    kind = dict(known.dtypes)["key"]
    rows = map_batches(known, run, f"k {kind}, good boolean, evidence double")
    places = docs.groupBy(F.col(key).alias("k")).agg(
        F.min(F.struct(F.col(host).alias("h"), F.col(path).alias("p"))).alias("place")
    )
    placed = rows.join(places, "k").select("k", "good", "evidence", "place.*")
    scored = store(_scores(placed, sites, F.col("h"), F.col("p")).select("good", "score"))
    return Sites(model, sites, least_kept(scored, "score", LOST_GOOD, n_good))


def classify(
    docs: DataFrame, fitted: Sites, host: str = "source", path: str = "lang"
) -> DataFrame:
    """``row`` (all columns as a struct), ``evidence``, ``score`` and ``kept`` of every document."""
    rows = _with_evidence(docs, fitted.model)
    scored = _scores(rows, fitted.sites, F.col(f"row.{host}"), F.col(f"row.{path}"))
    return scored.withColumn("kept", F.col("score") >= F.lit(fitted.least))
