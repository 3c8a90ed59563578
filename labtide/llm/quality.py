"""Document quality by hierarchical empirical Bayes: a classifier's evidence, with the sites it comes from."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtide.llm.staging import body, staged, without

MAX_LABELLED = 20_000
CUT = 0.35
LARGEST = 8.0
UNITS = 1 << 30
MEASURES = ["symbols", "capitals", "digits", "shouts", "rare", "again", "lines", "pipes", "length", "size"]

LETTERS = np.zeros(256, dtype=np.int64)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def measures(text: str) -> list[float]:
    """Shares of kinds of characters, of repeated words and lines, and the length of words and text; all bounded."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    n = max(len(data), 1)
    counts = np.bincount(data, minlength=256)
    letters = int(counts @ LETTERS)
    digits, white = int(counts[48:58].sum()), int(counts[9:14].sum() + counts[32])
    marks = n - letters - digits - white - int(counts[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum())
    words = text.split()
    lines = [line for line in text.split("\n") if line]
    total = max(len(words), 1)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    return [
        max(marks, 0) / n,
        int(counts[65:91].sum()) / max(letters, 1),
        digits / n,
        int(counts[33]) / n,
        1 - len(set(words)) / total,
        repeats / total,
        1 - len(set(lines)) / max(len(lines), 1),
        int(counts[124]) / n,
        min(len(text) / total, 40.0) / 10,
        float(np.log1p(len(words))) / 5,
    ]


def measured(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, body, host, path and the measures of each row's whole text; no shuffle."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [measures(text.as_py() or "") for text in part.column(0)]
            values = pa.array(found, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*part.columns[1:], values], names=["doc_id", "body", "host", "path", "measures"])

    rows = docs.select(
        F.col("text").cast("string"),
        F.col("doc_id").cast("bigint"),
        body().alias("body"),
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
    )
    return rows.mapInArrow(batches, "doc_id bigint, body bigint, host string, path string, measures array<double>")


def expanded(values: np.ndarray) -> np.ndarray:
    """Measures, their squares, and a constant."""
    return np.hstack([values, values**2, np.ones((len(values), 1))])


def fit(values: np.ndarray, good: np.ndarray, penalty: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton steps. One class alone gives a constant."""
    x, y = expanded(values), good.astype(float)
    weights = np.zeros(x.shape[1])
    prior = np.full(x.shape[1], penalty)
    prior[-1] = 1e-6
    if len(y) == 0:
        return weights
    if y.min() == y.max():
        weights[-1] = LARGEST if y[0] else -LARGEST
        return weights
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + prior * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(prior)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def training_rows(rows: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Measures and labels of at most ``most`` labelled rows, those with the smallest hash of their doc_id.

    A document labelled more than once counts as good if most of its labels say so; null labels are left out.
    """
    truth = labels.where("quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    truth = truth.agg((F.avg("quality") >= 0.5).alias("good"))
    found = rows.join(truth, "doc_id").select("doc_id", "body", "measures", "good").distinct()
    # Twice the sample is expected below this hash, so that tasks send few rows that the limit drops again.
    share = min(1.0, 2 * most / max(found.count(), 1))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    found = found.where(place < int(share * (1 << 30))).orderBy(place, "doc_id", "body").limit(most).collect()
    return np.array([r["measures"] for r in found]).reshape(-1, len(MEASURES)), np.array([r["good"] for r in found], dtype=bool)


def _strength(level: DataFrame, rate: float) -> float:
    """Pseudo-count of the prior of a level, by moments: the more its sites differ beyond chance, the smaller.

    With expected binomial variance r(1-r)/n and observed variance v between sites, a beta prior of mean r has
    r(1-r)/v - 1 pseudo-documents. It stays between 1 and 10,000.
    """
    spread = F.col("n") * (F.col("good") / F.col("n") - rate) ** 2
    row = level.agg(
        F.sum(F.round(spread * UNITS).cast("decimal(28,0)")).alias("spread"),
        F.sum("n").alias("n"),
        F.count("*").alias("sites"),
    ).first()
    if not row["n"] or row["sites"] < 2:
        return 10.0
    chance = rate * (1 - rate)
    beyond = (int(row["spread"]) / UNITS - row["sites"] * chance) / row["n"]
    return float(min(max(chance / beyond - 1, 1.0), 10_000.0)) if beyond > 0 else 10_000.0


def _odds(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(safe / (1 - safe))


def judged(
    docs: DataFrame,
    labels: DataFrame,
    host: Column | None = None,
    path: Column | None = None,
    cut: float = CUT,
    most: int = MAX_LABELLED,
) -> DataFrame:
    """doc_id, body, evidence, host_rate, path_rate, posterior and kept for every row of ``docs``.

    The classifier is a logistic regression on ``measures`` of the whole text, fitted to a sample of at most ``most``
    labelled documents. Its probabilities, for all documents, are summed by host and by path (by default ``source``, and
    ``lang`` below it). A host's rate of good documents is shrunk towards the rate of all, a path's towards its host's,
    the more the fewer documents there are. A document's own probability is taken out of its site's sums. The posterior
    odds are those of the classifier, times the path's odds over the odds of all; documents below ``cut`` are rejected.

    The sums have map-side combination and the rates come back by joins on site, which adaptive execution can split.
    Probabilities are summed as whole numbers of ``UNITS``, so that no result depends on the order of rows.
    A null host or path is a site of its own. Null and empty texts are measured as empty. Repeated rows are judged alike.
    """
    columns = set(docs.columns)
    if host is None:
        host = F.col("source") if "source" in columns else F.lit(None)
    if path is None:
        path = F.col("lang") if "lang" in columns else F.lit(None)
    rows = staged(measured(docs, host, path), "measures")
    weights = fit(*training_rows(rows, labels, most)).tolist()
    linear, square, constant = weights[: len(MEASURES)], weights[len(MEASURES) : -1], weights[-1]
    evidence = F.lit(constant)
    for i in range(len(MEASURES)):
        value = F.get("measures", F.lit(i))
        evidence = evidence + value * linear[i] + value * value * square[i]
    evidence = F.least(F.greatest(evidence, F.lit(-LARGEST)), F.lit(LARGEST))
    scored = rows.select("doc_id", "body", "host", "path", evidence.alias("evidence"))
    scored = scored.withColumn("units", F.round(UNITS / (1 + F.exp(-F.col("evidence")))).cast("bigint"))
    scored = scored.withColumn("p", F.col("units") / UNITS)

    units = F.sum(F.col("units").cast("decimal(20,0)")).alias("units")
    counted = staged(scored.groupBy("host", "path").agg(units, F.count("*").alias("n")), "paths")
    good = (F.col("units").cast("double") / UNITS).alias("good")
    paths = counted.select("host", "path", good, "n")
    hosts = counted.groupBy("host").agg(F.sum("units").alias("units"), F.sum("n").alias("n")).select("host", good, "n")
    whole = counted.agg(F.sum("units").alias("units"), F.sum("n").alias("n")).first()
    rate = int(whole["units"]) / UNITS / whole["n"] if whole["n"] else 0.5
    host_strength, path_strength = _strength(hosts, rate), _strength(paths, rate)

    sites = paths.withColumnsRenamed({"good": "path_good", "n": "path_n"}).alias("p").join(
        hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host"))
    )
    sites = sites.select(
        F.col("p.host").alias("site"), F.col("p.path").alias("part"), "path_good", "path_n", F.col("good").alias("host_good"), F.col("n").alias("host_n")
    )
    same = F.col("host").eqNullSafe(F.col("site")) & F.col("path").eqNullSafe(F.col("part"))
    met = scored.join(sites, same)
    host_rate = (F.col("host_good") - F.col("p") + host_strength * rate) / (F.col("host_n") - 1 + host_strength)
    met = met.withColumn("host_rate", host_rate)
    path_rate = (F.col("path_good") - F.col("p") + path_strength * F.col("host_rate")) / (F.col("path_n") - 1 + path_strength)
    met = met.withColumn("path_rate", path_rate)
    odds = F.col("evidence") + _odds(F.col("path_rate")) - _odds(F.lit(rate))
    return met.withColumn("posterior", 1 / (1 + F.exp(-odds))).select(
        "doc_id", "body", "evidence", "host_rate", "path_rate", "posterior", (F.col("posterior") >= cut).alias("kept")
    )


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are not rejected, in all their columns."""
    return without(docs, judged(docs, labels, **options).where(~F.col("kept")).select("doc_id", "body").distinct())
