"""Document quality by hierarchical empirical Bayes.

A classifier over a text's own shape gives each document its evidence. The evidence of all
documents is summed by host and by path below the host. A host's posterior mean is its own mean
shrunk toward the global one, a path's is shrunk toward its host's; how far is estimated from the
data: the ratio of the variance inside groups to that between them (method of moments). Sparse
sites thus follow their prior and large ones their own record. A document's score is its evidence
with the site's posterior odds in place of the global ones.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotterline.llm.common import bound_batches, map_frames, materialize, small_frames
from blotterline.llm.models import (
    DIGIT,
    LETTER,
    OTHER,
    UPPER,
    character_classes,
    code_points,
    fit_logistic_rows,
    logistic,
    sums_by_text,
)

#: Numbers that ``features`` gives per text.
WIDTH = 7
FRAME_CHARS = 1_000_000
#: Shrinkage where groups do not differ more than chance explains: all the way to the prior.
ALL_THE_WAY = 1e12


def features(texts: list[str]) -> np.ndarray:
    """Shape of each text: shares of capitals, other marks and digits, repeated words and lines,
    the most frequent word's share, word length. Shares of short texts are damped."""
    points, lengths = code_points(texts)
    kind = character_classes()[np.minimum(points, 0x10FFFF)]
    count = {k: sums_by_text(kind == k, lengths) for k in (LETTER, UPPER, DIGIT, OTHER)}
    letters = count[LETTER] + count[UPPER]
    shape = np.column_stack(
        [
            count[UPPER] / (letters + 30),
            count[OTHER] / (lengths + 30),
            count[DIGIT] / (lengths + 30),
        ]
    )
    use = np.zeros((len(texts), 4))
    for at, text in enumerate(texts):
        words, lines = text.split(), text.split("\n")
        if not words:
            continue
        repeats = sum(map(str.__eq__, words, words[1:]))
        most = Counter(words).most_common(1)[0][1]
        use[at] = (
            repeats / (len(words) + 10),
            most / (len(words) + 20),
            (len(lines) - len(set(lines))) / (len(lines) + 3),
            min(20.0, len(text) / len(words)) / 20 * min(1.0, len(words) / 20),
        )
    return np.hstack([shape, use])


class QualityModel:
    """A logistic regression over standardized features, or a constant where labels lack a class.

    Fitted on all rows (x array<double>, y 0 or 1) of a stored table; ``share`` is the mean of all labels.
    """

    def __init__(self, rows: DataFrame, share: float | None):
        x = [F.col("x")[i] for i in range(WIDTH)]
        n, mean, *moments = rows.agg(
            F.count(F.lit(1)), F.avg("y"), *[F.avg(c) for c in x], *[F.stddev_pop(c) for c in x]
        ).first()
        self.constant = 0.5 if not n else mean if mean in (0, 1) else None
        if self.constant is None:
            self.centre, self.spread = np.array(moments[:WIDTH]), np.array(moments[WIDTH:]) + 1e-9
            self.weights = fit_logistic_rows(rows, self.centre, self.spread)
            # Labels without a document have other shares of the classes than those with one.
            odds, own = share / (1 - share), mean / (1 - mean)
            self.weights[-1] += np.log(odds / own)

    def evidence(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return logistic((features(texts) - self.centre) / self.spread, self.weights)


def fit_quality(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """The classifier from ``labels`` (doc_id, quality 0 or 1) and the texts they belong to.

    All labelled documents, whole texts; a repeated doc_id counts once. Labels that are null or have
    no document are left out. Only the few numbers of each text are joined to its label, so no text
    is shuffled, and the fit adds them up in the tasks that hold them.
    """
    bound_batches(docs.sparkSession)
    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id", "quality")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, "text", FRAME_CHARS):
            x = features(frame["text"].fillna("").tolist())
            yield pd.DataFrame({"doc_id": frame["doc_id"], "x": list(x)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        map_frames(texts, run, f"doc_id {kind}, x array<double>")
        .join(known.distinct(), "doc_id")
        .dropDuplicates(["doc_id", "quality"])
        .select("x", F.col("quality").cast("double").alias("y"))
    )
    share = known.agg(F.avg("quality")).first()[0]
    return QualityModel(materialize(rows, "labelled"), share)


def with_evidence(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with ``evidence``: the classifier's probability of good quality. No shuffle."""
    bound_batches(docs.sparkSession)
    docs = docs.drop("evidence")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, "text", FRAME_CHARS):
            texts = frame["text"].fillna("").tolist()
            yield frame.assign(evidence=shared.value.evidence(texts))

    return map_frames(docs, run, docs.select("*", F.lit(0.0).alias("evidence")).schema)


def host_of(site: Column) -> Column:
    """The host of a URL, or a plain source name; null: empty."""
    return F.regexp_extract(F.coalesce(site.cast("string"), F.lit("")), r"^(?:\w+://)?([^/?#]*)", 1)


def path_of(site: Column) -> Column:
    """The first part of a URL's path; empty where there is none."""
    return F.regexp_extract(F.coalesce(site.cast("string"), F.lit("")), r"^(?:\w+://)?[^/?#]*/([^/?#]*)", 1)


def _shrinkage(groups: DataFrame, prior: str) -> float:
    """How many documents the prior of a group (n, s, ss) counts as, from all groups' moments."""
    n, mean = F.col("n"), F.col("s") / F.col("n")
    row = groups.agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("groups"),
        F.sum(F.col("ss") - n * mean * mean).alias("inside"),
        F.sum(n * (mean - F.col(prior)) ** 2).alias("between"),
        F.sum(n.cast("double") * n).alias("squares"),
    ).first()
    if not row["n"] or row["groups"] < 2 or row["n"] <= row["groups"]:
        return ALL_THE_WAY
    inside = row["inside"] / (row["n"] - row["groups"])
    weight = row["n"] - row["squares"] / row["n"]
    between = (row["between"] - (row["groups"] - 1) * inside) / max(weight, 1e-9)
    return min(ALL_THE_WAY, inside / between) if between > 1e-9 else ALL_THE_WAY


def site_posteriors(evidence: DataFrame) -> DataFrame:
    """host, path, n, host_posterior, path_posterior, prior from rows (host, path, evidence).

    Sums combine before the shuffle, so a host with a third of all rows is a row per task.
    """
    paths = materialize(
        evidence.groupBy("host", "path").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("evidence").alias("s"),
            F.sum(F.col("evidence") ** 2).alias("ss"),
        ),
        "site-paths",
    )
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")])
    total = hosts.agg(F.sum("s") / F.sum("n")).first()[0]
    total = 0.5 if total is None else float(total)
    hosts = materialize(hosts.withColumn("prior", F.lit(total)), "site-hosts")
    weight = _shrinkage(hosts, "prior")
    hosts = hosts.withColumn("host_posterior", (F.col("s") + weight * F.col("prior")) / (F.col("n") + weight))
    below = paths.join(hosts.select("host", "prior", "host_posterior"), "host")
    weight = _shrinkage(below, "host_posterior")
    posterior = (F.col("s") + weight * F.col("host_posterior")) / (F.col("n") + weight)
    return below.withColumn("path_posterior", posterior).select(
        "host", "path", "n", "prior", "host_posterior", "path_posterior"
    )


def _logit(p: Column) -> Column:
    bounded = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(bounded / (1 - bounded))


def judged(docs: DataFrame, model: QualityModel, site: str = "source") -> DataFrame:
    """``docs`` with host, path, evidence, host_posterior, path_posterior and quality_score (0 to 1).

    ``site`` is a URL or a source name. Null texts are judged as empty ones, null sites are one
    site. Rows are judged one by one, so repeated rows stay and count for their site; an empty
    table gives no rows. Columns of ``docs`` with these names are replaced.
    """
    own = ("host", "path", "evidence", "host_posterior", "path_posterior", "quality_score")
    docs = docs.drop(*[c for c in own if c != site])
    marked = with_evidence(docs, model).withColumn("_host", host_of(F.col(site))).withColumn("_path", path_of(F.col(site)))
    keys = marked.select(F.col("_host").alias("host"), F.col("_path").alias("path"), "evidence")
    sites = materialize(site_posteriors(keys), "sites").select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), "prior", "host_posterior", "path_posterior"
    )
    odds = _logit(F.col("evidence")) + _logit(F.col("path_posterior")) - _logit(F.col("prior"))
    scored = marked.join(sites, ["_host", "_path"]).withColumn("quality_score", 1 / (1 + F.exp(-odds)))
    return scored.withColumn("host", F.col("_host")).withColumn("path", F.col("_path")).drop("_host", "_path", "prior")


def good(docs: DataFrame, model: QualityModel, site: str = "source", least: float = 0.5) -> DataFrame:
    """The documents of good quality, with their own columns."""
    whole = docs.select(F.struct("*").alias("row"), F.col("text"), F.col(site).alias("site"))
    return judged(whole, model, "site").where(F.col("quality_score") >= least).select("row.*")
