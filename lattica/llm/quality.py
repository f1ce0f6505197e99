"""Quality by hierarchical empirical Bayes.

A logistic model of the text gives each document's evidence.  Hosts and paths
have beta posteriors of the share of good documents: each level is shrunk
towards the one above with a strength estimated by moments over all of that
level, so that sparse sites stay near the global prior.  A document's posterior
odds are its evidence with the global prior odds taken out and its path's put in;
the path's posterior leaves the document itself out, so that its evidence counts once.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise

#: Most labelled rows that fit the text model; most sites whose posteriors are broadcast.
FIT_ROWS, BROADCAST_SITES = 20_000, 20_000
#: Bounds of a site's shrinkage, in documents.
LEAST_STRENGTH, MOST_STRENGTH = 5.0, 10_000.0


def features(text: Column) -> list[Column]:
    """Shares and logs that describe a whole text; all between about 0 and 10."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1)).cast("double")
    words = F.split(t, r"\s+")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    bare = F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")
    odd = F.translate(t, "#$%&*|<>{}[]^~=+_\\/@", "")
    lines = F.split(t, "\n")
    return [
        ((F.length(t) - F.length(bare)) / n).alias("upper"),
        ((F.length(t) - F.length(odd)) / n).alias("symbols"),
        ((F.length(t) - F.length(F.translate(t, "!", ""))) / n).alias("shouts"),
        ((F.length(t) - F.length(F.translate(t, "0123456789", ""))) / n).alias("digits"),
        (F.size(F.array_distinct(words)) / n_words).alias("distinct_words"),
        (F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1))).cast("double").alias("distinct_lines"),
        F.least(n / n_words / 10, F.lit(3.0)).alias("word_length"),
        (F.log(n) / 10).alias("log_length"),
    ]


NAMES = ["upper", "symbols", "shouts", "digits", "distinct_words", "distinct_lines", "word_length", "log_length"]


def _expand(x: np.ndarray) -> np.ndarray:
    """Features, square roots, squares of the shape features, and a constant, at unit scale."""
    return np.column_stack([np.ones(len(x)), x, np.sqrt(np.maximum(x[:, :4], 0)), x[:, 4:] ** 2, x[:, 4] * x[:, 7]])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> np.ndarray:
    """Ridge logistic regression by Newton steps; weights of ``_expand``'s columns."""
    a = _expand(x)
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = a.T @ (a * np.maximum(p * (1 - p), 1e-6)[:, None]) + ridge * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        size = np.abs(step).max()
        w += step * min(1.0, 10 / max(size, 1e-12))
        if size < 1e-6:
            break
    return w


def _logit(weights: np.ndarray, where: str = "") -> Column:
    """The model's logit, of columns or of a struct's fields (``where`` ends in a dot)."""
    x = [F.col(where + n) for n in NAMES]
    columns = [F.lit(1.0), *x, *[F.sqrt(F.greatest(c, F.lit(0.0))) for c in x[:4]], *[c * c for c in x[4:]], x[4] * x[7]]
    total = F.lit(0.0)
    for w, c in zip(weights, columns, strict=True):
        total = total + F.lit(float(w)) * c
    return F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total))


def _strength(level: DataFrame, prior: Column, n: str, s: str) -> float:
    """Shrinkage by moments over all units of a level: how many documents the prior is worth."""
    got = level.select(
        F.sum(F.col(n)).alias("n"),
        F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - prior, 2)).alias("between"),
        F.sum(prior * (1 - prior)).alias("within"),
        F.sum(F.col(n) * prior * (1 - prior)).alias("scale"),
    ).first()
    if not got["n"] or not got["scale"]:
        return MOST_STRENGTH
    # sum n (p_i - m)^2 is about within + rho * scale
    rho = max((got["between"] - got["within"]) / got["scale"], 1e-9)
    return float(min(MOST_STRENGTH, max(LEAST_STRENGTH, 1 / rho - 1)))


class QualityModel:
    """A fitted text model with the corpus's host and path posteriors."""

    def __init__(self, weights: np.ndarray, prior: float, sites: DataFrame, k_host: float, k_path: float):
        self.weights, self.prior, self.sites, self.k_host, self.k_path = weights, prior, sites, k_host, k_path


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", label_col: str = "quality") -> QualityModel:
    """Fit the text model on at most ``FIT_ROWS`` labelled rows (by hash) and the sites on every row.

    A label that is neither 0 nor 1, or a row that has none, takes no part in
    the fit.  Without labels of both kinds the model is the constant prior (the
    labels' own, or one half).  Null hosts or paths are sites of their own.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"), *features(F.col(text_col)))
    rows = materialise(rows, "quality-features")
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1)).groupBy("id").agg(F.max("label").alias("label"))
    labelled = materialise(rows.join(known, "id").select("id", *NAMES, "label"), "quality-labelled")
    # a share by hash first, so that no task sends more than its part of the bound
    share = min(1.0, FIT_ROWS / max(labelled.count(), 1))
    sample = labelled.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 20)) <= int(share * (1 << 20))).limit(FIT_ROWS).select(*NAMES, "label").collect()
    discard(labelled)
    y = np.array([r["label"] for r in sample], float)
    if len(set(y.tolist())) == 2:
        weights = fit(np.array([[r[n] for n in NAMES] for r in sample]), y)
        prior = float(y.mean())
    else:
        prior = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        weights = np.zeros(_expand(np.zeros((1, len(NAMES)))).shape[1])
        weights[0] = np.log(prior / (1 - prior))
    p = 1 / (1 + F.exp(-_logit(weights)))
    # sums of the documents' evidence; partial sums take a hot host's rows where they lie
    sites = materialise(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("s")), "quality-sites")
    hosts = sites.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    whole = sites.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mean = min(max(whole["s"] / whole["n"], 0.01), 0.99) if whole["n"] else prior
    k_host = _strength(hosts, F.lit(mean), "host_n", "host_s")
    hosts = hosts.withColumn("host_mean", (k_host * mean + F.col("host_s")) / (k_host + F.col("host_n")))
    joined = sites.alias("a").join(hosts.alias("b"), F.col("a.host").eqNullSafe(F.col("b.host"))).select("a.host", "path", "n", "s", "host_n", "host_s", "host_mean")
    joined = materialise(joined, "quality-hosts")
    k_path = _strength(joined, F.col("host_mean"), "n", "s")
    joined = joined.withColumn("site_mean", (k_path * F.col("host_mean") + F.col("s")) / (k_path + F.col("n")))
    posteriors = materialise(joined.select("host", "path", "n", "s", "host_n", "host_s", "host_mean", "site_mean"), "quality-posteriors")
    discard(rows, sites)
    return QualityModel(weights, mean, posteriors, k_host, k_path)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", host_col: str = "source", path_col: str = "lang", own: bool = False) -> DataFrame:
    """``docs`` with ``quality_evidence`` (of the text), ``quality_site`` (its path's posterior) and ``quality_score``.

    ``own``: the rows are those that the sites were summed over, and each is left
    out of its own site.  Columns of these three names are replaced; others stay,
    whatever their names.

    The posteriors are broadcast while there are at most ``BROADCAST_SITES``
    sites and joined by shuffle beyond it.  Every row stays; a site that the
    model does not know has the global prior; a null text is an empty one.
    """
    sums = ["n", "s", "host_n", "host_s"]
    sites = model.sites.select(F.struct("host", "path").alias("of"), F.struct(*sums).alias("site"))
    if sites.count() <= BROADCAST_SITES:
        sites = F.broadcast(sites)
    columns = [c for c in docs.columns if c not in ("quality_evidence", "quality_site", "quality_score")]
    at = F.struct(F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"))
    got = docs.select(F.struct(*columns).alias("row"), F.struct(*features(F.col(text_col))).alias("x"), at.alias("at"))
    got = got.join(sites, F.col("at").eqNullSafe(F.col("of")), "left").withColumn("logit", _logit(model.weights, "x."))
    evidence = 1 / (1 + F.exp(-F.col("logit")))
    n, s, host_n, host_s = (F.coalesce(F.col("site")[c], F.lit(0)) - (1 if c.endswith("n") else evidence) * F.when(F.col("site").isNotNull() & F.lit(own), 1).otherwise(0) for c in sums)
    host = (model.k_host * model.prior + host_s) / (model.k_host + host_n)
    site = F.least(F.lit(0.999), F.greatest(F.lit(0.001), (model.k_path * host + s) / (model.k_path + n)))
    prior = float(np.log(model.prior / (1 - model.prior)))
    return got.select(
        *[F.col("row")[c].alias(c) for c in columns],
        evidence.alias("quality_evidence"),
        site.alias("quality_site"),
        (1 / (1 + F.exp(-(F.col("logit") - F.lit(prior) + F.log(site / (1 - site)))))).alias("quality_score"),
    )


def classify_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **names) -> DataFrame:
    """``docs`` with its scores and ``keep``: whether the posterior reaches ``threshold``; such a column of ``docs`` is replaced.

    Repeated rows are rows of their own.  No rows in: no rows out.  See ``fit_quality`` for nulls and missing labels.
    """
    model = fit_quality(docs, labels, **names)
    named = {k: v for k, v in names.items() if k in ("text_col", "host_col", "path_col")}
    return score_quality(docs, model, own=True, **named).withColumn("keep", F.col("quality_score") >= threshold)
