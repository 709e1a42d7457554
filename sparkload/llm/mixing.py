"""Mixing by soft domains: posteriors of a classifier, and document rates that meet target token totals."""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, begin, col, stored, text_of, unpacked

TRAINING_ROWS = 1_000  # expected number of sampled rows of each domain at most
SAMPLE_ROWS = 64_000  # expected number of sampled rows of all domains, unless there are more domains
FEATURES = 1_024  # hashed pairs of bytes
ROWS_AT_ONCE = 8_192  # of the sample in a gradient step
STEPS = 60


@dataclass
class DomainModel:
    """Multinomial logistic regression on the relative frequencies of hashed byte pairs."""

    domains: list[str]
    weights: np.ndarray  # features x domains
    bias: np.ndarray

    def posteriors(self, text: str) -> np.ndarray:
        z = pair_frequencies(text) @ self.weights + self.bias
        e = np.exp(z - z.max())
        return e / e.sum()


def pair_frequencies(text: str, features: int = FEATURES) -> np.ndarray:
    """Square roots of the relative frequencies of pairs of neighbouring bytes, hashed to ``features`` places."""
    data = np.frombuffer(text.lower().encode(), np.uint8).astype(np.uint32)
    if len(data) < 2:
        return np.zeros(features, np.float32)
    pairs = (data[:-1] * np.uint32(256) + data[1:]) * np.uint32(0x9E3779B1) >> np.uint32(32 - int(math.log2(features)))
    counts = np.bincount(pairs, minlength=features).astype(np.float32)
    return np.sqrt(counts / (len(data) - 1))


def fit_domain_model(
    docs: DataFrame, labelled: DataFrame, rows: int = TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain"
) -> DomainModel:
    """Fitted on a bounded sample of a labelled table of ids and domains: some ``rows`` documents of each domain.

    Any number of domains; where they are more than ``SAMPLE_ROWS / rows``, each has an equal part of ``SAMPLE_ROWS`` and one document at
    least. Memory and work of the fit grow with the sample and the domains. An id with several domains counts with the smallest name; nulls
    are left out. Without any labelled document there is one domain named ``""``, and every document is in it.
    """
    votes = labelled.select(col(id_col).cast("long").alias("id"), col(domain_col).cast("string").alias("domain")).dropna()
    votes = votes.groupBy("id").agg(F.min("domain").alias("domain"))
    draw = F.pmod(F.xxhash64(F.lit("mix"), "id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    drawn = votes.withColumn("draw", draw)
    sizes = stored(drawn.groupBy("domain").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("draw", "id")).alias("least")), "mixing-domains")
    n_domains = sizes.count()
    rows = min(rows, max(1.0, SAMPLE_ROWS / max(1, n_domains)))
    shares = sizes.select("domain", (F.lit(float(rows)) / F.col("n")).alias("share"), F.col("least.id").alias("least"))
    shares = F.broadcast(shares) if n_domains <= BROADCAST_ROWS else shares
    chosen = drawn.join(shares, "domain").filter((F.col("draw") < F.col("share")) | (F.col("id") == F.col("least")))
    chosen = stored(chosen.select("id", "domain"), "mixing-ids")
    texts = docs.select(col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), "id")

    @F.pandas_udf("binary")
    def features(texts: pd.Series) -> pd.Series:
        begin("mixing")
        return pd.Series([zlib.compress(pair_frequencies(t).tobytes(), 1) for t in texts])

    # bounded by the documented number of rows, each of bounded size
    got = texts.select("id", "domain", features("text").alias("x")).orderBy("id", "x").collect()
    if not got:
        return DomainModel([""], np.zeros((FEATURES, 1)), np.zeros(1))
    domains = sorted({r.domain for r in got})
    x = np.array([np.frombuffer(zlib.decompress(r.x), np.float32) for r in got], np.float32)
    place = {d: k for k, d in enumerate(domains)}
    return DomainModel(domains, *fit_softmax(x, np.array([place[r.domain] for r in got]), len(domains)))


def fit_softmax(x: np.ndarray, y: np.ndarray, k: int, ridge: float = 1e-4, steps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Accelerated gradient descent on the ridge multinomial log-likelihood; rows weighted so that the ``k`` domains ``y`` count alike.

    Gradients are summed over ``ROWS_AT_ONCE`` rows at a time, so that no table of all rows and domains is held.
    """
    mean = x.mean(axis=0)
    z = x - mean
    weight = (1 / np.maximum(1, np.bincount(y, minlength=k)))[y].astype(np.float32)[:, None] / np.float32(k)
    w, b = np.zeros((x.shape[1], k), np.float32), np.zeros(k, np.float32)
    parts = [slice(a, a + ROWS_AT_ONCE) for a in range(0, len(x), ROWS_AT_ONCE)]
    rate = 2.0 / (sum(float((weight[r] * z[r] * z[r]).sum()) for r in parts) + ridge)
    at, at_b, t = w, b, 1.0
    for _ in range(steps):
        slope, slope_b = np.zeros_like(w), np.zeros_like(b)
        for r in parts:
            s = z[r] @ at + at_b
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(p)), y[r]] -= 1
            p *= weight[r]
            slope += z[r].T @ p
            slope_b += p.sum(axis=0)
        new = at - rate * (slope + ridge * at)
        new_b = at_b - 2.0 * slope_b
        t, before = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        at, at_b = new + (before - 1) / t * (new - w), new_b + (before - 1) / t * (new_b - b)
        w, b = new, new_b
    return w, b - mean @ w


def soft_domains(model: DomainModel, text: Column) -> Column:
    """``struct<p array<double>, n_tokens long>``: domain posteriors, and words between white space as tokens."""

    @F.pandas_udf("p array<double>, n_tokens long")
    def membership(texts: pd.Series) -> pd.DataFrame:
        begin("mixing")
        return pd.DataFrame({"p": [model.posteriors(t or "").tolist() for t in texts], "n_tokens": [len((t or "").split()) for t in texts]})

    return membership(text)


@dataclass
class Rates:
    """Rates as a function of posteriors: ``max(least, 1 - sum_j shift_j p_j)``; ``totals`` are what they give."""

    shift: list[float]
    least: float
    totals: list[float]
    targets: list[float]
    steps: int = 0

    def column(self, p: Column) -> Column:
        moved = F.zip_with(p, F.array(*[F.lit(float(s)) for s in self.shift]), lambda x, s: s * x)
        return F.greatest(F.lit(1.0) - F.aggregate(moved, F.lit(0.0), lambda a, x: a + x), F.lit(float(self.least)))


def domain_totals(members: DataFrame, k: int, rate: Column | None = None) -> list[float]:
    """Expected tokens of each domain: one aggregation by its place, summed in every task first."""
    tokens = F.col("n_tokens") * (F.lit(1.0) if rate is None else rate)
    weighted = members.select("p", tokens.alias("w")).select("w", F.posexplode("p").alias("j", "x"))
    found = {r.j: r.t for r in weighted.groupBy("j").agg(F.sum(F.col("w") * F.col("x")).alias("t")).collect()}
    return [found.get(j) or 0.0 for j in range(k)]


def fit_rates(members: DataFrame, targets: list[float], least: float = 0.0, steps: int = STEPS, tolerance: float = 1e-4) -> Rates:
    """Rates ``r >= least`` that minimise ``sum_j (T_j - target_j)^2 / (2 N_j)``, ``T_j = sum_d r_d n_d p_dj``.

    ``members`` has ``p`` and ``n_tokens`` of each document; ``N_j`` is the total at rate 1. In the metric that weighs
    documents by their tokens, the gradient is ``sum_j p_dj (T_j - target_j) / N_j``. As posteriors sum to 1, a step of length 1
    never overshoots. Gradients are summed and the sum is projected (dual averaging), so a document's rate is a
    function of its posteriors and of one number per domain: a step is one aggregation over the documents, and no rates are stored
    or sent around. It ends when no total is further from its target, or has moved further in a step, than ``tolerance`` of its
    domain's size, and after ``steps`` at the latest; where targets are out of reach of ``least``, the loss
    nears its least value as one over the steps.
    """
    k = len(targets)
    sizes = domain_totals(members, k)
    rates = Rates([0.0] * k, least, sizes, list(targets))
    for rates.steps in range(steps):
        gaps = [(t - goal) / size if size > 0 else 0.0 for t, goal, size in zip(rates.totals, targets, sizes)]
        if max(map(abs, gaps), default=0.0) <= tolerance:
            break
        rates.shift = [s + g for s, g in zip(rates.shift, gaps)]
        before, rates.totals = rates.totals, domain_totals(members, k, rates.column(F.col("p")))
        if all(abs(t - b) <= tolerance * size for t, b, size in zip(rates.totals, before, sizes)):
            break
    return rates


def copies_of(rate: Column, key: Column) -> Column:
    """Whole copies whose expected number is the rate, drawn by a hash of the key: the same in every run."""
    whole = F.floor(rate)
    draw = F.pmod(F.xxhash64(F.lit("copies"), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("int")


def document_rates(
    docs: DataFrame, model: DomainModel, power: float = 0.7, least: float = 1.0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, domain, n_tokens, rate, copies`` for every row; ``domain`` is the likeliest.

    Targets are the domains' sizes smoothed by ``power`` (see ``smoothed_targets``). A null or empty text has no tokens and
    the classifier's constant posteriors; repeated rows and rows without an id have rates like any other.
    """
    e = soft_domains(model, text_of(text_col))
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), e.alias("e")).select("doc_id", "e.p", "e.n_tokens")
    members = stored(rows, "members")
    rates = fit_rates(members, smoothed_targets(domain_totals(members, len(model.domains)), power), least)
    rate = rates.column(F.col("p"))
    likeliest = F.element_at(F.array(*[F.lit(d) for d in model.domains]), F.array_position("p", F.array_max("p")).cast("int"))
    found = members.select("doc_id", likeliest.alias("domain"), "n_tokens", rate.alias("rate"))
    return found.withColumn("copies", copies_of(F.col("rate"), F.col("doc_id")))


def mixed(docs: DataFrame, model: DomainModel, power: float = 0.7, least: float = 1.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, each repeated as often as its rate says, with all their columns.

    Texts are classified twice, for the fit and for the rows, rather than shuffled.
    """
    e = soft_domains(model, text_of(text_col))
    members = stored(docs.select(e.alias("e")).select("e.p", "e.n_tokens"), "members")
    rates = fit_rates(members, smoothed_targets(domain_totals(members, len(model.domains)), power), least)
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col(id_col).cast("long").alias("id"), e.alias("e"))
    times = copies_of(rates.column(F.col("e.p")), F.col("id"))
    return unpacked(rows.select("row", F.explode(F.array_repeat(F.lit(True), times)).alias("copy")).select("row"))


def smoothed_targets(sizes: list[float], power: float = 0.7) -> list[float]:
    """Totals in proportion to ``size ** power``, as large as it takes for none to be below its size.

    Small domains gain; with rates of at least 1 no document is dropped.
    """
    weights = [s**power if s > 0 else 0.0 for s in sizes]
    budget = max([s / w for s, w in zip(sizes, weights) if w > 0], default=0.0)
    return [w * budget for w in weights]
