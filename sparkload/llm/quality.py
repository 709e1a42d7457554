"""Quality classifier: document evidence combined with host and path posteriors by empirical Bayes."""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import begin, col, id_and_text, stored, text_of, unpacked

TRAINING_ROWS = 2_500  # expected number of sampled rows of each combination of labels
WORDS = 200  # words with a weight of their own, for each label
LEAST_WORD_ROWS = 8
CLIP = 12.0  # bound on a document's log-odds

_SPACED = str.maketrans({c: " " for c in string.punctuation})
_SYMBOLS = np.array([chr(b) in string.punctuation and chr(b) not in ".,;:'\"!?-()" for b in range(256)])
_MARKS = np.array([chr(b) in ".,;:'\"!?-()" for b in range(256)])
N_SHAPE = 18


def words_of(text: str) -> list[str]:
    return text.lower().translate(_SPACED).split()


def shape_of(text: str, words: list[str]) -> list[float]:
    """Length, character classes and repetition of a text, and their squares."""
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, n = max(1, len(data)), max(1, len(words))
    letters = max(1, int(counts[65:91].sum() + counts[97:123].sum()))
    frequent = max(Counter(words).values(), default=0)
    distinct = len(set(words))
    lines = [x for x in text.split("\n") if x]
    values = [
        math.log1p(len(words)),
        len(data) / n / 10,
        float(counts[65:91].sum()) / letters,
        float(counts[_SYMBOLS].sum()) / size,
        float(counts[_MARKS].sum()) / size,
        float(counts[48:58].sum()) / size,
        math.log1p(distinct) / math.log1p(n),
        frequent / n,
        1 - len(set(lines)) / max(1, len(lines)),
    ]
    return values + [v * v for v in values]


@dataclass
class LinearModel:
    """Log-odds of a label: a constant, weights of the shape, weights of words present."""

    bias: float
    shape: np.ndarray
    words: dict[str, float] = field(default_factory=dict)
    prior: float = 0.5

    def __post_init__(self):
        self.known = frozenset(self.words)

    def evidence(self, shape: np.ndarray, words: list[str]) -> float:
        """Log-odds less those of the label's share among the labelled rows."""
        odds = self.bias + float(self.shape @ shape) + sum([self.words[w] for w in self.known.intersection(words)])
        return min(CLIP, max(-CLIP, odds - math.log(self.prior / (1 - self.prior))))


def fit_logistic(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 2.0, steps: int = 30, scaled: int | None = None
) -> tuple[float, np.ndarray]:
    """Ridge logistic regression by Newton steps; bias and weights on the given scale.

    The first ``scaled`` columns (all by default) are standardised. Columns of words present are not, so that the
    ridge holds back words that few rows speak for.
    """
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread < 1e-9] = 1.0
    spread[x.shape[1] if scaled is None else scaled :] = 1.0
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / spread])
    beta = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        curve = weight * np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((z * curve[:, None]).T @ z + np.diag(penalty), z.T @ (weight * (y - p)) - penalty * beta)
        beta += step * min(1.0, 5 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    weights = beta[1:] / spread
    return float(beta[0] - weights @ mean), weights


@dataclass
class QualityModel:
    good: LinearModel
    toxic: LinearModel

    def evidence(self, text: str) -> tuple[float, float]:
        words = words_of(text)
        shape = np.array(shape_of(text, words))
        return self.good.evidence(shape, words), self.toxic.evidence(shape, words)


def _neutral(prior: float) -> LinearModel:
    """No evidence for or against any text."""
    return LinearModel(math.log(prior / (1 - prior)), np.zeros(N_SHAPE), prior=prior)


GOOD_PRIOR, TOXIC_PRIOR = 0.99, 0.01  # where nothing is labelled, or all alike: documents are kept


def fit_quality_model(
    docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, n_words: int = WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> QualityModel:
    """Two classifiers (good, toxic) fitted on a bounded sample of the labelled documents.

    ``rows`` is the expected number of documents taken for each combination of the labels, chosen by a hash
    of the id; case weights restore the true shares, which are counted over all labels. The sampled ids
    are broadcast (their number is bounded), so no text is shuffled. Several labels of one document
    count as one: the lower quality, the higher toxicity. Labels with a null are left out. A label that no
    sampled document has, or all have, tells nothing: every document then passes by it.
    """
    votes = labels.select(col("doc_id").cast("long").alias("id"), col("quality").cast("int").alias("q"), col("toxic").cast("int").alias("t"))
    votes = votes.dropna().groupBy("id").agg(F.min("q").alias("q"), F.max("t").alias("t"))
    counts = {(r.q, r.t): r.n for r in votes.groupBy("q", "t").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return QualityModel(_neutral(GOOD_PRIOR), _neutral(TOXIC_PRIOR))
    draw = F.pmod(F.xxhash64(F.lit("train"), "id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    share = F.lit(0.0)
    for (q, t), n in counts.items():
        share = F.when((F.col("q") == q) & (F.col("t") == t), F.lit(rows / n)).otherwise(share)
    chosen = stored(votes.filter(draw < share), "training-ids")
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "id").dropDuplicates(["id"])
    sample = stored(texts, "training")

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("quality")
        for batch in batches:
            q, t = batch.column("q").to_pylist(), batch.column("t").to_pylist()
            out = [(w, q[k], t[k]) for k, text in enumerate(batch.column("text").to_pylist()) for w in set(words_of(text))]
            word, good, toxic = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(word, pa.string()), pa.array(good, pa.int32()), pa.array(toxic, pa.int32())], ["word", "q", "t"]
            )

    by_word = sample.mapInArrow(presence, "word string, q int, t int").groupBy("word")
    seen = stored(by_word.agg(F.count(F.lit(1)).alias("n"), F.sum("q").alias("q"), F.sum("t").alias("t")).filter(F.col("n") >= LEAST_WORD_ROWS), "words")
    totals = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("q"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    n, n_good, n_toxic = totals

    def chosen_words(label: str, n_label: int) -> list[str]:
        """Words whose presence tells most about a label, by the chi-square statistic of the two."""
        both, rows_with, all_rows = F.col(label).cast("double"), F.col("n").cast("double"), float(n)
        gap = both * all_rows - rows_with * n_label
        chi = gap * gap / F.greatest(rows_with * (all_rows - rows_with), F.lit(1.0))
        return [r.word for r in seen.orderBy(chi.desc(), "word").limit(n_words).collect()]

    vocabularies = {"q": chosen_words("q", n_good), "t": chosen_words("t", n_toxic)}
    every = sorted({*vocabularies["q"], *vocabularies["t"]})
    place = {w: k for k, w in enumerate(every)}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes, present = [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                shapes.append(shape_of(text, words))
                present.append(sorted(place[w] for w in set(words) if w in place))
            yield pa.RecordBatch.from_arrays(
                [batch.column("q"), batch.column("t"), pa.array(shapes, pa.list_(pa.float64())), pa.array(present, pa.list_(pa.int32()))],
                ["q", "t", "shape", "present"],
            )

    # at most the documented number of sampled rows, each with a bounded number of features
    got = sample.orderBy("id").mapInArrow(features, "q int, t int, shape array<double>, present array<int>").collect()
    if not got:
        return QualityModel(_neutral(GOOD_PRIOR), _neutral(TOXIC_PRIOR))
    sampled = Counter((r.q, r.t) for r in got)
    weight = np.array([counts[r.q, r.t] / sampled[r.q, r.t] for r in got])
    weight *= len(got) / weight.sum()
    shape = np.array([r["shape"] for r in got])
    present = np.zeros((len(got), len(every)))
    for k, r in enumerate(got):
        present[k, r.present] = 1
    total = sum(counts.values())

    def model(label: str, one: int) -> LinearModel:
        y = np.array([float(r[label] == one) for r in got])
        prior = sum(c for (q, t), c in counts.items() if (q if label == "q" else t) == one) / total
        if not 0 < y.mean() < 1:
            return _neutral(GOOD_PRIOR if label == "q" else TOXIC_PRIOR)
        own = vocabularies[label]
        x = np.hstack([shape, present[:, [place[w] for w in own]]])
        bias, weights = fit_logistic(x, y, weight, ridge=0.4, scaled=N_SHAPE)
        return LinearModel(bias, weights[:N_SHAPE], dict(zip(own, weights[N_SHAPE:].tolist())), prior)

    return QualityModel(model("q", 1), model("t", 1))


def evidence_column(model: QualityModel, text: Column) -> Column:
    """``struct<good, toxic>``: log-odds that the text itself lends to each label."""

    @F.pandas_udf("good double, toxic double")
    def evidence(texts: pd.Series) -> pd.DataFrame:
        begin("quality")
        return pd.DataFrame([model.evidence(t or "") for t in texts], columns=["good", "toxic"], dtype="float64")

    # Spark would evaluate a deterministic one again for each filter that it derives from the result.
    return evidence.asNondeterministic()(text)


def document_site(source: str = "source", part: str = "lang") -> tuple[Column, Column]:
    """Host and path of a row of a documents table: its source, and the part of the source in one language."""
    host = F.coalesce(col(source).cast("string"), F.lit(""))
    return host, F.concat(host, F.lit("/"), F.coalesce(col(part).cast("string"), F.lit("")))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(rows: DataFrame, label: str, centre: Column, centres: int) -> float:
    """How many rows a group's centre is worth to it: beta-binomial strength by the method of moments.

    ``rows`` has the size ``n`` and soft count ``label`` of each group; the shares of the groups are compared with
    ``centre``, of which there are ``centres``. Groups that differ no more than chance would make them shrink fully.
    """
    n = F.col("n").cast("double")
    sums = rows.agg(F.sum(n * F.pow(F.col(label) / n - centre, 2)), F.sum(n * centre * (1 - centre)), F.sum(n), F.sum(n * n), F.count(F.lit(1)))
    spread, noise, total, squares, groups = sums.first()
    if not groups or groups <= centres:
        return 1e9
    noise /= total
    between = (spread - (groups - centres) * noise) / max(1e-9, total - squares / total)
    return min(1e9, max(1.0, noise / between - 1)) if between > 1e-12 else 1e9


def site_posteriors(scored: DataFrame, priors: dict[str, float]) -> DataFrame:
    """``path, prior_good, prior_toxic``: share of each label on a path, shrunk to its host, the host to all.

    ``scored`` has ``host, path`` and the log-odds ``good, toxic`` of documents. Rows are summed per path in
    every task before they are shuffled, so a host with a third of all rows is a few rows; hosts
    are summed from paths. The result has a row a path and is stored.
    """
    soft = {k: F.sum(_sigmoid(F.col(k) + math.log(p / (1 - p)))).alias(k) for k, p in priors.items()}
    paths = stored(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), *soft.values()), "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("n"), *[F.sum(k).alias(k) for k in priors]), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("hosts"), *[F.sum(k).alias(k) for k in priors]).first()
    raw = hosts.select("host", *[(F.col(k) / F.col("n")).alias(f"raw_{k}") for k in priors])
    met = paths.join(raw, "host")
    host_means, path_means = [], []
    for k in priors:
        mean = min(1 - 1e-6, max(1e-6, total[k] / total["n"])) if total["n"] else 0.5
        by_host = _strength(hosts, k, F.lit(mean), 1)
        by_path = _strength(met, k, F.col(f"raw_{k}"), total["hosts"])
        host_means.append(((by_host * mean + F.col(k)) / (by_host + F.col("n"))).alias(f"host_{k}"))
        path_means.append(((by_path * F.col(f"host_{k}") + F.col(k)) / (by_path + F.col("n"))).alias(f"prior_{k}"))
    means = paths.join(hosts.select("host", *host_means), "host").select("path", *path_means)
    return stored(means, "site-posteriors")


def classify(scored: DataFrame, model: QualityModel) -> DataFrame:
    """Adds ``p_good, p_toxic, keep`` to rows with ``host, path, good, toxic``.

    The site's share of a label is the prior of its documents, their own log-odds the evidence. The table of
    paths is stored, so its size decides between a broadcast and a shuffle; adaptive execution splits
    a path that holds a large share of the rows.
    """
    sites = site_posteriors(scored, {"good": model.good.prior, "toxic": model.toxic.prior})
    p_good = _sigmoid(F.col("good") + _logit(F.col("prior_good")))
    p_toxic = _sigmoid(F.col("toxic") + _logit(F.col("prior_toxic")))
    joined = scored.join(sites, "path").withColumn("p_good", p_good).withColumn("p_toxic", p_toxic)
    return joined.withColumn("keep", (F.col("p_good") >= 0.5) & (F.col("p_toxic") < 0.5))


def score_documents(docs: DataFrame, model: QualityModel, site: tuple[Column, Column] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, p_good, p_toxic, keep`` for every row.

    Texts are read once; what follows works on a stored table of log-odds. A null or empty text is judged by
    its shape (no words), a null source or language forms a site of its own, repeated rows and rows without an
    id are judged like any other.
    """
    host, path = site or document_site()
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), host.alias("host"), path.alias("path"), evidence_column(model, text_of(text_col)).alias("e"))
    scored = stored(rows.select("doc_id", "host", "path", "e.good", "e.toxic"), "evidence")
    return classify(scored, model).select("doc_id", "p_good", "p_toxic", "keep")


def keep_good(docs: DataFrame, model: QualityModel, site: tuple[Column, Column] | None = None, text_col: str = "text") -> DataFrame:
    """The rows that the classifier keeps, with all their columns.

    Texts are scored twice, first for the sites and then for the rows, rather than shuffled.
    """
    host, path = site or document_site()
    e = evidence_column(model, text_of(text_col))
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), host.alias("host"), path.alias("path"), e.alias("e"))
    scored = rows.select("row", "host", "path", "e.good", "e.toxic")
    return unpacked(classify(scored, model).filter("keep").select("row"))
