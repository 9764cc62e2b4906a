"""Quality by hierarchical empirical Bayes: what a document's shape says, weighed with what its host and path are like.

A small numpy network trained on labelled documents gives each document a probability of being good. Over all documents
these probabilities are summed by host and path; sparse sites are shrunk, path to host to all documents, with prior
weights estimated from the spread between sites. A document's own share is taken out of its site before the two are
combined, so that it does not count twice.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagebook.llm.common import by_small, first_by_hash, written

FEATURES = 16
SCALE = 1_000_000
_KINDS: np.ndarray | None = None


def _kinds() -> np.ndarray:
    """Code point -> 0 other, 1 upper, 2 other letter, 3 digit, 4 white space, 5 common punctuation, 6 symbol."""
    global _KINDS
    if _KINDS is None:
        def kind(c: str) -> int:
            return 1 if c.isupper() else 2 if c.isalpha() else 3 if c.isdigit() else 4 if c.isspace() else 5 if c in ".,;:?'\"-()" else 6 if c.isprintable() else 0
        _KINDS = np.array([kind(chr(i)) for i in range(0x3000)] + [2], dtype=np.uint8)
    return _KINDS


def shape(text: str | None) -> list[float]:
    """Features of a whole text, of any length; a null is an empty text."""
    text = text or ""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = np.bincount(_kinds()[np.minimum(codes, 0x3000)], minlength=7).astype(float)
    total, letters = max(1.0, n.sum()), max(1.0, n[1] + n[2])
    words = text.split()
    nw = max(1, len(words))
    counts = Counter(words)
    lines = text.split("\n")
    most = max(counts.values(), default=0)
    return [
        n[1] / letters, n[3] / total, n[4] / total, n[5] / total, n[6] / total, n[0] / total, (n[1] + n[2]) / total,
        len(counts) / nw, most / nw, len(counts) / nw**0.7, len(set(lines)) / len(lines), len(lines) / nw,
        sum(map(len, words)) / nw / 10, np.log1p(len(words)) / 10, counts.get("|", 0) / nw, 1.0 if words else 0.0,
    ]


def shapes(texts) -> np.ndarray:
    return np.array([shape(t) for t in texts], dtype=np.float64).reshape(-1, FEATURES)


class Network:
    """One hidden layer, trained by Adam on the logistic loss."""

    def __init__(self, hidden: int = 24, rounds: int = 400, seed: int = 1):
        self.hidden, self.rounds, self.seed = hidden, rounds, seed

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        rng = np.random.default_rng(self.seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        self.p = [rng.normal(0, 0.3, (x.shape[1], self.hidden)), np.zeros(self.hidden), rng.normal(0, 0.3, self.hidden), np.zeros(1)]
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        m, v = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p]
        for t in range(1, self.rounds + 1):
            i = rng.integers(0, len(x), min(len(x), 2048))
            h = np.tanh(x[i] @ self.p[0] + self.p[1])
            d = (1 / (1 + np.exp(-(h @ self.p[2] + self.p[3]))) - y[i]) / len(i)
            dh = d[:, None] * self.p[2] * (1 - h * h)
            for k, g in enumerate((x[i].T @ dh, dh.sum(0), h.T @ d, d.sum(keepdims=True))):
                g = g + 1e-4 * self.p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                self.p[k] = self.p[k] - 0.02 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return 1 / (1 + np.exp(-(np.tanh(x @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3])))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _shapes(texts: pd.Series) -> pd.Series:
    return pd.Series(list(shapes(texts)))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Network | None:
    """The network, from max_rows labelled documents at most, taken by a hash of their id; None without any label.

    Of several labels of a document the lower one counts, of several texts of one id the one with the smallest hash, so
    the sample and its order are the same however the tables are partitioned. The labelled ids are of bounded number, so
    they are broadcast.
    """
    order = F.xxhash64(F.lit("fit"), "doc_id")
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("y"))
    known = first_by_hash(known, order, max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "y", F.xxhash64("text").alias("h"), _shapes("text").alias("x"))
    rows = rows.groupBy("doc_id", "y").agg(F.min_by("x", "h").alias("x")).select("x", "y", order.alias("o"), "doc_id").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["o"], r["doc_id"]))
    return Network().fit(np.array([r["x"] for r in rows]), np.array([float(r["y"]) for r in rows]))


def prior_weight(groups: DataFrame, n: str, k: str, least: float, most: float) -> float:
    """Documents that a prior counts as, from the spread of the groups' means (k / n) between them: method of moments."""
    c, r = F.col(n).cast("double"), F.col(k) / F.col(n) / SCALE
    t = groups.agg(F.sum(c).alias("n"), F.sum(c * c).alias("nn"), F.sum(c * r).alias("k"), F.sum(c * r * r).alias("kk"), F.count(F.lit(1)).alias("g")).first()
    if not t["n"] or t["g"] < 2 or t["n"] ** 2 <= t["nn"]:
        return most
    mean = t["k"] / t["n"]
    within = mean * (1 - mean)
    between = (t["kk"] / t["n"] - mean * mean - within * (t["g"] - 1) / t["n"]) / (1 - t["nn"] / t["n"] ** 2)
    # Sums of doubles differ in their last digits with their order, so the weight is rounded.
    return float(f"{min(most, max(least, within / between - 1)):.6g}") if between > 1e-12 else most


SCORES = ["doc_score", "host_score", "path_score", "score"]


def scored(docs: DataFrame, model: Network | None, keep: list[str] | None = None, host: str = "source", path: str = "lang", least_weight: float = 2.0, most_weight: float = 1000.0) -> DataFrame:
    """A row per row of docs: row (a struct of its columns, or of those in keep), doc_score, host_score, path_score and
    score, the combined probability.

    Null hosts and paths are sites of their own. A null text is an empty one; texts of any length are read whole.
    Repeated rows each count as evidence of their site and get one score. No rows give no rows. Without a model every
    score is 1, so nothing is rejected. Columns of docs may have any name. The network runs once over each row; rows
    are written with what it said, as site evidence must be complete before any score is.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row")
    if model is None:
        return docs.select(row, *[F.lit(1.0).alias(c) for c in SCORES])

    @F.pandas_udf("long")
    def parts(texts: pd.Series) -> pd.Series:
        return pd.Series(np.rint(model.predict(shapes(texts)) * SCALE).astype(np.int64))

    site = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0"))
    rows = written(docs.select(row, parts("text").alias("p"), site(host).alias("host"), site(path).alias("path")))
    paths = written(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("k")))
    hosts = written(paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("k").alias("hk")))
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hk").alias("k")).first()
    base = min(1 - 1e-6, max(1e-6, (total["k"] or 0) / SCALE / total["n"])) if total["n"] else 0.5
    wh, wp = prior_weight(hosts, "hn", "hk", least_weight, most_weight), prior_weight(paths, "n", "k", least_weight, most_weight)
    sites = written(by_small(paths, hosts, ["host"], F.col("path")))
    p = F.col("p") / SCALE
    out = by_small(rows, sites, ["host", "path"], F.struct("p", F.monotonically_increasing_id()))
    out = out.withColumn("host_score", (F.col("hk") / SCALE - p + wh * base) / (F.col("hn") - 1 + wh))
    out = out.withColumn("path_score", (F.col("k") / SCALE - p + wp * F.col("host_score")) / (F.col("n") - 1 + wp))

    def logit(c):
        c = F.greatest(F.least(c, F.lit(1 - 1e-6)), F.lit(1e-6))
        return F.log(c / (1 - c))

    score = 1 / (1 + F.exp(-(logit(p) + logit(F.col("path_score")) - logit(F.lit(base)))))
    return out.withColumns({"doc_score": p, "score": score}).select("row", *SCORES)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """docs whose score is at least threshold; columns as they came."""
    return scored(docs, fit(docs, labels)).where(F.col("score") >= threshold).select("row.*")


def query(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = scored(docs, fit(docs, labels), ["doc_id"])
    return out.select("row.doc_id", *SCORES, (F.col("score") >= 0.5).alias("kept"))
