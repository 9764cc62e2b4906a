"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all other text is unlabelled. A linear numpy model over words and word
beginnings minimises the positive-unlabelled risk with logistic loss. The negative part of the risk,
R_u(-) - prior * R_p(-), is kept from going under zero: where it does, the step goes up it instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagebook.llm.common import first_by_hash, written

EDGES = ".,;:!?\"'()[]{}<>|*#$%&+-_/\\~^=@`"


def features(text: str | None) -> set[str]:
    """Distinct words of the whole text in lower case, and the first three, four and five letters of longer ones."""
    out = {w.strip(EDGES) for w in set((text or "").lower().split())}
    out |= {w[:k] + "*" for w in out for k in (3, 4, 5) if len(w) > k}
    out.discard("")
    return out


def held_out(doc_id: Column) -> Column:
    """Rows that learning may not look at: crc32 of the id as text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class NonNegativePU:
    """w: weight of each feature; bias. Weights are held back by decay, shared among the positives.

    The steps go up and down around zero of the negative risk, so the last one says little by itself: w and bias are the
    mean of the last `averaged` steps (0: the last one).
    """

    def __init__(self, prior: float, rounds: int = 200, rate: float = 0.05, decay: float = 0.3, averaged: int = 0):
        self.prior, self.rounds, self.rate, self.decay, self.averaged = prior, rounds, rate, decay, averaged

    def fit(self, rows: list[np.ndarray], positive: np.ndarray, size: int) -> NonNegativePU:
        """rows: the feature numbers (under size) that each document has."""
        starts, flat = np.cumsum([0, *map(len, rows)]), np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)
        doc = np.repeat(np.arange(len(rows)), np.diff(starts))
        up = positive / max(1, positive.sum())
        un = (~positive) / max(1, (~positive).sum())
        w, b, decay = np.zeros(size), 0.0, self.decay / max(1, positive.sum())
        m, v = np.zeros(size + 1), np.zeros(size + 1)
        last = min(self.rounds, max(1, self.averaged))
        sums = np.zeros(size + 1)
        for t in range(1, self.rounds + 1):
            g = np.bincount(doc, weights=w[flat], minlength=len(rows)) + b
            s = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
            as_negative = np.logaddexp(0, g)
            negative = un @ as_negative - self.prior * (up @ as_negative)
            d_neg = (un - self.prior * up) * s
            d = -d_neg if negative < 0 else d_neg - self.prior * up * (1 - s)
            grad = np.append(np.bincount(flat, weights=d[doc], minlength=size) + decay * w, d.sum())
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            step = self.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
            if t > self.rounds - last:
                sums += np.append(w, b)
        self.w, self.bias = sums[:-1] / last, float(sums[-1] / last)
        return self


def _numbered(words: list[str], kind: str):
    """Feature numbers of each text, as rows of (id, h, f)."""
    at = {w: i for i, w in enumerate(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(at[w] for w in features(t) & at.keys()) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(found, pa.list_(pa.int32()))], ["id", "h", "f"])

    return run, f"id {kind}, h long, f array<int>"


def _counted(words: list[str]):
    """Per batch, in how many texts each of words occurs: rows (f, n), and (-1, texts)."""
    at = {w: i for i, w in enumerate(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(words), dtype=np.int64), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                for w in features(t) & at.keys():
                    n[at[w]] += 1
            total += b.num_rows
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(n[some], total), pa.int64())], ["f", "n"])

    return run


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = 4000, max_unlabelled: int = 20_000, size: int = 2000, least: int = 3, max_candidates: int = 100_000) -> tuple[dict[str, float], float] | None:
    """(feature weights, bias), or None where no row is confirmed toxic.

    Nothing is learned from held-out rows. Positives are max_positive confirmed toxic documents at most, by hash of id.
    Candidates for features are what at least `least` of them have, the max_candidates most frequent ones; how often
    each occurs is counted over all documents, and the `size` that tell positives from all text best are taken. The risk
    over unlabelled text is estimated from max_unlabelled documents at most, drawn by hash of id from all text,
    confirmed toxic or not, as the estimator has it. Of rows that repeat an id, the text with the smallest hash counts
    for the samples. The class prior is the toxic share of labelled rows outside the held-out ones.
    """
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = known.where("toxic is not null").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k")).first()
    if not counts["k"]:
        return None
    prior = min(0.9, max(0.001, counts["k"] / counts["n"]))
    order = F.xxhash64(F.lit("fit"), "doc_id")
    texts = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    sure = first_by_hash(known.where("toxic = 1").select("doc_id"), order, max_positive).select("doc_id", F.lit(True).alias("positive"))
    rest = first_by_hash(texts.select("doc_id").where("doc_id is not null"), order, max_unlabelled).select("doc_id", F.lit(False).alias("positive"))
    # The ids are of bounded number, so they are broadcast; the sample's texts are written once.
    sample = texts.join(F.broadcast(sure.unionByName(rest)), "doc_id").select("doc_id", "positive", "text", F.xxhash64("text").alias("h"))
    sample = written(sample.groupBy("doc_id", "positive").agg(F.min_by("text", "h").alias("text")))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(features(t)) for t in b.column(0).to_pylist()], pa.list_(pa.string()))], ["f"])

    ours = sample.where("positive").select("text").mapInArrow(listed, "f array<string>").select(F.explode("f").alias("f"))
    found = ours.groupBy("f").agg(F.count(F.lit(1)).alias("a")).where(F.col("a") >= least).orderBy(F.desc("a"), "f").limit(max_candidates).collect()
    positives, candidates = sample.where("positive").count(), [r["f"] for r in found]
    if not positives or positives == sample.count():
        return None
    everywhere = texts.select("text").mapInArrow(_counted(candidates), "f int, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()
    everywhere = {r["f"]: r["n"] for r in everywhere}
    a, b = np.array([r["a"] for r in found], dtype=float), np.array([everywhere.get(i, 0) for i in range(len(found))], dtype=float)
    b *= positives / everywhere[-1]  # as if all text were as many documents as the positives
    apart = np.abs(np.log((a + 0.5) / (b + 0.5))) * np.sqrt(a + b)
    words = [candidates[i] for i in sorted(range(len(found)), key=lambda i: (-round(apart[i], 9), candidates[i]))[:size]]

    run, schema = _numbered(words, docs.schema["doc_id"].dataType.simpleString())
    got = [(sample.where(c).select("doc_id", "text", order.alias("h")).mapInArrow(run, schema).collect()) for c in ("positive", "not positive")]
    got = [sorted(x, key=lambda r: (r["h"], r["id"])) for x in got]
    rows = [np.array(r["f"], dtype=np.int64) for x in got for r in x]
    model = NonNegativePU(prior, averaged=100).fit(rows, np.array([True] * len(got[0]) + [False] * len(got[1])), len(words))
    return dict(zip(words, map(float, model.w))), model.bias


def score(docs: DataFrame, model: tuple[dict[str, float], float] | None) -> DataFrame:
    """docs with score (0 to 1), which replaces a column of that name. Null and empty texts get what the bias says; texts
    are read whole; repeated rows get one score; no rows give no rows; without a model every score is 0."""
    if model is None:
        return docs.withColumn("score", F.lit(0.0))
    weights, bias = model

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        g = np.array([sum(sorted(weights[f] for f in features(t) & weights.keys())) for t in texts], dtype=float) + bias
        return pd.Series(1 / (1 + np.exp(-np.clip(g, -500, 500))))

    return docs.withColumn("score", scores("text"))


def query(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = score(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
