"""Document fingerprints by a homomorphic multiset hash.

Each paragraph (line) is hashed to a wide vector; a text's fingerprint is the sum of its paragraphs' vectors, modulo 2**16
in each hash lane and 2**32 in each sketch lane: a text that Spark can hold has under 2**31 runs, so its counts never
wrap. So the order of paragraphs does not matter, and a paragraph is put in or taken out by adding or subtracting its
vector. The first lanes are uniform (SHAKE-128) and make equality strict; the others are a signed count sketch of the
paragraph's character runs, linear too, whose cosine estimates how much of two texts is the same.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagebook.llm.common import hashed_under

HASH_LANES, SKETCH_LANES, RUN = 128, 128, 6
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 2**64) for k in range(RUN)], dtype=np.uint64)


def _sketch(codes: np.ndarray) -> np.ndarray:
    """Signed counts of runs of RUN code points; a line shorter than that counts as one run. Lines end at code 10."""
    out = np.zeros(SKETCH_LANES, dtype=np.int64)
    for at in range(0, max(1, len(codes)), 1 << 18):  # blocks overlap by a run, so memory is bounded
        c = codes[at : at + (1 << 18) + RUN - 1].astype(np.uint64)
        n = len(c) - RUN + 1
        if n <= 0:
            break
        h = np.zeros(n, dtype=np.uint64)
        breaks = np.concatenate([[0], np.cumsum(c == 10)])
        for k in range(RUN):
            h += c[k : k + n] * _POWERS[k]
        h = h[breaks[RUN:] == breaks[:n]]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        lane = (h >> np.uint64(40)).astype(np.int64) % SKETCH_LANES
        out += np.bincount(lane * 2 + ((h >> np.uint64(20)) & np.uint64(1)).astype(np.int64), minlength=2 * SKETCH_LANES).reshape(-1, 2) @ np.array([1, -1])
    return out


def fingerprint(text: str) -> np.ndarray:
    """Vector of HASH_LANES numbers of 16 bits and SKETCH_LANES signed counts of 32 bits, held as unsigned numbers of 32."""
    lines = text.split("\n")
    sums = np.zeros(HASH_LANES, dtype=np.uint64)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sketch = _sketch(codes)
    for at in range(0, len(lines), 1024):
        raw = [x.encode("utf-8", "surrogatepass") for x in lines[at : at + 1024]]
        sums += np.frombuffer(b"".join(hashlib.shake_128(x).digest(2 * HASH_LANES) for x in raw), dtype="<u2").reshape(len(raw), HASH_LANES).sum(0, dtype=np.uint64)
    for x in lines:
        if 0 < len(x) < RUN:
            h = int.from_bytes(hashlib.shake_128(x.encode("utf-8", "surrogatepass")).digest(4), "little")
            sketch[(h >> 1) % SKETCH_LANES] += 1 if h & 1 else -1
    return _held(np.concatenate([sums, sketch.astype(np.uint64)]))


def _held(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.uint32)
    v[:HASH_LANES] &= 0xFFFF
    return v


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprint of both texts' paragraphs together."""
    return _held(a + b)


def remove(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprint of a's paragraphs without b's."""
    return _held(a - b)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: 1 for equal fingerprints, else the sketches' cosine, at least 0. Sketches without any run: 0."""
    if np.array_equal(a, b):
        return 1.0
    x, y = a[HASH_LANES:].astype(np.int32).astype(float), b[HASH_LANES:].astype(np.int32).astype(float)
    d = float(np.sqrt((x @ x) * (y @ y)))
    return min(1.0, max(0.0, float(x @ y) / d)) if d else 0.0


def written(v: np.ndarray) -> str:
    return base64.b64encode(v[:HASH_LANES].astype("<u2").tobytes() + v[HASH_LANES:].astype("<u4").tobytes()).decode()


def _place() -> list[Column]:
    """null, at, h of a document (doc_id, text): at falls as the id rises, for every long."""
    at = F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(0)).cast("long")
    return [F.col("doc_id").isNull().cast("int").alias("null"), at.alias("at"), F.xxhash64("text").alias("h")]


def cut_rows(docs: DataFrame, parts: int, draws: int = 32) -> list[tuple[int, int, int]]:
    """At most `parts` places in the order of dealt_by_id, the very first among them, at about even distances.

    They are order statistics of about parts * draws rows that hashes of id and text choose, so outlying ids or very many
    rows of one id do not make the parts uneven. The driver holds that many rows of three numbers: rows are counted in the
    pass that finds the first, and the hash's bound follows from their number, so no task orders what grows.
    """
    places = docs.select(*_place())
    seen = places.agg(F.min(F.struct("null", "at", "h")).alias("first"), F.count(F.lit(1)).alias("n")).first()
    first = seen["first"]
    if first is None:
        return []
    share = parts * draws / seen["n"]
    while True:
        near = hashed_under(F.xxhash64(F.lit("cut"), "null", "at", "h"), share)
        drawn = sorted(tuple(r) for r in places.where(near).distinct().collect())
        if share >= 1 or 2 * len(drawn) >= parts * draws:  # fewer where rows repeat very often
            break
        share *= 4
    return sorted({tuple(first), *(drawn[len(drawn) * k // parts] for k in range(1, parts))})


def dealt_by_id(docs: DataFrame, parts: int) -> DataFrame:
    """docs (doc_id, text) with null, at, h, part and guest: parts hold runs of documents in descending order of id, null
    ids last, rows of one id by the hash of their text, and are dealt whole to tasks.

    Each part's first document is also a guest at the end of the part before it (the first part's: of the last), so that
    every document meets its successor within one part.
    """
    cuts = cut_rows(docs, parts)

    @F.pandas_udf("part int, host int")
    def place(null: pd.Series, at: pd.Series, h: pd.Series) -> pd.DataFrame:
        part, host = [], []
        for key in zip(null.tolist(), at.tolist(), h.tolist()):
            k = bisect.bisect_right(cuts, key) - 1
            part.append(k)
            host.append((k - 1) % len(cuts) if cuts[k] == key else None)
        return pd.DataFrame({"part": pd.Series(part, dtype="int32"), "host": pd.Series(host, dtype="Int32")})

    rows = docs.select("doc_id", "text", *_place())
    rows = rows.withColumn("p", place("null", "at", "h"))
    places = F.array(F.struct("p.part", F.lit(0).alias("guest")), F.struct(F.col("p.host").alias("part"), F.lit(1).alias("guest")))
    rows = rows.withColumn("x", F.explode(F.filter(places, lambda x: x["part"].isNotNull())))
    return rows.select("doc_id", "text", "null", "at", "h", "x.part", "x.guest")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    last, out = None, []

    def row(a, b) -> tuple:
        text, nxt = a[1], b[1]
        k = len(text) // 2
        edited = text[: len(text) - k] + nxt[:k]
        e = fingerprint(edited)
        return a[0], len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), written(a[2]), written(e), likeness(a[2], e), likeness(a[2], b[2])

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    for b in batches:
        ids, texts, parts, guests = (b.column(i) for i in range(4))
        for i in range(b.num_rows):
            part, guest = parts[i].as_py(), guests[i].as_py()
            if last is not None and last[3] != part:
                raise RuntimeError("a part ended without the document that follows it")
            if guest and last is None:
                continue
            text = texts[i].as_py() or ""
            now = (ids[i].as_py(), text, fingerprint(text), part)
            if last is not None:
                out.append(row(last, now))
            last = None if guest else now
            if len(out) == 256:
                yield flushed()
                out = []
    if out:
        yield flushed()


def compared(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Per document of docs (doc_id, text): its fingerprint, that of its edited text, and how alike they are.

    The edited text has the last half of the text replaced by as much of the beginning of the next document's, in
    descending order of id (null ids last, rows of one id by the hash of their text); the last document's next is the
    first, a single document's is itself. Ids are integers. A null text is empty; texts are read whole. Other columns
    are left out; no rows give no rows. Texts are exchanged once, by ranges of ids.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = dealt_by_id(docs.select("doc_id", "text"), parts or 8 * n)
    rows = rows.repartition(n, "part").sortWithinPartitions("part", "guest", "null", "at", "h", "text")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.select("doc_id", "text", "part", "guest").mapInArrow(_compared, schema)


def query(spark, docs: DataFrame) -> DataFrame:
    return compared(docs)
