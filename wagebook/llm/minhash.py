"""Near-duplicates: MinHash with tensored banding, exact verification, connected components.

1. Texts become sets of word shingles; texts with one set form a class, which has a number of its own.
2. Each class gets HALVES half-keys of two minhashes. Every pair of half-keys is a table key: 66 keys of four minhashes
   each come from 24 minhashes. Two sets of Jaccard 0.8 miss every key about once in 10,000 times. Half-keys that one
   class alone has can be in no shared key, so keys are formed from the others only.
3. In each bucket the smallest class is the pivot, and each other member is held against it, not against each other.
   A sketch of 64 one-bit minhashes drops pairs that are far off before full sets are moved.
4. Pairs are confirmed on the full sets, and links are merged into components.
5. Members of a bucket that are still apart can be linked without their pivot. They go through an exact join on the
   rarest shingles (prefix filter), which loses no pair: two sets over the threshold share one of them. Only pairs of
   different components leave the join.

What grows with the input is never broadcast. No join meets a key unsalted that very many rows can have: buckets are joined by key and salt, and pivots and hubs of
components get a copy for each of their salts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagebook.llm.common import attached, by_small, dealt, grouped, id_key, one_each, written

HALVES, ROWS, BITS, LEAST_AGREE = 12, 2, 64, 44
#: A node with more partners than HUB gets a copy for each of SPREAD salts in joins.
HUB, SPREAD, BUCKET_SALTS = 500, 64, 16
_RNG = np.random.default_rng(20240501)
_MUL = (_RNG.integers(1, 2**63, HALVES * ROWS + BITS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_ADD = _RNG.integers(0, 2**63, HALVES * ROWS + BITS, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingles of k words as sorted 64-bit hashes. Words: ASCII white space parts them, A-Z are lowered."""

    def __init__(self, k: int):
        self.k, self.seen = k, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        seen = self.seen
        if len(seen) > 500_000:
            seen.clear()
        ids = np.empty(len(words), dtype=np.uint64)
        for i, w in enumerate(words):
            h = seen.get(w)
            if h is None:
                h = seen[w] = xxhash.xxh3_64_intdigest(w)
            ids[i] = h
        k = min(self.k, len(ids))
        n = len(ids) - k + 1
        h = np.full(n, k, dtype=np.uint64)
        for j in range(k):
            h = _mixed(h * _ODD + ids[j : j + n])
        return np.unique(h)


def minima(shingles: np.ndarray) -> np.ndarray:
    out = np.full(len(_MUL), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 8192):
        x = shingles[at : at + 8192]
        for lo in range(0, len(_MUL), 22):
            s = slice(lo, lo + 22)
            y = x[None, :] * _MUL[s, None] + _ADD[s, None]
            y ^= y >> np.uint64(32)
            out[s] = np.minimum(out[s], y.min(axis=1))
    return out


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                n, sets, halves, bits = [], [], [], []
                for t in part.column(1):
                    s = shingler(t.as_py())
                    m = minima(s)
                    n.append(len(s))
                    sets.append(xxhash.xxh3_128_digest(s.tobytes()))
                    halves.append(_mixed(_mixed(m[: HALVES * ROWS : 2]) * _ODD + m[1 : HALVES * ROWS : 2]).astype(np.int64))
                    bits.append(np.packbits((_mixed(m[HALVES * ROWS :]) & np.uint64(1)).astype(np.uint8)).view(">i8")[0])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, HALVES * (len(n) + 1), HALVES), pa.int32()), pa.array(np.concatenate(halves)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(sets, pa.binary()), lists, pa.array(bits, pa.int64())], ["id", "n", "set_hash", "halves", "bits"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                sets = [shingler(t.as_py()).astype(np.int64) for t in part.column(1)]
                ends = np.cumsum([0, *map(len, sets)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["c", "shingles"])

    return run


def _near(n_a: Column, n_b: Column, bits_a: Column, bits_b: Column, percent: int) -> Column:
    """What pairs of percent or more pass: sizes that allow it, and (but for about one in a million) like sketches."""
    sizes = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent
    return sizes & (F.lit(BITS) - F.bit_count(bits_a.bitwiseXOR(bits_b)) >= LEAST_AGREE)


def _spread(rows: DataFrame, key: str, other: str) -> tuple[DataFrame, DataFrame]:
    """(rows with salt, hubs): rows whose key has more than HUB rows are salted by other, all others have salt 0. hubs:
    key, hub, one row for each such key. Counting is map-side combined, and the join with hubs is salted too."""
    hubs = written(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HUB).select(key, F.lit(True).alias("hub")))
    out = by_small(rows, hubs, [key], F.col(other), SPREAD)
    return out.withColumn("salt", F.when(F.col("hub"), F.pmod(F.xxhash64(other), F.lit(SPREAD)).cast("int")).otherwise(0)).drop("hub"), hubs


def _copies(table: DataFrame, hubs: DataFrame, key: str) -> DataFrame:
    """table, one row per key, with salt: a copy for each salt that _spread gives to rows of the key."""
    salts = F.when(F.col("hub"), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    return table.join(hubs, key, "left").withColumn("salt", F.explode(salts)).drop("hub")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union. Sets are joined to either side."""
    rows, hubs_b = _spread(pairs, "b", "a")
    rows, hubs_a = _spread(rows.withColumnRenamed("salt", "salt_b"), "a", "b")
    rows = rows.withColumnRenamed("salt", "salt_a")
    for x, hubs in (("b", hubs_b), ("a", hubs_a)):
        side = _copies(sets.select(F.col("c").alias(x), F.col("shingles").alias(f"s{x}")), hubs, x).withColumnRenamed("salt", f"salt_{x}")
        rows = rows.join(side.hint("merge"), [x, f"salt_{x}"])
    both = F.size(F.array_intersect("sa", "sb"))
    return rows.where(both * 100 >= (F.size("sa") + F.size("sb") - both) * percent).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(c, comp) of every node in edges (a, b): comp is the smallest node that can be reached.

    Rounds of hooking each node to its smallest neighbour's label and of following labels, each written to the shared
    folder; their number goes with the logarithm of the longest path. Edges of a hub, and nodes of a component with very
    many, are spread by salts.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both, hubs = _spread(written(both), "b", "a")
    both = written(both)
    label = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("comp")).withColumnRenamed("a", "c"))
    while True:
        at = _copies(label.select(F.col("c").alias("b"), F.col("comp").alias("nb")), hubs, "b")
        near = both.join(at.hint("merge"), ["b", "salt"]).groupBy("a").agg(F.min("nb").alias("nb"))
        hooked = label.join(near, label["c"] == near["a"]).select("c", "comp", F.least("comp", "nb").alias("low"))
        # The label's own node takes the lower label too, so that whole trees move.
        roots = hooked.groupBy("comp").agg(F.min("low").alias("deep")).withColumnRenamed("comp", "low")
        moved = by_small(hooked, roots, ["low"], F.col("c"), BUCKET_SALTS, grows=True)
        new = written(moved.select("c", F.least("low", F.coalesce("deep", "low")).alias("comp"), (F.least("low", F.coalesce("deep", "low")) < F.col("comp")).alias("changed")))
        label = new.select("c", "comp")
        if not new.where("changed").limit(1).count():
            return label


def _labels(nodes: DataFrame, merged: DataFrame) -> DataFrame:
    """nodes (c, ...) with comp. A pivot may be in very many rows."""
    return by_small(nodes, merged, ["c"], F.monotonically_increasing_id(), BUCKET_SALTS, grows=True).withColumn("comp", F.coalesce("comp", "c"))


def bucket_keys(classes: DataFrame) -> DataFrame:
    """(key, c, n, bits) of classes (c, n, halves, bits): their table keys, but for those that no other class can share."""
    halves = classes.select("c", F.posexplode("halves").alias("t", "x")).withColumn("half", F.xxhash64("t", "x"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("half")
    mine = by_small(halves, shared, ["half"], F.col("c"), BUCKET_SALTS, "left_semi", True).groupBy("c").agg(F.array_sort(F.collect_list(F.struct("t", "x"))).alias("h"))
    pairs = F.flatten(F.transform("h", lambda p, i: F.transform(F.slice("h", i + 2, F.size("h")), lambda q: F.struct((p["t"] * HALVES + q["t"]).alias("t"), p["x"].alias("x"), q["x"].alias("y")))))
    keys = mine.where(F.size("h") > 1).select("c", F.explode(pairs).alias("k")).select("c", F.xxhash64("k.t", "k.x", "k.y").alias("key"))
    return keys.join(classes.select("c", "n", "bits").hint("merge"), "c").select("key", "c", "n", "bits")


def class_components(texts: DataFrame, classes: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """(c, comp) of every class that is linked with another. classes: c, n, halves, bits, and id_key and check of one of
    its documents; texts: id_key, check, text of all documents."""
    rows = written(bucket_keys(classes.where("n > 0")))
    buckets = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("c", "n", "bits")).alias("pivot")).where("size > 1")
    buckets = written(buckets.select("key", "size", F.col("pivot.c").alias("p"), F.col("pivot.n").alias("pn"), F.col("pivot.bits").alias("pb")))
    near = _near(F.col("n"), F.col("pn"), F.col("bits"), F.col("pb"), percent)
    members = by_small(rows, buckets, ["key"], F.col("c"), BUCKET_SALTS, "inner", True)
    members = written(members.select("key", "size", "p", "c", near.alias("near"), F.bit_count(F.col("bits").bitwiseXOR(F.col("pb"))).alias("off")))
    star = members.where("near and c <> p")
    needed = star.select(F.explode(F.array("c", "p")).alias("c")).union(members.where("size > 2").select("c")).distinct()
    wanted = written(classes.join(needed, "c").select("c", "id_key", "check"))
    # A row may repeat id and text: each is read, one set stays.
    sets = texts.join(wanted.hint("merge"), ["id_key", "check"]).select("c", "text").mapInArrow(_sets(shingle_words), "c long, shingles array<long>")
    sets = written(sets.dropDuplicates(["c"]))
    # First each class with the most alike of its pivots, then what that leaves open.
    first = star.groupBy("c").agg(F.min_by("p", F.struct("off", "p")).alias("p")).select(F.col("c").alias("a"), F.col("p").alias("b"))
    first = written(first)
    links = written(confirmed(first, sets, percent))
    merged = components(links)
    rest = star.select(F.col("c").alias("a"), F.col("p").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    rest = _labels(rest.withColumnRenamed("a", "c"), merged).withColumnRenamed("c", "a").withColumnRenamed("comp", "ca")
    rest = written(_labels(rest.withColumnRenamed("b", "c"), merged).withColumnRenamed("c", "b").where("ca <> comp").select("a", "b"))
    links = written(links.union(confirmed(rest, sets, percent)))
    merged = components(links)
    # Buckets of three and more whose members are not yet one component.
    many = written(_labels(members.where("size > 2").select("key", "c"), merged))
    open_keys = many.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    open_nodes = by_small(many, open_keys, ["key"], F.col("c"), BUCKET_SALTS, "left_semi", True).select("c", "comp").distinct()
    open_nodes = written(open_nodes.join(classes.select("c", "n", "bits"), "c"))
    found = confirmed(written(prefix_pairs(open_nodes, sets, percent)), sets, percent)
    return components(written(links.union(found)))


def prefix_pairs(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes (c, comp, n, bits) from different components that share a shingle of their prefixes.

    A set's prefix are its n - ceil(n * percent / 100) + 1 rarest shingles, in one order over all nodes. At the first
    shingle that two sets share, what is left of the shorter rest bounds their overlap, so a pair leaves the join only
    where that bound still reaches percent. For each shingle, the component with most nodes is not paired with itself.
    """
    tokens = nodes.join(sets, "c").select("c", "n", F.explode("shingles").alias("s"))
    rare = tokens.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    length = (F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1).cast("int")
    prefix = tokens.join(rare.where("df > 1"), "s", "left").groupBy("c", "n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "s"))).alias("all"))
    prefix = prefix.select("c", F.posexplode(F.slice("all", F.lit(1), length)).alias("at", "x")).where("x.df > 1").select("c", "at", F.col("x.s").alias("s"))
    rows = written(prefix.join(nodes, "c"))
    counts = rows.groupBy("s", "comp").agg(F.count(F.lit(1)).alias("k"))
    tops = written(counts.groupBy("s").agg(F.max_by("comp", F.struct("k", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")).where("comps > 1").select("s", "top"))
    shared = written(by_small(rows, tops, ["s"], F.col("c"), BUCKET_SALTS, "inner", True))
    few = shared.where("comp <> top").select("s", *[F.col(c).alias(f"{c}1") for c in ("c", "comp", "n", "bits", "at")])
    pairs = few.join(shared, "s").where((F.col("comp1") != F.col("comp")) & ((F.col("comp") == F.col("top")) | (F.col("c1") < F.col("c"))))
    bound = F.least(F.col("n1") - F.col("at1"), F.col("n") - F.col("at"))
    pairs = pairs.where(bound * (100 + percent) >= (F.col("n1") + F.col("n")) * percent)
    pairs = pairs.where(_near(F.col("n1"), F.col("n"), F.col("bits1"), F.col("bits"), percent))
    return pairs.select(F.greatest("c1", "c").alias("a"), F.least("c1", "c").alias("b")).distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """Per row of docs: id, check (hash of the text), n (shingles), component, stays.

    component is the smallest id that can be reached over links of percent or more, the row itself included. Texts
    without words have no shingles and no links. Ids are of any type that can be ordered; a null one counts as larger
    than any, so it is the component of null ids alone. Each text has its own set, whatever id it has: texts that share
    an id are linked like others. Repeated rows come out repeated. stays: whether the row is the one of its component
    that has the smallest id, and of equal ids the text of the smallest hash; a text without words stays. Texts are read
    whole; other columns are not looked at. No rows give no rows.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("check"), F.col(text_col).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    sig = texts.select("id", "text", "check").mapInArrow(_with_check(shingle_words), f"id {kind}, n long, set_hash binary, halves array<long>, bits long, check long")
    rows = written(dealt(sig))
    least = F.struct(F.col("id").isNull().alias("none"), "id", "check")
    aggs = {"one": (F.min(F.struct(least.alias("least"), "n", "bits", "halves")), F.min)}
    # Classes are numbered in the order of their least ids: a bucket's pivot is then its earliest text, of which the others
    # are more likely to be edits than of one another, and numbers do not depend on how docs are partitioned.
    classes = grouped(rows.where("n > 0"), "set_hash", aggs).select("set_hash", "salts", "one.*").orderBy("least")
    classes = written(classes.withColumn("c", F.monotonically_increasing_id()))
    of = classes.select("c", "n", "bits", "halves", id_key(F.col("least.id")).alias("id_key"), "least.check")
    comps = class_components(texts.select(id_key(F.col("id")).alias("id_key"), "check", "text"), of, shingle_words, percent)
    labelled = written(classes.select("set_hash", "salts", "c", "least").join(comps, "c", "left").withColumn("comp", F.coalesce("comp", "c")))
    named = labelled.groupBy("comp").agg(F.min("least").alias("first"))
    labelled = by_small(labelled, named, ["comp"], F.col("c"), BUCKET_SALTS, grows=True).select("set_hash", "salts", F.col("first.id").alias("component"), F.col("first.check").alias("stay"))
    alone = rows.where("n = 0").select("id", "check", "n", F.col("id").alias("component"), F.lit(True).alias("stays"))
    stays = F.col("id").eqNullSafe(F.col("component")) & (F.col("check") == F.col("stay"))
    return attached(rows.where("n > 0"), labelled, "set_hash").select("id", "check", "n", "component", stays.alias("stays")).unionByName(alone)


def _with_check(k: int):
    inner = _signatures(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                for x in inner(iter([part.select(["id", "text"])])):
                    yield pa.RecordBatch.from_arrays([*x.columns, part.column(2)], [*x.schema.names, "check"])

    return run


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """docs without those that another row of their component stands for (see stays in near_groups), and one row where
    rows repeat id and text; columns as they came."""
    gone = near_groups(docs, id_col, text_col, shingle_words, percent).where("not stays").select(id_key(F.col("id")).alias("id_key"), "check").distinct()
    return one_each(docs, gone, id_col, text_col)


def query(spark, docs: DataFrame) -> DataFrame:
    out = near_groups(docs, shingle_words=2)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))
