"""The ten operators against brute force on a small table, with nulls, empties, ties, repeats and extra columns."""

import base64
import gzip
import hashlib
import os
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wagebook.llm import bpe, exact, minhash, mixing, multiset, quality, sharding, toxicity, urls, warc
from wagebook.llm.common import first_by_hash, scratch

TABLES = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


WORDS = [a + b for a in ("ka", "lo", "mi", "ter", "un", "os", "re") for b in ("ta", "ren", "sil", "v", "dom", "pa.")]


def make(n=240, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = i % 8
        if kind == 0 and i >= 40:
            text = rows[rng.randrange(0, 20)][1]
        elif kind == 1 and i >= 40:
            words = (rows[rng.randrange(2, 20)][1] or "x").split(" ")
            for _ in range(max(1, len(words) // 12)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            text = " ".join(words)
        elif kind == 2 and i >= 40:
            text = "\t " + (rows[rng.randrange(0, 20)][1] or "").replace(" ", "  \n", 1).upper()
        else:
            text = prose(rng, rng.choice([1, 2, 5, 30, 90, 200]))
        rows.append((i * 3, text, rng.choice(["en", "de", None]), rng.choice(["src0"] * 3 + ["src11", "src16", None]), 5))
    rows += [(9001, None, None, None, None), (9002, "", "en", "src0", 0), (9003, " \n\t ", "en", "src0", 3), (9004, "Solo", "en", "src0", 4), (9005, "sOLO", "en", "src0", 4)]
    rows.append((9006, "é ß 🎉 \x0b" + "lang " * 40000, "fr", "src3", 1))
    rows.append((9007, "x" * 100000, "fr", "src3", 1))
    return rows


@pytest.fixture(scope="module")
def rows():
    return make()


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    extra = {c: F.lit("clash") for c in ("id", "c", "a", "b", "n", "key", "salt", "digest", "part", "keep_id", "check", "comp", "size", "host", "path", "tokens", "leaf", "kept")}
    return df.withColumns(extra)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def normal(text):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact(spark, docs, rows, empty):
    got = {r["doc_id"]: r for r in exact.query(spark, docs).collect()}
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[normal(t)].append(i)
    assert len(got) == len(rows)
    for t, ids in groups.items():
        for i in ids:
            assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"], got[i]["text_sha256"]) == (min(ids), len(ids), i == min(ids), hashlib.sha256(t.encode()).hexdigest())
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(min(x) for x in groups.values())
    assert exact.query(spark, empty).count() == 0


def test_exact_index_grows(spark):
    index = exact.new_index(spark)
    a = spark.createDataFrame([(5, "x  y"), (7, "z"), (None, "n")], "id long, text string")
    b = spark.createDataFrame([(1, "x y"), (2, "new"), (2, "new")], "id long, text string")
    exact.exact_groups(a, index, "id").collect()
    got = {(r["id"], r["keep_id"], r["group_size"]) for r in exact.exact_groups(b, index, "id").collect()}
    assert got == {(1, 5, 1), (2, 2, 2)}
    assert index.rows().count() == 4
    exact.exact_groups(b, index, "id").collect()
    assert index.rows().count() == 4


def test_exact_other_ids_nulls_and_repeats(spark):
    rows = [("b", "x  y"), ("a", "x y"), (None, "x y"), (None, "only"), (None, "only"), ("c", "twice"), ("c", "twice"), ("d", "p  q"), ("d", "p q"), ("d", "other")]
    df = spark.createDataFrame(rows, "key string, body string").withColumns({"row": F.lit(1), "id_key": F.lit(2), "stays": F.lit(3)}).repartition(3)
    kept = exact.drop_copies(df, id_col="key", text_col="body")
    assert kept.columns == df.columns
    got = Counter((r["key"], normal(r["body"])) for r in kept.collect())
    assert got == Counter([("a", "x y"), (None, "only"), ("c", "twice"), ("d", "p q"), ("d", "other")])
    tables = [r["tableName"] for r in spark.sql("SHOW TABLES").collect() if r["tableName"].startswith("digest_index")]
    exact.query(spark, df.selectExpr("key as doc_id", "body as text")).collect()
    assert [r["tableName"] for r in spark.sql("SHOW TABLES").collect() if r["tableName"].startswith("digest_index")] == tables
    index = exact.new_index(spark)
    exact.exact_groups(df, index, "key", "body").collect()
    assert sorted(map(tuple, index.compact().rows().collect()), key=str) == sorted(map(tuple, index.rows().collect()), key=str)
    assert exact.drop_copies(df.limit(3), index, "key", "body").count() <= 3


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    k = min(k, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute_components(rows, k, percent=80):
    sets = {i: shingles(t, k) for i, t, *_ in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= max(len(x), len(y)) * percent:
                both = len(x & y)
                if both * 100 >= (len(x) + len(y) - both) * percent:
                    r, s = sorted((root(a), root(b)))
                    up[s] = r
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_minhash(spark, docs, rows, empty):
    want = brute_components(rows, 2)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.query(spark, docs).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}
    assert len(set(c for _, c in want.values())) < len(rows) - 20
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(i for i, (_, c) in brute_components(rows, 5).items() if i == c)
    assert minhash.query(spark, empty).count() == 0


def test_minhash_large_group_and_chain(spark):
    rng = random.Random(11)
    words = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = [(0, " ".join(words))]
    for i in range(1, 150):  # a drifting chain: far ends are under the threshold
        if i % 3 == 0:
            words = list(words)
            words[rng.randrange(120)] = f"v{i}"
        edited = list(words)
        edited[rng.randrange(120)] = f"u{i}"
        edited[rng.randrange(120)] = f"t{i}"
        rows.append((i, " ".join(edited)))
    want = brute_components(rows, 2)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.query(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_minhash_ids_with_two_texts_nulls_and_repeats(spark):
    rng = random.Random(4)
    w, v, one = (" ".join(f"{c}{rng.randrange(900)}" for _ in range(100)) for c in "wvo")
    near = lambda t: t + " end"
    rows = [(1, w), (1, v), (2, near(w)), (3, near(v)), (None, near(near(w))), (None, one), (None, near(one)), (7, "solo text here"), (7, "solo text here"), (None, None), (None, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"check": F.lit(1), "comp": F.lit(2), "row": F.lit(3)}).repartition(3)
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.query(spark, df).collect())
    assert got == Counter([(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (None, 1, False), (None, None, True), (None, None, True), (7, 7, True), (7, 7, True), (None, None, True), (None, None, True)])
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    left = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert left[7, "solo text here"] == 1 and left[1, w] == left[1, v] == 1 and left[2, near(w)] == left[3, near(v)] == left[None, near(near(w))] == 0
    assert left[None, one] + left[None, near(one)] == 1 and left[None, None] == left[None, " "] == 1 and sum(left.values()) == 6
    names = spark.createDataFrame([("b", w), ("a", near(w))], "doc_id string, text string")
    assert {(r["doc_id"], r["component_id"]) for r in minhash.query(spark, names).collect()} == {("a", "a"), ("b", "a")}


@pytest.mark.skipif(not os.path.exists(TABLES), reason="the tables are not here")
def test_minhash_recall_over_all_pairs_of_a_table(spark):
    docs = spark.read.parquet(f"file://{TABLES}/documents.parquet")
    want = brute_components([tuple(r) for r in docs.select("doc_id", "text").collect()], 2)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.query(spark, docs).collect()}
    linked = sum(i != c for i, (_, c) in want.items())
    missed = sum(got[i] != x for i, x in want.items())
    assert linked > 50 and missed == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i + 1, i) for i in range(60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)] + [(500, k) for k in range(501, 540)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        r, s = sorted((root(a), root(b)))
        up[s] = r
    got = {r["c"]: r["comp"] for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up}


def test_bpe(spark, docs, rows, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_path())
    got = {r["doc_id"]: r for r in bpe.query(spark, docs).collect()}
    for i, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.query(spark, empty).count() == 0


def test_bpe_odd_texts():
    from tokenizers import Tokenizer

    t, own, rng = Tokenizer.from_file(bpe.default_path()), bpe.WordBPE(bpe.default_path()), random.Random(4)
    texts = ["", " ", "<|endoftext|>Hi<|startoftext|> x", "<|endoftext|", "ΑΣ ΣΑΣ İ \x1c\x1d a\x1fb \x85 c\xa0d it's THEY'LL 123 １２ ½ é e\u0301", "\x00\x01 x", "ﬁ ǅ ß ẞ", "a" * 3000]
    texts += ["".join(rng.choice("abcdeginorstlhxyz'!. ") for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    for text in texts:
        ids = own.encode(text)
        want = t.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text
        assert own.decode(ids).decode() == t.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["ab", "中文字", "aaaaaaab", "xqzj"])
def test_bpe_time_grows_with_the_word(text):
    from tokenizers import Tokenizer

    own, t = bpe.WordBPE(bpe.default_path()), Tokenizer.from_file(bpe.default_path())
    took = {}
    for n in (20_000, 320_000):
        piece = (text * n)[:n]
        began = time.time()
        got = own.ids[own.encode_piece(piece)].tolist()
        took[n] = time.time() - began
        if n == 20_000:
            assert got == t.encode(piece, add_special_tokens=False).ids
    assert took[320_000] < 12 and took[320_000] < 48 * took[20_000] + 1


def test_bpe_tokens_are_their_own_encoding():
    own = bpe.WordBPE(bpe.default_path())
    whole = [i for i, t in enumerate(own.tokens) if t.endswith(bpe.END)]
    letters = {c: b for b, c in enumerate(own.letters)}
    for i in whole[:: 37]:
        raw = bytes(letters[c] for c in own.tokens[i][:-1])
        try:
            piece = raw.decode()
        except UnicodeDecodeError:
            continue
        assert own.encode_piece(piece) == [i]


def test_multiset(spark, docs, rows, empty):
    got = {r["doc_id"]: r for r in multiset.query(spark, docs).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for k, (i, t, *_) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        a, e, b = map(multiset.fingerprint, (t, edited, nxt))
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), multiset.written(a), multiset.written(e))
        assert (r["near_edited"], r["near_next"]) == (multiset.likeness(a, e), multiset.likeness(a, b))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert multiset.query(spark, empty).count() == 0
    one = spark.createDataFrame([(4, "ab")], "doc_id long, text string")
    assert multiset.query(spark, one).first()["near_next"] == 1.0


def plain_sketch(text):
    """Counts of runs of six characters within lines, by lane and sign, one at a time."""
    lanes = [0] * multiset.SKETCH_LANES
    powers = [pow(0x9E3779B97F4A7C15, k + 1, 2**64) for k in range(6)]
    for line in text.split("\n"):
        for i in range(len(line) - 5):
            h = sum(ord(c) * p for c, p in zip(line[i : i + 6], powers)) % 2**64
            h ^= h >> 31
            h = h * 0xBF58476D1CE4E5B9 % 2**64
            h ^= h >> 29
            lanes[(h >> 40) % multiset.SKETCH_LANES] += -1 if (h >> 20) & 1 else 1
        if 0 < len(line) < 6:
            h = int.from_bytes(hashlib.shake_128(line.encode()).digest(4), "little")
            lanes[(h >> 1) % multiset.SKETCH_LANES] += 1 if h & 1 else -1
    return lanes


def plain_fingerprint(text):
    hashes = [0] * multiset.HASH_LANES
    for line in text.split("\n"):
        raw = hashlib.shake_128(line.encode()).digest(2 * multiset.HASH_LANES)
        hashes = [(h + int.from_bytes(raw[2 * k : 2 * k + 2], "little")) % 2**16 for k, h in enumerate(hashes)]
    return b"".join(h.to_bytes(2, "little") for h in hashes) + b"".join((x % 2**32).to_bytes(4, "little") for x in plain_sketch(text))


def plain_likeness(a, b):
    if sorted(a.split("\n")) == sorted(b.split("\n")):
        return 1.0
    x, y = plain_sketch(a), plain_sketch(b)
    d = (sum(v * v for v in x) * sum(v * v for v in y)) ** 0.5
    return min(1.0, max(0.0, sum(p * q for p, q in zip(x, y)) / d)) if d else 0.0


def test_multiset_against_plain_counts(spark):
    rng = random.Random(21)
    texts = [prose(rng, 30) + "\n" + prose(rng, 3) + "\nab\n" for _ in range(30)] + ["lang " * 40000, "lang " * 30000, "x" * 60000, "", "é🎉\nab"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(2**61, "far away"), (None, "no id"), (None, None), (5, "second text of five")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"h": F.lit("x"), "p": F.lit("x"), "part": F.lit("x")}).repartition(4)
    hashes = {(r["doc_id"], r["text"]): r["h2"] for r in df.select("doc_id", "text", F.xxhash64("text").alias("h2")).collect()}
    order = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r]))
    got = defaultdict(list)
    for r in multiset.compared(df, parts=7).collect():
        got[r["doc_id"], r["n_chars"]].append(r)
    assert sum(map(len, got.values())) == len(docs)
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        r = next(x for x in got[i, len(t)] if base64.b64decode(x["fingerprint"]) == plain_fingerprint(t))
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and base64.b64decode(r["edited_fingerprint"]) == plain_fingerprint(edited)
        assert abs(r["near_edited"] - plain_likeness(t, edited)) < 1e-9 and abs(r["near_next"] - plain_likeness(t, nxt)) < 1e-9


def test_multiset_parts_are_even(spark):
    df = spark.range(4000).selectExpr("case when id < 1500 then null when id = 1501 then 4611686018427387904 else id end as doc_id", "concat('t', id) as text")
    sizes = [r["count"] for r in multiset.dealt_by_id(df, 16).where("guest = 0").groupBy("part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 4000 / 16


def test_multiset_ids_at_the_ends_of_long(spark):
    ids = [-(2**63), -(2**63) + 1, -1, 0, 1, 2**63 - 2, 2**63 - 1]
    df = spark.createDataFrame([(i, f"text {k} {'ab' * k}") for k, i in enumerate(ids)] + [(None, "no id")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in multiset.query(spark, df).collect()}
    texts = [f"text {k} {'ab' * k}" for k in range(len(ids))]
    order = list(zip(ids, texts))[::-1] + [(None, "no id")]
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        assert got[i]["edited_sha256"] == hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()


def test_multiset_parts_where_all_rows_repeat(spark):
    df = spark.range(40_000).selectExpr("id % 200 as doc_id", "concat('t', id % 200) as text")
    cuts = multiset.cut_rows(df, 8)
    assert len(cuts) == 8 and max(b[1] - a[1] for a, b in zip(cuts, cuts[1:])) < 80


@pytest.mark.parametrize("copies", [1, 300])
def test_first_by_hash_is_exact(spark, copies):
    h = F.xxhash64(F.lit("x"), "id")
    ids = spark.range(2000 * copies).select((F.col("id") % 2000).alias("id"))
    want = [r["id"] for r in ids.distinct().orderBy(h, "id").limit(50).collect()]
    assert [r["id"] for r in first_by_hash(ids, h, 50).collect()] == want
    assert first_by_hash(ids, h, 5000).count() == 2000
    assert first_by_hash(ids.where("false"), h, 50).count() == 0


def test_samples_are_not_ordered_whole(spark):
    """Rows over the hash's bound go before the sort."""
    plan = first_by_hash(spark.range(100_000), F.xxhash64("id"), 50)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter (xxhash64" in plan and plan.index("Sort") < plan.index("Filter (xxhash64")


def test_multiset_is_homomorphic():
    a, b = "one line\nshort\n\nand a third one", "more of it\nx"
    fa, fb = multiset.fingerprint(a), multiset.fingerprint(b)
    assert np.array_equal(multiset.fingerprint(a + "\n" + b), multiset.add(fa, fb))
    assert np.array_equal(multiset.fingerprint(b + "\n" + a), multiset.add(fa, fb))
    assert np.array_equal(multiset.remove(multiset.add(fa, fb), fb), fa)
    assert not np.array_equal(fa, multiset.fingerprint(a + "\n"))
    long = "\n".join(f"paragraph {i} of many words" for i in range(20000))
    half = "\n".join(long.split("\n")[:10000]) + "\n" + "\n".join(f"other {i} said things" for i in range(10000))
    assert 0.3 < multiset.likeness(multiset.fingerprint(long), multiset.fingerprint(half)) < 0.9


def test_multiset_likeness_of_repeated_lines():
    line, other = "the same line over and over\n", "another one\n"
    a, b = (multiset.fingerprint(line * n + other * 10) for n in (130000, 120000))
    assert multiset.likeness(a, b) > 0.999
    assert multiset.likeness(a, multiset.fingerprint(other * 130000)) < 0.5
    words = "ab cd " * 90000
    assert multiset.likeness(multiset.fingerprint(words), multiset.fingerprint(words[:270000])) > 0.999
    assert np.array_equal(multiset.remove(multiset.add(a, b), b), a)
    raw = base64.b64decode(multiset.written(a))
    assert len(raw) == 2 * multiset.HASH_LANES + 4 * multiset.SKETCH_LANES
    assert np.abs(np.frombuffer(raw[2 * multiset.HASH_LANES :], dtype="<i4")).max() >= 130000


def test_sharding(spark, docs, rows, empty):
    got = sharding.query(spark, docs).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    text = {i: (t or "").encode() for i, t, *_ in rows}
    shards = defaultdict(list)
    for r in got:
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text[r["doc_id"]]) + 1, zlib.crc32(text[r["doc_id"]]), "rows", None)
        shards[r["shard"]].append(r["slot"])
    assert set(shards) == set(range(8))
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.query(spark, docs.repartition(3)).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in got}
    assert sharding.query(spark, empty).count() == 0
    few = sharding.shuffled(docs.select("doc_id"), ["doc_id"], 3, blocks=13)
    assert sorted(Counter(r["shard"] for r in few.collect()).values()) == sorted(len(rows) // 3 + (k < len(rows) % 3) for k in range(3))


def test_sharding_is_what_the_matrix_says(spark):
    """Shard and slot worked out in plain Python from the hashes and the matrix."""
    df = spark.createDataFrame([(i % 50 if i % 9 else None, i) for i in range(300)], "k long, n int")
    h = df.select("k", "n", *[F.xxhash64(F.lit(f"5/{j}"), "k", "n").alias(f"h{j}") for j in range(3)]).collect()
    blocks = defaultdict(list)
    for r in h:
        blocks[r["h0"] % 8].append(r)
    sent = sharding.communication_matrix([len(blocks[b]) for b in range(8)], [100, 100, 100], 5)
    assert [sum(c) for c in zip(*sent)] == [100, 100, 100]
    least = lambda k: (k is not None, k or 0)
    shards = defaultdict(list)
    for b in range(8):
        at = sorted(blocks[b], key=lambda r: (r["h1"], least(r["k"]), r["n"]))
        for s, n in enumerate(sent[b]):
            shards[s] += at[:n]
            at = at[n:]
    want = {}
    for s, rows in shards.items():
        part = lambda r: ((r["h2"] % 2**64) >> 20) % 4096
        for slot, r in enumerate(sorted(rows, key=lambda r: (part(r), r["h2"], least(r["k"]), r["n"]))):
            want[r["n"]] = (s, slot)
    got = sharding.shuffled(df, ["k", "n"], 3, seed=5, blocks=8)
    assert {r["n"]: (r["shard"], r["slot"]) for r in got.collect()} == want


def test_hypergeometric_law():
    rng = np.random.default_rng(1)
    draws = np.array([sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)])
    assert abs(draws.mean() - 6) < 0.12 and abs(draws.var() - 20 * 0.3 * 0.7 * 80 / 99) < 0.3
    big = np.array([sharding.hypergeometric(rng, 10**11, 7 * 10**11, 10**6) for _ in range(300)])
    assert abs(big.mean() - 125000) < 120
    m = sharding.communication_matrix([5, 0, 9, 1], [4, 4, 4, 3], 1)
    assert [sum(r) for r in m] == [5, 0, 9, 1] and [sum(c) for c in zip(*m)] == [4, 4, 4, 3]


def test_warc(spark, empty):
    html = [None, "", "<p>à</p>", "<p>à</p>", "x" * 50000, "<p>à</p>", "one"]
    pages = [(i + 10, None if i == 4 else f"http://h/{i}\n", h) for i, h in enumerate(html)] + [(12, "http://h/2", "<p>à</p>"), (None, "u", "one")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"salt": F.lit(1), "sha": F.lit(2), "first": F.lit(3)})
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.query(spark, df).where("verified").collect()), key=str)
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in pages:
        raw, f = (h or "").encode(), first[h or ""]
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if i == f else "revisit", None if i == f else f))
    assert got == sorted(want, key=str)
    assert warc.query(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_reader_finds_damage(spark):
    a, b = warc.record(1, "http://a", b"hello", None, False), warc.record(2, None, b"hello", 1, True)
    whole = a + b + warc.CLOSING
    for size in (1, 7, 10**6):
        got = list(warc.read_archive(whole[i : i + size] for i in range(0, len(whole), size)))
        assert [(h["warc-type"], n, ok) for h, n, _, ok in got] == [("response", 5, True), ("revisit", 5, True)]
    bad = warc._gzip(zlib.decompress(a, 31).replace(b"hello", b"jello"))
    assert [ok for *_, ok in warc.read_archive([bad])] == [False]
    with pytest.raises(ValueError):
        list(warc.read_archive([whole[:-5]]))
    with pytest.raises(ValueError):
        list(warc.read_archive([warc._gzip(zlib.decompress(a, 31).replace(b"hello", b"hell"))]))
    path = scratch(spark)
    warc.write_warc(spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string"), path)
    assert warc.read_warc(spark, path).count() == 1


def test_warc_archives_roll_and_hold_a_record_a_member(spark):
    path = scratch(spark)
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", "".join(rng.choice("abcdef \n") for _ in range(3000))) for i in range(40)] + [(99, "http://long", "y" * 3_000_000)]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), path, date="2024-05-06T07:08:09Z", archive_bytes=8000)
    files = [r["content"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    assert len(files) > 6 and max(map(len, files)) < 20000
    kinds = Counter()
    for raw in map(bytes, files):
        whole = gzip.decompress(raw)
        members = []
        while raw:
            z = zlib.decompressobj(31)
            members.append(z.decompress(raw))
            raw = z.unused_data
        assert b"".join(members) == whole
        for m in members:
            head, _, block = m.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            assert head.startswith(b"WARC/1.1") and len(block) == int(fields["Content-Length"]) + 4
            kinds[fields["WARC-Type"]] += 1
    assert kinds == {"response": 41, "metadata": len(files)}
    assert warc.read_warc(spark, path).where("verified").count() == 41


def test_urls_sites(spark):
    hosts = ["a.co.uk", "b.a.co.uk", "x.com:80", "me@y.x.com", "10.0.0.1:8080", "[::1]:80", "com", ""]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = {r["h"]: (r["d"], r["s"]) for r in df.select("h", *[c.alias(n) for c, n in zip(urls.site_of(F.col("h"), urls.SUFFIXES), "ds")]).collect()}
    assert got == {"a.co.uk": ("a.co.uk", "co.uk"), "b.a.co.uk": ("a.co.uk", "co.uk"), "x.com:80": ("x.com", "com"), "me@y.x.com": ("x.com", "com"), "10.0.0.1:8080": ("10.0.0.1", "10.0.0.1"), "[::1]:80": ("[::1]", "[::1]"), "com": ("com", "com"), "": ("", "")}


def test_urls(spark):
    pages = [(i, f"http://Bad.site.com/{i}?q") for i in range(40)] + [(i, f"https://good.site.com:80/a{i}#x") for i in range(40, 90)]
    pages += [(100, None), (101, "no scheme"), (102, "http://x.example.net/en/1"), (103, "http://example.net/en"), (104, "ftp://a.example.com/de/"), (105, "http://notexample.com/de/x"), (106, "http://w.org/fr/a"), (107, "http://a.net"), (108, "a://b://c/d"), (0, "http://Bad.site.com/0?q")]
    labels = [(i, 0, 0) for i in range(40)] + [(i, 1, 0) for i in range(40, 90)] + [(101, None, None), (555, 0, 0)]
    p = spark.createDataFrame(pages, "page_id long, url string").withColumns({"host": F.lit("x"), "n": F.lit(1)})
    got = {(r["page_id"]): (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.query(spark, p, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert got[3] == ("bad.site.com", "/3", None, "block")
    assert got[50] == ("good.site.com:80", "/a50", None, "allow")
    assert got[100] == got[101] == ("", "", None, "allow")
    assert got[102] == ("x.example.net", "/en/1", "example.net/en/", "allow")
    assert got[103] == ("example.net", "/en", "net/", "block")
    assert got[104][2:] == ("example.com/de/", "block") and got[105][2] is None
    assert got[106][2:] == ("org/fr/", "allow") and got[107][:3] == ("a.net", "", None)
    assert got[108][:2] == ("b:", "//c/d")
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.query(spark, none, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_mixing(spark, docs, rows, empty):
    got = mixing.query(spark, docs).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    total = sum(r["tokens"] for r in got)
    used = sum(r["tokens"] * r["epochs"] for r in got)
    assert used <= 0.8 * total
    by = defaultdict(list)
    for r in got:
        by[r["domain"], r["lang"], r["source"]].append(r)
    for leaf in by.values():
        spent = sum(r["tokens"] * r["epochs"] for r in leaf)
        assert spent <= leaf[0]["budget"] and max(r["epochs"] for r in leaf) - min(r["epochs"] for r in leaf) <= 1
        out = [r["tokens"] for r in leaf if r["epochs"] == min(x["epochs"] for x in leaf)]
        assert max(r["epochs"] for r in leaf) == 3 or spent + max(out) > leaf[0]["budget"]
    assert mixing.query(spark, empty).count() == 0
    kept = mixing.keep_mix(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)


def test_budgets_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "1", 10), ("a", "x", "2", 100), ("a", "y", "1", 100), ("b", "x", "1", 1000), ("c", "z", "1", 5)], "domain string, lang string, source string, tokens long")
    got = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in mixing.budgets(leaves, ["domain", "lang", "source"], {("a",): 2.0, ("c",): 0.0}, 150 / 1215, 1).collect()}
    # 149 or 150 tokens: a takes two thirds; its x gets half: leaf 1 has 10 only, so leaf 2 takes the rest.
    assert got["a", "x", "1"] == 10 and got["c", "z", "1"] == 0
    assert got["a", "x", "2"] in (39, 40) and got["a", "y", "1"] in (49, 50) and got["b", "x", "1"] in (49, 50)


def test_quality(spark, rows, empty):
    rng = random.Random(8)
    good = [(i, prose(rng, 60), "en", f"src{i % 3}", 1) for i in range(300)]
    junk = [(1000 + i, " ".join(rng.choice(WORDS).upper() + "!!" for _ in range(60)), "en", "src9", 1) for i in range(100)]
    docs = spark.createDataFrame([*good, *junk, (5000, None, None, None, None), (5001, "", "en", "src0", 0)], SCHEMA).withColumns({"n": F.lit(1), "_x": F.lit(2)})
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 300, 2)] + [(1000 + i, 0, 0) for i in range(0, 100, 2)] + [(0, None, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.query(spark, docs, labels).collect()}
    assert len(got) == 402
    assert sum(got[i]["kept"] for i in range(300)) >= 298 and sum(got[1000 + i]["kept"] for i in range(100)) <= 2
    assert all(0 <= r["score"] <= 1 for r in got.values())
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert quality.keep_good(docs, labels.where("quality > 5")).count() == 402
    assert quality.query(spark, empty, labels).count() == 0


def test_quality_scores_do_not_depend_on_partitions(spark):
    rng = random.Random(18)
    rows = [(i, prose(rng, 40) if i % 3 else " ".join(w.upper() + "!!" for w in prose(rng, 40).split()), "en", f"src{i % 4}", 1) for i in range(300)]
    rows += [(0, "a second text of zero", "en", "src1", 1), (7, rows[7][1], "en", "src3", 1), (9006, "lang " * 40000, "fr", "src3", 1), (None, "no id at all", None, None, None)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, SCHEMA)
    got = [sorted((str(r["doc_id"]), r["score"], r["kept"]) for r in quality.query(spark, docs.repartition(n), labels.repartition(n)).collect()) for n in (1, 5)]
    assert got[0] == got[1] and len(got[0]) == len(rows)
    clash = docs.withColumns({c: F.lit(f"own {c}") for c in ("salt", "_n", "score", "row", "p", "host", "path", "n", "k", "a.b")})
    kept = quality.keep_good(clash, labels)
    assert kept.columns == clash.columns and {tuple(r[5:]) for r in kept.collect()} == {tuple(f"own {c}" for c in clash.columns[5:])}


def test_quality_of_labels_not_fitted_on(spark):
    docs, labels = (spark.read.parquet(f"file://{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    known = labels.where("quality is not null")
    model = quality.fit(docs, known.where("doc_id % 2 = 0"))
    held = {r["doc_id"]: r["quality"] for r in known.where("doc_id % 2 = 1").collect()}
    got = [(r["row"]["doc_id"], r["score"]) for r in quality.scored(docs, model, ["doc_id"]).collect()]
    good, bad = ([s for i, s in got if held.get(i) == y] for y in (1, 0))
    assert len(bad) > 10 and sum(s >= 0.5 for s in good) >= 0.98 * len(good) and sum(s >= 0.5 for s in bad) <= 0.1 * len(bad)


def test_quality_against_plain_bayes(spark):
    """host, path and combined scores from the classifier's, worked out with numpy."""

    class Fixed:
        def predict(self, x):
            return np.round(x[:, 1] * 0.9 + 0.05, 6)

    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("a1 " if i % 3 else "aa1") for _ in range(40)), rng.choice(["p", None]), f"s{min(i % 7, i % 11)}", 1) for i in range(400)]
    got = {r["row"]["doc_id"]: r for r in quality.scored(spark.createDataFrame(rows, SCHEMA), Fixed()).collect()}
    p = Fixed().predict(quality.shapes([t for _, t, *_ in rows]))

    def weight(groups):
        n, mean = np.array([len(g) for g in groups], float), np.array([p[g].mean() for g in groups])
        total, m = n.sum(), (n * mean).sum() / n.sum()
        between = ((n * (mean - m) ** 2).sum() / total - m * (1 - m) * (len(n) - 1) / total) / (1 - (n * n).sum() / total**2)
        return min(1000.0, max(2.0, m * (1 - m) / between - 1)) if between > 1e-12 else 1000.0

    by_host, by_path = defaultdict(list), defaultdict(list)
    for k, (_, _, path, host, _) in enumerate(rows):
        by_host[host].append(k)
        by_path[host, path].append(k)
    wh, wp, base = weight(list(by_host.values())), weight(list(by_path.values())), p.mean()
    logit = lambda x: np.log(x / (1 - x))
    for k, (i, _, path, host, _) in enumerate(rows):
        h, q = by_host[host], by_path[host, path]
        hs = (p[h].sum() - p[k] + wh * base) / (len(h) - 1 + wh)
        ps = (p[q].sum() - p[k] + wp * hs) / (len(q) - 1 + wp)
        want = 1 / (1 + np.exp(-(logit(p[k]) + logit(ps) - logit(base))))
        assert abs(got[i]["host_score"] - hs) < 1e-4 and abs(got[i]["path_score"] - ps) < 1e-4 and abs(got[i]["score"] - want) < 1e-3


def test_quality_sites_shrink(spark):
    class Fixed:
        mean = 0

        def predict(self, x):
            return np.where(x[:, 0] > 0.5, 0.05, 0.6)

    rows = [(i, "BAD", "p", "bad", 1) for i in range(50)] + [(100 + i, "fine", "p", "good", 1) for i in range(50)] + [(200, "fine", "p", "bad", 1), (201, "fine", "q", "new", 1)]
    got = {r["row"]["doc_id"]: r for r in quality.scored(spark.createDataFrame(rows, SCHEMA), Fixed()).collect()}
    assert got[200]["score"] < got[201]["score"] <= got[100]["score"]
    assert abs(got[201]["path_score"] - got[201]["host_score"]) < 1e-9


def test_toxicity(spark, empty):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(900):
        bad = i % 6 == 0
        words = prose(rng, 50).split(" ")
        if bad:
            words[3] = rng.choice(["vileword", "vilething", "awful!"])
        rows.append((i, " ".join(words), "en", "s", 1))
        if i % 7 < 4:
            labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame([*rows, (2000, None, None, None, None), (2001, "", "en", "s", 0)], SCHEMA).withColumns({"positive": F.lit(1), "f": F.lit(1)})
    got = {r["doc_id"]: r for r in toxicity.query(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (i in set(held)) for i in range(900))
    assert sum(got[i]["predicted"] == int(i % 6 == 0) for i in held) >= 0.98 * len(held)
    assert got[2000]["predicted"] == got[2001]["predicted"] == 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.query(spark, docs, none).collect()} == {0.0}
    assert toxicity.query(spark, empty, none).count() == 0


def plain_pu_steps(rows, positive, size, prior, rounds, rate, decay):
    """The estimator, one document and one weight at a time; the gradient by differences of the risk that the step is for."""
    p, u = [r for r, y in zip(rows, positive) if y], [r for r, y in zip(rows, positive) if not y]
    soft = lambda g: max(g, 0) + np.log1p(np.exp(-abs(g)))

    def parts(v):
        g = lambda r: sum(v[i] for i in r) + v[-1]
        minus = sum(soft(g(r)) for r in u) / len(u) - prior * sum(soft(g(r)) for r in p) / len(p)
        plus = prior * sum(soft(-g(r)) for r in p) / len(p)
        return minus, plus

    v, m, q = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        minus, _ = parts(v)
        loss = (lambda x: -parts(x)[0]) if minus < 0 else (lambda x: sum(parts(x)))
        grad = np.array([(loss(v + 1e-4 * e) - loss(v - 1e-4 * e)) / 2e-4 for e in np.eye(size + 1)])
        grad[:-1] += decay / len(p) * v[:-1]
        m, q = 0.9 * m + 0.1 * grad, 0.999 * q + 0.001 * grad * grad
        v = v - rate * (m / (1 - 0.9**t)) / (np.sqrt(q / (1 - 0.999**t)) + 1e-8)
    return v


def test_toxicity_steps_against_differences():
    rng = random.Random(14)
    rows = [[i for i in range(6) if rng.random() < (0.7 if k < 8 and i < 2 else 0.3)] for k in range(40)]
    positive = np.arange(40) < 8
    for prior in (0.05, 0.5):
        model = toxicity.NonNegativePU(prior, rounds=25).fit([np.array(r, dtype=np.int64) for r in rows], positive, 6)
        want = plain_pu_steps(rows, positive, 6, prior, 25, 0.05, 0.3)
        assert np.allclose([*model.w, model.bias], want, atol=5e-3)


def test_toxicity_weights_are_the_mean_of_the_last_steps():
    rng = random.Random(16)
    rows = [[i for i in range(6) if rng.random() < (0.7 if k < 8 and i < 2 else 0.3)] for k in range(40)]
    positive = np.arange(40) < 8
    numbers = [np.array(r, dtype=np.int64) for r in rows]
    single = [toxicity.NonNegativePU(0.3, rounds=t).fit(numbers, positive, 6) for t in range(16, 26)]
    model = toxicity.NonNegativePU(0.3, rounds=25, averaged=10).fit(numbers, positive, 6)
    assert np.allclose(model.w, np.mean([m.w for m in single], axis=0)) and np.isclose(model.bias, np.mean([m.bias for m in single]))


def test_toxicity_counts_all_text_and_one_row_an_id(spark):
    rng = random.Random(15)
    rows = [(i, prose(rng, 20) + (" vileword" if i % 4 == 0 else ""), "en", "s", 1) for i in range(400)] + [(4, "lang " * 50000, "en", "s", 1)] * 3
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, SCHEMA)
    a, b = (toxicity.fit(docs.repartition(n), labels) for n in (1, 5))
    assert a == b and a[0]["vileword"] > 1
    got = toxicity.query(spark, docs, labels)
    assert got.count() == 403 and got.where("doc_id = 4").select("score").distinct().count() == 2


def test_index_is_found_again_by_its_path(spark):
    place, batch = scratch(spark), "digest string, id long"
    one = exact.DigestIndex(spark, "index_first", place, 3)
    one.add(spark.createDataFrame([("aa", 1), ("bb", 2), ("bb", 5)], batch))
    one.forget()
    two = exact.DigestIndex(spark, "index_second", place)
    two.add(spark.createDataFrame([("bb", 9), ("cc", 3)], batch))
    assert two.buckets == 3 and sorted(map(tuple, two.rows().collect())) == [("aa", 1), ("bb", 2), ("cc", 3)]
    with pytest.raises(ValueError, match="3 buckets, not 4"):
        exact.DigestIndex(spark, "index_third", place, 4).add(spark.createDataFrame([("dd", 1)], batch))
    with pytest.raises(ValueError, match="index_second is a table at"):
        exact.DigestIndex(spark, "index_second", scratch(spark)).add(spark.createDataFrame([("dd", 1)], batch))
    plan = two.rows().groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Initial Plan")[0]
    fresh = spark.newSession()  # another catalog
    three = exact.DigestIndex(fresh, "index_second", place)
    three.add(fresh.createDataFrame([("aa", 0), ("ee", 4)], batch))
    assert sorted(map(tuple, three.rows().collect())) == [("aa", 1), ("bb", 2), ("cc", 3), ("ee", 4)]
    two.forget()
