"""run() of the pipeline against a chain of plain-Python stages on a small table, with nulls, empty and very long texts and
clashing column names. What the quality stage rejects is taken from its operator, whose own tests are in test_small."""

import hashlib
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_small import SCHEMA, WORDS, brute_components, make, normal, prose
from wagebook.llm import bpe, mixing, quality


def fill(children, given):
    """children: name -> (weight, capacity); shares of given by weight, what one cannot take goes to the others."""
    out, open_ = {c: 0.0 for c in children}, dict(children)
    while open_ and given > 1e-9:
        total = sum(w for w, _ in open_.values())
        full = [c for c, (w, cap) in open_.items() if cap <= given * w / total]
        if not full:
            return out | {c: given * w / total for c, (w, _) in open_.items()}
        for c in full:
            out[c] = open_[c][1]
        given -= sum(open_.pop(c)[1] for c in full)
    return out


def brute_mix(rows, share):
    leaves = defaultdict(list)
    for i, text, lang, source, _ in rows:
        leaves[mixing.DOMAINS.get(source, "web"), lang or "", source or ""].append((hashlib.md5(f"9/0/{i}".encode()).hexdigest(), i, len((text or "").encode().split())))
    tokens = {k: sum(x[2] for x in v) for k, v in leaves.items()}
    weight = lambda *p: mixing.WEIGHTS.get(p, 1.0)
    total = float(int(sum(tokens.values()) * share))
    budget = {}
    for d, b in fill({d: (weight(d), sum(t for k, t in tokens.items() if k[0] == d)) for d in {k[0] for k in leaves}}, total).items():
        for g, c in fill({g: (weight(d, g), sum(t for k, t in tokens.items() if k[:2] == (d, g))) for g in {k[1] for k in leaves if k[0] == d}}, b).items():
            for s, e in fill({s: (1.0, tokens[d, g, s]) for s in {k[2] for k in leaves if k[:2] == (d, g)}}, c).items():
                budget[d, g, s] = int(np.floor(e + 1e-7))
    kept = set()
    for leaf, docs in leaves.items():
        if tokens[leaf] and budget[leaf] >= tokens[leaf]:
            kept |= {i for _, i, _ in docs}
            continue
        run = 0
        for _, i, n in sorted(docs):
            run += n
            if run <= budget[leaf]:
                kept.add(i)
    return [r for r in rows if r[0] in kept]


def test_run_is_the_chain_of_its_stages(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(12)
    rows = make(200, 5)
    junk = [(20000 + i, " ".join(rng.choice(WORDS).upper() + "!!" for _ in range(60)), "en", "src1", 1) for i in range(60)]
    good = [(30000 + i, prose(rng, 70), "en", f"src{i % 20}", 1) for i in range(80)]
    rows = rows + junk + good
    labels = [(i, 0, 0) for i in range(20000, 20040)] + [(i, 1, 0) for i in range(30000, 30060)] + [(i, 1, 0) for i in range(0, 300, 6)]
    clash = {c: F.lit(c) for c in ("salt", "_n", "score", "row", "id", "check", "leaf", "kept", "id_key", "tokens")}
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(clash)
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    sf_dir = f"file://{tmp_path}"

    scores = {r["doc_id"]: r["kept"] for r in quality.query(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    left = [r for r in rows if scores[r[0]]]
    assert not any(r[0] // 10000 == 2 for r in left) and sum(r[0] // 10000 == 3 for r in left) >= 79
    first = {}
    for r in sorted(left, key=lambda r: r[0]):
        first.setdefault(normal(r[1]), r[0])
    left = [r for r in left if first[normal(r[1])] == r[0]]
    comp = brute_components(left, 5)
    left = brute_mix([r for r in left if comp[r[0]][1] == r[0]], 0.9)
    t = Tokenizer.from_file(bpe.default_path())
    want = {}
    for i, text, *_ in left:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == want and 0 < len(got) < len(rows)


def test_stages_keep_the_columns(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "bpe"]
    docs = spark.createDataFrame(make(40, 2), SCHEMA)
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"file://{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, f"file://{tmp_path}").columns == docs.columns
        assert stage(spark, docs.where("false"), f"file://{tmp_path}").count() == 0
