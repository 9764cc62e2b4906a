"""The manifest against a tree built node by node."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from wagebook.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)])


def lower(t):
    return None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, i):
    out = []
    for nodes in tree[:-1]:
        run = nodes[i - i % 8 : i - i % 8 + 8]
        out.append(("".join(run[: i % 8]), "".join(run[i % 8 + 1 :])))
        i //= 8
    return out


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, (_, _, l, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            p = path(trees[g], i) + path(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            at = leaf(r, lower(r[1])) if hit else l
            for a, b in p:
                at = h(a, at, b)
            out.append((r[0], l, trees[g][-1][0], top[-1][0], h(*[a + b for a, b in p]), at, at == top[-1][0]))
    return out


def same(spark, rows):
    clash = {c: F.lit("clash") for c in ("g", "key", "hash", "leaf", "rank", "block", "levels", "kids", "path", "root", "d0", "_tie")}
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns(clash))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    order = lambda x: tuple(str(v) for v in x)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(plain(rows), key=order)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_sizes(spark, n):
    same(spark, [(3 * i - 20, f"Text {i} É", "en", "s", i) for i in range(n)])


def test_groups_and_nulls(spark):
    rows = [(i, None if i % 7 == 0 else f"A{i} 🎉" * (i % 5), [None, "", "de", "é", "en"][i % 5], None if i % 3 else "s", None if i % 4 else i) for i in range(90)]
    rows += [(None, "Null id", "de", None, 1), (None, "Null id", "de", None, 1), (5, "same id", "en", "s", 2), (5, "SAME id", "en", "s", 2)]
    rows += [(7, "all the same", "it", "s", 2)] * 20 + [(1000 + i, "x", f"lang{i}", None, 1) for i in range(20)] + [(2000, "Z" * 200_000, "en", "s", 1)]
    same(spark, rows)


def test_several_rounds(spark):
    """Over 4,096 leaves: the blocks' hashes are leaves of a second round."""
    same(spark, [(i, f"T{i}", "en" if i % 3 else "de", "s", 1) for i in range(9000)])


def test_empty(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_proofs_join_nothing(spark):
    docs = spark.createDataFrame([(i, "t", "en", "s", 1) for i in range(50)], SCHEMA)
    assert "Join" not in merkle.manifest(docs)._jdf.queryExecution().executedPlan().toString()
