import hashlib

import pytest
from pyspark.sql import functions as F

from tollhouse.llm import merkle

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, grp string, `place` long, tree long"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, fanout):
    """(root, for each node the siblings before and after it by level)."""
    paths, at = [([], []) for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            run = i - i % fanout
            path[0].append("".join(nodes[run:i]))
            path[1].append("".join(nodes[i + 1 : run + fanout]))
        nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], paths


def brute(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0], sha("".join(map(framed, r[:5])))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    leaves = {g: sorted(groups[g], key=lambda x: (x[0], x[1] or 0, x[2])) for g in order}
    trees = {g: tree([x[2] for x in leaves[g]], fanout) for g in order}
    root, tops = tree([trees[g][0] for g in order], fanout)
    out = []
    for g, top in zip(order, tops):
        for (_, i, leaf), (before, after) in zip(leaves[g], trees[g][1]):
            out.append((i, g, leaf, trees[g][0], root, before + top[0], after + top[1]))
    return out


def sample(n):
    langs = [None, "", "en", "en", "en", "en", "de", "éa", "z"]
    rows = [(i * 7 % n, f"s{i % 3}" if i % 5 else None, langs[i % len(langs)] if i % 11 else "en", i if i % 4 else None, "x" * (i % 9) if i % 6 else None) for i in range(n)]
    return rows + [rows[3], rows[3], (None, None, None, None, None), (None, "a", "en", 1, "b"), (2, "a", "en", 1, "")]


@pytest.mark.parametrize("fanout, block_levels, n", [(2, 1, 83), (2, 3, 200), (3, 1, 60), (5, 2, 150)])
def test_same_as_brute_force(spark, fanout, block_levels, n):
    rows = sample(n)
    docs = spark.createDataFrame([(*r, "clash", "clash", 1, 1) for r in rows], COLUMNS).repartition(5)
    found = merkle.manifest(docs, fanout=fanout, block_levels=block_levels, carry={"same": F.col("n_chars")})
    got = found.withColumn("folded", merkle.folded(F.col("leaf"))).withColumn("proof", merkle.proof_hash()).collect()
    assert sorted(map(repr, ((r[0], r[1], r[2], r[3], r[4], r[5], r[6]) for r in got))) == sorted(map(repr, brute(rows, fanout)))
    assert all(r["folded"] == r["root"] for r in got)
    assert all(r["proof"] == sha("".join(b + a for b, a in zip(r["before"], r["after"]))) for r in got)
    assert sorted(map(repr, ((r["doc_id"], r["same"]) for r in got))) == sorted(map(repr, ((r[0], r[3]) for r in rows)))


def test_a_changed_leaf_leads_elsewhere(spark):
    docs = spark.createDataFrame([(*r, None, None, 1, 1) for r in sample(30)], COLUMNS)
    got = merkle.manifest(docs, block_levels=2).withColumn("folded", merkle.folded(F.sha2("leaf", 256)))
    assert got.where("folded = root").isEmpty()


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(1, "a", "en", 2, "é", None, None, None, None)], COLUMNS)
    (row,) = merkle.manifest(docs).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == sha("1:11:a2:en1:22:é") and row["before"] == [] == row["after"]
    assert merkle.manifest(docs.where("false")).collect() == []


def test_groups_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_GROUPS", 0)
    rows = sample(40)
    got = merkle.manifest(spark.createDataFrame([(*r, None, None, 1, 1) for r in rows], COLUMNS), block_levels=1).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, brute(rows, 2)))


def test_very_long_text(spark):
    docs = spark.createDataFrame([(1, "a", "en", 2, "é" * 3_000_000, None, None, None, None)], COLUMNS)
    assert merkle.manifest(docs).first()["leaf"] == sha("1:11:a2:en1:2" + framed("é" * 3_000_000))
