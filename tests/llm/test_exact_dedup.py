import hashlib
import random

import pytest

from tollhouse.llm.exact_dedup import Trie, exact_dedup, text_owners, without_copies


@pytest.mark.parametrize("budget", [0, 2_000, 20_000, 1 << 30])
def test_trie_against_a_dict(budget):
    rng = random.Random(budget)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(600)]
    keys += [b"long" * 3000 + k for k in keys[:50]] + [b"", b"", b"long" * 3000]
    trie, want = Trie(budget), {}
    for i, k in enumerate(keys):
        trie.insert(k, (i, i, 1))
        low, high, n = want.get(k, (i, i, 0))
        want[k] = (min(low, i), max(high, i), n + 1)
    found = list(trie.owners())
    assert len(found) == len(want) and dict(found) == want


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for i in sorted(ids, key=lambda x: (x is not None, x), reverse=True):
            out.append((i, keep, len(ids), first, hashlib.sha256(t.encode()).hexdigest()))
            first = False
    return sorted(out, key=repr)


@pytest.mark.parametrize("budget", [1_000, 1 << 30])
def test_nulls_ties_and_repeats(documents, corpus, budget):
    rows = list(enumerate(corpus)) + [(900, None), (7, corpus[7]), (7, corpus[7]), (None, corpus[1]), (None, "only null ids"), (None, "only null ids"), (901, "é"), (902, "é")]
    got = sorted(map(tuple, exact_dedup(documents(rows), budget=budget).collect()), key=repr)
    assert got == brute(rows)


def test_smallest_and_owners(documents):
    docs = documents([(3, "a"), (1, "a"), (2, "b")])
    assert sorted((bytes(r[0]), *r[1:]) for r in text_owners(docs).collect()) == [(b"a", 1, 3, 2), (b"b", 2, 2, 1)]
    assert {r["keep_id"] for r in exact_dedup(docs, keep="smallest").collect()} == {1, 2}


def test_kept_rows_and_empty_table(documents):
    docs = documents([(1, "a"), (2, "a"), (2, "a"), (3, None), (4, "")])
    kept = without_copies(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 4]
    assert exact_dedup(documents([])).collect() == [] and without_copies(documents([])).collect() == []


def test_clashing_names_stay_as_they_are(spark):
    docs = spark.createDataFrame([(1, "a", "k", 7, "r", 3), (2, "a", "l", 8, "s", 4), (None, "b", "m", 9, "t", 5)], "doc_id long, text string, _key string, _copy int, `row` string, id int")
    out = without_copies(docs)
    assert out.columns == docs.columns and sorted(tuple(r)[1:] for r in out.collect()) == [("a", "l", 8, "s", 4), ("b", "m", 9, "t", 5)]
