import itertools
import zlib

import numpy as np
import pytest

from tollhouse.llm.hilbert_shards import hilbert_index, shards, write_shards


@pytest.mark.parametrize("d, bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_step_by_step(d, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=d)))
    index = hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(rows, n, total):
    per = {}
    for r in rows:
        per.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in per.values())
    counts = [len(per.get(s, [])) for s in range(n)]
    assert sum(counts) == total and max(counts) - min(counts) <= 1 and set(per) <= set(range(n))


@pytest.mark.parametrize("n", [1, 3, 8, 200])
def test_shards(spark, corpus, n):
    rows = [(i, t, f"l{i % 3}" if i % 5 else None, f"src{i % 7}", i) for i, t in enumerate([*corpus, None, None])] + [(None, "x", "l1", "é", 0)]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string, lang string, source string, size long").repartition(3)
    got = shards(docs, n).collect()
    check(got, n, 2 * len(rows))
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows * 2), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == want
    by_curve = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in by_curve] == sorted(r["curve"] for r in got)


def test_empty_and_written(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert shards(empty).collect() == []
    docs = spark.createDataFrame([(i, f"text {i}" * (i % 9), f"l{i % 4}", f"s{i % 3}") for i in range(100)], "doc_id long, text string, lang string, source string")
    write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.drop("shard").exceptAll(docs).isEmpty() and [r["count"] for r in back.groupBy("shard").count().collect()] == [25] * 4


def test_cells_against_brute_force(spark):
    """Strings by their place among the whole distinct values, all at their quantiles, then the curve."""
    rows = [(i, "x" * (i * 13 % 101), f"https://common-prefix/{i % 90:03d}", None if i % 9 == 0 else f"s{i % 5}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    got = {r["doc_id"]: r["curve"] for r in shards(docs).collect()}
    cells = []
    for column in (2, 3, 1):
        value = [len(r[1]) + 1 if column == 1 else r[column] for r in rows]
        distinct = sorted(set(value), key=lambda v: (v is not None, v))
        code = [v if column == 1 else distinct.index(v) for v in value]
        # the least value that so many rows do not exceed
        cuts = sorted({sorted(code)[max(-(-k * len(code) // 64) - 1, 0)] for k in range(1, 64)})
        cells.append([sum(c < x for c in cuts) for x in code])
    want = hilbert_index(np.array(cells).T, 6)
    assert [got[i] for i in range(400)] == want.tolist()


def test_written_columns_keep_their_names(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i}", "l", "s", i, "x", i) for i in range(20)], "doc_id long, text string, lang string, source string, slot long, shard string, id long")
    write_shards(docs, str(tmp_path / "out"), 4)
    assert spark.read.parquet(str(tmp_path / "out")).drop("shard_").exceptAll(docs).isEmpty()


def test_very_long_text(spark):
    docs = spark.createDataFrame([(1, "é" * 2_000_000, "l" * 100_000, "s"), (2, None, "l" * 100_001, None)], "doc_id long, text string, lang string, source string")
    assert sorted((r["doc_id"], r["size"]) for r in shards(docs, 2).collect()) == [(1, 4_000_001), (2, 1)]
