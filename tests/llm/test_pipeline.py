import corpus_pipeline
from tests.llm.test_bin_packing import check, library  # noqa: F401
from tests.llm.test_paragraph_dedup import brute_substrings, words_of
from tests.llm.test_quality_rules import brute as quality
from tests.llm.test_simhash import brute_groups

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, library, tmp_path):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(10_001, None, None, None, None), (10_002, "", "en", None, 0), (1, docs.where("doc_id = 1").first()["text"], "en", "src1", 1)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    columns, kept = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        kept.append([(r["doc_id"], r["text"]) for r in before.collect()])
        assert i == 4 or docs.columns == columns
    given, after_rules, after_exact, after_near, after_cut = kept
    assert sorted(after_rules) == sorted((i, t) for i, t in given if quality(t)[-1])
    largest = {}
    for i, t in after_rules:
        largest[t] = max(largest.get(t, i), i)
    assert sorted(after_exact) == sorted((i, t) for t, i in largest.items())
    assert sorted(i for i, _ in after_near) == sorted(i for i, _, c in brute_groups(after_exact, 2) if i == c)
    gone = brute_substrings(after_near)
    near = dict(after_near)
    assert all(words_of(t) == [w for k, w in enumerate(words_of(near[i])) if k not in gone.get(i, {})] for i, t in after_cut if i is not None)
    seen = {}
    for i, t in after_cut:
        w = words_of(t)
        for k in range(len(w) - 50):
            seen.setdefault(tuple(w[k : k + 51]), set()).add(i)
    assert sorted(i for i, _ in after_cut) == sorted(i for i, _ in after_near) and all(len(x) == 1 for x in seen.values())
    check(docs.collect(), after_cut, library, 1024)


def test_run_is_the_stages_one_after_another(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 100 and 4 <= len(corpus_pipeline.STAGES) <= 5
