import re
from functools import partial

from pyspark.sql import functions as F

from tollhouse.llm import quality_rules as q
from tollhouse.llm.common import let, text_or_empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    chars = sum(map(len, words))
    n = len(words)
    base = n < 20 or 100 * len(covered) > 30 * n
    same = sum(a == b for a, b in zip(words, words[1:]))
    dup = len(lines) - len(set(lines))
    bad = 10 * symbols > n or 10 * text.count("!") > 3 * n or 10 * dup > 3 * len(lines) or 10 * same > 2 * n or chars < 2 * n or chars > 20 * n
    return n, chars, symbols, dup, len(covered), base, not (base or bad)


def test_against_brute_force(documents, corpus):
    odd = ["a " * 9, "a " * 8, "b c " * 30, "one two three four five six seven eight " * 2 + "end", "x\n" * 40, "## " * 25, "go!! " * 30, "\u00a0 \u2003 wide spaces stay words \x1c " * 6, "ééé " * 21, "w" * 30 + " v" * 25]
    rows = list(enumerate([*corpus, *odd, None])) + [(1, corpus[1]), (None, corpus[2])]
    got = sorted((tuple(r) for r in q.quality(documents(rows)).collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=repr)


def test_kept_rows(documents, corpus):
    rows = list(enumerate([*corpus, "go!! " * 30, None]))
    docs = documents(rows)
    kept = q.kept_rows(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, t in rows if brute(t)[-1]]
    assert q.quality(documents([])).collect() == [] and q.kept_rows(documents([])).collect() == []


def test_order_is_rejection_per_cost():
    a, b, c, d = (q.Rule(x, None) for x in "abcd")
    found = [q.Measured(a, 0.5, 10.0), q.Measured(b, 0.1, 0.1), q.Measured(c, 0.0, 2.0), q.Measured(d, 0.0, 1.0)]
    assert [r.name for r in q.cascade(found)] == ["b", "a", "d", "c"]


def test_any_order_gives_the_same_verdict(documents, corpus):
    docs = documents(list(enumerate([*corpus, "go!! " * 30, "## " * 25])))
    text = text_or_empty()
    # the words must be computed once for a text, or each window would split it again
    verdicts = [docs.select("doc_id", let(q.words_of(text), partial(q.rejected, rules, text)).alias("bad")) for rules in (q.BASE + q.RULES, (q.BASE + q.RULES)[::-1])]
    assert sorted(map(tuple, verdicts[0].collect())) == sorted(map(tuple, verdicts[1].collect()))


def test_native(documents, corpus):
    plan = q.quality(documents(list(enumerate(corpus)))).where(F.col("kept"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.replace("RoundRobinPartitioning", "").split("Project")[0]
