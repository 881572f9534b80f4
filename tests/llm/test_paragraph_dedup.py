import random

import numpy as np
import pytest

from tollhouse.llm import paragraph_dedup as p


def words_of(text):
    return text.encode().split()


def brute_paragraphs(rows, min_words=50, threshold=0.8):
    """(id, first, n, keep_id) by comparing all paragraphs with one another."""
    pars = []
    for doc, text in rows:
        at = 0
        for i, line in enumerate((text or "").encode().split(b"\n")):
            w = line.split()
            if len(w) >= min_words and doc is not None:
                pars.append((doc, i, at, len(w), set(zip(*(w[k:] for k in range(5))))))
            at += len(w)
    group = list(range(len(pars)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(pars)):
        for j in range(i):
            a, b = pars[i][4], pars[j][4]
            if len(a & b) >= threshold * len(a | b):
                group[top(i)] = top(j)
    heads = {}
    for i, x in enumerate(pars):
        heads[top(i)] = min(heads.get(top(i), x[:2]), x[:2])
    return {(x[0], x[2], x[3], heads[top(i)][0]) for i, x in enumerate(pars) if x[:2] != heads[top(i)]}


def test_bands_reach_the_recall():
    for s in (0.5, 0.8, 0.9):
        n = p.bands_for(s)
        assert 1 - (1 - s**p.BAND_ROWS) ** n >= p.RECALL > 1 - (1 - s**p.BAND_ROWS) ** (n - 1)


@pytest.mark.parametrize("block", [2, 400])
def test_paragraphs_against_all_pairs(documents, corpus, block, monkeypatch):
    monkeypatch.setattr(p, "BLOCK", block)
    rng = random.Random(5)
    rows = list(enumerate(corpus)) + [(900, None), (0, corpus[0]), (None, corpus[1])]
    # a dense cloud: neighbours alike, its ends not
    cloud = [f"v{i}" for i in range(70)]
    for k in range(40):
        cloud[rng.randrange(70)] = f"u{k}"
        rows.append((1000 + k, "lead in\n" + " ".join(cloud)))
    rng.shuffle(rows)
    got = {tuple(r) for r in p.paragraph_removals(documents(rows)).collect()}
    assert got == brute_paragraphs(rows)


def test_every_repeated_run_of_51_words_is_found(documents, corpus):
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(51)]
    rows = []
    for k in range(12):
        filler = [f"f{k}_{i}" for i in range(rng.randint(0, 200))]
        at = rng.randint(0, len(filler))
        glue = "\n" if k % 3 == 0 else " "
        rows.append((k, glue.join([*filler[:at], *passage, *filler[at:]])))
    rows += [(50, " ".join(f"c{i}" for i in range(300))), (51, " ".join([*(f"d{i}" for i in range(60)), *passage[:25], "end"]))]
    found = {}
    for r in p.passage_removals(documents(rows)).collect():
        text = words_of(dict(rows)[r["doc_id"]])
        keep = words_of(dict(rows)[r["keep_id"]])
        span = text[r["first"] : r["first"] + r["n"]]
        assert r["keep_id"] == 0 and any(keep[i : i + len(span)] == span for i in range(len(keep)))
        found.setdefault(r["doc_id"], []).append(r)
    assert set(found) == set(range(1, 12))


def test_runs_in_one_document_only_stay(documents):
    text = " ".join(f"w{i}" for i in range(40))
    assert p.passage_removals(documents([(1, text + " mid " + text), (1, text), (2, "other")])).collect() == []


def test_anchors_depend_on_the_neighbourhood_only():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    at = p.anchors(h, 22)
    assert np.diff(np.concatenate(([-1], at, [400]))).max() <= 22  # one in every window of 22
    want = {i for i in range(400) if any(h[i] == h[max(s, 0) : s + 22].min() for s in range(max(0, i - 21), min(i, 378) + 1))}
    assert set(at.tolist()) == want
    assert p.anchors(h[:5], 22).tolist() == [int(np.argmin(h[:5]))] and len(p.anchors(h[:0], 22)) == 0


def test_run_hashes_are_of_the_run():
    h = np.random.default_rng(4).integers(0, 1 << 63, 300, dtype=np.uint64)
    doubled = np.concatenate((h[:7], h, h[100:200]))
    a, b = p._run_hashes(h, 30, 12345), p._run_hashes(doubled, 30, 12345)
    assert np.array_equal(a, b[7 : 7 + len(a)]) and len(set(a.tolist())) == len(a)
    assert p._run_hashes(h[:29], 30, 1).tolist() == []


def test_cut_spans():
    text = "one two\n three four five\n\nsix  seven"
    cut = lambda *spans: p.cut_spans(text, [{"first": a, "n": n} for a, n in spans])
    assert cut((0, 2)) == " three four five\n\nsix  seven"
    assert cut((2, 3)) == "one two\n\nsix  seven"
    assert cut((3, 1)) == "one two\n three five\n\nsix  seven"
    assert cut((6, 1)) == "one two\n three four five\n\nsix"
    assert cut((0, 7)) == "" and cut() == text
    assert cut((1, 1), (3, 2)) == "one\n three\n\nsix  seven"
    assert p.merge_spans([{"first": 0, "n": 3, "keep_id": 5}, {"first": 2, "n": 4, "keep_id": 4}, {"first": 6, "n": 1, "keep_id": 9}, {"first": 8, "n": 1, "keep_id": 1}]) == [
        {"first": 0, "n": 7, "keep_id": 4},
        {"first": 8, "n": 1, "keep_id": 1},
    ]


def test_texts_without_repeats(documents, corpus):
    rows = list(enumerate(corpus)) + [(900, None), (None, corpus[1])]
    docs = documents(rows)
    out = p.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    kept = {r["doc_id"]: r["text"] for r in out.collect() if r["doc_id"] is not None}
    spans = {r["doc_id"]: r["spans"] for r in p.substring_removals(docs).collect()}
    for doc, text in rows:
        if doc is None:
            continue
        gone = {i for s in spans.get(doc, []) for i in range(s["first"], s["first"] + s["n"])}
        assert words_of(kept[doc] or "") == [w for i, w in enumerate(words_of(text or "")) if i not in gone]
        if doc not in spans:
            assert kept[doc] == text
    # nothing of 51 words is left in two documents
    seen = {}
    for doc, text in kept.items():
        w = words_of(text or "")
        for i in range(len(w) - 50):
            seen.setdefault(tuple(w[i : i + 51]), set()).add(doc)
    assert all(len(x) == 1 for x in seen.values())
    assert p.substring_removals(documents([])).collect() == [] and p.without_repeats(documents([])).collect() == []


def test_a_repeated_passage_goes_from_its_first_word_to_its_last(documents):
    rng = random.Random(8)
    rows, want = [], {}
    for n in (51, 52, 60, 80, 200):
        passage = [f"q{n}_{i}" for i in range(n)]
        for k in range(8):
            doc, before, after = len(rows), rng.randint(0, 60), rng.randint(0, 60)
            rows.append((doc, " ".join([*(f"a{doc}_{i}" for i in range(before)), *passage, *(f"z{doc}_{i}" for i in range(after))])))
            want[doc] = [(before, n)] if k else []
    # the start of one passage, and all of it with another's end
    shared = [f"s{i}" for i in range(140)]
    for a, z in ((0, 100), (40, 140), (0, 140), (0, 70)):
        rows.append((len(rows), " ".join([f"l{len(rows)}", *shared[a:z], f"r{len(rows)}"])))
        want[len(rows) - 1] = [[], [(1, 60)], [(1, 140)], [(1, 70)]][len(rows) - 41]
    found = {}
    for r in p.passage_removals(documents(rows)).collect():
        found.setdefault(r["doc_id"], []).append(r.asDict())
    got = {doc: [(s["first"], s["n"]) for s in p.merge_spans(sorted(x, key=lambda s: s["first"]))] for doc, x in found.items()}
    assert got == {doc: x for doc, x in want.items() if x}


def test_word_hashes_do_not_depend_on_the_parts():
    data = ("één\x0btwo  three\r\n\n" * 50 + "x" * 300 + " tail").encode()
    starts, hashes = p.word_hashes(data)
    assert [data[a:].split()[0] for a in starts] == data.split()
    assert len(set(hashes.tolist())) == len(set(data.split()))
    for part in (1, 7, 100):
        a, h = p.word_hashes(data, part)
        assert a.tolist() == starts.tolist() and h.tolist() == hashes.tolist()
    assert len(p.word_hashes(b"")[0]) == len(p.word_hashes(b" \n")[0]) == 0


def test_shared_counts(monkeypatch):
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (1, 30, 50, 7, 40, 90)]
    for columns in (3, 4096):
        monkeypatch.setattr(p, "COLUMNS", columns)
        want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets[3:]] for a in sets[:3]]
        assert p.shared(sets[:3], sets[3:]).tolist() == want


def brute_substrings(rows, passage=51):
    """For each document the owner of each word that goes: of its paragraph, or the smallest of its windows."""
    texts = {i: words_of(t or "") for i, t in rows if i is not None}
    owner = {i: {} for i in texts}
    for doc, first, n, keep in brute_paragraphs(rows, min_words=5):
        owner[doc].update(dict.fromkeys(range(first, first + n), keep))
    found = {}
    for doc, w in texts.items():
        for k in range(len(w) - passage + 1):
            if not any(i in owner[doc] for i in range(k, k + passage)):
                found.setdefault(tuple(w[k : k + passage]), set()).add((doc, k))
    for places in found.values():
        keep = min(places)[0]
        for doc, k in places:
            for i in range(k, k + passage) if doc != keep else ():
                owner[doc][i] = min(owner[doc].get(i, keep), keep)
    return {i: x for i, x in owner.items() if x}


def owners_of(frame):
    got = {}
    for r in frame.collect():
        words = [(i, s["keep_id"]) for s in r["spans"] for i in range(s["first"], s["first"] + s["n"])]
        got[r["doc_id"]] = dict(words)
        assert len(got[r["doc_id"]]) == len(words)  # spans share no word
    return got


def mosaic(seed, n):
    """Texts put together from parts of a few long passages, words of their own, and near copies of lines."""
    rng = random.Random(seed)
    sources = [[f"s{k}_{i}" for i in range(150)] for k in range(4)]
    rows = []
    for doc in range(n):
        parts = []
        for _ in range(rng.randint(1, 5)):
            source, a = rng.choice(sources), rng.randint(0, 110)
            parts.append(rng.choice([source[a : a + rng.randint(20, 140)], [f"o{doc}_{rng.random()}" for _ in range(rng.randint(1, 40))]]))
        words = [w for part in parts for w in part]
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"e{doc}"
        rows.append((doc, "".join(w + rng.choice(["\n"] + [" "] * 30) for w in words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_against_brute_force(documents, corpus, seed):
    rows = mosaic(seed, 60) + [(100 + i, t) for i, t in enumerate(corpus[:48])] + [(400, None), (None, corpus[3]), (401, "")]
    want = brute_substrings(rows)
    assert owners_of(p.substring_removals(documents(rows))) == want and len(want) > 20


def test_the_last_copy_of_a_passage_stays(documents):
    """A paragraph that goes for a similar one must not be what another text's passage goes for."""
    base, passage = [f"w{i}" for i in range(1000)], [f"p{i}" for i in range(52)]
    near = [*base[:400], *passage, *base[452:]]
    other = " ".join([*(f"x{i}" for i in range(80)), *passage, *(f"y{i}" for i in range(80))])
    out = {r["doc_id"]: r["text"] for r in p.without_repeats(documents([(0, " ".join(base)), (1, " ".join(near)), (2, other)])).collect()}
    assert out[1] == "" and out[2] == other
    out = {r["doc_id"]: r["text"] for r in p.without_repeats(documents([(0, " ".join(base)), (1, " ".join(near)), (2, other), (3, other.replace("x", "z"))])).collect()}
    assert " ".join(passage) in out[2] and "p" not in out[3]


def test_each_removed_word_stands_elsewhere(documents):
    rows = mosaic(7, 50)
    texts, spans = {i: words_of(t) for i, t in rows}, owners_of(p.substring_removals(documents(rows)))
    kept = {w for i, ws in texts.items() for k, w in enumerate(ws) if k not in spans.get(i, {})}
    lines = {(i, f) for i, f, n, _ in brute_paragraphs(rows, min_words=5) for f in range(f, f + n)}  # noqa: B020
    # words of passages: all are kept somewhere; paragraphs may differ from what stands for them
    assert all(texts[i][k] in kept for i, x in spans.items() for k in x if (i, k) not in lines)


def test_ids_with_several_texts_and_clashing_names(spark, corpus):
    twice = "one line of words that is long enough\nand some more of it"
    rows = [(1, twice), (2, twice), (2, "another text with the same id"), (3, twice), (3, twice), (4, corpus[0]), (5, corpus[0]), (None, twice)]
    docs = spark.createDataFrame([(i, t, i, "a", [1], "b", 2, "c", "d") for i, t in rows], "doc_id long, text string, _id long, _new string, _spans array<int>, `row` string, id long, spans string, _text string")
    assert {r["doc_id"] for r in p.substring_removals(docs).collect()} == {3, 5}
    out = p.without_repeats(docs)
    assert out.columns == docs.columns and sorted((r["doc_id"] or 0, r["text"]) for r in out.collect() if r["doc_id"] in (2, 3, 5)) == [(2, "another text with the same id"), (2, twice), (3, ""), (3, ""), (5, "")]
    assert all(r["_new"] == "a" and r["_spans"] == [1] and r["row"] == "b" and r["spans"] == "c" and r["_text"] == "d" for r in out.collect())


def test_sides_beyond_a_broadcast(documents, corpus, monkeypatch):
    monkeypatch.setattr(p, "BROADCAST_ROWS", 0)
    rows = mosaic(3, 20) + [(100 + i, t) for i, t in enumerate(corpus[:48])]
    assert owners_of(p.substring_removals(documents(rows))) == brute_substrings(rows)


def test_sets_of_few_shingles(documents):
    lines = ["a a a a a", "a a a a a a a a a", "b a a a a a", "a a a a a a a b", "a b a b a b a b a b", "b a b a b a", "c d e f g h i", "c d e f g h i j", "c d e f g h", "x c d e f g h i j"]
    rows = list(enumerate(lines))
    got = {tuple(r) for r in p.paragraph_removals(documents(rows), min_words=5).collect()}
    assert got == brute_paragraphs(rows, min_words=5) and (1, 0, 9, 0) in got


def test_short_lines_are_compared_like_long_ones(documents, corpus):
    rng = random.Random(12)
    rows = [(i, t) for i, t in enumerate(corpus[:48])]
    base = [f"b{i}" for i in range(49)]
    for k, near in enumerate((base, [*base, "x", "y", "z"], ["u", *base[1:]], base[:30], base[:20], base[:19], base[:5], base[:4])):
        rows.append((100 + k, " ".join(f"o{k}_{i}" for i in range(rng.randint(5, 60))) + "\n" + " ".join(near)))
    rows += [(200, "say five words right here\nfour words right here"), (201, "say five words right here\nfour words right here"), (202, rows[51][1])]
    got = {tuple(r) for r in p.paragraph_removals(documents(rows), min_words=5).collect()}
    assert got == brute_paragraphs(rows, min_words=5)
    spans = {r["doc_id"]: [(s["first"], s["n"], s["keep_id"]) for s in r["spans"]] for r in p.substring_removals(documents(rows)).collect()}
    first = len(words_of(dict(rows)[101])) - 52
    assert spans[101] == [(first, 52, 100)] and spans[201] == [(0, 5, 200)]  # 49 words against 52; a line of five words
