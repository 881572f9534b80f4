import hashlib
from collections import Counter, defaultdict

import pytest

from tollhouse.llm import token_links
from tollhouse.llm.queries import tokenizer_path

A_PATH, B_PATH = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in printable} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in printable)}
    assert decoders.ByteLevel().decode(["Ġ"]) == " "

    def of_a(text):
        return [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]

    def of_b(text):
        out = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            out.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        return out

    return of_a, of_b


def groups_of(text, libraries):
    """[(A ids, B ids), ...] by walking both sides."""
    if not text:
        return []
    a, b = libraries[0](text), libraries[1](text)
    want = b" " + text.encode()
    if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
        return []
    out, i, j = [], 0, 0
    while i < len(a):
        left, right, x, y = [], [], 0, 0
        while True:
            if x <= y:
                left.append(a[i][0])
                x += len(a[i][1])
                i += 1
            else:
                right.append(b[j][0])
                y += len(b[j][1])
                j += 1
            if x == y and right:
                break
        out.append((left, right))
    return out


def brute(rows, libraries):
    seen = {t: groups_of(t, libraries) for _, t in rows}
    counts = Counter((g[0][-1], g[1][-1]) for _, t in rows for g in seen[t])
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for i, t in rows:
        groups = seen[t]
        links = [(g[0][-1], g[1][-1]) for g in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        best = sum(counts[p] == highest[p[1]] for p in links)
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return out


ODD = [
    "a<|endoftext|>b", "<s> x </s> <unk> <0x41>", "▁ taken", "one  two   three\n\n\tfour ", "naïve Ünïcödé — 東京 🙂🙂 é é", " lead", "\r\n\x00\x01", "123456789 4111-1111", "don't we'll I'M",
    "x" * 5000, "   ", "﻿bom", "a b c", "ſtraße ﬁ", "؀ऀก",
]


def test_same_as_brute_force(documents, corpus, libraries):
    texts = corpus[:30] + corpus[-6:] + ODD
    rows = [*enumerate(texts), (900, None), (901, ODD[0]), (901, ODD[0]), (None, "the end"), (902, "the end")]
    rows += [(1000 + i, "of the same text") for i in range(300)]
    got = token_links.token_links(documents(rows), A_PATH, B_PATH)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(rows, libraries)))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_linkable_pairs_hold_all_links():
    a, b = [b"ab", b"b", b"c", b"", b"abc"], [b"b", b"xab", b"", b"bc", b"zc"]
    pairs = {(i // 5, i % 5) for i in token_links.linkable(a, b).tolist()}
    ends = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x and y and (x.endswith(y) or y.endswith(x))}
    assert pairs == ends


def test_a_text_is_tokenised_once(documents, monkeypatch):
    aligned = token_links.aligned_texts(documents([(i, "same" if i % 3 else "other") for i in range(50)]), A_PATH, B_PATH)
    assert sorted(r["copies"] for r in aligned.collect()) == [17, 33]


def test_no_rows(documents):
    assert token_links.token_links(documents([(1, "a")]).where("false"), A_PATH, B_PATH).collect() == []
