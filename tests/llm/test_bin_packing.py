import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tollhouse.llm import bin_packing as b
from tollhouse.llm.queries import END_ID, tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


def test_ids_are_the_librarys(library, corpus):
    encoder = b.Encoder(PATH)
    rng = random.Random(6)
    letters = "ab cd  eé'st're\n\t_1²½.,!<|endoftext|>"
    texts = [*corpus, "漢字 and more", "\x1c \x85 \xa0x", "I'll we've 'S", *("".join(rng.choice(letters) for _ in range(40)) for _ in range(500))]
    for t in texts:
        assert ids(encoder, t) == library.encode(t, add_special_tokens=False).ids, t
    for _ in range(1500):  # white space in every place
        t = "".join(rng.choice("ab  \n\t,\x85\xa0") for _ in range(rng.randint(0, 9)))
        assert ids(encoder, t) == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_every_plain_character_is_classed_as_the_library_does(library):
    encoder = b.Encoder(PATH)
    for c in map(chr, range(0x250)):
        for t in (f"a{c}a", f"1{c}1", f" {c} {c}", f"a {c}b{c}.{c}", f"{c}{c} x{c}  {c}"):
            assert ids(encoder, t) == library.encode(t, add_special_tokens=False).ids, hex(ord(c))


def test_fullest_against_all_combinations():
    rng = random.Random(7)
    for _ in range(200):
        capacity = rng.randint(5, 40)
        counts = {rng.randint(1, capacity): rng.randint(1, 4) for _ in range(rng.randint(1, 7))}
        taken = b.fullest(counts, capacity)
        assert taken[max(counts)] >= 1 and all(n <= counts[x] for x, n in taken.items())
        sums = {0}
        for x, n in counts.items():
            for _ in range(n - (x == max(counts))):
                sums |= {s + x for s in sums}
        assert sum(x * n for x, n in taken.items()) - max(counts) == max(s for s in sums if s <= capacity - max(counts))


def test_plan_uses_every_piece_once_and_few_bins():
    rng = random.Random(9)
    counts = {x: rng.randint(0, 100_000) for x in range(1, 1025)}
    bins = b.plan(counts, 1024)
    used = {}
    for p in bins:
        assert sum(x * n for x, n, _ in p.items) <= 1024
        for x, n, _ in p.items:
            used[x] = used.get(x, 0) + n * p.times
    assert used == {x: n for x, n in counts.items() if n}
    least = max(sum(x * n for x, n in counts.items()) / 1024, sum(n for x, n in counts.items() if x > 512))  # no fewer bins can do
    assert sum(p.times for p in bins) <= 1.03 * least and len(bins) < 6000


def check(rows, docs, library, capacity):
    want = {}
    for i, t in docs:
        x = [*library.encode(t or "", add_special_tokens=False).ids, END_ID]
        first = len(x) % capacity or capacity
        edges = [0, *range(first, len(x), capacity), len(x)]
        for k, (a, z) in enumerate(zip(edges, edges[1:])):
            want.setdefault((i, k, a, z - a, zlib.crc32(np.array(x[a:z], "<u4").tobytes())), []).append(1)
    got = {}
    for r in rows:
        got.setdefault((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]), []).append(1)
    assert got == want
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for x in places.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


@pytest.mark.parametrize("capacity", [1, 7, 1024])
def test_packing(documents, corpus, library, capacity):
    texts = corpus[:12] + corpus[-4:] if capacity < 1024 else corpus
    if capacity < 1024:
        texts = [t[:3000] for t in texts]
    rows = list(enumerate(texts)) + [(900, None), (1, texts[1]), (None, "null id")]
    got = b.pack(documents(rows), PATH, END_ID, capacity, with_ids=True)
    n = check(got.collect(), rows, library, capacity)
    total = sum(r["length"] for r in got.select("length").collect())
    assert n <= max(1.2 * total / capacity, total / capacity + 2)
    lines = b.sequences(got).collect()
    assert len(lines) == n and sum(len(r["ids"]) for r in lines) == total


def test_empty(documents):
    assert b.pack(documents([]), PATH, END_ID).collect() == []


def test_added_tokens_are_the_files(documents):
    plain = Tokenizer.from_file(PATH)
    encoder = b.Encoder(PATH)
    texts = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|>\n<|endoftext|> é", "漢字<|endoftext|>", "<|endoftext|" + "y" * b.LONG + "<|endoftext|>", "<|endoftext |>"]
    for t in texts:
        assert ids(encoder, t) == plain.encode(t, add_special_tokens=False).ids, t[:40]
    assert len(ids(encoder, "a<|endoftext|>b")) == 3
    check(b.pack(documents(list(enumerate(texts))), PATH, END_ID, 1024).collect(), list(enumerate(texts)), plain, 1024)
