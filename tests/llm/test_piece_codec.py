import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from tollhouse.llm.piece_codec import PieceModel, decoded, encoded
from tollhouse.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return PieceModel(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(library):
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz ABCé漢字 \t\n  ▁🎉0123456789.,'<s>"
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(261, 32000)]
    for k in range(1500):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) if k % 2 else "".join(rng.choice(pieces) for _ in range(rng.randint(1, 12)))
        yield t.replace(" ", "") if k % 7 == 0 else t.replace(" ", " " * rng.randint(1, 40)) if k % 11 == 0 else t
    for _ in range(5):  # no place to cut but where the ways meet
        yield "".join(rng.choice(pieces) for _ in range(500)).replace(" ", "")


def test_ids_are_the_librarys(model, library):
    for text in texts(library):
        ids = model.encode(text).tolist()
        assert ids == library.encode(text), text
        assert model.decode(ids) == text.replace("▁", " ") == library.decode(ids)


def test_long_text_is_given_out_as_it_is_read(model):
    runs = list(model.search("ab" * 5000))
    assert len(runs) > 100 and max(map(len, runs)) <= 4 * model.longest


def test_unigram_against_all_segmentations():
    model = PieceModel(PATH, kind="unigram")
    rng = random.Random(2)
    for _ in range(60):
        text = "".join(rng.choice("theinan▁") for _ in range(rng.randint(1, 90)))
        best = [0.0] + [-1e18] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - model.longest), end):
                score = model.scores.get(text[start:end], model.least - 10.0 if end - start == 1 else None)
                if score is not None:
                    best[end] = max(best[end], best[start] + score)
        pieces = [i for run in model.search(text) for i in run]
        assert "".join(map(model.piece, pieces)) == text
        assert sum(model.score_of.get(i, model.least - 10.0) for i in pieces) == pytest.approx(best[-1])


def test_rows(spark, documents, corpus, library):
    rows = list(enumerate(corpus)) + [(900, None), (1, corpus[1]), (None, "null id")]
    out = encoded(documents(rows), PATH)
    want = sorted(((i, library.encode(t or "")) for i, t in rows), key=repr)
    got = out.collect()
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=repr) == want
    assert all(r["round_trip"] and r["n_ids"] == len(r["ids"]) for r in got)
    back = decoded(out.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"]), PATH)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {i: t or "" for i, t in rows if i is not None}
    assert encoded(documents([]), PATH).collect() == []


def test_every_word_goes_through_the_streaming_search(library):
    model, asked = PieceModel(PATH), []
    search = model.search
    model.search = lambda text: asked.append(text) or search(text)
    text = "The quick brown fox and the quick brown dog"
    assert model.encode(text).tolist() == library.encode(text)
    assert "".join(asked) == "▁The▁quick▁brown▁fox▁and▁the▁dog"  # each word once
    asked.clear()
    assert model.encode(text).tolist() == library.encode(text) and not asked
