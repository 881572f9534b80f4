import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, `_text` string, words string, bits long, kept boolean"


@pytest.fixture(scope="session")
def corpus():
    """Small invented texts: near copies, shared passages, long and odd ones; reproducible."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghilmnoprstuvé") for _ in range(rng.randint(2, 9))) for _ in range(400)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    texts = []
    for _ in range(40):
        texts.append("\n".join(" ".join(words(rng.randint(5, 90))) for _ in range(rng.randint(1, 4))))
    base = words(80)
    for n in (0, 1, 2, 3, 6, 9, 12, 20):  # ever less alike
        near = list(base)
        for i in rng.sample(range(80), n):
            near[i] = rng.choice(vocabulary)
        texts.append(" ".join(words(12)) + "\n" + " ".join(near))
    passage = words(51)
    for _ in range(3):  # inside other lines, and over lines
        texts.append(" ".join([*words(30), *passage, *words(40)]))
    texts.append(" ".join(words(20)) + "\n" + " ".join(passage[:25]) + "\n" + " ".join(passage[25:]) + "\n" + " ".join(words(20)))
    texts += [texts[0], texts[0], texts[5], "", " \n\t ", "x", " ".join(words(30_000))]
    return texts


@pytest.fixture
def documents(spark):
    """Documents of the given (id, text) rows, with further columns whose names clash with inner ones."""

    def make(rows):
        data = [(i, t, None, None, None, "clash", "clash", 1, True) for i, t in rows]
        return spark.createDataFrame(data, COLUMNS).repartition(3)

    return make
