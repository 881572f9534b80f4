"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice of a text has a place for each boundary between characters and an edge for each piece. Every place keeps one
back pointer: the last piece of the best way there. Only places within the longest piece of the newest one can still be
built on, so the search holds a window of that size; as soon as all ways back from the window meet in one boundary, the
ids before it are final and are given out.

What is best depends on the model's kind. Unigram: the greatest sum of scores. BPE: the segmentation that merging by
score arrives at; it is the one in which each two neighbouring pieces are what merging makes of their joint text, so the
best way to a place is the one whose last step joins such a pair.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.llm.common import text_or_empty

SPACE = "▁"
#: Words and pairs of pieces that one worker remembers.
CACHED_WORDS, CACHED_PAIRS = 500_000, 1_000_000
#: Ids in a batch that is given back to Spark, about.
BATCH_IDS = 1 << 21


class PieceModel:
    """Pieces, scores and kind of a model file, and the search over them."""

    def __init__(self, path: str, kind: str = "bpe", cached: int = CACHED_WORDS):
        import sentencepiece

        if kind not in ("bpe", "unigram"):
            raise ValueError("kind is bpe or unigram")
        self.reader = sentencepiece.SentencePieceProcessor(model_file=path)
        sp, self.kind, self.cached = self.reader, kind, cached
        every = range(sp.vocab_size())
        self.unknown_id = sp.unk_id()
        self.ids = {sp.id_to_piece(i): i for i in every if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        self.scores = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = {int(sp.id_to_piece(i)[1:-1], 16): i for i in every if sp.is_byte(i)}
        self.longest = max(map(len, self.ids), default=1)
        self.least = min(self.scores.values(), default=0.0)
        #: Pieces as a tree of characters; "" leads to the id of the piece that ends there.
        self.tree: dict = {}
        for p, i in self.ids.items():
            node = self.tree
            for c in p:
                node = node.setdefault(c, {})
            node[""] = i
        #: Characters that stand next to each other in some piece: a way through the lattice can be cut between others.
        self.neighbours = {p[n : n + 2] for p in self.ids for n in range(len(p) - 1)}
        self.text_of = {i: p for p, i in self.ids.items()}
        self.score_of = {i: self.scores[p] for p, i in self.ids.items()}
        self.size = sp.vocab_size()
        #: Whether no piece reaches over the start of a word; every way through the lattice then meets there.
        self.words_apart = not any(SPACE in p[1:] and p.strip(SPACE) for p in self.ids)
        line_end = "\n" if not any("\n" in p for p in self.ids) else ""  # then a word of its own
        self.words = re.compile(f"{SPACE}*[^{SPACE}{line_end}]+|{SPACE}+" + ("|\n" if line_end else ""))
        self.bytes_of = [b""] * sp.vocab_size()
        for p, i in self.ids.items():
            self.bytes_of[i] = p.replace(SPACE, " ").encode()
        for b, i in self.byte_ids.items():
            self.bytes_of[i] = bytes([b])
        if self.unknown_id >= 0:
            self.bytes_of[self.unknown_id] = " ⁇ ".encode()
        self.known: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """What merging makes of a short text: time and again the neighbours whose joint piece scores best, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def piece(self, i: int) -> str:
        """The text of a piece; characters that are none have the numbers from the vocabulary's size on."""
        return self.text_of[i] if i < self.size else chr(i - self.size)

    def joins(self, a: int, b: int) -> bool:
        """Whether merging the text of both makes these two pieces of it."""
        x, y = self.piece(a), self.piece(b)
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        found = self.pairs[a << 22 | b] = self.merged(x + y) == [x, y]
        return found

    def search(self, text: str) -> Iterator[list[int]]:
        """The pieces of the best way through the lattice of ``text``, in runs that are given out once they are final."""
        bpe, longest, size, n = self.kind == "bpe", self.longest, self.size, len(text)
        tree, pairs, scores, none = self.tree, self.pairs, self.score_of, self.least - 10.0
        # of the places from `base` on: where the last piece of the best way begins, the piece, the way's score
        base, begins, pieces, best = 0, [-1] + [-2] * n, [-1] * (n + 1), [0.0] * (n + 1)
        if n > 4 * longest:  # a long text: places are made as the window moves on
            begins, pieces, best = begins[: 2 * longest + 1], pieces[: 2 * longest + 1], best[: 2 * longest + 1]
        for start in range(n):
            at = start - base
            if begins[at] != -2:
                node, end, before, way = tree, start, pieces[at], best[at]
                while end < n:
                    node = node.get(text[end])
                    end += 1
                    if node is None:
                        if end > start + 1:
                            break
                        i, node = size + ord(text[start]), {}
                    else:
                        i = node.get("")
                        if i is None:
                            if end > start + 1:
                                continue
                            i = size + ord(text[start])
                    to = end - base
                    if bpe:
                        if begins[to] == -2:
                            fits = before == -1 or pairs.get(before << 22 | i)
                            if fits is None:
                                fits = self.joins(before, i)
                            if fits:
                                begins[to], pieces[to] = start, i
                    else:
                        score = way + scores.get(i, none)
                        if begins[to] == -2 or score > best[to]:
                            begins[to], pieces[to], best[to] = start, i, score
            if len(begins) <= n - base and start + 1 - base >= longest:
                # all that can still be built on lies between here and one piece's length on
                ahead = {p for p in range(start + 1, start + longest + 1) if begins[p - base] != -2}
                while len(ahead) > 1:
                    far = max(ahead)
                    ahead.remove(far)
                    ahead.add(begins[far - base])
                final = ahead.pop()
                if final > base:
                    yield self._way(begins, pieces, base, final)
                    # a piece before the boundary still has a say in the pairs over it
                    del begins[: final - base], pieces[: final - base], best[: final - base]
                    begins[0], base = -1, final
                more = min(2 * longest + start + 1 - base, n - base) + 1 - len(begins)
                begins += [-2] * more
                pieces += [-1] * more
                best += [0.0] * more
        if n > base:
            yield self._way(begins, pieces, base, n)

    def _word(self, word: str) -> bytes:
        """The ids of a word that is not remembered: of its parts, cut where no piece reaches over."""
        if len(word) > 4 * self.longest or self.kind != "bpe":
            return array("i", self.ids_of(self.search(word))).tobytes()
        neighbours, known = self.neighbours, self.known
        cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in neighbours]
        out = []
        for a, b in zip([0, *cuts], [*cuts, len(word)]):
            part = word[a:b]
            ids = known.get(part)
            if ids is None:
                ids = array("i", self.ids_of(self.search(part))).tobytes()
                if len(known) < self.cached:
                    known[part] = ids
            out.append(ids)
        return b"".join(out)

    @staticmethod
    def _way(begins: list[int], pieces: list[int], base: int, end: int) -> list[int]:
        out = []
        while end > base:
            out.append(pieces[end - base])
            end = begins[end - base]
        return out[::-1]

    def ids_of(self, runs: Iterable[list[int]]) -> Iterator[int]:
        """Ids, with a character that is no piece as its bytes, or as unknown if the model has no bytes."""
        after_unknown = False
        for run in runs:
            for i in run:
                if i < self.size:
                    yield i
                elif self.byte_ids:
                    yield from (self.byte_ids[b] for b in chr(i - self.size).encode("utf-8", "surrogatepass"))
                elif not after_unknown:
                    yield self.unknown_id
                after_unknown = i >= self.size

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        line, known, out = self.reader.normalize(text), self.known, []
        if not self.words_apart:
            return np.fromiter(self.ids_of(self.search(line)), np.int32)
        for word in self.words.findall(line):
            ids = known.get(word)
            if ids is None:
                ids = self._word(word)
                if len(known) < self.cached and len(word) <= 64:
                    known[word] = ids
            out.append(ids)
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, without the space that stands before every text."""
        text = b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


@lru_cache(maxsize=1)
def piece_model(path: str, kind: str) -> PieceModel:
    """The model of this worker, kept from task to task with the words it remembers."""
    return PieceModel(path, kind)


def encoded(docs: DataFrame, model_path: str, kind: str = "bpe", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_ids long, ids array<int>, round_trip boolean): each row's ids, and whether decoding them gives the text back
    (with U+2581, which stands for a space in pieces, read as one).

    Null and empty texts have no ids. Repeated rows stay repeated, an empty table gives an empty one, other columns are
    not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, rows, size = piece_model(model_path, kind), [], 0

        def batch_of(rows: list) -> pa.RecordBatch:
            names = ["_id", "n_ids", "ids", "round_trip"]
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(r[1]) for r in rows]))), pa.int32()), pa.array(np.concatenate([r[1] for r in rows]), pa.int32()))
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[1]) for r in rows], pa.int64()), ids, pa.array([r[2] for r in rows], pa.bool_())]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py()
                ids = model.encode(text)
                rows.append((doc, ids, model.decode(ids.tolist()) == text.replace(SPACE, " ")))
                size += len(ids) + 16
                if size >= BATCH_IDS:
                    yield batch_of(rows)
                    rows, size = [], 0
        if rows:
            yield batch_of(rows)

    texts = docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).alias("_text"))
    return texts.mapInArrow(run, "_id long, n_ids long, ids array<int>, round_trip boolean").withColumnRenamed("_id", id_col)


def decoded(rows: DataFrame, model_path: str, kind: str = "bpe", id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the text of each row's ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path, kind)
        for batch in batches:
            texts = [model.decode([i for i in x or [] if i is not None]) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["_id", "text"])

    return rows.select(F.col(id_col).cast("long").alias("_id"), F.col(ids_col).cast("array<int>")).mapInArrow(run, "_id long, text string").withColumnRenamed("_id", id_col)
