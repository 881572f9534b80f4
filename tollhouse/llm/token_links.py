"""Alignment of two tokenizers by their ends, on exactly deduplicated texts.

Texts are shuffled whole, so that each distinct one is tokenised and aligned once, whatever the number of its copies; its
links count as often as it has copies. Measures go back to the rows by the text's hash.

Two tokens are linked where they end at the same byte, so one's bytes are the end of the other's. The id pairs that can ever
be linked follow from the two vocabularies alone: for each token the ends of its bytes that are tokens of the other one. They
are numbered (324,300 for the two public files), a text's links are such numbers, and counts are an array over them. This is
the one thing sent to all tasks, and its size does not depend on the texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.llm.bin_packing import LONG, PATTERN, PLAIN, byte_ranks
from tollhouse.llm.common import stored, text_or_empty

#: Bytes of text that are aligned at a time; a longer text is a batch of its own.
BATCH_BYTES = 1 << 20
#: Width of an id in decimal, with the mark behind it.
DIGITS = 6
_COMMA, _BAR, _SEMICOLON = b",|;"


class Side:
    """One tokenizer: ids of texts, and each id's bytes."""

    def __init__(self, token_bytes: list[bytes]):
        self.token_bytes = token_bytes
        self.lengths = np.array([len(x) for x in token_bytes], np.int64)


class ByteLevel(Side):
    """Byte-level BPE over space + text; strings of added tokens are plain text.

    Merges are worked off by ``tiktoken`` where both libraries cut words alike (see ``bin_packing``), else by ``tokenizers``.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        ranks = byte_ranks(self.tokenizer)
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        table = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            table[i] = piece
        super().__init__(table)

    def ids(self, text: str) -> list[int]:
        if len(text) < LONG and PLAIN.fullmatch(text):
            return self.fast(" " + text)
        return self.tokenizer.encode(" " + text, add_special_tokens=False).ids


class Pieces(Side):
    """A SentencePiece model, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        byte = re.compile("<0x([0-9A-F]{2})>")
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        # unknown and control pieces stand for no bytes
        none = [self.model.is_control(i) or self.model.is_unknown(i) for i in range(len(names))]
        super().__init__([b"" if x else bytes([int(m[1], 16)]) if (m := byte.fullmatch(n)) else n.replace("▁", " ").encode() for n, x in zip(names, none)])

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text, out_type=int)


def linkable(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """All id pairs of which one's bytes are the end of the other's, sorted, as a * len(b) + b."""

    def ids_of(table):
        out: dict[bytes, list[int]] = {}
        for i, x in enumerate(table):
            if x:
                out.setdefault(x, []).append(i)
        return out

    of_a, of_b, n = ids_of(a), ids_of(b), len(b)
    found = {i * n + j for i, x in enumerate(a) for k in range(len(x)) for j in of_b.get(x[k:], ())}
    found |= {i * n + j for j, x in enumerate(b) for k in range(len(x)) for i in of_a.get(x[k:], ())}
    return np.array(sorted(found), np.int64)


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.pairs = linkable(self.a.token_bytes, self.b.token_bytes)
        n = max(len(self.a.lengths), len(self.b.lengths))
        if n > 10 ** (DIGITS - 1):
            raise ValueError("ids of more than five digits")
        text = [str(i).encode() for i in range(n)]
        self.digits = np.frombuffer(b"".join(x.ljust(DIGITS, b"\0") for x in text), np.uint8).reshape(n, DIGITS)
        self.n_digits = np.array([len(x) for x in text], np.int64)

    def tokens(self, text: str) -> tuple[list[int], list[int]]:
        """Both lists of ids; both empty if either side's bytes are not those of space + text."""
        if not text:
            return [], []
        data, a, b = b" " + text.encode("utf-8", "surrogatepass"), self.a.ids(text), self.b.ids(text)
        for side, ids in ((self.a, a), (self.b, b)):
            if b"".join([side.token_bytes[i] for i in ids]) != data:
                return [], []
        return a, b

    def aligned(self, texts: list[str]) -> list[tuple[int, int, int, np.ndarray, str]]:
        """For each text: tokens of A and B, groups, numbers of its linked pairs in order, hash of the groups."""
        both = [self.tokens(t) for t in texts]
        n_a, n_b = (np.array([len(x[k]) for x in both], np.int64) for k in (0, 1))
        a, b = (np.fromiter((i for x in both for i in x[k]), np.int64, int(n.sum())) for k, n in ((0, n_a), (1, n_b)))
        if not len(a):
            return [(0, 0, 0, np.zeros(0, np.int32), "")] * len(texts)
        # texts one after another: both sides have the same bytes, so ends stay comparable and ascend
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        mark = np.zeros(int(ends_a[-1]) + 1, np.uint8)
        mark[ends_a] = 1
        in_b = mark[ends_b] == 1
        mark[ends_b] += 2
        last_a, last_b = np.flatnonzero(mark[ends_a] == 3), np.flatnonzero(in_b)
        links = np.searchsorted(self.pairs, a[last_a] * len(self.b.lengths) + b[last_b]).astype(np.int32)

        # a1,a2|b1;a3|b2,b3; ...: the tokens of A go before those of B in each group
        groups_before_a = np.cumsum(mark[ends_a] == 3) - (mark[ends_a] == 3)
        groups_before_b = np.cumsum(in_b) - in_b
        until_b = np.concatenate(([0], last_b + 1))  # tokens of B in the groups before
        until_a = last_a + 1  # tokens of A up to and with a group
        place_a = np.arange(len(a)) + until_b[groups_before_a]
        place_b = np.arange(len(b)) + until_a[groups_before_b]
        order = np.empty(len(a) + len(b), np.int64)
        order[place_a], order[place_b] = a, b
        sign = np.full(len(order), _COMMA, np.uint8)
        sign[place_a[last_a]], sign[place_b[last_b]] = _BAR, _SEMICOLON
        n = self.n_digits[order]
        letters = self.digits[order]
        letters[np.arange(len(order)), n] = sign
        flat = letters[np.arange(DIGITS) <= n[:, None]].tobytes()
        ends = np.concatenate(([0], np.cumsum(n + 1)))
        stop = np.cumsum(n_a + n_b)
        n_groups = np.searchsorted(last_b, np.cumsum(n_b)) - np.searchsorted(last_b, np.cumsum(n_b) - n_b)
        upto, out, view = np.cumsum(n_groups), [], memoryview(flat)
        for k in range(len(texts)):
            if not n_a[k]:
                out.append((0, 0, 0, np.zeros(0, np.int32), ""))
                continue
            text = view[ends[stop[k] - n_a[k] - n_b[k]] : ends[stop[k]] - 1]
            out.append((int(n_a[k]), int(n_b[k]), int(n_groups[k]), links[upto[k] - n_groups[k] : upto[k]], hashlib.sha256(text).hexdigest()))
        return out


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of this worker, kept from task to task."""
    return Aligner(a_path, b_path)


_ALIGNED = "_key binary, copies long, n_a long, n_b long, n_groups long, links array<int>, groups_sha256 string"


def aligned_texts(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """One row per distinct text: its SHA-256, copies, n_a, n_b, n_groups, links (numbers of the linked pairs, in order) and
    groups_sha256. Null counts as empty."""
    distinct = docs.select(text_or_empty(text_col).alias("_text")).groupBy("_text").agg(F.count(F.lit(1)).alias("copies"))
    keyed = distinct.select(F.sha2("_text", 256).alias("_hex"), "copies", "_text").select(F.unhex("_hex").alias("_key"), "copies", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(a_path, b_path).aligned
        for batch in batches:
            texts = batch.column(2).to_pylist()
            sizes, at = np.array([len(x) for x in texts], np.int64), 0
            while at < len(batch):
                n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), BATCH_BYTES)))
                part, some = batch.slice(at, n), texts[at : at + n]
                at += n
                n_a, n_b, n_groups, links, digests = zip(*align(some))
                offsets = np.concatenate(([0], np.cumsum(n_groups))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(links)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)), lists, pa.array(digests)],
                    names=["_key", "copies", "n_a", "n_b", "n_groups", "links", "groups_sha256"],
                )

    return keyed.mapInArrow(run, _ALIGNED)


def pair_counts(aligned: DataFrame, n_pairs: int) -> DataFrame:
    """(pair int, n long): how many links of all rows hold each pair. A task adds up its texts first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_pairs, np.int64)
        for batch in batches:
            links = batch.column(1)
            times = np.repeat(batch.column(0).to_numpy(), np.diff(links.offsets.to_numpy()))
            np.add.at(total, links.flatten().to_numpy(), times)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["pair", "n"])

    return aligned.select("copies", "links").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def token_links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum (long) and groups_sha256 string.

    A encodes space + text, B the text. Offsets at which a token of both ends cut them into groups, ``a1,a2|b1;a3|b2,b3``; a
    link is a token of A and one of B that end together. A pair's count is how many links of all rows hold it; n_best counts
    the links whose count is the highest of their B id, ties included. Texts null, empty, or that either side changes (such
    as one with U+2581) have no tokens: zeros and an empty string. Repeated rows and ids stay, each with its measures, and
    count each; no rows give no rows; other columns are not read.
    """
    aligned = stored(aligned_texts(docs, a_path, b_path, text_col))
    pairs = aligner(a_path, b_path).pairs
    width = len(aligner(a_path, b_path).b.lengths)
    rows = pair_counts(aligned, len(pairs)).toArrow()  # at most one row for each linkable pair of the vocabularies
    counts = np.zeros(len(pairs), np.int64)
    counts[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    highest = np.zeros(width, np.int64)
    np.maximum.at(highest, pairs % width, counts)
    best = (counts == highest[pairs % width]) & (counts > 0)
    sent = docs.sparkSession.sparkContext.broadcast((counts, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = sent.value
        for batch in batches:
            links = batch.column(4)
            at, flat = links.offsets.to_numpy(), links.flatten().to_numpy()
            sums = [np.concatenate(([0], np.cumsum(x[flat]))) for x in (best.astype(np.int64), counts)]
            n_best, count_sum = (pa.array(x[at[1:] - at[0]] - x[at[:-1] - at[0]]) for x in sums)
            columns = [*(batch.column(i) for i in range(4)), n_best, count_sum, batch.column(5)]
            yield pa.RecordBatch.from_arrays(columns, names=["_key", "n_a", "n_b", "n_groups", "n_best", "count_sum", "groups_sha256"])

    found = aligned.select("_key", "n_a", "n_b", "n_groups", "links", "groups_sha256")
    found = found.mapInArrow(run, "_key binary, n_a long, n_b long, n_groups long, n_best long, count_sum long, groups_sha256 string")
    ids = docs.select(F.col(id_col).cast("long").alias("_id"), F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("_key"))
    return ids.join(found, "_key").select(F.col("_id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
