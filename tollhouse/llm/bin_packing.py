"""Best-fit packing by minimum bin slack.

Documents become token ids and, where longer than a sequence, pieces. What decides a packing is only how many pieces
there are of each length: at most as many numbers as a sequence has tokens. On these counts each bin takes the largest
length left and, by a subset-sum dynamic programme over bitsets, the fullest combination of the lengths available; the
combination is taken as often as the counts allow. Pieces then find their bins by their rank among those of their length.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.llm.common import ranked, stored, text_or_empty

# How the byte-level tokenizer cuts a text into words before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of these characters only take the fast way: both libraries class them alike (a test goes through them all).
PLAIN = re.compile("[\0-ɏ]*")
#: Characters from which on a text takes the slow way: the fast way's cutting needs stack for very long words.
LONG = 200_000


def byte_ranks(tokenizer) -> dict[bytes, int]:
    """The tokenizer's pieces as bytes with their ids, which are in the order of the merges. A byte is written as
    its own character if that is printable Latin-1, else as the next free one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in own}
    byte_of |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(own))}
    added = set(tokenizer.get_added_tokens_decoder())
    return {bytes(byte_of[c] for c in piece): i for piece, i in tokenizer.get_vocab(with_added_tokens=False).items() if i not in added}


class Encoder:
    """Ids of byte-level BPE texts as little-endian 32-bit bytes.

    The file is read by ``tokenizers`` and taken as it is: the string of an added token is that token, wherever it stands.
    Its pieces and merges are handed to the faster merging of ``tiktoken`` for texts of plain characters without such a
    string; all others are encoded by ``tokenizers`` itself. The ids are the same.
    """

    def __init__(self, tokenizer_path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_ranks(self.tokenizer), special_tokens={}).encode_ordinary

    def encode(self, text: str) -> bytes:
        if len(text) < LONG and PLAIN.fullmatch(text) and not any(x in text for x in self.added):
            return array("I", self.fast(text)).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


@lru_cache(maxsize=1)
def encoder(tokenizer_path: str) -> Encoder:
    """The encoder of this worker, kept from task to task."""
    return Encoder(tokenizer_path)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: whole sequences, but for a shorter first piece if the length asks for one."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


_PIECES = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece int, start, length, ids_crc32 long[, ids array<int>]): each document's ids with ``end_id`` after them,
    cut to ``capacity``. Null text counts as empty: one piece with the end id. Repeated rows give repeated pieces."""
    ddl = "_id long, " + _PIECES + (", ids array<int>" if with_ids else "")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = memoryview(encode(text.as_py()) + end)
                for i, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + n)]
                    for column, x in zip(rows, (doc, i, start, n, zlib.crc32(own), own if with_ids else None)):
                        column.append(x)
            columns = [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:5])]
            names = ["_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array([np.frombuffer(x, "<i4") for x in rows[5]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    texts = docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).alias("_text"))
    return texts.mapInArrow(run, ddl).withColumnRenamed("_id", id_col)


@dataclass(frozen=True)
class Bins:
    """``times`` bins, from number ``first`` on, each with these lengths: (length, how many, offset of the first)."""

    first: int
    times: int
    items: tuple[tuple[int, int, int], ...]


def fullest(counts: Mapping[int, int], capacity: int) -> dict[int, int]:
    """How many of each length go into one bin: the largest one, and with it the combination that fills most.

    ``reach`` has bit s set where lengths taken so far can sum to s; a length's copies are added one after another, and
    the bitset before each addition tells afterwards which were needed.
    """
    order = sorted((x for x, n in counts.items() if n), reverse=True)
    largest = order[0]
    room = capacity - largest
    full, reach, steps = (1 << room + 1) - 1, 1, []
    for x in order:
        for _ in range(min(counts[x] - (x == largest), room // x)):
            if reach >> room & 1:
                break
            more = (reach | reach << x) & full
            if more == reach:
                break
            steps.append((x, reach))
            reach = more
        if reach >> room & 1:
            break
    at, taken = reach.bit_length() - 1, {largest: 1}
    for x, before in reversed(steps):
        if not before >> at & 1:
            taken[x] = taken.get(x, 0) + 1
            at -= x
    return taken


def plan(counts: Mapping[int, int], capacity: int) -> list[Bins]:
    """Bins for the counts of lengths (1 to ``capacity``). Each entry uses some length up to less than a bin's share of
    it, so the entries are bounded by the capacity, whatever the counts."""
    left, out, first = {x: n for x, n in counts.items() if n}, [], 0
    while left:
        taken = fullest(left, capacity)
        times = min(left[x] // n for x, n in taken.items())
        items, at = [], 0
        for x in sorted(taken, reverse=True):
            items.append((x, taken[x], at))
            at += x * taken[x]
            left[x] -= times * taken[x]
            if not left[x]:
                del left[x]
        out.append(Bins(first, times, tuple(items)))
        first += times
    return out


def packed(parts: DataFrame, capacity: int = 1024, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """``parts`` (with a ``length`` of 1 to ``capacity`` on each row) with sequence_id and offset: long, gapless in each
    sequence. Rows that agree in ``order`` and length may change places. No rows give no rows."""
    parts = stored(parts)
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    table: dict[int, list[tuple[int, int, int, int, int]]] = {}
    for bins in plan(counts, capacity):
        for x, n, offset in bins.items:
            runs = table.setdefault(x, [])
            begin = runs[-1][0] + runs[-1][1] if runs else 0
            runs.append((begin, bins.times * n, n, bins.first, offset))
    runs_of = {x: np.array(runs, np.int64).T for x, runs in table.items()}

    @F.pandas_udf("struct<sequence_id:long, offset:long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        x, r = length.to_numpy(), rank.to_numpy()
        sequence, offset = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        for size in np.unique(x):
            at = np.flatnonzero(x == size)
            begin, _, each, first, start = runs_of[size]
            run = np.searchsorted(begin, r[at], side="right") - 1
            k = r[at] - begin[run]
            sequence[at] = first[run] + k // each[run]
            offset[at] = start[run] + k % each[run] * size
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    rows = ranked(parts, list(order), within=["length"], rank="_rank")
    return rows.withColumn("_place", place("length", "_rank")).select("*", "_place.sequence_id", "_place.offset").drop("_place", "_rank")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and place: see ``pieces`` and ``packed``."""
    if capacity < 1:
        raise ValueError("capacity is at least 1")
    return packed(pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col, with_ids), capacity, (id_col, "piece", "ids_crc32"))


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids array<int>): each sequence's ids in order, from pieces packed ``with_ids``. A group holds at
    most one sequence's capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed_pieces.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
