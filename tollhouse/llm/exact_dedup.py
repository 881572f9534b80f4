"""Exact dedup by Patricia-trie owners.

Texts are dealt by byte length and a hash of the content. Each task puts whole byte strings into a compressed radix trie
whose terminal nodes hold the smallest and the largest identifier and the count. A first trie in every input task
collapses the copies it meets, so that of a text that fills a third of the table only one row per task is dealt out.
A trie that outgrows its budget spills its largest subtree to an unnamed scratch file of the task; strings that lead
into it follow, and it is worked off as a trie of its own at the end.
"""

from __future__ import annotations

import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.llm.common import handing_back, partitions, text_or_empty

#: Bytes that a trie may hold before it spills or, in the first pass, is handed on.
TRIE_BYTES = 96 << 20
#: What a node takes besides its label, about.
NODE_BYTES = 400
#: Rows and bytes that one batch from a trie holds at most (a single longer text makes a batch of its own).
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20
_HEAD = struct.Struct("<qqqI")
#: Stand-ins for "no identifier", beyond every identifier that occurs.
_NO_LOW, _NO_HIGH = (1 << 63) - 1, -(1 << 63)


class _Node:
    __slots__ = ("children", "label", "owner", "spill")

    def __init__(self, label: bytes, owner: tuple[int, int, int] | None = None):
        self.label, self.owner, self.children, self.spill = label, owner, {}, None


def _shared(a: bytes, b: bytes, at: int) -> int:
    """Length of the common start of ``a`` and ``b[at:]``."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[at + low : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _merged(a: tuple[int, int, int] | None, b: tuple[int, int, int]) -> tuple[int, int, int]:
    return b if a is None else (min(a[0], b[0]), max(a[1], b[1]), a[2] + b[2])


class Trie:
    """A compressed radix trie from byte strings to (smallest id, largest id, count)."""

    def __init__(self, budget: int = TRIE_BYTES):
        self.root, self.budget, self.size, self.strings = _Node(b""), budget, 0, 0

    def insert(self, key: bytes, owner: tuple[int, int, int]) -> None:
        node, at = self.root, 0
        while True:
            if node.spill is not None:
                _write(node.spill, key, owner)
                return
            if at == len(key):
                self.strings += node.owner is None
                node.owner = _merged(node.owner, owner)
                return
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = _Node(key[at:], owner)
                self.size += len(key) - at + NODE_BYTES
                self.strings += 1
                if self.size > self.budget and self.strings > 1:
                    self._spill()
                return
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            n = _shared(child.label, key, at)
            fork = _Node(child.label[:n])
            child.label = child.label[n:]
            fork.children[child.label[0]] = child
            node.children[key[at]] = fork
            self.size += NODE_BYTES
            node, at = fork, at + n

    def _spill(self) -> None:
        """The largest subtree below the first fork goes to a scratch file."""
        node, start = self.root, b""
        while len(node.children) == 1 and node.owner is None and node.spill is None:
            node = next(iter(node.children.values()))
            start += node.label
        inside = [(sum(len(x.label) + NODE_BYTES for x, _ in _walk(c, b"")), c) for c in node.children.values() if c.spill is None]
        if not inside:
            return
        size, child = max(inside, key=lambda x: x[0])
        out = tempfile.TemporaryFile()  # noqa: SIM115  unnamed: it goes with the task
        for x, key in _walk(child, start):
            if x.owner is not None:
                _write(out, key, x.owner)
                self.strings -= 1
            if x.spill is not None:
                for below, owner in _read(x.spill):
                    _write(out, below, owner)
                x.spill.close()
        # what hangs below may not move again; its first byte stays here as the way to the file
        child.spill, child.children, child.owner, child.label = out, {}, None, child.label[:1]
        self.size -= size - NODE_BYTES

    def owners(self) -> Iterator[tuple[bytes, tuple[int, int, int]]]:
        """Each string with its owner, once; spilled subtrees after the rest."""
        spilled = []
        for node, key in _walk(self.root, b""):
            if node.owner is not None:
                yield key, node.owner
            if node.spill is not None:
                spilled.append(node.spill)
        self.root = _Node(b"")
        for file in spilled:
            again = Trie(self.budget)
            for key, owner in _read(file):
                again.insert(key, owner)
            file.close()
            yield from again.owners()


def _walk(node: _Node, start: bytes) -> Iterator[tuple[_Node, bytes]]:
    todo = [(node, start + node.label)]
    while todo:
        node, key = todo.pop()
        yield node, key
        todo += [(c, key + c.label) for c in node.children.values()]


def _write(file, key: bytes, owner: tuple[int, int, int]) -> None:
    file.write(_HEAD.pack(*owner, len(key)))
    file.write(key)


def _read(file) -> Iterator[tuple[bytes, tuple[int, int, int]]]:
    file.seek(0)
    while head := file.read(_HEAD.size):
        *owner, n = _HEAD.unpack(head)
        yield file.read(n), tuple(owner)


_PART = pa.schema([("_bytes", pa.binary()), ("_low", pa.int64()), ("_high", pa.int64()), ("_n", pa.int64())])
_PART_DDL = "_bytes binary, _low long, _high long, _n long"


def _batches(found: Iterator[tuple[bytes, tuple[int, int, int]]]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for key, owner in found:
        rows.append((key, *owner))
        size += len(key)
        if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PART)], schema=_PART)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PART)], schema=_PART)


def _owned(budget: int, hand_on: bool):
    """A pass over the rows of one task; ``hand_on``: a full trie is given out instead of spilled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(2 * budget if hand_on else budget)
        for batch in batches:
            keys, low, high, n = (batch.column(i) for i in range(4))
            for key, owner in zip(keys, zip(low.to_pylist(), high.to_pylist(), n.to_pylist())):
                trie.insert(key.as_py(), owner)
                if hand_on and trie.size > budget:
                    yield from _batches(trie.owners())
                    trie = Trie(2 * budget)
        yield from _batches(trie.owners())

    return run


def text_owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct text: text_bytes, smallest_id, largest_id (null where all ids are), group_size long.

    No rows give no rows; null counts as the empty text, and rows with a null id count in the size only.
    """
    ids = F.col(id_col).cast("long")
    rows = docs.select(text_or_empty(text_col).cast("binary").alias("_bytes"), F.coalesce(ids, F.lit(_NO_LOW)).alias("_low"), F.coalesce(ids, F.lit(_NO_HIGH)).alias("_high"), F.lit(1).cast("long").alias("_n"))
    parts = rows.mapInArrow(handing_back(_owned(budget, True)), _PART_DDL)
    dealt = parts.repartition(partitions(docs.sparkSession), F.length("_bytes"), F.xxhash64("_bytes"))
    owners = dealt.mapInArrow(handing_back(_owned(budget, False)), _PART_DDL)
    return owners.select(
        F.col("_bytes").alias("text_bytes"),
        F.when(F.col("_low") != _NO_LOW, F.col("_low")).alias("smallest_id"),
        F.when(F.col("_high") != _NO_HIGH, F.col("_high")).alias("largest_id"),
        F.col("_n").alias("group_size"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", budget: int = TRIE_BYTES) -> DataFrame:
    """One row per input row: the id, keep_id (of the row that stays), group_size long, kept boolean, text_sha256.

    ``keep`` is "largest" or "smallest". Texts are equal when their bytes are. Null text counts as empty. Of rows with the
    same text and the same id, one is kept; rows with a null id are kept only where their whole group has none (again one
    of them). Other columns of ``docs`` are not read; an empty table gives an empty one.
    """
    owners = text_owners(docs, id_col, text_col, budget).where("group_size > 1")
    groups = owners.select(
        F.sha2("text_bytes", 256).alias("text_sha256"), F.length("text_bytes").alias("_bytes"), F.col(f"{keep}_id").alias("_keep"), F.col("group_size").alias("_size")
    )
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.sha2(text.cast("binary"), 256).alias("text_sha256"), F.octet_length(text).alias("_bytes"))
    rows = rows.groupBy(id_col, "text_sha256", "_bytes").agg(F.count(F.lit(1)).alias("_copies"))
    found = rows.join(groups, ["text_sha256", "_bytes"], "left")
    found = found.withColumn("_keep", F.when(F.col("_size").isNull(), F.col(id_col)).otherwise(F.col("_keep")))
    return found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy")).select(
        id_col,
        F.col("_keep").alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col(id_col).eqNullSafe(F.col("_keep")) & (F.col("_copy") == 1)).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they were."""
    from pyspark.sql import Window

    flags = exact_dedup(docs, id_col, text_col, keep).where("kept").select(F.col(id_col).alias("kept_id"), F.col("text_sha256").alias("sha"))
    # the row as one struct, so that none of its names can clash
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("id"), F.sha2(text_or_empty(text_col).cast("binary"), 256).alias("key"))
    stay = keyed.join(flags, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("sha")), "left_semi")
    one = Window.partitionBy("id", "key").orderBy(F.lit(0))
    return stay.withColumn("copy", F.row_number().over(one)).where("copy = 1").select("row.*")
