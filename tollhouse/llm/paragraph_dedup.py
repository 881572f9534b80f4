"""Substring dedup: paragraph MinHash banding, exact Jaccard, and removal by components; then exact passages.

One pass over the texts hashes words, lines and runs of words, and is written as a table that all later steps read by
columns. Paragraphs are lines of at least ``min_words`` words; equal ones are one node, and so are lines with the same set
of at most three shingles, as nothing but an equal set is similar to so small a one. All other nodes whose MinHash values
agree in a band meet in a bucket. In each bucket all are compared with its least node; what is left in other components after
that is compared, in blocks, with the bucket's other members. So no link is lost that banding finds, and yet a bucket of very
many near-equal paragraphs makes one row for each of them, not one for each pair.

A passage inside differing paragraphs, or over several lines, shows in no paragraph's likeness. So all windows of
``PASSAGE`` words that stand in two documents are looked for among the words that paragraphs leave. Any such window holds an
anchor, a run of ``RUN`` words whose hash is the least of its neighbours, at the same place in each copy: only windows
around anchors that several documents share are compared. What the first step removes neither goes again nor stands for
others, so of every repeated passage a copy remains.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.llm.common import handing_back, stored, text_or_empty, written
from tollhouse.llm.components import components

MIN_WORDS, SHINGLE, SIMILARITY = 50, 5, 0.8
#: Rows in a band, and the share of pairs at the threshold that banding is to find.
BAND_ROWS, RECALL = 3, 0.999
#: Words of a repeated passage, and of the runs among which its anchors are.
PASSAGE, RUN = 51, 16
#: Paragraphs on either side of a comparison in blocks, and shingles compared at a time there.
BLOCK, COLUMNS = 400, 4096
#: Rows up to which a side of a join is broadcast; beyond, both sides are shuffled.
BROADCAST_ROWS = 400_000
#: Bytes hashed at a time; a single longer text is a batch of its own, hashed in parts that end with a word.
BATCH_BYTES = 1 << 18

_M64 = (1 << 64) - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.random.default_rng(12).integers(0, 2, 256, dtype=np.uint64)


def bands_for(similarity: float, rows: int = BAND_ROWS, recall: float = RECALL) -> int:
    """The fewest bands of ``rows`` values that find a pair of this similarity with the given probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def largest_alone(similarity: float) -> int:
    """The most shingles (three at the very most) of a set that nothing but an equal set is similar to."""
    return max((m for m in (1, 2, 3) if m < similarity * (m + 1)), default=0)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return x ^ (x >> np.uint64(29))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` or more powers of an odd number and of its inverse, kept for the next call."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = max(n, 1 << 16)
        up, down = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)))) for x in (base, pow(base, -1, 1 << 64)))
        if size > 1 << 20:
            return up, down
        _POWERS[base] = up, down
    up, down = _POWERS[base]
    return up[:n], down[:n]


def _run_hashes(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of each run of ``n`` words, from the words' hashes, by sums of products with powers of an odd number."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    up, down = _powers(seed | 1, len(words))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * down)))
    return _mixed((sums[n:] - sums[:-n]) * up[: len(words) - n + 1])


def _least_of(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each ``n`` neighbouring values, by doubling."""
    width = 1
    while width < n:
        step = min(width, n - width)
        x = np.minimum(x[:-step], x[step:])
        width += step
    return x


def anchors(hashes: np.ndarray, gap: int, stops: np.ndarray | None = None) -> np.ndarray:
    """Places whose hash is the least of some ``gap`` neighbouring ones. ``stops``: for each place, the place at which its
    text ends; neighbours are of one text. Texts of fewer places have none, but for the only text's least."""
    n = len(hashes)
    if stops is None:
        if n <= gap:
            return np.array([int(np.argmin(hashes))]) if n else np.zeros(0, np.int64)
        stops = np.full(n, n)
    if n < gap:
        return np.zeros(0, np.int64)
    least = _least_of(hashes, gap)
    inside = np.arange(len(least)) + gap <= stops[: len(least)]
    high = np.where(inside, ~least, np.uint64(_M64))
    # a place is an anchor if its hash equals the least of a window that it lies in
    edge = np.full(gap - 1, _M64, np.uint64)
    cover = ~_least_of(np.concatenate((edge, high, edge)), gap)
    return np.flatnonzero((hashes == cover) & (cover > 0))


def word_hashes(data: bytes, part: int = BATCH_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words of UTF-8 bytes; words are what stands between white space."""
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(at + part, len(data))
        if end < len(data):  # on to the end of a word
            stop = _NEXT_SPACE.search(data, end)
            end = stop.start() if stop else len(data)
        d = np.frombuffer(data, np.uint8, end - at, at)
        space = _SPACE[d]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True]))))
        first, last = edges[::2], edges[1::2]
        up, down = _powers(0xD6E8FEB86659FD93, len(d))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[d] * down)))
        if len(first):
            starts.append(first + at)
            hashes.append(_mixed((sums[last] - sums[first]) * up[first]))
        at = end
    return (np.concatenate(starts), np.concatenate(hashes)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


_NEXT_SPACE = re.compile(rb"[\x20\x09-\x0D]")


class Hashed:
    """Some texts with the hashes of all their words."""

    def __init__(self, texts: list[bytes]):
        data = b"\n".join(texts)
        starts, self.words = word_hashes(data)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        begins = np.cumsum(sizes) - sizes
        #: the first word of each text, and one more
        self.texts = np.append(np.searchsorted(starts, begins), len(starts))
        # a line begins with the first word after a line break
        breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
        lines = np.unique(np.concatenate((np.searchsorted(starts, breaks), self.texts)))
        #: first word and words of each line that has any
        self.lines, self.line_words = lines[:-1], np.diff(lines)

    def text_of(self, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.texts, word, "right") - 1

    def stops(self) -> np.ndarray:
        """For each word the place after the last one of its text."""
        return np.repeat(self.texts[1:], np.diff(self.texts))


def _batched(batches: Iterator[pa.RecordBatch], column: int = 1) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows with their texts as bytes, some at a time."""
    for batch in batches:
        texts = batch.column(column).cast(pa.binary())
        ends, at = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64) + 1), 0
        while at < len(batch):
            before = int(ends[at - 1]) if at else 0
            n = max(1, int(np.searchsorted(ends, before + BATCH_BYTES, "right")) - at)
            yield batch.slice(at, n), texts.slice(at, n).to_pylist()
            at += n


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values, kind))


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, so many of each, one after another."""
    return np.arange(int(counts.sum())) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


_FACTS = "_id long, tag long, p_first array<int>, p_n array<int>, p_key array<long>, p_check array<long>, p_bands array<array<long>>, a_first array<int>, a_key array<long>"
_RUN_SEED, _SHINGLE_SEED = 0x8BB84B93962EACC9, 0xA0761D6478BD642F
#: Bits of a band's key; the number of the band stands above them.
_BAND_BITS = 52


def _facts(min_words: int, shingle: int, similarity: float, passage: int, run: int):
    """Paragraphs and anchors of each text."""
    bands, alone = bands_for(similarity), largest_alone(similarity)
    rng = np.random.default_rng(20)
    factors = rng.integers(0, 1 << 63, bands * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    adds = rng.integers(0, 1 << 63, bands * BAND_ROWS, dtype=np.uint64)

    def paragraphs(x: Hashed) -> tuple:
        long = x.line_words >= min_words
        first, n = x.lines[long], x.line_words[long]
        if not len(first):
            none = np.zeros(0, np.int64)
            return first, n, none, none, none, none
        # a paragraph's digest is that of its words in order
        at, starts = _ranges(first, n), np.cumsum(n) - n
        words, place = x.words[at], np.arange(len(at)) - np.repeat(starts, n)
        most = int(n.max())
        key = _mixed(np.add.reduceat(words * _powers(0x2545F4914F6CDD1D, most)[0][place], starts) + n.astype(np.uint64))
        check = _mixed(np.add.reduceat(_mixed(words) * _powers(0xD1342543DE82EF95, most)[0][place], starts))
        m = n - shingle + 1
        s, starts = _run_hashes(x.words, shingle, _SHINGLE_SEED)[_ranges(first, m)], np.cumsum(m) - m
        # sets of at most three shingles: the least, the greatest, and one between
        low, high = np.minimum.reduceat(s, starts), np.maximum.reduceat(s, starts)
        between = (s != np.repeat(low, m)) & (s != np.repeat(high, m))
        mid_low = np.minimum.reduceat(np.where(between, s, np.uint64(_M64)), starts)
        mid_high = np.maximum.reduceat(np.where(between, s, np.uint64(0)), starts)
        some = mid_low != np.uint64(_M64)
        distinct = np.where(some, np.where(mid_low == mid_high, 3, 4), np.where(low == high, 1, 2))
        small = distinct <= alone
        mid = np.where(some, mid_low, np.uint64(0))
        key = np.where(small, _mixed(low + _mixed(mid + _mixed(high))), key)
        check = np.where(small, _mixed(high + _mixed(low + _mixed(mid))), check)
        # MinHash of the others
        large = np.flatnonzero(~small)
        s, starts = s[_ranges(starts[large], m[large])], np.cumsum(m[large]) - m[large]
        keys = np.zeros((len(large), bands), np.uint64)
        if len(large):
            for j in range(bands):
                value = np.full(len(large), j, np.uint64)
                for k in range(j * BAND_ROWS, (j + 1) * BAND_ROWS):
                    value = _mixed(value * _ODD + np.minimum.reduceat((s ^ adds[k]) * factors[k], starts))
                keys[:, j] = (value >> np.uint64(64 - _BAND_BITS)) + (np.uint64(j) << np.uint64(_BAND_BITS))
        return first, n, key, check >> np.uint64(1), np.where(small, 0, bands), keys.ravel()

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _batched(batches):
            x = Hashed(texts)
            first, n, key, check, n_bands, keys = paragraphs(x)
            of = x.text_of(first)
            pars = np.bincount(of, minlength=len(texts))
            nested = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(pars))), pa.int32()), _lists(keys.view(np.int64), n_bands, pa.int64()))
            hashes = _run_hashes(x.words, run, _RUN_SEED)
            at = anchors(hashes, passage - run + 1, x.stops()[: len(hashes)] - run + 1)
            text = x.text_of(at)
            found = np.bincount(text, minlength=len(texts))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    rows.column(2),
                    _lists((first - x.texts[of]).astype(np.int32), pars, pa.int32()),
                    _lists(n.astype(np.int32), pars, pa.int32()),
                    _lists(key.astype(np.uint64).view(np.int64), pars, pa.int64()),
                    _lists(check.astype(np.uint64).view(np.int64), pars, pa.int64()),
                    nested,
                    _lists((at - x.texts[text]).astype(np.int32), found, pa.int32()),
                    _lists(hashes[at].view(np.int64), found, pa.int64()),
                ],
                names=["_id", "tag", "p_first", "p_n", "p_key", "p_check", "p_bands", "a_first", "a_key"],
            )

    return run_


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_tag"))


def facts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = SHINGLE, shingle: int = SHINGLE, similarity: float = SIMILARITY, passage: int = PASSAGE, run: int = RUN) -> DataFrame:
    """What both steps read of the texts, as a table. Ids with several different texts are left out."""
    if not shingle <= min_words or not 0 < run <= passage:
        raise ValueError("a paragraph has a shingle, a passage a run")
    found = written(_texts(docs, id_col, text_col).mapInArrow(handing_back(_facts(min_words, shingle, similarity, passage, run)), _FACTS))
    clash = found.groupBy("_id").agg(F.min("tag").alias("_a"), F.max("tag").alias("_z")).where("_a != _z").select("_id")
    clash = stored(clash)
    return found if clash.isEmpty() else found.join(clash, "_id", "left_anti")


def _few(side: DataFrame) -> DataFrame:
    """A stored side of a join, to be broadcast if its count allows."""
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def _shingles_of(shingle: int):
    """(node, shingles): the sorted distinct shingles of wanted paragraphs, from texts and (first, n, node) of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _batched(batches, 0):
            x = Hashed(texts)
            s = _run_hashes(x.words, shingle, _SHINGLE_SEED)
            nodes, sets = [], []
            for k, want in enumerate(rows.column(1).to_pylist()):
                for w in want:
                    at = int(x.texts[k]) + w["first"]
                    nodes.append(w["node"])
                    sets.append(np.unique(s[at : at + w["n"] - shingle + 1]))
            if nodes:
                flat = np.concatenate(sets)
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), _lists(flat.view(np.int64), np.array([len(x) for x in sets]), pa.int64())], names=["node", "shingles"])

    return run


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    at, flat = column.offsets.to_numpy(), column.flatten().to_numpy().view(np.uint64)
    return [flat[a - at[0] : b - at[0]] for a, b in zip(at[:-1], at[1:])]


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Exact Jaccard similarity of sorted distinct shingles of at least ``threshold``; sizes alone rule out most others."""
    if min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= threshold * (len(a) + len(b) - both)


def shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of the one list has in common with each of the other, by products of blocks of columns."""
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float64)
    for at in range(0, len(both), COLUMNS):
        columns = both[at : at + COLUMNS]
        sides = []
        for sets in (left, right):
            has = np.zeros((len(sets), len(columns)), np.float32)
            for i, s in enumerate(sets):
                k = np.searchsorted(columns, s[np.searchsorted(s, columns[0]) : np.searchsorted(s, columns[-1], "right")])
                s = s[np.searchsorted(s, columns[0]) : np.searchsorted(s, columns[-1], "right")]
                has[i, k[columns[k] == s]] = 1
            sides.append(has)
        out += sides[0] @ sides[1].T
    return out


def _paragraph_spans(known: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(_id, first, n, keep_id) from ``facts``."""
    each = F.inline(F.arrays_zip(*(F.col(f"p_{c}").alias(c) for c in ("first", "n", "key", "check"))))
    pars = known.select("_id", each)
    with_bands = known.select("_id", F.inline(F.arrays_zip(*(F.col(f"p_{c}").alias(c) for c in ("first", "n", "key", "check", "bands")))))
    place = F.struct("_id", "first", "n")
    nodes = with_bands.groupBy("key", "check").agg(F.min(place).alias("owner"), F.max(F.struct("_id", "first")).alias("last"), F.any_value("bands").alias("bands"))
    copied = (F.col("owner._id") != F.col("last._id")) | (F.col("owner.first") != F.col("last.first"))
    # numbered where they are written, so that what is shuffled from here on is short
    nodes = written(nodes.select("key", "check", "owner", "bands", copied.alias("copied"), F.monotonically_increasing_id().alias("node")))

    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = entries.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("other"), F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = stored(buckets)
    large = stored(buckets.where("size > 2").select("bucket", "hub", "size"))
    members = stored(entries.join(_few(large), "bucket"))
    stars = buckets.where("size = 2").select(F.col("other").alias("node"), "hub").union(members.where("node != hub").select("node", "hub")).distinct()
    stars = stored(stars)

    # the shingles of the paragraphs that meet others, from one copy of each
    wanted = stars.select("node").union(stars.select("hub")).distinct().join(nodes.select("node", "owner"), "node")
    wanted = wanted.groupBy(F.col("owner._id").alias("_id")).agg(F.collect_list(F.struct("owner.first", "owner.n", "node")).alias("_want"))  # at most a document's lines
    found = texts.select("_id", "_text").join(_few(stored(wanted)), "_id").select("_text", "_want")
    sets = stored(found.mapInArrow(handing_back(_shingles_of(shingle)), "node long, shingles array<long>").dropDuplicates(["node"]))

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = [similar(a, b, similarity) for a, b in zip(_arrays(batch.column(2)), _arrays(batch.column(3)))]
            yield batch.select([0, 1]).filter(pa.array(yes, pa.bool_()))

    hubs = sets.select(F.col("node").alias("hub"), F.col("shingles").alias("hub_shingles"))
    pairs = stars.join(sets, "node").join(hubs, "hub").select("node", "hub", "shingles", "hub_shingles")
    links = stored(pairs.mapInArrow(alike, "node long, hub long"))
    roots = stored(components(links, "node", "hub"))

    # what larger buckets brought together and the stars left apart
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    hub_root = placed.where("node = hub").select("bucket", F.col("root").alias("hub_root"))
    placed = placed.join(hub_root, "bucket").withColumn("apart", F.col("root") != F.col("hub_root"))
    apart = placed.groupBy("bucket").agg(F.count_if("apart").alias("_apart")).where("_apart > 0")
    placed = placed.join(apart, "bucket").where("node != hub").join(sets, "node")
    left_blocks, right_blocks = F.ceil(F.col("_apart") / BLOCK).cast("int"), F.ceil(F.col("size") / BLOCK).cast("int")
    own, other = F.xxhash64("node", F.lit(1)), F.xxhash64("node", F.lit(2))
    left = placed.where("apart").select("*", F.lit(True).alias("_left"), F.explode(F.sequence(F.lit(0), right_blocks - 1)).alias("_j")).withColumn("_i", F.pmod(own, left_blocks).cast("int"))
    right = placed.select("*", F.lit(False).alias("_left"), F.explode(F.sequence(F.lit(0), left_blocks - 1)).alias("_i")).withColumn("_j", F.pmod(other, right_blocks).cast("int"))
    names = ["bucket", "_i", "_j", "_left", "shingles", "node", "root"]
    blocks = left.select(*names).unionByName(right.select(*names))

    def compare(table: pa.Table) -> pa.Table:
        """Links between components of one block: fewer than there are components in it."""
        table = table.combine_chunks()
        is_left, nodes, above = np.array(table["_left"].to_pylist(), bool), table["node"].to_numpy(), table["root"].to_numpy()
        sets = _arrays(table["shingles"].chunk(0)) if len(table) else []
        left, right = np.flatnonzero(is_left), np.flatnonzero(~is_left)
        out: list[tuple[int, int]] = []
        if len(left) and len(right):
            common = shared([sets[i] for i in left], [sets[j] for j in right])
            sizes = np.array([len(s) for s in sets])
            yes = common >= similarity * (sizes[left][:, None] + sizes[right][None, :] - common)
            yes &= above[left][:, None] != above[right][None, :]
            i, j = np.nonzero(yes)
            _, one = np.unique(np.stack((above[left[i]], above[right[j]])), axis=1, return_index=True)
            top = {r: r for r in above.tolist()}  # a link joins two components: at most one less than there are
            for a, b in ((left[i[k]], right[j[k]]) for k in one):
                x, y = int(above[a]), int(above[b])
                while top[x] != x:
                    top[x] = x = top[top[x]]
                while top[y] != y:
                    top[y] = y = top[top[y]]
                if x != y:
                    top[x] = y
                    out.append((int(nodes[a]), int(nodes[b])))
        return pa.table([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["node", "hub"])

    more = stored(blocks.groupBy("bucket", "_i", "_j").applyInArrow(compare, "node long, hub long"))
    if not more.isEmpty():
        roots = stored(components(roots.withColumnRenamed("root", "hub").unionByName(more), "node", "hub"))

    classes = nodes.select("key", "check", "copied", "node", F.struct("owner._id", "owner.first").alias("owner"))
    linked = classes.join(roots, "node")
    heads = linked.groupBy("root").agg(F.min("owner").alias("head"))
    named = linked.join(heads, "root").select("key", "check", "head")
    alone = classes.where("copied").join(roots, "node", "left_anti").select("key", "check", F.col("owner").alias("head"))
    gone = pars.join(named.unionByName(alone), ["key", "check"]).where("_id != head._id OR first != head.first")
    return gone.select("_id", "first", "n", F.col("head._id").alias("keep_id")).distinct()


def paragraph_removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(id, first int, n int, keep_id): paragraphs, as word spans of their document, that a like one of ``keep_id`` stands for."""
    known = facts(docs, id_col, text_col, min_words, shingle, similarity)
    return _paragraph_spans(known, _texts(docs, id_col, text_col), shingle, similarity).withColumnRenamed("_id", id_col)


def _left_over(run: int):
    """(_id, first, key): anchors whose run no removed span touches."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, first, key, gone in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3).to_pylist()):
                first, key = first.values.to_numpy(), key.values.to_numpy()
                free = ~touched(first, run, gone)
                out.append((np.full(int(free.sum()), doc, np.int64), first[free], key[free]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["_id", "first", "key"])

    return go


def touched(first: np.ndarray, n: int, gone: list | None) -> np.ndarray:
    """Which of the runs of ``n`` words from these places share a word with a span (first, n)."""
    if not gone:
        return np.zeros(len(first), bool)
    spans = np.array(sorted((s["first"], s["first"] + s["n"]) for s in gone))
    ends = np.maximum.accumulate(spans[:, 1])
    k = np.searchsorted(spans[:, 0], first + n)  # spans that begin before the run ends
    return (k > 0) & (ends[np.maximum(k - 1, 0)] > first)


def _windows(passage: int, run: int):
    """(_id, first, key, check): the windows around wanted anchors that no removed span touches."""
    seeds = (0xE7037ED1A0B428DB, 0x2D358DCCAA6C78A5)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _batched(batches):
            x, out = Hashed(texts), []
            key, check = _run_hashes(x.words, passage, seeds[0]), _run_hashes(_mixed(x.words), passage, seeds[1])
            for k, (doc, want, gone) in enumerate(zip(rows.column(0).to_pylist(), rows.column(2), rows.column(3).to_pylist())):
                want = want.values.to_numpy()
                at = np.unique((want[:, None] + np.arange(run - passage, 1)[None, :]).ravel())
                at = at[(at >= 0) & (at + passage <= x.texts[k + 1] - x.texts[k])]
                at = at[~touched(at, passage, gone)]
                if len(at):
                    here = at + x.texts[k]
                    out.append((np.full(len(at), doc, np.int64), at.astype(np.int32), key[here].view(np.int64), (check[here] >> np.uint64(33)).astype(np.int32)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["_id", "first", "key", "check"])

    return go


_SPAN = "array<struct<first:int,n:int,keep_id:long>>"


def _owners(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, keep_id): what several documents hold, with the smallest of these."""
    return rows.groupBy(*keys).agg(F.min("_id").alias("keep_id"), F.max("_id").alias("_last")).where("keep_id != _last").drop("_last")


def _passage_spans(known: DataFrame, texts: DataFrame, gone: DataFrame, passage: int, run: int) -> DataFrame:
    """(_id, first, n, keep_id) from ``facts`` and the spans (_id, first, n) that are gone already."""
    lost = gone.groupBy("_id").agg(F.collect_list(F.struct("first", "n")).alias("_gone"))  # at most a document's lines
    lost = stored(lost)
    rows = known.where(F.size("a_key") > 0).select("_id", "a_first", "a_key").join(_few(lost), "_id", "left")
    left = written(rows.mapInArrow(handing_back(_left_over(run)), "_id long, first int, key long"))
    several = stored(_owners(left, "key").select("key"))
    hits = left.join(_few(several), "key").groupBy("_id").agg(F.collect_set("first").alias("_want"))  # at most a document's anchors
    wanted = stored(hits.join(lost, "_id", "left"))
    found = texts.select("_id", "_text").join(_few(wanted), "_id").select("_id", "_text", "_want", "_gone")
    windows = written(found.mapInArrow(handing_back(_windows(passage, run)), "_id long, first int, key long, `check` int"))
    owners = stored(_owners(windows, "key", "check"))
    repeated = windows.join(_few(owners), ["key", "check"]).where("_id != keep_id")
    per_doc = repeated.groupBy("_id").agg(F.collect_set(F.struct("first", "keep_id")).alias("_found"))  # at most a document's words

    @F.pandas_udf(_SPAN)
    def spans(found: pd.Series) -> pd.Series:
        return found.map(lambda x: owned_spans([(w["first"], w["keep_id"]) for w in x], passage))

    return per_doc.select("_id", F.inline(spans("_found")))


def owned_spans(windows: list[tuple[int, int]], n: int) -> list[dict]:
    """Spans of the words that windows of ``n`` words cover, each word with the smallest owner of its windows."""
    first, owner = (np.array(x, np.int64) for x in zip(*windows))
    order = np.argsort(-owner, kind="stable")  # the smallest owner is written last
    words = np.unique((first[:, None] + np.arange(n)[None, :]).ravel())
    at = np.searchsorted(words, first)
    of = np.empty(len(words), np.int64)
    for k in order:
        of[at[k] : at[k] + n] = owner[k]
    cut = np.flatnonzero(np.concatenate(([True], (np.diff(words) > 1) | (np.diff(of) != 0), [True])))
    return [{"first": int(words[a]), "n": int(b - a), "keep_id": int(of[a])} for a, b in zip(cut[:-1], cut[1:])]


def passage_removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE, run: int = RUN, gone: DataFrame | None = None) -> DataFrame:
    """(id, first int, n int, keep_id): words, by their place in the document, that lie in a window of ``passage`` words which
    also stands in ``keep_id``, the smallest document with it. Windows that repeat in one document only are no removals, and
    neither are those with a word of ``gone``: spans (id, first, n) that are removed already."""
    known = facts(docs, id_col, text_col, passage=passage, run=run)
    if gone is None:
        gone = docs.sparkSession.createDataFrame([], "_id long, first int, n int")
    else:
        gone = gone.select(F.col(id_col).cast("long").alias("_id"), "first", "n")
    return _passage_spans(known, _texts(docs, id_col, text_col), gone, passage, run).withColumnRenamed("_id", id_col)


def substring_removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = SHINGLE, shingle: int = SHINGLE, similarity: float = SIMILARITY, passage: int = PASSAGE, run: int = RUN) -> DataFrame:
    """(id, spans array<struct<first, n, keep_id>>): for each document that loses words, what it loses, as spans of its
    words in order that share no word. A span is a paragraph, of which keep_id keeps a similar one (or one that is linked to
    it by similar ones), or a part of a repeated passage that stands in keep_id outside its removed paragraphs.

    Paragraphs go first, and a passage goes only where another document still has it. Where passages overlap in chains, the
    word's own place in keep_id may go for a still smaller document that holds the words around it, so each removed word
    stands, among words of a shared passage, in a text that keeps it.

    Words are runs of characters other than space and the controls tab to carriage return; a null text has none. Rows
    with a null id, or with an id that has several different texts, neither lose words nor stand for others. Rows that repeat
    id and text lose the same spans, and repeat nothing of one another. No rows give no rows; other columns are not read.
    """
    texts = _texts(docs, id_col, text_col)
    known = facts(docs, id_col, text_col, min_words, shingle, similarity, passage, run)
    gone = stored(_paragraph_spans(known, texts, shingle, similarity))
    found = gone.unionByName(_passage_spans(known, texts, gone.select("_id", "first", "n"), passage, run))
    per_doc = found.groupBy("_id").agg(F.array_sort(F.collect_set(F.struct("first", "n", "keep_id"))).alias("spans"))  # bounded by the text's length
    return per_doc.select(F.col("_id").alias(id_col), F.col("spans").cast(_SPAN).alias("spans"))


def merge_spans(found) -> list[dict]:
    """Spans in order, those that overlap or touch as one."""
    out: list[dict] = []
    for x in found:
        end = x["first"] + x["n"]
        if out and x["first"] <= out[-1]["first"] + out[-1]["n"]:
            out[-1]["n"] = max(out[-1]["n"], end - out[-1]["first"])
            out[-1]["keep_id"] = min(out[-1]["keep_id"], x["keep_id"])
        else:
            out.append({"first": x["first"], "n": x["n"], "keep_id": x["keep_id"]})
    return out


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cut_spans(text: str, spans) -> str:
    """The text without these spans of its words. A span that begins a line takes the blanks and one line break after it
    along; any other the blanks before it."""
    at = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    out, here = [], 0
    for span in spans:
        start, end = at[span["first"]][0], at[span["first"] + span["n"] - 1][1]
        line = text.rfind("\n", 0, start) + 1
        if not text[line:start].strip(" \t\x0b\f\r"):
            start = line
            while end < len(text) and text[end] in " \t\x0b\f\r":
                end += 1
            end += end < len(text) and text[end] == "\n"
        else:
            while text[start - 1] in " \t\x0b\f\r":
                start -= 1
        out.append(text[here : max(start, here)])
        here = max(here, end)
    return "".join([*out, text[here:]])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with their columns, the text without what ``substring_removals`` finds."""
    spans = substring_removals(docs, id_col, text_col).select(F.col(id_col).alias("id"), "spans")

    @F.pandas_udf("string")
    def shortened(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut_spans(t, merge_spans(s)) for t, s in zip(texts, spans)], dtype=object)

    # as structs, so that no column of docs can clash with one of the join
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    own = F.col("row").getField(id_col).cast("long")
    rows = rows.join(spans, own == F.col("id"), "left")
    hit, old = F.col("spans").isNotNull(), F.col("row").getField(text_col)
    new = F.when(hit, shortened(F.when(hit, F.coalesce(old.cast("string"), F.lit(""))).otherwise(""), F.coalesce("spans", F.array().cast(_SPAN)))).otherwise(old)
    return rows.select(*((new if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns))
