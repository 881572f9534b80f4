"""Personal data by bootstrapped contextual extraction.

Spans that fixed expressions find (emails, IPv4 addresses, card numbers, phone numbers) are seeds. Every identifier-like
mention, seed or not, stands in up to three lexical patterns: its two words before, one on either side, its two words after.
Patterns and distinct instances form a graph, which Spark scores in rounds: a pattern is trusted for a kind by the share of
its instances that are of that kind, an unseen instance by the trusted patterns it stands in, and what is accepted counts as
evidence for patterns in the next round. Accepted instances are marked wherever they stand: numbers without a country code,
addresses without a dotted domain, IPv6 addresses, card numbers with a slip in them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollhouse.llm.common import stored, text_or_empty

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: A pattern is trusted from this share of its instances on, of which there are counted so many more.
MIN_CONFIDENCE, SMOOTHING = 0.8, 2
#: An unseen instance is accepted from this score on.
MIN_SCORE = 0.95
ROUNDS = 3
#: Scores are whole millionths, so that sums do not depend on their order.
UNIT = 1_000_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HIT = re.compile("[0-9@]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LABEL = re.compile(r"[^0-9@:=]*[A-Za-z][^0-9@:=]*[:=]")
_DIGITISH = re.compile(r"[0-9()+./-]+")
_EDGE = ".,;:!?\"'[]{}<>|=*_"
_NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for c in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the fixed expressions find, in order; in time proportional to the text."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, EMAIL, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), IP, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), CARD, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), PHONE, m.end()))
    return sorted(out)


def could_be(value: str) -> int:
    """Bits of the kinds that an identifier-like string may be, beyond the fixed expressions."""
    bits = 0
    if "@" in value:
        local, _, host = value.partition("@")
        return 1 << EMAIL if local and host and "@" not in host else 0
    n, other = len(_NOT_DIGIT.sub("", value)), set(value) - set("0123456789")
    if value.count(".") == 3 and other <= {"."} or value.count(":") >= 2 and other <= set(":.abcdefABCDEF"):
        bits |= 1 << IP
    if 12 <= n <= 19 and other <= set(" -"):
        bits |= 1 << CARD
    if 7 <= n <= 15 and other <= set(" ().+/-"):
        bits |= 1 << PHONE
    return bits


@dataclass(frozen=True)
class Mention:
    start: int
    end: int
    #: -1 where no fixed expression found it
    kind: int
    #: kinds that an unseen one may be, as bits
    mask: int
    value: str
    #: two words before and two after, empty where there is none
    context: tuple[str, str, str, str]


def _normal(word: str) -> str:
    return _NOT_LETTERS.sub("", word.lower()) or word


_NOT_LETTERS = re.compile(r"^[\W_]+|[\W_]+$")


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[Mention]:
    """The base spans and the identifier-like strings outside them, with their context."""
    if not _HIT.search(text):
        return []
    words = [m.span() for m in _WORD.finditer(text)]
    starts = np.array([a for a, _ in words], np.int64)
    spans = [(start, end, kind, 0) for start, kind, end in base]

    # words with a digit or an @, less a label before it and marks around it; bare numbers one space apart are one
    loose: list[list] = []  # start, end, only digits, end of its word
    for a, b in words:
        if not _HIT.search(text, a, b):
            continue
        label = _LABEL.match(text, a, b)
        if label and label.end() < b:
            a = label.end()
        word = text[a:b]
        s = a + len(word) - len(word.lstrip(_EDGE))
        e = max(b - len(word) + len(word.rstrip(_EDGE)), s)
        if s == e:
            continue
        bare = _DIGITISH.fullmatch(text, s, e) is not None
        if bare and loose and loose[-1][2] and loose[-1][1] == loose[-1][3] == s - 1 and text[s - 1] == " " and a == s:
            loose[-1][1], loose[-1][3] = e, b
        else:
            loose.append([s, e, bare, b])
    taken = sorted((start, end) for start, _, end in base)
    merged: list[list[int]] = []
    for start, end in taken:
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    k = 0
    for s, e, bare, _ in loose:
        if bare:  # brackets without their other half
            s += text[s] == "(" and ")" not in text[s:e]
            e -= e > s and text[e - 1] == ")" and "(" not in text[s:e]
        while k < len(merged) and merged[k][1] <= s:
            k += 1
        if s < e and (k == len(merged) or merged[k][0] >= e) and _HIT.search(text, s, e):
            spans.append((s, e, -1, could_be(text[s:e])))

    out = []
    for s, e, kind, mask in spans:
        i = int(np.searchsorted(starts, s, "right")) - 1
        j = int(np.searchsorted(starts, e - 1, "right")) - 1
        left = [text[max(words[i][0], 0) : s]] if s > words[i][0] and _NOT_LETTERS.sub("", text[words[i][0] : s]) else []
        left = [*(text[a:b] for a, b in words[max(i - 2, 0) : i]), *left][-2:]
        right = [text[e : words[j][1]]] if e < words[j][1] and _NOT_LETTERS.sub("", text[e : words[j][1]]) else []
        right = [*right, *(text[a:b] for a, b in words[j + 1 : j + 3])][:2]
        l2, l1 = [*[""] * (2 - len(left)), *map(_normal, left)]
        r1, r2 = [*map(_normal, right), *[""] * (2 - len(right))]
        out.append(Mention(s, e, kind, mask, text[s:e].lower(), (l2, l1, r1, r2)))
    return out


def patterns(context: tuple[str, str, str, str]) -> list[tuple[str, str, str]]:
    """The lexical patterns of a context; one without any word is none."""
    l2, l1, r1, r2 = context
    return [p for p in (("before", l2, l1), ("around", l1, r1), ("after", r1, r2)) if p[1] or p[2]]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _key(pattern: tuple[str, str, str]) -> int:
    return _signed(xxhash.xxh3_64_intdigest("\n".join(pattern).encode("utf-8", "surrogatepass")))


_FOUND = """_id long, _at array<int>, _to array<int>, _kind array<int>,
  m_at array<int>, m_to array<int>, m_kind array<int>, m_mask array<int>, m_value array<binary>, m_patterns array<array<long>>"""


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = ["_id", "_at", "_to", "_kind", "m_at", "m_to", "m_kind", "m_mask", "m_value", "m_patterns"]
    ints = pa.list_(pa.int32())
    types = [pa.int64(), ints, ints, ints, ints, ints, ints, ints, pa.list_(pa.binary()), pa.list_(pa.list_(pa.int64()))]
    for batch in batches:
        columns: list[list] = [batch.column(0).to_pylist(), *([] for _ in range(9))]
        for text in batch.column(1):
            text = text.as_py()
            base = base_spans(text) if _HIT.search(text) else []
            ms = mentions(text, base) if base or _HIT.search(text) else []
            cells = [
                [s for s, _, _ in base], [e for _, _, e in base], [k for _, k, _ in base],
                [m.start for m in ms], [m.end for m in ms], [m.kind for m in ms], [m.mask for m in ms],
                [xxhash.xxh3_128_digest(m.value.encode("utf-8", "surrogatepass")) for m in ms],
                [[_key(p) for p in patterns(m.context)] for m in ms],
            ]
            for column, cell in zip(columns[1:], cells):
                column.append(cell)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=fields)


def _trusted(edges: DataFrame, accepted: DataFrame | None, confidence: float, smoothing: int) -> DataFrame:
    """(pattern, k, doubt): trusted patterns with their kind and minus the logarithm of one minus their confidence."""
    if accepted is not None:
        edges = edges.join(accepted, "value", "left")
        kind, score = F.when(F.col("kind") >= 0, F.col("kind")).otherwise(F.col("k")), F.when(F.col("kind") >= 0, UNIT).otherwise(F.col("score"))
    else:
        kind, score = F.col("kind"), F.lit(UNIT)
    sums = [F.sum(F.when(kind == k, score).otherwise(0)).cast("long").alias(f"s{k}") for k in range(len(KINDS))]
    share = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *sums)
    best = F.greatest(*(F.struct(F.col(f"s{k}").alias("s"), F.lit(-k).alias("k")) for k in range(len(KINDS))))
    share = share.select("pattern", best.alias("best"), F.col("n") + smoothing).toDF("pattern", "best", "n")
    share = share.where(F.col("best.s") >= F.lit(int(round(confidence * 100))) * UNIT * F.col("n") / 100)
    sure = F.col("best.s") / (F.col("n") * UNIT)
    return share.select("pattern", (-F.col("best.k")).alias("k"), F.round(-F.log1p(-sure) * UNIT).cast("long").alias("doubt"))


def _accepted(edges: DataFrame, trusted: DataFrame, min_score: float) -> DataFrame:
    """(value, k, score): unseen instances, their kind and score in millionths."""
    unseen = edges.where("kind < 0 AND mask > 0").join(trusted, "pattern").where("shiftright(mask, k) % 2 = 1")
    scores = unseen.groupBy("value", "k").agg(F.sum("doubt").alias("doubt")).groupBy("value").agg(F.max(F.struct("doubt", (-F.col("k")).alias("minus"))).alias("best"))
    score = F.floor((1 - F.exp(-F.col("best.doubt") / UNIT)) * UNIT).cast("long")
    return scores.select("value", (-F.col("best.minus")).alias("k"), score.alias("score")).where(F.col("score") >= int(min_score * UNIT))


def learned(edges: DataFrame, confidence: float = MIN_CONFIDENCE, smoothing: int = SMOOTHING, min_score: float = MIN_SCORE, rounds: int = ROUNDS) -> DataFrame:
    """(value, k, score) of the unseen instances that are accepted after ``rounds`` rounds, or sooner when nothing changes.

    ``edges``: (pattern, value, kind, mask), each pair of pattern and value once.
    """
    accepted = None
    for _ in range(rounds):
        now = stored(_accepted(edges, _trusted(edges, accepted, confidence, smoothing), min_score))
        same = now.isEmpty() if accepted is None else now.exceptAll(accepted).isEmpty() and accepted.exceptAll(now).isEmpty()
        accepted = now
        if same:
            break
    return accepted


def personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", confidence: float = MIN_CONFIDENCE, smoothing: int = SMOOTHING, min_score: float = MIN_SCORE, rounds: int = ROUNDS
) -> DataFrame:
    """One row per row of ``docs``: id, base and added, both array<struct<start int, kind int, end int>> in order: places in
    code points, the end exclusive, the kind as its place in ``KINDS``.

    Null and empty texts have no spans. Rows that repeat, or have no id, have spans each; as evidence for a pattern an
    instance counts once, however often it is repeated. Of kinds with equal evidence the first listed is taken. No rows give
    no rows; other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).alias("_text"))
    rows = stored(texts.mapInArrow(_found, _FOUND).withColumn("_row", F.monotonically_increasing_id()))
    each = F.inline(F.arrays_zip(*(F.col(f"m_{c}").alias(c) for c in ("at", "to", "kind", "mask", "value", "patterns"))))
    found = rows.where(F.size("m_at") > 0).select("_row", each)
    edges = found.select("value", "kind", "mask", F.explode("patterns").alias("pattern"))
    edges = stored(edges.groupBy("pattern", "value").agg(F.max("kind").alias("kind"), F.bit_or("mask").alias("mask")))
    accepted = learned(edges, confidence, smoothing, min_score, rounds)
    more = found.where("kind < 0 AND mask > 0").join(accepted, "value")
    # a row's own mentions: bounded by its text
    more = more.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct(F.col("at").alias("start"), F.col("k").alias("kind"), F.col("to").alias("end")))).alias("added"))
    base = F.arrays_zip(F.col("_at").alias("start"), F.col("_kind").alias("kind"), F.col("_to").alias("end"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return rows.select("_row", F.col("_id"), base.alias("base")).join(more, "_row", "left").select(F.col("_id").alias(id_col), "base", F.coalesce("added", none).alias("added"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, by start and then kind, joined by commas."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
