"""URL filters by a bit-parallel wildcard automaton.

All glob rules are packed end to end into one row of state bits, as many 64-bit words as it takes. One step of Shift-And
moves every pattern on by one byte of every URL of a batch at once: ``((D & literal[c]) << 1) | (D & loop[c])``.

Globs: ``*`` stands for any bytes but ``/`` and ``**`` for any bytes; all else is literal and the whole URL must match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class UrlRule:
    """A verdict for a host with its subdomains, below a path: ``UrlRule("block", "net", "/es/")``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def globs(self) -> tuple[str, str]:
        return f"{self.host}{self.path}**", f"*.{self.host}{self.path}**"


class GlobAutomaton:
    """All globs at once; ``matches`` gives a boolean for each URL and glob."""

    def __init__(self, globs: Sequence[str]):
        self.globs = list(globs)
        literal, loop_any, loop_host, start, final, at = [0] * 256, 0, 0, 0, [], 0
        for glob in self.globs:
            start |= 1 << at
            for token in re.findall(rb"\*\*+|\*|[^*]", glob.encode("utf-8"), re.DOTALL):
                if token == b"*":
                    loop_host |= 1 << at
                elif token[:1] == b"*":
                    loop_any |= 1 << at
                else:
                    literal[token[0]] |= 1 << at
                    at += 1
            final.append(at)
            at += 1
        self.words = at // 64 + 1
        loop = [loop_any | (0 if c == ord("/") else loop_host) for c in range(256)]
        self.start = self._row(start)
        self.literal = np.array([self._row(x) for x in literal])
        self.loop = np.array([self._row(x) for x in loop])
        self.final = [(f // 64, np.uint64(1 << f % 64)) for f in final]

    def _row(self, bits: int) -> np.ndarray:
        return np.array([bits >> 64 * i & (1 << 64) - 1 for i in range(self.words)], np.uint64)

    def matches(self, urls: Sequence[str]) -> np.ndarray:
        raw = [u.encode("utf-8", "surrogatepass") for u in urls]
        size = np.array([len(r) for r in raw], np.int64)
        order = np.argsort(-size, kind="stable")  # the longest first: those still running are a prefix
        data = np.frombuffer(b"".join(raw) + b"\0", np.uint8)
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))[order] if len(raw) else np.zeros(0, np.int64)
        size = size[order]
        state = np.tile(self.start, (len(raw), 1))
        live = len(raw)
        for at in range(int(size[0]) if len(raw) else 0):
            live = int(np.searchsorted(-size[:live], -at, side="left"))
            c = data[begin[:live] + at]
            now = state[:live]
            go = now & self.literal[c]
            moved = go << np.uint64(1)
            if self.words > 1:
                moved[:, 1:] |= go[:, :-1] >> np.uint64(63)
            state[:live] = moved | (now & self.loop[c])
        hit = np.zeros((len(raw), len(self.globs)), bool)
        for i, (word, bit) in enumerate(self.final):
            hit[order, i] = state[:, word] & bit != 0
        return hit


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judged(pages: DataFrame, rules: Sequence[UrlRule], blocked: Sequence[str] = (), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: the id, host, path, rule (the longest that fits; else null), verdict, glob (the first of
    ``blocked`` that fits; else null).

    ``blocked`` are globs over the canonical URL: the host and the path, of which an empty one is read as ``/``; rules are held
    against the path as it stands. The verdict is the rule's; without a rule it is block
    if a glob fits, else allow. A null URL and one without ``://`` have an empty host and path, so that only a glob of
    stars fits. Of equally long rules the first given wins. Repeated rows stay; other columns are not read.
    """
    rules, blocked = tuple(rules), tuple(blocked)
    machine = [g for r in rules for g in r.globs] + list(blocked)

    @F.pandas_udf("struct<rule:string, verdict:string, glob:string>")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        automaton = GlobAutomaton(machine)
        ranks = sorted(range(len(rules)), key=lambda i: -len(rules[i].name))
        below = np.array([r.path != "" for r in rules], bool)
        for hosts, paths in batches:
            empty = (paths == "").to_numpy()
            urls = hosts + paths.mask(empty & (hosts != "").to_numpy(), "/")
            hit = automaton.matches(urls.tolist())
            fits = hit[:, : 2 * len(rules)].reshape(len(urls), len(rules), 2).any(axis=2) & ~(empty[:, None] & below[None, :])
            globs = hit[:, 2 * len(rules) :]
            rule, glob = np.full(len(urls), -1), np.where(globs.any(axis=1), globs.argmax(axis=1), -1) if blocked else np.full(len(urls), -1)
            for i in reversed(ranks):
                rule[fits[:, i]] = i
            yield pd.DataFrame(
                {
                    "rule": [rules[i].name if i >= 0 else None for i in rule],
                    "verdict": [rules[i].verdict if i >= 0 else ("block" if g >= 0 else "allow") for i, g in zip(rule, glob)],
                    "glob": [blocked[g] if g >= 0 else None for g in glob],
                }
            )

    url = F.col(url_col).cast("string")
    parts = pages.select(F.col(id_col).alias(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    found = parts.withColumn("_judged", judge("host", "path"))
    return found.select(id_col, "host", "path", "_judged.rule", "_judged.verdict", "_judged.glob")
