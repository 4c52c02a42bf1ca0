"""URL rules as one bit-parallel automaton.

Every rule becomes a run of states in a vector of 64-bit words: state j holds while its first
j characters have been read.  A step shifts all words by one bit (with carry), keeps the
states that the next character extends and those that a star lets stay (Shift-And).  A batch of
urls steps together, so all rules run over all urls at once.

Canonical url: ``.`` and the host with A-Z in lower case, then the path.  The host is what
stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, the path what
follows up to ``?``, ``#`` or the end; a url that is null or has no ``://`` has neither.
In a pattern ``*`` stands for any run of bytes and ``?`` for one; in the part before the first
``/`` neither stands for ``/``.  The longest matching rule decides, of equal ones a block; a
url without a match gets the default verdict, ``allow``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    verdict: str
    name: str
    pattern: str


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule on a host with its subdomains and on the start of the path."""
    return Rule(verdict, host + path, f"*.{host}{path}*")


class Automaton:
    def __init__(self, rules: list[Rule]) -> None:
        # The last of the accepting rules in this order decides.
        self.rules = sorted(rules, key=lambda r: (len(r.name.encode()), r.verdict == BLOCK, r.name))
        self.first: list[int] = []
        self.final: list[int] = []
        steps, stays_at = [], []
        for rule in self.rules:
            self.first.append(len(steps))
            steps.append(None)
            stays_at.append(None)
            in_host = True
            for char in rule.pattern.encode():
                if char == ord("*"):
                    stays_at[-1] = in_host
                    continue
                in_host = in_host and char != ord("/")
                steps.append((char, in_host))
                stays_at.append(None)
            self.final.append(len(steps) - 1)
        self.words = max(1, -(-len(steps) // 64))
        self.reach = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        everything = np.arange(256)
        for state, (step, stay) in enumerate(zip(steps, stays_at)):
            word, bit = state // 64, np.uint64(1 << state % 64)
            if step is None:
                self.start[word] |= bit
            else:
                char, in_host = step
                chars = [char] if char != ord("?") else everything[
                    (everything != ord("/")) | (not in_host)]
                self.reach[chars, word] |= bit
            if stay is not None:
                self.stay[everything[(everything != ord("/")) | (not stay)], word] |= bit

    def judge(self, urls: list[bytes]) -> np.ndarray:
        """Number of the deciding rule of each url, -1 without one."""
        sizes = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-sizes, kind="stable")
        sorted_sizes = sizes[order]
        text = np.frombuffer(b"".join(urls), np.uint8)
        begin = (np.cumsum(sizes) - sizes)[order]
        state = np.tile(self.start, (len(urls), 1))
        one, high = np.uint64(1), np.uint64(63)
        for at in range(int(sorted_sizes[0]) if len(urls) else 0):
            alive = int(np.searchsorted(-sorted_sizes, -at, side="left"))
            now = state[:alive]
            char = text[begin[:alive] + at]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> high
            state[:alive] = (moved & self.reach[char]) | (now & self.stay[char])
        best = np.full(len(urls), -1, np.int64)
        for rule, final in enumerate(self.final):
            hit = (state[:, final // 64] >> np.uint64(final % 64)) & one
            best[hit.astype(bool)] = rule
        out = np.empty(len(urls), np.int64)
        out[order] = best
        return out


def host(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    found = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """(id, host, path, rule, verdict) of every url; other columns are not read."""
    common.python_batches(pages.sparkSession)
    automaton = Automaton(rules)

    @F.pandas_udf("rule string, verdict string")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [r.name for r in automaton.rules] + [None]
        verdicts = [r.verdict for r in automaton.rules] + [default]
        for urls in batches:
            found = automaton.judge([u.encode() for u in urls])
            yield pd.DataFrame({"rule": [names[i] for i in found],
                                "verdict": [verdicts[i] for i in found]})

    parts = pages.select(F.col(id_col), host(url_col).alias("host"), path(url_col).alias("path"))
    canonical = F.concat(F.lit("."), "host", "path")
    return parts.withColumn("_judged", judged(canonical)).select(
        id_col, "host", "path", "_judged.rule", "_judged.verdict")
