"""URL filter: all glob rules simulated at once by a bit-parallel automaton.

Globs are written for the canonical form ``.host/path``: ``*`` is any run without "/", ``**`` any run, ``?`` any one
byte but "/", and a backslash takes the next character as it is. Each glob is a row of states in a multiword bit
mask (Shift-And, with self-loops for the wildcards). A batch of URLs advances together, one byte per step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from maskwright.llm.words import buffers

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    glob: str


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host with all its subdomains and the paths that start with ``path``."""
    quoted = "".join("\\" + c if c in "*?\\" else c for c in host + path)
    return Rule(host + path, verdict, f"*.{quoted}**")


class Automaton:
    """Masks of all globs, ``words`` 64-bit words wide."""

    def __init__(self, globs: list[str]):
        steps: list[np.ndarray] = []  # per state: which bytes lead into it from the state before
        loops: list[np.ndarray] = []  # per state: which bytes keep it
        starts, ends = [], []
        for glob in globs:
            starts.append(len(steps))
            steps.append(np.zeros(256, bool))
            loops.append(np.zeros(256, bool))
            at = 0
            data = glob.encode()
            while at < len(data):
                if data[at:at + 2] == b"**":
                    loops[-1] = np.ones(256, bool)
                    at += 2
                    continue
                if data[at:at + 1] == b"*":
                    loops[-1] = loops[-1] | _not_slash()
                    at += 1
                    continue
                if data[at:at + 1] == b"?":
                    taken = _not_slash()
                else:
                    at += data[at:at + 1] == b"\\" and at + 1 < len(data)
                    taken = np.arange(256) == data[at]
                steps.append(taken)
                loops.append(np.zeros(256, bool))
                at += 1
            ends.append(len(steps) - 1)
        self.words = max(1, -(-len(steps) // 64))
        self.step, self.loop = self._masks(steps), self._masks(loops)
        self.start = self._bits(starts)
        self.ends = [(e // 64, np.uint64(1 << e % 64)) for e in ends]

    def _bits(self, states: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for s in states:
            out[s // 64] |= np.uint64(1 << s % 64)
        return out

    def _masks(self, taken: list[np.ndarray]) -> np.ndarray:
        """For each byte, the states whose entry in ``taken`` holds for it."""
        return np.stack([self._bits([s for s, t in enumerate(taken) if t[byte]]) for byte in range(256)])

    def run(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The last state sets (strings x words) for strings laid out behind each other."""
        n = np.diff(starts)
        order = np.argsort(-n, kind="stable")  # longest first: those still running stay in front
        first, n = starts[:-1][order], n[order]
        state = np.tile(self.start, (len(n), 1))
        for k in range(int(n[0]) if len(n) else 0):
            live = int(np.searchsorted(-n, -k))  # strings longer than k
            byte, now = data[first[:live] + k], state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = moved & self.step[byte] | now & self.loop[byte]
        out = np.empty_like(state)
        out[order] = state
        return out


def _not_slash() -> np.ndarray:
    return np.arange(256) != ord("/")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z as a-z; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _UPPER.lower()), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def judge_urls(pages: DataFrame, rules: list[Rule], default: str = ALLOW, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: ``id_col``, host, path, rule (the longest name that fits; null if none), verdict.

    Of equally long names the first listed wins. Where no rule fits, as for a null url, one without ``://`` or any
    url when there are no rules, ``default`` holds. Ids may be null or repeat: every row is judged on its own. Urls of any
    length are read whole. Other columns are not read.
    """
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), i))
    automaton = Automaton([rules[i].glob for i in order])

    @F.pandas_udf("int")
    def best(urls: pd.Series) -> pd.Series:
        sets = automaton.run(*buffers(pa.array(urls, pa.large_string())))
        found = np.full(len(urls), -1)
        for rank in range(len(order) - 1, -1, -1):  # the best last, over what fits as well
            word, bit = automaton.ends[rank]
            found[sets[:, word] & bit != 0] = order[rank]
        return pd.Series(found)

    url = F.col(url_col).cast("string")
    judged = pages.select(F.col(id_col).alias("id_"), host(url).alias("host"), path(url).alias("path")).withColumn(
        "at_", best(F.concat(F.lit("."), "host", "path")))
    names = F.array(*[F.lit(r.name) for r in rules]) if rules else F.array().cast("array<string>")
    verdicts = F.array(*[F.lit(r.verdict) for r in rules]) if rules else F.array().cast("array<string>")
    return judged.select(
        F.col("id_").alias(id_col), "host", "path", F.get(names, F.col("at_")).alias("rule"),
        F.coalesce(F.get(verdicts, F.col("at_")), F.lit(default)).alias("verdict"))
