r"""URL filters: a bit-parallel wildcard automaton (multiword Shift-And) over canonical URLs.

Rules are globs over ``host + path``. ``*`` stands for any run of bytes, ``+`` in a host part for
a run without ``/`` (so a host wildcard never leaves the host). Every glob becomes a row of bit
positions, one per literal byte; all globs lie behind each other in one bit vector of 64-bit
words. One step moves the states of all rules at once:

    S = ((S << 1 with carries) | starts | (loops where the wildcard takes the byte)) & mask[byte]

A wildcard is a loop at the bit before it: the state stays there while the wildcard accepts the
byte read. Rules end in ``*``, so a rule fits as soon as its last bit is set. The host's
subdomains are ``+.`` before the rule's host. Numpy runs the steps for a whole batch of URLs at
once; work grows with (URL bytes) x (words of rules).

Defined cases: null urls and urls without ``://`` have empty host and path; a rule never fits
those; repeated rows are judged alike; empty tables give empty tables; extra columns stay out.
Of rules that fit, the longest (host and path) wins; ties go to the first in the list.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portmart.llm.text import column_bytes


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str  # fits this host and all its subdomains
    path: str  # prefix of the path

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))
# The method's own verdict where no such rule fits: these globs block, all else is allowed.
BLOCK_GLOBS = ("spam-+/*", "+.spam-+/*", "+/*/tracker/*", "+/*.exe*")


class ShiftAnd:
    """Packed masks of a list of globs; ``run`` gives, per input, the words of matched rules."""

    def __init__(self, globs: Sequence[str]):
        bits: list[tuple[int, bool, int]] = []  # literal byte, is it the rule's first, wildcard before it (0, 1 any, 2 no slash)
        self.last: list[int] = []
        for g in globs:
            if not g.endswith("*"):
                raise ValueError(f"rule {g!r} must end in '*'")
            first, wild = True, 0
            for b in g.encode()[:-1]:
                if b in b"*+":
                    wild = max(wild, 1 if b == ord("*") else 2) if not wild else 1
                    continue
                bits.append((b, first, wild))
                first, wild = False, 0
            self.last.append(len(bits) - 1)
        n = self.words = (len(bits) + 63) // 64
        self.mask = np.zeros((256, n), np.uint64)
        self.start = np.zeros(n, np.uint64)  # rules anchored at the first byte
        self.free = np.zeros((2, n), np.uint64)  # rules that begin with a wildcard: any, no slash
        self.loop = np.zeros((2, n), np.uint64)  # bits whose state waits in a wildcard behind them
        self.firsts = np.zeros(n, np.uint64)
        for i, (b, first, wild) in enumerate(bits):
            w, v = divmod(i, 64)
            v = np.uint64(1 << v)
            self.mask[b, w] |= v
            if first:
                self.firsts[w] |= v
                self.start[w] |= v
                if wild:
                    self.free[wild - 1, w] |= v
            elif wild:
                p, q = divmod(i - 1, 64)
                self.loop[wild - 1, p] |= np.uint64(1 << q)
        self.final = np.zeros(n, np.uint64)
        for i in self.last:
            self.final[i // 64] |= np.uint64(1 << (i % 64))

    def run(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(inputs, words): the final bits that were ever set."""
        n, length = len(offsets) - 1, np.diff(offsets)
        hit = np.zeros((n, self.words), np.uint64)
        order = np.argsort(-length, kind="stable")
        at, size = offsets[:-1][order], length[order]
        state = np.zeros((n, self.words), np.uint64)
        wait = np.zeros((n, self.words), np.uint64)  # states that wait in a wildcard
        begun = np.tile(self.start | self.free[0] | self.free[1], (n, 1))
        live = n
        for i in range(int(size[0]) if n else 0):
            live = int(np.searchsorted(-size[:live], -i, "left"))  # inputs with more than i bytes
            byte = data[at[:live] + i]
            s = state[:live] | wait[:live]
            moved = s << np.uint64(1)
            moved[:, 1:] |= s[:, :-1] >> np.uint64(63)
            new = ((moved & ~self.firsts) | begun[:live]) & self.mask[byte]
            # what waits goes on waiting while its wildcard takes this byte; new states begin to
            keep = self.loop[0] | np.where((byte != ord("/"))[:, None], self.loop[1], np.uint64(0))
            wait[:live] = (wait[:live] & keep) | (new & (self.loop[0] | self.loop[1]))
            state[:live] = new
            hit[:live] |= new & self.final
            begun[:live] = (begun[:live] & self.free[0]) | np.where((byte != ord("/"))[:, None], begun[:live] & self.free[1], np.uint64(0))
        out = np.empty_like(hit)
        out[order] = hit
        return out

    def matched(self, hit: np.ndarray, rule: int) -> np.ndarray:
        w, v = divmod(self.last[rule], 64)
        return (hit[:, w] >> np.uint64(v)) & np.uint64(1) > 0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def filter_urls(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[Rule] = RULES,
                block_globs: Sequence[str] = BLOCK_GLOBS) -> DataFrame:
    """``(id, host, path, rule, verdict)`` for every row of ``df``."""
    globs = [g for r in rules for g in (f"{r.host}{r.path}*", f"+.{r.host}{r.path}*")] + list(block_globs)
    ranked = sorted(range(len(rules)), key=lambda i: (len(rules[i].name), -i))  # the last that fits wins
    engine = ShiftAnd(globs)
    host, path = host_and_path(F.col(f"`{url_col}`"))
    rows = df.select(F.col(f"`{id_col}`").alias(id_col), host.alias("host"), path.alias("path"))
    kind = dict(rows.dtypes)[id_col]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(pa.array([h + p for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())], pa.string()))
            hit = engine.run(data, offsets)
            rule = np.full(batch.num_rows, -1)
            for i in ranked:
                rule[engine.matched(hit, 2 * i) | engine.matched(hit, 2 * i + 1)] = i
            blocked = np.zeros(batch.num_rows, bool)
            for j in range(2 * len(rules), len(globs)):
                blocked |= engine.matched(hit, j)
            own = np.where(blocked, "block", "allow")
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(2),
                pa.array([rules[i].name if i >= 0 else None for i in rule], pa.string()),
                pa.array([rules[i].verdict if i >= 0 else v for i, v in zip(rule, own.tolist())], pa.string()),
            ], names=[id_col, "host", "path", "rule", "verdict"])
    return rows.mapInArrow(judge, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")
