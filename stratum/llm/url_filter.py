"""URL filter: a bit-parallel glob automaton over canonical URLs.

Rules are globs over the canonical form ``.host/path`` (query and fragment
removed, host lower-cased, a dot before the host so that "the domain and its
subdomains" is the one pattern ``*.domain``):

* ``?``   any byte but ``/``
* ``*``   any run of bytes without ``/`` (so it stays inside host or segment)
* ``**``  any run of bytes

All globs are packed side by side into 64-bit words, one bit per state
(Shift-And with self loops for the stars).  One step advances every pattern of
every URL of a batch:

    D' = ((D << 1) & MOVE[c]) | (D & STAY[c])

where the shift carries across words.  The tables have 256 x W entries, fixed by
the rules; they travel with the task closure and do not grow with the data.

Scale: one narrow pass, no shuffle; only the URL column is read.  URLs of a
batch advance together, sorted by length; a URL longer than LONG_URL advances
alone on Python integers (same automaton) so that it does not hold a batch.

Defined results: a null URL, or one without ``://``, has empty host and path
and no rule; the method's globs see the canonical form ``.`` and therefore match
only patterns that accept it, so the verdict is ``allow``.  Repeated rows give
repeated results.  Input columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.frames import tidy

LONG_URL = 2048


@dataclass(frozen=True)
class Glob:
    """``pattern`` over the canonical form; ``name`` is reported on a match.

    Among matching globs of the highest ``tier`` the longest ``name`` wins, then
    the earlier glob.
    """

    pattern: str
    verdict: str
    name: str | None = None
    tier: int = 0


def domain_rule(verdict: str, host: str, path: str) -> Glob:
    """A host with all its subdomains, and a path prefix."""
    return Glob(f"*.{host}{path}**", verdict, f"{host}{path}", tier=1)


class ShiftAnd:
    """The packed automaton of a list of globs."""

    def __init__(self, globs: Sequence[str]):
        move: list[tuple[int, object]] = []  # (bit, byte or None for "?")
        stay: list[tuple[int, bool]] = []  # (bit, True when "/" is allowed)
        self.starts, self.accepts = [], []
        bit = 0
        for g in globs:
            self.starts.append(bit)
            raw, i = g.encode("utf-8"), 0
            while i < len(raw):
                if raw[i:i + 2] == b"**":
                    stay.append((bit, True))
                    i += 2
                elif raw[i:i + 1] == b"*":
                    stay.append((bit, False))
                    i += 1
                else:
                    bit += 1
                    move.append((bit, None if raw[i:i + 1] == b"?" else raw[i]))
                    i += 1
            self.accepts.append(bit)
            bit += 1
        self.words = max(1, -(-bit // 64))
        self.move_int, self.stay_int = [0] * 256, [0] * 256
        for b, c in move:
            for x in ([c] if c is not None else [y for y in range(256) if y != 0x2F]):
                self.move_int[x] |= 1 << b
        for b, slash in stay:
            for x in range(256):
                if slash or x != 0x2F:
                    self.stay_int[x] |= 1 << b
        self.start_int = sum(1 << b for b in self.starts)
        self.move, self.stay = self._table(self.move_int), self._table(self.stay_int)
        self.start = self._table([self.start_int])[0]

    def _table(self, ints: list[int]) -> np.ndarray:
        mask = (1 << 64) - 1
        return np.array([[(v >> (64 * w)) & mask for w in range(self.words)] for v in ints],
                        dtype=np.uint64)

    def match(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Boolean matrix (text, glob) over a flat buffer of texts."""
        n = len(offsets) - 1
        size = np.diff(offsets)
        state = np.tile(self.start, (n, 1))
        order = np.argsort(-size, kind="stable")
        usual = order[size[order] <= LONG_URL]
        ends = -size[usual]
        one, top = np.uint64(1), np.uint64(63)
        cur = state[usual]
        for j in range(int(size[usual[0]]) if len(usual) else 0):
            live = int(np.searchsorted(ends, -j, side="left"))  # texts longer than j
            d = cur[:live]
            c = data[offsets[usual[:live]] + j]
            shifted = d << one
            shifted[:, 1:] |= d[:, :-1] >> top
            cur[:live] = (shifted & self.move[c]) | (d & self.stay[c])
        state[usual] = cur
        for i in order[size[order] > LONG_URL]:
            d = self.start_int
            for c in data[offsets[i]:offsets[i + 1]].tobytes():
                d = ((d << 1) & self.move_int[c]) | (d & self.stay_int[c])
            state[i] = self._table([d])[0]
        out = np.empty((n, len(self.accepts)), dtype=bool)
        for g, b in enumerate(self.accepts):
            out[:, g] = (state[:, b // 64] >> np.uint64(b % 64)) & one != 0
        return out


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                  "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, globs: Sequence[Glob], id_col: str = "page_id",
               url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict, glob): the winning glob of every URL.

    ``rule`` is the name of a winning glob that has one, ``glob`` the pattern that
    decided; both are null where nothing matched and ``default`` is the verdict.
    """
    globs = list(globs)
    machine = ShiftAnd([g.pattern for g in globs])
    rank = sorted(range(len(globs)), key=lambda i: (-globs[i].tier, -len(globs[i].name or ""), i))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stratum.llm.textops import flat

        for b in batches:
            hit = machine.match(*flat(b.column("canonical")))[:, rank]
            first = np.where(hit.any(axis=1), hit.argmax(axis=1), -1)
            win = [globs[rank[i]] if i >= 0 else None for i in first]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("host"), b.column("path"),
                 pa.array([g.name if g else None for g in win], pa.string()),
                 pa.array([g.verdict if g else default for g in win], pa.string()),
                 pa.array([g.pattern if g else None for g in win], pa.string())],
                names=[id_col, "host", "path", "rule", "verdict", "glob"])

    kind = pages.schema[id_col].dataType.simpleString()
    url = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("u"))
    parts = url.select("id", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"))
    return parts.withColumn("canonical", F.concat(F.lit("."), "host", "path")).mapInArrow(
        tidy(judge), f"`{id_col}` {kind}, host string, path string, rule string, verdict string, "
               "glob string")


# The domain rules of the registered query.
DOMAIN_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
# The method's own globs decide URLs without a domain rule: unwanted host labels.  They
# look at the host alone; no path glob is among them.
METHOD_BLOCK = ["*.adult-*", "*.casino-*", "*.cheap-*", "*.spam-*", "*.ads-*", "*.ad?.*"]


def standard_globs() -> list[Glob]:
    rules = [domain_rule(*r) for r in DOMAIN_RULES]
    return rules + [Glob(f"{p}/**", "block") for p in METHOD_BLOCK] + [
        Glob(p, "block") for p in METHOD_BLOCK]
