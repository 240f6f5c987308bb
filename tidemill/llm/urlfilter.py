"""URL filters: all glob rules at once, as one bit-parallel wildcard automaton.

Rules become bits of multiword Shift-And masks; a step of the automaton reads
one character of every URL of a slice, so the work of a URL is its length
times the number of mask words, whatever the number of rules per word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U = np.uint64
SLICE = 4096
#: Longer URLs, in bytes, are read one by one: few would take part in a step of many.
LONG = 1024
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


class Rule(NamedTuple):
    """Allow or block ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def coded(text: str) -> bytes:
    """``text`` in ASCII: other characters, spaces and controls as percent codes of their UTF-8."""
    if text.isascii() and text.isprintable() and " " not in text:
        return text.encode()
    return b"".join(b"%c" % b if 0x20 < b < 0x7F else b"%%%02X" % b for b in text.encode("utf-8", "surrogatepass"))


def canonical(host: str, path: str) -> bytes:
    """``.host/path`` as ``coded`` writes it."""
    return coded(f".{host}{path}")


class Star(NamedTuple):
    """Any run of characters, without ``/`` if ``inside`` one part."""

    inside: bool


#: What a pattern is made of: runs, single bytes, and None for any one character.
Piece = Star | int | None


def glob_pieces(glob: str) -> list[Piece]:
    """``*`` any run, ``**`` any run without ``/``, ``?`` any character; others stand for themselves, in the form of canonical URLs."""
    out: list[Piece] = []
    for part in re.findall(r"\*\*|\*|\?|[^*?]+", glob, re.S):
        out += {"**": [Star(True)], "*": [Star(False)], "?": [None]}.get(part) or list(coded(part))
    return out


def rule_pieces(rule: Rule) -> list[Piece]:
    """The host and its subdomains, then what starts with the path; every character of a rule stands for itself."""
    return [Star(True), *canonical(rule.host, rule.path), Star(False)]


class Automaton:
    """All of ``patterns`` over canonical URLs; the whole URL must fit."""

    def __init__(self, patterns: Sequence[Sequence[Piece]]):
        states: list[set[int] | None] = []  # what the step into a state reads; None: a pattern's first state
        loops: list[set[int]] = []
        ends: list[int] = []
        begins: list[int] = []
        every = set(range(256))
        for pattern in patterns:
            begins.append(len(states))
            states.append(None)
            loops.append(set())
            for piece in pattern:
                if isinstance(piece, Star):
                    loops[-1] = every - {ord("/")} if piece.inside else every
                else:
                    states.append(every if piece is None else {piece})
                    loops.append(set())
            ends.append(len(states) - 1)
        self.words = (len(states) + 63) // 64 or 1
        self.step, self.stay = np.zeros((256, self.words), U), np.zeros((256, self.words), U)
        self.begin = np.zeros(self.words, U)
        self.ends = [(x // 64, U(1) << U(x % 64)) for x in ends]
        for x in begins:
            self.begin[x // 64] |= U(1) << U(x % 64)
        for x, reads in enumerate(states):
            bit = U(1) << U(x % 64)
            self.step[list(reads or ()), x // 64] |= bit
            self.stay[list(loops[x]), x // 64] |= bit

    def matches(self, urls: list[bytes]) -> np.ndarray:
        """Boolean, a row per URL and a column per glob."""
        size = np.array([len(u) for u in urls], np.int64)
        state = np.tile(self.begin, (len(urls), 1))
        for k in np.flatnonzero(size > LONG):
            state[k] = self._alone(urls[k])
        short = np.flatnonzero(size <= LONG)
        order = short[np.argsort(-size[short], kind="stable")]
        first = (np.cumsum(size) - size)[order]
        data = np.frombuffer(b"".join(urls), np.uint8)
        moving = state[order]
        for at in range(int(size[order[0]]) if len(order) else 0):
            n = int(np.searchsorted(-size[order], -at))
            read, now = data[first[:n] + at], moving[:n]
            moved = now << U(1)
            moved[:, 1:] |= now[:, :-1] >> U(63)
            moving[:n] = (moved & self.step[read]) | (now & self.stay[read])
        state[order] = moving
        out = np.zeros((len(urls), len(self.ends)), bool)
        for k, (word, bit) in enumerate(self.ends):
            out[:, k] = (state[:, word] & bit) != 0
        return out

    def _alone(self, url: bytes) -> np.ndarray:
        """The state after one URL, with all words of the masks as one number."""
        step, stay = ([int.from_bytes(row.tobytes(), "little") for row in table] for table in (self.step, self.stay))
        state = int.from_bytes(self.begin.tobytes(), "little")
        for c in url:
            state = state << 1 & step[c] | state & stay[c]
        return np.frombuffer(state.to_bytes(8 * self.words, "little"), U)


def judged(pages: DataFrame, rules: Sequence[Rule], globs: Sequence[str], url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, globs_hit``.

    Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased;
    path: from there to ``? #`` or the end. A null URL or one without ``://``
    has an empty host and path, which no rule fits. Of the rules that fit, the
    longest name wins (block, if allow and block have the same name) and gives
    the verdict. Where none fits, a URL that one of ``globs`` fits is blocked
    and any other allowed. ``globs_hit`` counts the globs that fit. Repeated
    rows are judged each; columns named as one of the new ones are replaced.
    """
    new = ("host", "path", "rule", "verdict", "globs_hit")
    rest = [c for c in pages.columns if c not in new]
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block"))
    patterns = [rule_pieces(r) for r in ranked] + [glob_pieces(g) for g in globs]
    text = F.coalesce(F.col(url), F.lit(""))
    lower = F.translate(F.regexp_extract(text, HOST, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = pages.select(*rest, lower.alias("host"), F.regexp_extract(text, PATH, 1).alias("path"))
    schema = split.schema.simpleString()[7:-1] + ",rule:string,verdict:string,globs_hit:int"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(patterns)
        names = np.array([r.name for r in ranked] + [None], object)
        verdicts = np.array([r.verdict for r in ranked] + ["allow"], object)
        n = len(ranked)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                found = automaton.matches([canonical(h, p) for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True)])
                fits = np.concatenate([found[:, :n], np.ones((len(found), 1), bool)], axis=1).argmax(axis=1)
                hit = found[:, n:].sum(axis=1).astype(np.int32)
                verdict = np.where((fits == n) & (hit > 0), "block", verdicts[fits])
                more = [pa.array(names[fits].tolist(), pa.string()), pa.array(verdict.tolist(), pa.string()), pa.array(hit)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *new[2:]])

    return split.mapInArrow(judge, schema)


#: Block these where no rule speaks.
GLOBS = ("**.doubleclick.**/*", "**.adult-**.*", "**.cheap-**.*", "**.casino**.*", "*/ads/*", "*/adserver/*", "*/tracking/*", "*/wp-login.php*", "*/cgi-bin/*", "**.onion/*", "*.exe", "*.zip")
