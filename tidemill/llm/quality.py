"""Quality classifier: interpolated modified Kneser-Ney word bigrams of trusted text, and perplexity quantiles by language.

Words and bigrams of all trusted text are counted by hash, and so is what
follows and precedes each word; nothing of these tables is dropped, and they
grow with the text. Documents' distinct words and bigrams are joined to them
on Spark, a shard of the hash range after another, which bounds the disk that
a join takes. Under the words lies a model of letters: a trigram over
characters folded to 64 symbols, of fixed size, which spells words that
trusted text lacks and the blanks between words. Characters of scripts that
put no blanks between words are words each.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .store import ARROW_BYTES, SMALL_ROWS, dropped, small, written

ORDER, SYMBOLS = 3, 64
CELLS = SYMBOLS**ORDER
#: One in so many trusted texts is left out of the counts that set thresholds, and is measured with them.
FOLDS = 5
#: Bytes of text whose distinct n-grams leave a task together.
SLICE = 1 << 22
#: Shards at most, and words for one; words of one part of a shard, and n-grams of texts that meet it in one task.
SHARDS, SHARD_WORDS, PART_WORDS, TASK_PAIRS = 8, 8_000_000, 2_000_000, 4_000_000
#: Parts whose words one task adds up before they are dealt: most words are in many parts.
TALLIED = 8
#: Shards of bigrams that are counted together: trusted text is cut once for them, and their sums are dealt at once.
COUNTED = 4
#: Parts for which there is one lot of words.
LOT_PARTS = 8

#: Symbol of each byte. Letters 0-25, capitals 26, digits 27, blank, line end, other controls, then marks; bytes of other characters fold to 50-63.
SYMBOL = np.full(256, 30, np.uint8)
SYMBOL[97:123] = np.arange(26)
SYMBOL[65:91] = 26
SYMBOL[48:58] = 27
SYMBOL[32], SYMBOL[10] = 28, 29
for _n, _marks in enumerate((".", ",", "!", "?", "'", '"', "-", ":;", "()[]{}", "|", "#", "$", "%", "&", "*", "/\\", "@", "_", "=+<>~^`"), 31):
    SYMBOL[[ord(c) for c in _marks]] = _n
SYMBOL[128:192] = 50 + np.arange(64) % 10
SYMBOL[192:] = 60 + np.arange(64) % 4


def codes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of the trigram that ends at each byte; a text begins after line ends."""
    s, size = SYMBOL.astype(np.int32)[data], np.diff(bounds)
    out = s.copy()
    for back in range(1, ORDER):
        out[back:] += s[:-back] * SYMBOLS**back
    for k in range(ORDER - 1):
        at = bounds[:-1][size > k] + k
        out[at] = sum((s[at - back] if back <= k else 29) * SYMBOLS**back for back in range(ORDER))
    return out


def discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2, and 3 or more; half of that where too few counts are low."""
    n1, n2, n3, n4 = (float((counts == k).sum()) for k in (1, 2, 3, 4))
    if min(n1, n2, n3) == 0:
        return np.array([0, 0.5, 0.75, 1.0])
    y = n1 / (n1 + 2 * n2)
    return np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], [0, 0.1, 0.1, 0.1], [0, 1, 2, 3])


def kneser_ney(counts: np.ndarray) -> np.ndarray:
    """log2 of P(c | a b) for every trigram, from ``counts`` of shape (64, 64, 64)."""
    levels = [counts, (counts > 0).sum(axis=0)]
    levels.append((levels[1] > 0).sum(axis=0))
    lower = np.full(SYMBOLS, 1 / SYMBOLS)
    for level in reversed(levels):
        cut = discounts(level)[np.minimum(level, 3)]
        total = level.sum(axis=-1, keepdims=True)
        left = np.where(total > 0, cut.sum(axis=-1, keepdims=True) / np.maximum(total, 1), 1.0)
        lower = np.maximum(level - cut, 0) / np.maximum(total, 1) + left * lower
    return np.log2(lower)


def letter_table(trusted: DataFrame) -> np.ndarray:
    """log2 probabilities of letters, of fixed size, from all of ``trusted`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, data, bounds in T.chunks(batch["text"]):
                total += np.bincount(codes(data, bounds), minlength=CELLS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["code", "n"])

    dense = np.zeros(CELLS, np.int64)
    for row in trusted.select("text").mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        dense[row["code"]] = row["n"]
    return kneser_ney(dense.reshape((SYMBOLS,) * ORDER)).astype(np.float32).reshape(-1)


def _salts(names: list[str]) -> np.ndarray:
    known = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(names)}
    return np.array([known[x] for x in names], T.U)


def bigrams(found: T.Words, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bigram, word before, word) of each word, as hashes that differ by the text's name; a text's first word follows a mark."""
    n, salts = np.diff(found.first), _salts(names)
    of = np.repeat(np.arange(len(n)), n)
    word = T.mixed(found.hash ^ salts[of])
    before = np.roll(word, 1)
    before[found.first[:-1][n > 0]] = T.mixed(~salts[n > 0])
    return of, T.mixed((before * T.U(0x9FB21C651E98DF25)) ^ word), before, word


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys >> T.U(48)) * T.U(shards) >> T.U(16)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys & T.U(0xFFFFFFFF)) * T.U(parts) >> T.U(32)).astype(np.int64)


def word_bits(found: T.Words, table: np.ndarray, some: np.ndarray) -> np.ndarray:
    """log2 of the probability of the letters of each word numbered in ``some``, in lower case and apart from its neighbours."""
    start, end = found.start[some], found.end[some]
    bounds = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    letters = found.low[np.repeat(start - bounds[:-1], end - start) + np.arange(bounds[-1])]
    sums = np.concatenate([[0], np.cumsum(table[codes(letters, bounds)], dtype=np.float64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def every_word_bits(found: T.Words, table: np.ndarray) -> np.ndarray:
    """``word_bits`` of all words, each distinct one spelled once."""
    order, out = T.ordered(found.hash), np.empty(len(found.hash))
    new = _begins(found.hash[order])
    out[order] = word_bits(found, table, order[new])[np.cumsum(new) - 1]
    return out


def _begins(keys: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Which of the sorted ``keys`` differ from the one before, or do in one of ``more``."""
    new = np.ones(len(keys), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in (keys, *more)])
    return new


def _added(values: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values[order], first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)


def lexicon(trusted: DataFrame, letters) -> DataFrame:
    """``w, name, bits`` of each language's words, and of the mark before its texts."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch["name"].to_pylist()
            for at, data, bounds in T.chunks(batch["text"], SLICE):
                found = T.words(data, bounds, T.SPACES, True)
                names = every[at : at + len(bounds) - 1]
                of, _, _, word = bigrams(found, names)
                order = T.ordered(word)
                one = order[_begins(word[order])]
                marks = sorted(set(names))
                keys = np.concatenate([word[one], T.mixed(~_salts(marks))]).view(np.int64)
                bits = np.concatenate([word_bits(found, letters.value, one), np.zeros(len(marks))]).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([names[i] for i in of[one].tolist()] + marks, pa.string()), pa.array(bits)], names=["w", "name", "bits"])

    rows = trusted.select("name", "text").mapInArrow(listed, "w long, name string, bits float")
    return rows.groupBy("w").agg(F.min("name").alias("name"), F.min("bits").alias("bits"))


_COUNTED = "part int, b binary, many binary, c binary, n binary, t binary"


def _raw(row: dict, kinds: dict[str, type]) -> list[np.ndarray]:
    return [np.frombuffer(row[c].as_buffer(), t) for c, t in kinds.items()]


_KINDS = {"b": T.U, "many": np.uint32, "c": T.U, "n": np.uint64, "t": np.uint64}


def _packed_counts(part: int, b: np.ndarray, c: np.ndarray, n: np.ndarray, t: np.ndarray) -> tuple:
    """Bigrams added up, in order: each word before once, with how many follow it, and those with their counts."""
    order = T.ordered(c)
    order = order[T.ordered(b[order])]
    first = np.flatnonzero(_begins(b[order], c[order]))
    n, t, one = _added(n, order, first), _added(t, order, first), order[first]
    before, many = np.unique(b[one], return_counts=True)
    return part, *(x.tobytes() for x in (before, many.astype(np.uint32), c[one], n.astype(np.uint64), t.astype(np.uint64)))


def _batch(rows: list[tuple]) -> dict[str, pa.Array]:
    kinds = (pa.int32(), *[pa.binary()] * 5)
    return {c: pa.array([r[k] for r in rows], kinds[k]) for k, c in enumerate(("part", *_KINDS))}


def bigram_counts(trusted: DataFrame, shard: int, shards: int, parts: int, salts: int, within: int = 1) -> DataFrame:
    """Bigrams of a shard, which ``within`` smaller ones make up, of ``trusted`` (name, text, held), packed, a row per part of each smaller shard, numbered through: how often each occurs (``n``), and how often in texts not held out (``t``).

    Tasks add up what ``SLICE`` bytes of text have, and parts are added up in
    two steps if slices are very many, since each may have the same bigrams.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, held = batch["name"].to_pylist(), np.asarray(batch["held"].cast(pa.int8()), np.int64)
            for at, data, bounds in T.chunks(batch["text"], SLICE):
                size = len(bounds) - 1
                of, key, b, c = bigrams(T.words(data, bounds, T.SPACES, True), every[at : at + size])
                inner = shard_of(key, shards * within).astype(np.int64) - shard * within
                mine = np.flatnonzero((inner >= 0) & (inner < within))
                part, free = inner[mine] * parts + part_of(key[mine], parts), 1 - held[at : at + size][of[mine]]
                rows = [_packed_counts(int(p), b[mine[x]], c[mine[x]], np.ones(len(x), np.int64), free[x]) for p in np.unique(part) for x in [np.flatnonzero(part == p)]]
                if rows:
                    yield pa.RecordBatch.from_pydict(_batch(rows))

    def add(group: pa.Table) -> pa.Table:
        each = [_raw(row, _KINDS) for row in ({c: group[c][k] for c in _KINDS} for k in range(group.num_rows))]
        b = np.concatenate([np.repeat(x[0], x[1]) for x in each])
        c, n, t = (np.concatenate([x[k] for x in each]) for k in (2, 3, 4))
        return pa.table(_batch([_packed_counts(group["part"][0].as_py(), b, c, n.astype(np.int64), t.astype(np.int64))]))

    rows = trusted.select("name", "text", "held").mapInArrow(count, _COUNTED)
    if salts > 1:
        rows = rows.withColumn("salt", F.spark_partition_id() % salts).groupBy("part", "salt").applyInArrow(lambda g: add(g.drop_columns(["salt"])), _COUNTED)
    return written(rows.groupBy("part").applyInArrow(add, _COUNTED), "bigrams")


_STATS = [f"{x}_{v}" for v in "nt" for x in ("s", "a", "f1", "f2", "f3", "f4", "k")]


def word_counts(pieces: list[DataFrame], parts: int) -> DataFrame:
    """Per word ``w`` of ``bigram_counts`` and v of n (all trusted text) and t (without held-out texts): what follows it and precedes it.

    ``s_v`` words follow it, ``a_v`` distinct ones, ``f1_v`` to ``f4_v`` of
    these so many times; ``k_v`` distinct words precede it. Each piece
    has ``parts`` rows at most.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                b, many, c, *counts = _raw({x: batch[x][k] for x in _KINDS}, _KINDS)
                if not len(b):
                    continue
                w = np.unique(np.concatenate([b, c]))
                first, left, right = np.cumsum(many, dtype=np.int64) - many, np.searchsorted(w, b), np.searchsorted(w, c)
                out = [w.view(np.int64)]
                for n in counts:
                    total = np.zeros((7, len(w)), np.int64)
                    for row, x in enumerate((n.astype(np.int64), n > 0, n == 1, n == 2, n == 3, n == 4)):
                        total[row, left] = np.add.reduceat(x, first, dtype=np.int64)
                    total[6] = np.bincount(right[n > 0], minlength=len(w))
                    out += list(total)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["w", *_STATS])

    together = reduce(DataFrame.union, pieces).drop("part").coalesce(max(1, len(pieces) * parts // TALLIED))
    every = together.mapInArrow(tally, "w long, " + ", ".join(f"{c} long" for c in _STATS))
    return every.groupBy("w").agg(*(F.sum(c).alias(c) for c in _STATS))


def _cuts(n: list[str], total: str, to: str) -> list[str]:
    """Modified Kneser-Ney discounts ``{to}1`` to ``{to}3`` from the columns of numbers of n-grams counted once to four times, or a half per count where those are 0."""
    n1, n2, n3, n4 = n
    y = f"({n1} / ({n1} + 2 * {n2}))"
    some = f"least({n1}, {n2}, {n3}) > 0"
    raw = (f"1 - 2 * {y} * {n2} / {n1}", f"2 - 3 * {y} * {n3} / {n2}", f"3 - 4 * {y} * {n4} / {n3}")
    return [f"if({some}, greatest(0.1D, least({k}D, {x})), {0.25 + 0.25 * k if k > 1 else 0.5}D) as {to}{k}" for k, x in enumerate(raw, 1)] + [f"cast({total} as double) as {to}s"]


def _less(v: str, cut: str, which: str) -> str:
    """A count less its discount, not below 0."""
    return f"greatest({v} - case when {v} >= 3 then {cut}3_{which} when {v} = 2 then {cut}2_{which} else {cut}1_{which} end, 0D)"


def _taken(one: str, two: str, more: str, cut: str, which: str) -> str:
    """What discounts take off so many counts of one, two and more."""
    return f"({cut}1_{which} * {one} + {cut}2_{which} * {two} + {cut}3_{which} * {more})"


def word_model(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``w, name, s_v, d_v, g_v, one_v`` of each word, and ``name, z_v`` and discounts of each language, for v of n and t.

    A word that trusted text lacks has the probability of its letters times
    2^z. Known words add ``d`` where they occur and ``g``, the weight of their
    context, where they come before another; known bigrams add to that what
    ``bigram_gains`` gives. So only what trusted text has needs to be joined,
    and the sum is the log2 of the interpolated probability.
    """
    tally = [x for v in "nt" for x in (F.sum(f"s_{v}").alias(f"s_{v}"), *(F.sum(f"f{k}_{v}").alias(f"f{k}_{v}") for k in (1, 2, 3, 4)), F.sum(f"k_{v}").alias(f"k_{v}"), *(F.count_if(F.col(f"k_{v}") == k).alias(f"k{k}_{v}") for k in (1, 2, 3, 4)), F.count_if(F.col(f"k_{v}") > 2).alias(f"m_{v}"))]
    cuts = words.groupBy("name").agg(*tally)
    for v in "nt":
        both = [x + f"_{v}" for x in _cuts([f"f{k}_{v}" for k in (1, 2, 3, 4)], f"s_{v}", "p") + _cuts([f"k{k}_{v}" for k in (1, 2, 3, 4)], f"k_{v}", "q")]
        cuts = cuts.selectExpr("*", *both).selectExpr("*", f"if(qs_{v} > 0, log2({_taken(f'k1_{v}', f'k2_{v}', f'm_{v}', 'q', v)} / qs_{v}), 0D) as z_{v}")
    cuts = written(cuts.select("name", *(f"{x}_{v}" for x in ("z", "qs", "q1", "q2", "q3", "p1", "p2", "p3") for v in "nt")), "languages")
    rows = words.join(small(cuts), "name")
    for v in "nt":
        rows = rows.withColumn(f"g_{v}", F.expr(f"if(s_{v} > 0, log2({_taken(f'f1_{v}', f'f2_{v}', f'(a_{v} - f1_{v} - f2_{v})', 'p', v)} / s_{v}), 0D)"))
        rows = rows.withColumn(f"one_{v}", F.expr(f"if(k_{v} > 0, log2({_less(f'k_{v}', 'q', v)} / qs_{v} + pow(2D, z_{v} + bits)), z_{v} + bits)"))
        rows = rows.withColumn(f"d_{v}", F.expr(f"one_{v} - z_{v} - bits"))
    numbers = [F.col(f"{x}_{v}").cast("float").alias(f"{x}_{v}") for x in ("d", "g", "one") for v in "nt"]
    return written(rows.select("w", "name", "s_n", "s_t", *numbers), "weights"), cuts


def lot_of(keys: np.ndarray, lots: int) -> np.ndarray:
    return ((keys >> T.U(16) & T.U(0xFFFFFFFF)) * T.U(lots) >> T.U(32)).astype(np.int64)


_GIVEN = "part int, known binary, values binary, counts binary, langs binary, cuts binary"
_GIVEN_KINDS = tuple(pa.binary() for _ in range(5))


def lots_of_words(weights: DataFrame, cuts: DataFrame, lots: int) -> DataFrame:
    """``weights`` packed, a row per lot of words: ``w`` in order, ``g`` and ``one``, numbers of words that follow, and each word's row of discounts in ``cuts``."""

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        w = np.asarray(group["w"]).view(T.U)
        order = np.argsort(w)
        langs = group["name"].combine_chunks().dictionary_encode()
        langs = langs.combine_chunks() if isinstance(langs, pa.ChunkedArray) else langs
        of, one = np.unique(np.asarray(langs.indices), return_index=True)
        discounts = np.zeros((len(of), 6))
        discounts[of] = np.stack([np.asarray(group[f"p{k}_{v}"], np.float64)[one] for v in "nt" for k in (1, 2, 3)], axis=1)
        values = np.stack([np.asarray(group[c], np.float32)[order] for c in ("g_n", "g_t", "one_n", "one_t")])
        counts = np.stack([np.asarray(group[c], np.int64)[order] for c in ("s_n", "s_t")])
        row = (w[order], values, counts, np.asarray(langs.indices, np.uint32)[order], discounts)
        return pa.table({"lot": pa.array([key[0].as_py()], pa.int32())} | {c: [x.tobytes()] for c, x in zip(("known", "values", "counts", "langs", "cuts"), row, strict=True)})

    rows = weights.join(small(cuts.select("name", *(f"p{k}_{v}" for v in "nt" for k in (1, 2, 3)))), "name")
    rows = rows.withColumn("lot", F.expr(f"cast(shiftright((shiftrightunsigned(w, 16) & 4294967295L) * {lots}L, 32) as int)"))
    return rows.groupBy("lot").applyInArrow(pack, "lot int, " + _GIVEN.partition(", ")[2])


def bigram_gains(counted: DataFrame, words: DataFrame, own: DataFrame, lots: int) -> DataFrame:
    """``part, known, values, seen`` per part of ``bigram_counts``: keys of its bigrams, and of its ``own`` words, in order (as ``_closed`` packs them), with what each adds, and how many words and bigrams of trusted text they are.

    A part asks lots of ``words`` for the distinct words of its bigrams, and
    what they give meets the bigrams in one task; both are packed, so no row
    is made of each bigram.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                b, _, c, _, _ = _raw({x: batch[x][k] for x in _KINDS}, _KINDS)
                w = np.unique(np.concatenate([b, c]))
                lot = lot_of(w, lots)
                order = np.argsort(lot, kind="stable")
                for x in np.split(order, np.flatnonzero(np.diff(lot[order])) + 1):
                    if len(x):
                        yield pa.RecordBatch.from_arrays([pa.array([int(lot[x[0]])], pa.int32()), batch["part"].slice(k, 1), pa.array([w[x].tobytes()], pa.binary())], names=["lot", "part", "w"])

    def give(asked_: pa.Table, lot: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if lot.num_rows:
            known, values, counts, langs, discounts = (np.frombuffer(lot[c][0].as_buffer(), t) for c, t in (("known", T.U), ("values", np.float32), ("counts", np.int64), ("langs", np.uint32), ("cuts", np.float64)))
            values, counts = values.reshape(4, -1), counts.reshape(2, -1)
            for r in range(asked_.num_rows):
                w = np.frombuffer(asked_["w"][r].as_buffer(), T.U)
                at = np.minimum(np.searchsorted(known, w), len(known) - 1)
                at = at[known[at] == w]
                out.append((asked_["part"][r].as_py(), *(x.tobytes() for x in (known[at], values[:, at], counts[:, at], langs[at], discounts))))
        return pa.table({c.split()[0]: pa.array([x[k] for x in out], t) for k, (c, t) in enumerate(zip(_GIVEN.split(", "), (pa.int32(), *_GIVEN_KINDS), strict=True))})

    def gain(key: tuple, counted_: pa.Table, given: pa.Table) -> pa.Table:
        keys, values, parts, seen = [], [], [], 0
        for r in range(given.num_rows):
            row = [np.frombuffer(given[c][r].as_buffer(), t) if given[c][r].is_valid else None for c, t in (("known", T.U), ("values", np.float32), ("counts", np.int64), ("langs", np.uint32), ("cuts", np.float64))]
            if row[2] is None:
                keys.append(row[0])
                values.append(row[1].reshape(4, -1))
                seen += given["seen"][r].as_py()
            else:
                cut = row[4].reshape(-1, 6)
                parts.append((row[0], row[1].reshape(4, -1), row[2].reshape(2, -1), row[3] + sum(len(x[4]) for x in parts), cut))
        if counted_.num_rows and parts:
            w, (g_one, counts) = np.concatenate([x[0] for x in parts]), (np.concatenate([x[k] for x in parts], axis=1) for k in (1, 2))
            langs, cuts = (np.concatenate([x[k] for x in parts]) for k in (3, 4))
            order = T.ordered(w)
            w, g_one, counts, langs = w[order], g_one[:, order], counts[:, order], langs[order]
            for r in range(counted_.num_rows):
                b, many, c, *ns = _raw({x: counted_[x][r] for x in _KINDS}, _KINDS)
                left, right = np.repeat(np.searchsorted(w, b), many), np.searchsorted(w, c)
                out = np.zeros((4, len(c)), np.float32)
                seen += int(ns[0].sum())
                for v, n in enumerate(ns):
                    some = np.flatnonzero(n > 0)
                    i, j, n = left[some], right[some], n[some].astype(np.int64)
                    under = (g_one[v, i] + g_one[2 + v, j]).astype(np.float64)
                    less = np.maximum(n - cuts[langs[i], 3 * v + np.minimum(n, 3) - 1], 0)
                    out[v, some] = np.log2(less / counts[v, i] + np.exp2(under)) - under
                keys.append(T.mixed((np.repeat(b, many) * T.U(0x9FB21C651E98DF25)) ^ c))
                values.append(out)
        if not keys:
            return pa.table({c: pa.array([], t) for c, t in (("part", pa.int32()), ("known", pa.binary()), ("values", pa.binary()), ("seen", pa.int64()))})
        known = np.concatenate(keys)
        order = T.ordered(known)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "known": [_closed(known[order])], "values": [np.concatenate(values, axis=1)[:, order].tobytes()], "seen": pa.array([seen], pa.int64())})

    wanted = counted.mapInArrow(ask, "lot int, part int, w binary")
    given = wanted.groupBy("lot").cogroup(words.groupBy("lot")).applyInArrow(give, _GIVEN)
    own = own.select("part", "known", "values", *(F.lit(None).cast("binary").alias(c) for c in ("counts", "langs", "cuts")), "seen")
    given = given.withColumn("seen", F.lit(None).cast("long"))
    return counted.groupBy("part").cogroup(given.union(own).groupBy("part")).applyInArrow(gain, "part int, known binary, values binary, seen long")


def _closed(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, byte plane by byte plane: the upper planes hold zeros, which compress."""
    return np.diff(keys, prepend=T.U(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _opened(raw: pa.Buffer) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(T.U).reshape(-1), dtype=T.U)


def _short(x: np.ndarray) -> bytes:
    """Numbers from 0 in as few bytes each as the largest takes, and that size before them."""
    kind = np.min_scalar_type(int(x.max())) if len(x) else np.dtype(np.uint8)
    return bytes([kind.itemsize]) + x.astype(kind).tobytes()


def _long(raw: pa.Buffer) -> np.ndarray:
    size = raw[0]
    return np.frombuffer(raw, f"<u{size}", offset=1)


def asked(docs: DataFrame, shard: int, shards: int, parts: int) -> DataFrame:
    """The distinct words and bigrams in a shard of ``docs`` (id, name, text), packed: a row per slice of text and part of the shard.

    ``keys`` stand in order (as ``_closed`` packs them), ``rows`` says how many texts have each, ``place``
    which ones (numbers in ``ids``), ``m`` how often, and ``f`` how often a
    word comes before another; ``slice`` numbers the slices.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = itertools.count(TaskContext.get().partitionId() << 32)
        for batch in (whole.slice(at, 1 << 15) for whole in batches for at in range(0, whole.num_rows, 1 << 15)):
            every, ids = batch["name"].to_pylist(), np.asarray(batch["id"])
            for at, data, bounds in T.chunks(batch["text"], SLICE):
                n, number = len(bounds) - 1, next(slices)
                of, key, b, c = bigrams(T.words(data, bounds, T.SPACES, True), every[at : at + n])
                mine = [np.flatnonzero(shard_of(x, shards) == T.U(shard)) for x in (key, c, b)]
                keys = np.concatenate([x[i] for x, i in zip((key, c, b), mine, strict=True)])
                word = np.repeat([1, 1, 0], [len(i) for i in mine])
                texts = of[np.concatenate(mine)]
                by_text = np.argsort(texts.astype(np.uint16), kind="stable")
                order = by_text[T.ordered(keys[by_text])]
                keys, texts, word = keys[order], texts[order], word[order]
                first = np.flatnonzero(_begins(keys, texts))
                m = np.add.reduceat(word, first) if len(first) else word
                f = np.diff(np.append(first, len(keys))) - m
                keys, texts = keys[first], texts[first]
                part, new, out = part_of(keys, parts).astype(np.int32), _begins(keys), []
                for p in range(parts) if parts < 1000 else np.unique(part).tolist():
                    here = np.flatnonzero(part == p)
                    if len(here):
                        begins = np.flatnonzero(new[here])
                        held = np.zeros(n, bool)
                        held[texts[here]] = True
                        place = (np.cumsum(held) - 1)[texts[here]]
                        arrays = (np.diff(np.append(begins, len(here))), place, m[here], f[here])
                        out.append((number, p, _closed(keys[here][begins]), ids[at : at + n][held].tobytes(), *map(_short, arrays)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), *[pa.binary()] * 6), strict=True)], names=["slice", "part", "keys", "ids", "rows", "place", "m", "f"])

    return docs.select("id", "name", "text").mapInArrow(ask, "slice long, part int, keys binary, ids binary, rows binary, place binary, m binary, f binary")


def packed(model: DataFrame, parts: int) -> DataFrame:
    """``part, known, values, seen`` from ``model`` (key, d_n, d_t, g_n, g_t, s_n): keys in order, four numbers each, and how many words they are in trusted text."""

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        keys = np.asarray(group["key"]).view(T.U)
        order = T.ordered(keys)
        values = np.stack([np.asarray(group[c], np.float32)[order] for c in ("d_n", "d_t", "g_n", "g_t")])
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "known": [keys[order].tobytes()], "values": [values.tobytes()], "seen": pa.array([int(np.asarray(group["s_n"]).sum())], pa.int64())})

    part = F.expr(f"cast(shiftright((key & 4294967295L) * {parts}L, 32) as int)")
    return model.withColumn("part", part).groupBy("part").applyInArrow(pack, "part int, known binary, values binary, seen long")


def joined_sums(questions: DataFrame, model: DataFrame, pairs: int) -> DataFrame:
    """``slice, ids, sums``: what the known words and bigrams of a part add to each text of a slice, packed.

    A part of the model stands before the questions to it in one task, which
    holds that part and a batch of questions at a time, however many they are;
    where many are likely, by how often trusted text has what is in the part,
    a copy of the part stands in each of several tasks. ``pairs`` is how many
    n-grams of texts the questions have at most.
    """
    total = model.agg(F.coalesce(F.sum("seen"), F.lit(0))).first()[0]
    share = f"{pairs / max(1, total)!r}D / {TASK_PAIRS}"
    tasks = small(model.select("part", F.expr(f"cast(greatest(1, ceil(seen * {share})) as int) as tasks")))
    left = questions.join(tasks, "part").withColumn("task", F.pmod(F.xxhash64("keys"), F.col("tasks")).cast("int"))
    left = left.selectExpr("part", "task", "1 as kind", "slice", "keys", "ids", "rows", "place", "m", "f")
    right = model.join(tasks, "part").withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))
    right = right.selectExpr("part", "task", "0 as kind", "0L as slice", "known as keys", "values as ids", *(f"cast(null as binary) as {c}" for c in ("rows", "place", "m", "f")))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = values = None
        for batch in batches:
            found: list[tuple] = []
            for r in range(batch.num_rows):
                raw = {c: batch[c][r].as_buffer() for c in ("keys", "ids", "rows", "place", "m", "f") if batch[c][r].is_valid}
                keys = _opened(raw["keys"])
                if not batch["kind"][r].as_py():
                    known, values = keys, np.array(np.frombuffer(raw["ids"], np.float32).reshape(4, -1))
                    continue
                ids, rows, place, m, f = np.frombuffer(raw["ids"], np.int64), *(_long(raw[c]) for c in ("rows", "place", "m", "f"))
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = np.repeat(known[at] == keys, rows)
                at, place, m, f = np.repeat(at, rows)[hit], place[hit], m[hit], f[hit]
                sums = np.stack([np.bincount(place, m * values[v, at].astype(np.float64) + f * values[v + 2, at].astype(np.float64), len(ids)) for v in (0, 1)])
                found.append((batch["slice"][r].as_py(), ids.tobytes(), sums.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=["slice", "ids", "sums"])

    dealt = right.union(left).repartition("part", "task").sortWithinPartitions("part", "task", "kind")
    return dealt.mapInArrow(look, "slice long, ids binary, sums binary")


def added_sums(sums: DataFrame) -> DataFrame:
    """``id, sum_n, sum_t`` of all parts of ``joined_sums``: a slice's rows are added up in one task, and texts of several slices after that."""

    def add(group: pa.Table) -> pa.Table:
        every = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in group["ids"]])
        ids, place = np.unique(every, return_inverse=True)
        sums = np.concatenate([np.frombuffer(x.as_buffer(), np.float64).reshape(2, -1) for x in group["sums"]], axis=1)
        return pa.table({"id": ids, "sum_n": np.bincount(place, sums[0]), "sum_t": np.bincount(place, sums[1])})

    per = sums.groupBy("slice").applyInArrow(add, "id long, sum_n double, sum_t double")
    return per.groupBy("id").agg(F.sum("sum_n").alias("sum_n"), F.sum("sum_t").alias("sum_t"))


def spelling(docs: DataFrame, letters) -> DataFrame:
    """``id, name, bytes, words, bits`` per row of ``docs``: log2 of its probability were all its words unknown, less the weight of unknown words."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, bounds in T.chunks(batch["text"]):
                n, table = len(bounds) - 1, letters.value
                found = T.words(data, bounds, T.SPACES, True)
                of = np.repeat(np.arange(n), np.diff(found.first))
                blank = np.flatnonzero(T.among(data, T.SPACES))
                where = np.repeat(np.arange(n), np.diff(np.searchsorted(blank, bounds)))
                bits = np.bincount(of, every_word_bits(found, table), minlength=n) + np.bincount(where, table[codes(data, bounds)[blank]], minlength=n)
                yield pa.RecordBatch.from_arrays([batch["id"].slice(at, n), batch["name"].slice(at, n), pa.array(np.diff(bounds)), pa.array(np.diff(found.first)), pa.array(bits)], names=["id", "name", "bytes", "words", "bits"])

    return docs.select("id", "name", "text").mapInArrow(spell, "id long, name string, bytes long, words long, bits double")


def perplexities(docs: DataFrame, trusted: DataFrame, shards: int | None = None) -> DataFrame:
    """``id, p_n, p_t``: perplexity per character by all of ``trusted``, and by that not held out.

    Rows of one id are equal in name and text, and so are averages over them.
    """
    letters = docs.sparkSession.sparkContext.broadcast(letter_table(trusted))
    base = spelling(docs, letters).where("bytes > 0").groupBy("id").agg(F.min("name").alias("name"), *(F.sum(x).alias(x) for x in ("bytes", "words", "bits")))
    base = written(base, "spelled")
    total = base.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    shards = shards or min(SHARDS, max(1, -(-total // SHARD_WORDS)))
    parts = max(1, -(-total // (shards * PART_WORDS)))
    salts = max(1, math.isqrt(total // 4_000_000) // 4)
    within = math.gcd(shards, COUNTED)
    counted = [bigram_counts(trusted, k, shards // within, parts, salts, within) for k in range(shards // within)]
    words = written(word_counts(counted, parts * within).join(lexicon(trusted, letters), "w"), "lexicon")
    weights, cuts = word_model(words)
    dropped(words)
    lots = max(1, shards * parts // LOT_PARTS)
    packed_words = written(lots_of_words(weights, cuts, lots), "lots")
    found = []
    for shard in range(shards):
        mine = F.expr(f"shiftright(shiftrightunsigned(w, 48) * {shards}L, 16) = {shard}")
        own = packed(weights.where(mine).select(F.col("w").alias("key"), "d_n", "d_t", "g_n", "g_t", "s_n"), parts)
        begin = shard % within * parts
        piece = counted[shard // within].where(F.col("part").between(begin, begin + parts - 1)).withColumn("part", F.col("part") - begin)
        model = written(bigram_gains(piece, packed_words, own, lots), "model")
        if (shard + 1) % within == 0:
            dropped(counted[shard // within])
        sums = joined_sums(asked(docs, shard, shards, parts), model, 2 * total // shards)
        found.append(written(added_sums(sums), "sums", {ARROW_BYTES: str(1 << 25)}))
        dropped(model)
    sums = reduce(DataFrame.union, found).groupBy("id").agg(F.sum("sum_n").alias("sum_n"), F.sum("sum_t").alias("sum_t"))
    every = base.join(small(cuts.select("name", "z_n", "z_t")), "name", "left").join(sums, "id", "left")
    every = written(every.select("id", *(F.expr(f"pow(2D, -(bits + words * coalesce(z_{v}, 0D) + coalesce(sum_{v}, 0D)) / bytes) as p_{v}") for v in "nt")), "perplexities")
    dropped(base, weights, packed_words, cuts, *found)
    return every


def thresholds(known: DataFrame, share: float, slack: float) -> DataFrame:
    """``name, threshold``: ``slack`` times the ``share`` quantile of a language's held-out perplexities.

    ``known`` has ``name, held, p_n, p_t`` of trusted rows. A language without
    held-out rows, or with nothing else, has the quantile of all its rows by
    all counts.
    """
    out = F.percentile_approx(F.when(F.col("held"), F.col("p_t")), share, 10000)
    every = F.percentile_approx("p_n", share, 10000)
    cut = F.when(F.count_if(~F.col("held")) > 0, F.coalesce(out, every)).otherwise(every)
    return known.groupBy("name").agg((cut * slack).alias("threshold"))


def classified(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", share: float = 0.95, slack: float = 1.2, shards: int | None = None) -> DataFrame:
    """``docs`` with ``perplexity, threshold, accepted``.

    ``trusted`` holds keys of trusted rows; the models, one per language
    however small, are trained on all their text, and a null language is one
    of its own. A row is rejected if its perplexity exceeds its language's
    threshold: ``slack`` times the ``share`` quantile of that language's
    trusted rows. For thresholds, one trusted text in ``FOLDS`` (picked by its
    hash, so that copies go together) is measured by the counts of the others,
    since a text that is counted itself looks too good. Null or empty texts
    have no perplexity and are accepted. A language without trusted text has no
    threshold, and its rows are accepted. Rows that repeat are scored each;
    columns named as a new one are replaced.
    """
    docs = docs.drop(*(c for c in ("perplexity", "threshold", "accepted") if c in docs.columns))
    name = F.coalesce(F.concat(F.lit("="), F.col(lang).cast("string")), F.lit("-"))
    named = docs.withColumn("__name", name).withColumn("__id", F.xxhash64("__name", F.col(text)))
    rows = named.select(F.col("__id").alias("id"), F.col("__name").alias("name"), F.col(text).alias("text"), F.col(key).alias("__key"))
    keys = trusted.select(F.col(key).alias("__key")).where(F.col("__key").isNotNull()).distinct()
    many = keys.count() > SMALL_ROWS
    good = rows.join(keys if many else F.broadcast(keys), "__key", "left_semi").drop("__key").withColumn("held", F.pmod(F.xxhash64("text", F.lit(1)), F.lit(FOLDS)) == 0)
    good = written(good, "trusted") if many else good
    found = perplexities(rows, good, shards)
    within = written(thresholds(good.select("id", "name", "held").join(found, "id"), share, slack), "cuts")
    out = named.join(found.select(F.col("id").alias("__id"), F.col("p_n").alias("perplexity")), "__id", "left")
    out = out.join(small(within.withColumnRenamed("name", "__name")), "__name", "left").drop("__id", "__name")
    return out.withColumn("accepted", ~F.coalesce(F.col("perplexity") > F.col("threshold"), F.lit(False)))
