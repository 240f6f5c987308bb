"""Language identification: scripts narrow the candidates, words are scored by letter n-grams, and a Viterbi path labels the spans of mixed text.

Words are runs of letters of one script. A model holds, for each language of
the training rows, how often hashed n-grams of two to four bytes occur in its
words, and which scripts it is written in. A text's words are labelled by the
path of highest score, on which a change of language costs a penalty; all
texts of a slice take a step at once, and long ones are cut into pieces that
are joined exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .store import ARROW_BYTES, written

#: Bytes of text in a slice, n-grams that count, cells of all languages together, of one language at most, and in a row that tasks send.
SLICE, ORDERS, ALL_CELLS, CELLS, PIECE = 1 << 22, (2, 3, 4), 1 << 22, 1 << 18, 1 << 14
#: Languages that a task counts before it sends what it has.
HELD = 32
#: What a change of language costs, the frequency below which n-grams are alike, the share of a language's letters that makes a script its own, and what a word costs in a language of other scripts.
PENALTY, RARE, OWN_SCRIPT, FOREIGN = 12.0, 1e-6, 0.01, 40.0
#: Words of a piece of a long text.
STEPS = 1024

#: First and last code point of each script's letters.
SCRIPTS = {
    "Latin": ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)),
    "Greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)), "Cyrillic": ((0x400, 0x52F),), "Armenian": ((0x531, 0x586),), "Hebrew": ((0x5D0, 0x5F2),),
    "Arabic": ((0x620, 0x65F), (0x66E, 0x6D3), (0x6FA, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFC)),
    "Devanagari": ((0x900, 0x963),), "Bengali": ((0x980, 0x9E3),), "Gurmukhi": ((0xA01, 0xA5E),), "Gujarati": ((0xA81, 0xAE3),), "Tamil": ((0xB82, 0xBD7),), "Telugu": ((0xC00, 0xC63),),
    "Kannada": ((0xC80, 0xCE3),), "Malayalam": ((0xD00, 0xD63),), "Sinhala": ((0xD81, 0xDDF),), "Thai": ((0xE01, 0xE4E),), "Lao": ((0xE81, 0xECD),), "Tibetan": ((0xF40, 0xFBC),),
    "Myanmar": ((0x1000, 0x103F), (0x1050, 0x109D)), "Georgian": ((0x10A0, 0x10FF),), "Hangul": ((0x1100, 0x11FF), (0x3131, 0x318E), (0xAC00, 0xD7A3)), "Ethiopic": ((0x1200, 0x135F),),
    "Khmer": ((0x1780, 0x17D3),), "Mongolian": ((0x1820, 0x18AA),), "Kana": ((0x3041, 0x3096), (0x309D, 0x30FF), (0x31F0, 0x31FF)),
    "Han": ((0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)),
}
_RANGES = sorted((low, high, k) for k, each in enumerate(SCRIPTS.values(), 1) for low, high in each)
_LOW, _HIGH, _SCRIPT = (np.array(x) for x in zip(*_RANGES, strict=True))


def script_of(points: np.ndarray) -> np.ndarray:
    """Number of each code point's script, from 1 on; 0 where it is no letter of one."""
    at = np.maximum(np.searchsorted(_LOW, points, side="right") - 1, 0)
    return np.where((points >= _LOW[at]) & (points <= _HIGH[at]), _SCRIPT[at], 0).astype(np.uint8)


_ASCII = np.concatenate([script_of(np.arange(128)), np.zeros(128, np.uint8)])


class Words(NamedTuple):
    """Words of texts: spans of bytes, scripts, letters, hashes, each text's first word, and the bytes with A-Z and Latin-1 capitals lowered."""

    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    letters: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    low: np.ndarray


def words(data: np.ndarray, bounds: np.ndarray) -> Words:
    n = len(data)
    low = np.zeros(n + 8, np.uint8)
    low[:n] = T.LOWER[data]
    script = _ASCII[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        wide = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
        points = (low[lead] & np.array([0, 0, 0x1F, 0x0F, 0x07], np.uint8)[wide]).astype(np.int64)
        for k in (1, 2, 3):
            more = wide > k
            points[more] = points[more] << 6 | (low[lead[more] + k] & 0x3F)
        kinds = script_of(points)
        for k in range(4):
            here = (wide > k) & (lead + k < n)
            script[lead[here] + k] = kinds[here]
        capital = lead[(points >= 0xC0) & (points <= 0xDE) & (points != 0xD7)]
        low[capital + 1] += 0x20
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    begins = script > 0
    ends = begins.copy()
    if n:
        change = (script[1:] != script[:-1]) | edge[1:n]
        begins[1:] &= change
        ends[:-1] &= change
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return Words(start, end, script[start], leads[end] - leads[start], T.word_hashes(low, start, end), np.searchsorted(start, bounds), low)


def grams(found: Words, one: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, cell) of all n-grams of the words ``one``, with a blank before and after."""
    size = found.end[one] - found.start[one] + 2
    of = np.repeat(np.arange(len(one)), size)
    place = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    inside = (place > 0) & (place < size[of] - 1)
    letters = np.full(len(of), 0x20, np.uint64)
    letters[inside] = found.low[(found.start[one][of] + place - 1)[inside]]
    out, shift = [], T.U(64 - (cells.bit_length() - 1))
    for n in ORDERS:
        last = np.flatnonzero(place >= n - 1)
        code = np.full(len(last), n, np.uint64)
        for k in range(n):
            code = code << T.U(8) | letters[last - k]
        out.append((of[last], (T.mixed(code) >> shift).astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Model(NamedTuple):
    """Languages in order, log2 frequencies of their n-grams, which scripts each uses, and the log2 share of each in the training letters."""

    names: list[str]
    bits: np.ndarray
    allowed: np.ndarray
    prior: np.ndarray


def in_training(key: Column) -> Column:
    """Rows that models may learn from: all but one in five, by the checksum of the key."""
    return F.crc32(key.cast("string").cast("binary")) % 5 != 0


def trained(rows: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """From all ``rows`` whose language is not null. Counts are added up by task, then by language and piece, in two steps."""
    rows = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("__text"), F.col(lang).cast("string").alias("__lang"))
    names = sorted(r[0] for r in rows.select("__lang").distinct().collect())
    cells = 1 << max(8, min(CELLS.bit_length() - 1, ALL_CELLS.bit_length() - 1 - max(len(names) - 1, 0).bit_length()))
    piece = min(PIECE, cells)

    def sent(held: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
        out = [(name, -1, scripts.tobytes()) for name, (_, scripts) in held.items()]
        out += [(name, k, part.tobytes()) for name, (total, _) in held.items() for k, part in enumerate(total.reshape(-1, piece)) if part.any()]
        columns = [*zip(*out, strict=True)] or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.binary()), strict=True)], names=["name", "piece", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            every = batch["__lang"].to_pylist()
            for at, data, bounds in T.chunks(batch["__text"], SLICE):
                found = words(data, bounds)
                own = every[at : at + len(bounds) - 1]
                known = sorted(set(own))
                number = np.array([known.index(x) for x in own])[np.repeat(np.arange(len(own)), np.diff(found.first))] if own else np.zeros(0, int)
                for k, name in enumerate(known):
                    mine = np.flatnonzero(number == k)
                    _, one, times = np.unique(found.hash[mine], return_index=True, return_counts=True)
                    word, cell = grams(found, mine[one], cells)
                    total, scripts = held.setdefault(name, [np.zeros(cells, np.int64), np.zeros(len(SCRIPTS) + 1, np.int64)])
                    total += np.bincount(cell, times[word], minlength=cells).astype(np.int64)
                    scripts += np.bincount(found.script[mine], found.letters[mine], minlength=len(scripts)).astype(np.int64)
                    if len(held) > HELD:
                        yield sent(held)
                        held = {}
        yield sent(held)

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(len(group["counts"][0].as_buffer()) // 8, np.int64)
        for x in group["counts"]:
            total += np.frombuffer(x.as_buffer(), np.int64)
        return pa.table({"name": group["name"][:1], "piece": group["piece"][:1], "counts": [total.tobytes()]})

    kind = "name string, piece int, counts binary"
    parts = rows.mapInArrow(count, kind).withColumn("part", F.spark_partition_id() % 64)
    once = parts.groupBy("name", "piece", "part").applyInArrow(lambda t: add(t.select(["name", "piece", "counts"])), kind)
    counts, scripts = np.zeros((len(names), cells)), np.zeros((len(names), len(SCRIPTS) + 1))
    place = {name: k for k, name in enumerate(names)}
    for row in written(once.groupBy("name", "piece").applyInArrow(add, kind), "letters").toLocalIterator():  # ALL_CELLS numbers
        values = np.frombuffer(row["counts"], np.int64)
        if row["piece"] < 0:
            scripts[place[row["name"]]] = values
        else:
            counts[place[row["name"]], row["piece"] * piece : (row["piece"] + 1) * piece] = values
    letters = scripts.sum(axis=1)
    seen = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    allowed = (scripts >= OWN_SCRIPT * np.maximum(letters, 1)[:, None]).T
    allowed[~allowed.any(axis=1)] = True
    return Model(names, np.log2(seen + RARE).astype(np.float32), allowed, np.log2((letters + 1) / (letters.sum() + 1)))


def word_scores(found: Words, model: Model) -> np.ndarray:
    """Of each word in each language: log2 frequencies of its n-grams, added up and divided by the number of orders."""
    _, one, same = np.unique(found.hash, return_index=True, return_inverse=True)
    word, cell = grams(found, one, model.bits.shape[1])
    scores = np.stack([np.bincount(word, bits[cell], minlength=len(one)) for bits in model.bits], axis=1) / len(ORDERS)
    scores -= FOREIGN * ~model.allowed[found.script[one]]
    return scores[same]


def _steps(scores: np.ndarray, begin: np.ndarray, size: np.ndarray, start: np.ndarray, keep: bool) -> np.ndarray:
    """Best score of a path that ends at each word in each language (``keep``), or at the last of each run of words; all runs take a step at once."""
    order = np.argsort(-size, kind="stable")
    begin, size, state = begin[order], size[order], start[order].copy()
    out = np.zeros_like(scores) if keep else state
    for t in range(int(size[0]) if len(size) else 0):
        m = int(np.searchsorted(-size, -t))
        now, at = state[:m], begin[:m] + t
        np.maximum(now, now.max(axis=1, keepdims=True) - PENALTY, out=now)
        now += scores[at]
        if keep:
            out[at] = now
    if keep:
        return out
    last = np.empty_like(state)
    last[order] = state
    return last


def _passes(scores: np.ndarray, begin: np.ndarray, size: np.ndarray, of: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``_steps`` over texts whose pieces, in order, belong to ``of``: each piece starts as the one before ends, whatever its own start."""
    langs, state = scores.shape[1], start[of]
    later = np.flatnonzero(np.concatenate([[False], of[1:] == of[:-1]]))
    if len(later):
        needed = np.union1d(later, later - 1)
        unit = np.where(np.eye(langs, dtype=bool), 0.0, -1e15)
        each = np.repeat(needed, langs)
        ends = _steps(scores, begin[each], size[each], np.tile(unit, (len(needed), 1)), False).reshape(len(needed), langs, langs)
        for k in later:
            state[k] = (state[k - 1][:, None] + ends[np.searchsorted(needed, k - 1)]).max(axis=0)
    return _steps(scores, begin, size, state, True)


def path(scores: np.ndarray, first: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """The language of each word on the best path of its text: where the best scores of paths up to it and from it on add up to most."""
    n = np.diff(first)
    many = -(-n // STEPS)
    of = np.repeat(np.arange(len(n)), many)
    begin = first[:-1][of] + STEPS * (np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many))
    size = np.minimum(STEPS, first[1:][of] - begin)
    start = np.tile(prior, (len(n), 1))
    ahead = _passes(scores, begin, size, of, start)
    total = len(scores)
    back = _passes(scores[::-1], (total - begin - size)[::-1], size[::-1], of[::-1], np.zeros_like(start))[::-1]
    return np.argmax(ahead + back - scores, axis=1)


def identified(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score, spans`` per row.

    ``spans`` are maximal runs of words of one language, with ``start`` and
    ``end`` in code points; ``lang_pred`` is the language with the most
    letters in them, the first by name where they tie. ``score`` is its share
    of the letters times its chance against the others over all words. Texts
    that are null or have no letter are ``und``, as all are if nothing was
    learned, with score 0 and no spans; letters of other scripts than those
    known only get the language that training had most of, with score 0.
    Rows that repeat are labelled each, null keys too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at, data, bounds in T.chunks(batch["__text"], SLICE):
                n, part = len(bounds) - 1, batch.slice(at, len(bounds) - 1)
                letter = np.asarray(part["letter"].cast(pa.int8())) > 0
                if not own.names or not letter.any():
                    lang, score, spans = ["und"] * n, np.zeros(n), ([], [], [], np.zeros(n, int))
                else:
                    found = words(data, bounds)
                    scores = word_scores(found, own)
                    labels = path(scores, found.first, own.prior)
                    of, langs = np.repeat(np.arange(n), np.diff(found.first)), len(own.names)
                    share = np.bincount(of * langs + labels, found.letters, minlength=n * langs).reshape(n, langs)
                    whole = np.stack([np.bincount(of, x, minlength=n) for x in scores.T], axis=1) + own.prior
                    best = np.where(share.sum(axis=1) > 0, np.argmax(share, axis=1), int(np.argmax(own.prior)))
                    rows = np.arange(n)
                    chance = 1 / np.exp2(np.minimum(whole - whole[rows, best][:, None], 1000)).sum(axis=1)
                    score = np.where(letter, share[rows, best] / np.maximum(share.sum(axis=1), 1) * chance, 0.0)
                    lang = [own.names[k] if ok else "und" for k, ok in zip(best.tolist(), letter.tolist(), strict=True)]
                    new = np.ones(len(labels), bool)
                    new[1:] = (labels[1:] != labels[:-1]) | (of[1:] != of[:-1])
                    begin = np.flatnonzero(new)
                    last = np.append(begin[1:], len(labels)) - 1
                    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    base = points[bounds[:-1]][of[begin]]
                    spans = (points[found.start[begin]] - base, points[found.end[last]] - base, [own.names[k] for k in labels[begin].tolist()], np.bincount(of[begin], minlength=n))
                each = pa.StructArray.from_arrays([pa.array(spans[0], pa.int32()), pa.array(spans[1], pa.int32()), pa.array(spans[2], pa.string())], names=["start", "end", "lang"])
                listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(spans[3])]).astype(np.int32)), each)
                yield pa.RecordBatch.from_arrays([part["__key"], pa.array(lang), pa.array(score, pa.float64()), listed], names=["id", "lang_pred", "score", "spans"])

    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    return rows.mapInArrow(label, f"id {kind}, lang_pred string, score double, spans array<struct<start: int, end: int, lang: string>>").withColumnRenamed("id", key)
