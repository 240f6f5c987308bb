"""Cross-tokenizer alignment: byte cuts that two tokenizers share, found by divide and conquer, and how often ids meet at them.

A text is cut first where neither tokenizer can join: at a single space
between two solid characters. These pieces repeat, so a task encodes each
distinct one once. Within pieces the token ends of both sides are bisected for
a common one near the middle, both halves in turn; intervals without one are
the groups. A link is a pair of tokens whose ranges end together, so one's
bytes are a suffix of the other's: the pairs that can occur follow from the
two vocabularies, and that bounds the table of counts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .store import ARROW_BYTES, dropped, written

#: Where the vocabularies are, and which.
TOKENIZERS, BYTE_LEVEL, PIECES = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text in a slice, distinct pieces that a worker remembers, and pieces encoded at once.
SLICE, REMEMBERED, BATCH = 1 << 22, 500_000, 50_000
#: Fixed value: the pattern that byte-level vocabularies split by.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces of these bytes (printable ASCII, line ends and Latin letters) are split alike by either library that has the merges; the faster one gets them.
COMMON = re.compile(rb"[\n\x20-\x7E\xC3-\xC8\x80-\xBF]+")
#: Slices are long rows: few of them in a batch.
FEW_ROWS = {ARROW_BYTES: str(1 << 23), "spark.sql.parquet.columnarReaderBatchSize": "4"}


def byte_level_decoder() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Vocabularies(NamedTuple):
    """Both models as bytes, the bytes of each token (None: stands for none), the pairs that can be linked, whether texts may be cut at spaces, and whether ids of A follow the order of its merges."""

    a_model: bytes
    b_model: bytes
    a_bytes: list[bytes | None]
    b_bytes: list[bytes | None]
    pairs: np.ndarray
    cut: bool
    ranked: bool


def vocabularies(folder: str = TOKENIZERS, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> Vocabularies:
    """Read on the driver; tasks get the models by broadcast."""
    import sentencepiece

    with open(os.path.join(folder, byte_level), "rb") as f:
        a_model = f.read()
    with open(os.path.join(folder, pieces), "rb") as f:
        b_model = f.read()
    spec, decode = json.loads(a_model), byte_level_decoder()
    a_bytes: list[bytes | None] = [None] * (1 + max([*spec["model"]["vocab"].values(), *(x["id"] for x in spec["added_tokens"])]))
    for word, i in spec["model"]["vocab"].items():
        a_bytes[i] = bytes(decode[c] for c in word)
    model = sentencepiece.SentencePieceProcessor(model_proto=b_model)
    b_bytes: list[bytes | None] = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        b_bytes.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else None if model.is_control(i) or model.is_unknown(i) else piece.replace("▁", " ").encode())
    before = spec.get("pre_tokenizer") or {}
    regular = spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    cut = bool(regular) and not any(x and b" " in x.lstrip(b" ") for x in b_bytes)
    merges = ["".join(x.split(" ") if isinstance(x, str) else x) for x in spec["model"]["merges"]]
    ranked = bool(regular) and [spec["model"]["vocab"].get(x) for x in merges] == [*range(256, 256 + len(merges))]
    return Vocabularies(a_model, b_model, a_bytes, b_bytes, suffix_pairs(a_bytes, b_bytes), cut, ranked)


def suffix_pairs(a: list[bytes | None], b: list[bytes | None]) -> np.ndarray:
    """``a * len(b) + b``, ascending, of all ids of which one's bytes end with the other's."""
    ends: tuple[dict[bytes, list[int]], ...] = ({}, {})
    for own, words in zip(ends, (a, b), strict=True):
        for i, word in enumerate(words):
            if word:
                own.setdefault(word, []).append(i)
    found = {i * len(b) + j for i, word in enumerate(a) if word for k in range(len(word)) for j in ends[1].get(word[k:], ())}
    found |= {i * len(b) + j for j, word in enumerate(b) if word for k in range(1, len(word)) for i in ends[0].get(word[k:], ())}
    return np.array(sorted(found), np.int64)


def shared_cuts(a: np.ndarray, b: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b``, ascending ends of tokens, of all ends that both have.

    ``a_first`` and ``b_first`` bound the tokens of each piece; a piece's last
    ends are equal. All intervals of a depth are searched at once: around the
    middle of each, in windows four times as wide each time, ends of ``a`` are bisected
    in ``b``, and the hit nearest to the middle cuts the interval in two.
    """
    some = np.diff(a_first) > 0
    lo, hi, b_lo, b_hi = a_first[:-1][some], a_first[1:][some], b_first[:-1][some], b_first[1:][some]
    found, met = [hi - 1], [b_hi - 1]
    while len(lo):
        open_ = (hi - lo > 1) & (b_hi - b_lo > 1)
        lo, hi, b_lo, b_hi = lo[open_], hi[open_], b_lo[open_], b_hi[open_]
        at, to = np.full(len(lo), -1), np.full(len(lo), -1)
        middle, left, wide = (lo + hi - 2) // 2, np.arange(len(lo)), 1
        while len(left):
            begin, end = np.maximum(middle[left] - wide + 1, lo[left]), np.minimum(middle[left] + wide, hi[left] - 1)
            n = end - begin
            of = np.repeat(np.arange(len(left)), n)
            place = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(len(of))
            other = np.searchsorted(b, a[place])
            hit = np.flatnonzero(b[np.minimum(other, len(b) - 1)] == a[place])
            near = hit[np.lexsort((np.abs(place[hit] - middle[left][of[hit]]), of[hit]))]
            which, first = np.unique(of[near], return_index=True)
            at[left[which]], to[left[which]] = place[near[first]], other[near[first]]
            whole = (begin == lo[left]) & (end == hi[left] - 1)
            left, wide = left[~whole & (at[left] < 0)], wide * 4
        cut = at >= 0
        lo, hi, b_lo, b_hi, at, to = (x[cut] for x in (lo, hi, b_lo, b_hi, at, to))
        found.append(at)
        met.append(to)
        lo, hi, b_lo, b_hi = np.concatenate([lo, at + 1]), np.concatenate([at + 1, hi]), np.concatenate([b_lo, to + 1]), np.concatenate([to + 1, b_hi])
    order = np.argsort(every := np.concatenate(found))
    return every[order], np.concatenate(met)[order]


#: Of a character's first byte: whether it begins one that is neither white space nor a control, as far as the byte tells.
SOLID = np.zeros(256, bool)
SOLID[[*range(0x21, 0x7F), *range(0xC3, 0xE0), *range(0xE4, 0xF5)]] = True


def pieces(data: np.ndarray, bounds: np.ndarray, cut: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, first piece of each text): texts cut at single spaces between solid characters, which stand for themselves at no piece's end."""
    n = len(data)
    at = np.zeros(0, np.int64)
    if cut and n > 2:
        ends = SOLID[data] & (data < 0x80)  # where a solid character ends
        tail = (data & 0xC0) == 0x80
        for wide, (low, high) in ((1, (0xC3, 0xE0)), (2, (0xE4, 0xF0)), (3, (0xF0, 0xF5))):
            ends[wide:] |= tail[wide:] & (data[:-wide] >= low) & (data[:-wide] < high)
        at = np.flatnonzero((data[1:-1] == 0x20) & ends[:-2] & SOLID[data[2:]]) + 1
        text = np.searchsorted(bounds, at, side="right") - 1
        at = at[(at > bounds[text]) & (at < bounds[text + 1] - 1)]
    some = np.flatnonzero(np.diff(bounds) > 0)
    begin = np.sort(np.concatenate([bounds[some], at + 1]))
    end = np.sort(np.concatenate([bounds[some + 1], at]))
    return begin, end, np.searchsorted(begin, bounds)


class Encoder:
    """Distinct pieces encoded so far in this worker: numbers of tokens, groups and links of each, and its groups as text."""

    def __init__(self, known: Vocabularies):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_buffer(known.a_model)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=known.b_model)
        self.fast = None
        if known.ranked:
            import tiktoken

            ranks = {x: i for i, x in enumerate(known.a_bytes) if x}
            self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known, width = known, len(known.a_bytes)
        self.bytes_a, self.bytes_b = ([x or b"" for x in words] for words in (known.a_bytes, known.b_bytes))
        self.size_a, self.size_b = (np.array([len(x) for x in words], np.int64) for words in (self.bytes_a, self.bytes_b))
        ids = [*map(str, range(width)), *map(str, range(len(known.b_bytes)))]
        # Each id as it stands within a group, at the end of its side, and at the end of a piece.
        self.said = [x + "," for x in ids] + [x + "|" for x in ids[:width]] + [x + ";" for x in ids[width:]] + [x + "\n" for x in ids]
        self.clear()

    def clear(self) -> None:
        self.at: dict[bytes, int] = {}
        self.text: list[str] = []
        self.tokens = np.zeros((2, 0), np.int64)
        self.links, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def learn(self, words: list[bytes]) -> None:
        """Encode pieces not met before."""
        known, width, wide = self.known, len(self.known.a_bytes), len(self.known.a_bytes) + len(self.known.b_bytes)
        plain = [w.decode("utf-8", "replace") for w in words]
        slow = [k for k, w in enumerate(words) if not (self.fast and COMMON.fullmatch(w))]
        others = dict(zip(slow, (x.ids for x in self.a.encode_batch_fast([" " + plain[k] for k in slow], add_special_tokens=False)), strict=True))
        ids = [[others[k] if k in others else self.fast(" " + w) for k, w in enumerate(plain)], self.b.encode(plain, num_threads=1)]
        n = np.array([np.fromiter(map(len, side), np.int64, len(words)) for side in ids])
        fine, a, b = np.ones(len(words), bool), *(np.fromiter(chain.from_iterable(side), np.int64, int(m)) for side, m in zip(ids, n.sum(axis=1), strict=True))
        whole = b" " + b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        if not all(b"".join(map(each.__getitem__, x.tolist())) == whole and (np.add.reduceat(size[x], np.cumsum(m) - m) == sizes).all() for each, size, x, m in ((self.bytes_a, self.size_a, a, n[0]), (self.bytes_b, self.size_b, b, n[1])) if m.all()) or not n.all():
            fine = np.array([all(b"".join([each[i] for i in side[k]]) == b" " + w for each, side in zip((self.bytes_a, self.bytes_b), ids, strict=True)) for k, w in enumerate(words)], bool)
            n[:, ~fine] = 0
            a, b = (np.array([i for x, ok in zip(side, fine, strict=True) if ok for i in x], np.int64) for side in ids)
        first_a, first_b = (np.concatenate([[0], np.cumsum(x)]) for x in n)
        cut_a, cut_b = shared_cuts(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), first_a, first_b)
        pair = a[cut_a] * len(known.b_bytes) + b[cut_b]
        # In the order of the text: a group's tokens of one side, then those of the other.
        at_a = np.arange(len(a)) + np.concatenate([[0], cut_b + 1])[np.searchsorted(cut_a, np.arange(len(a)))]
        at_b = np.arange(len(b)) + (cut_a + 1)[np.searchsorted(cut_b, np.arange(len(b)))]
        said = np.zeros(len(a) + len(b), np.int64)
        end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        end_a[cut_a], end_b[cut_b] = 1, 1
        end_b[first_b[1:][n[1] > 0] - 1] = 2
        said[at_a], said[at_b] = a + wide * end_a, b + width + wide * end_b
        lines = "".join(map(self.said.__getitem__, said.tolist())).split("\n")
        each = iter(lines)
        self.text += [next(each) if ok else "" for ok in n[0] > 0]
        self.at |= zip(words, range(len(self.at), len(self.at) + len(words)), strict=True)
        counts = np.diff(np.searchsorted(cut_a, first_a))
        n[:, ~fine] = -1
        self.tokens = np.concatenate([self.tokens, n], axis=1)
        self.links = np.concatenate([self.links, np.searchsorted(known.pairs, pair).astype(np.int32)])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts)])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Each piece's number, those not known encoded first."""
        if len(self.at) > REMEMBERED:
            self.clear()
        new = [w for w in words if w not in self.at]
        for k in range(0, len(new), BATCH):
            self.learn(new[k : k + BATCH])
        return np.array([self.at[w] for w in words], np.int64)


_ENCODERS: dict[bytes, Encoder] = {}


def _encoder(known: Vocabularies) -> Encoder:
    key = hashlib.sha256(known.a_model + known.b_model).digest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(known)
    return _ENCODERS[key]


def aligned_slices(docs: DataFrame, key: str, text: str, known: Vocabularies) -> DataFrame:
    """A row per slice of text: ``ids``, numbers of tokens and groups and the groups' digest of each row, and what links are counted from.

    ``links`` holds the links of each distinct piece (``many`` of them), as
    numbers of possible pairs, ``times`` how often it occurs in rows that have
    tokens, ``units`` the pieces of each row, and ``n_units`` how many.
    """
    models = docs.sparkSession.sparkContext.broadcast(tuple(known))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabularies(*models.value)
        encoder = _encoder(own)
        for batch in batches:
            for at, data, bounds in T.chunks(batch["__text"], SLICE):
                begin, end, first = pieces(data, bounds, own.cut)
                padded = np.concatenate([data, np.zeros(8, np.uint8)])
                _, one, unit = np.unique(T.word_hashes(padded, begin, end), return_index=True, return_inverse=True)
                raw = data.tobytes()
                number = encoder.numbers([raw[b:e] for b, e in zip(begin[one].tolist(), end[one].tolist(), strict=True)])
                n, sizes = len(bounds) - 1, np.diff(first)
                of = np.repeat(np.arange(n), sizes)
                tokens, many = encoder.tokens[:, number], (encoder.first[number + 1] - encoder.first[number])
                good = np.bincount(of, tokens[0][unit] < 0, minlength=n) == 0
                add = lambda x: np.where(good, np.bincount(of, x[unit], minlength=n), 0).astype(np.int64)
                said, digests = [encoder.text[k] for k in number.tolist()], []
                for k, ok in enumerate(good):
                    words = unit[first[k] : first[k + 1]].tolist()
                    digests.append(hashlib.sha256(";".join([said[u] for u in words]).encode()).hexdigest() if ok and words else "")
                place = np.repeat(encoder.first[number] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                units = np.where(good[of], unit, -1)
                times = np.bincount(units[units >= 0], minlength=len(number))
                row = [batch["__key"].slice(at, n).to_pylist(), *(add(x).tolist() for x in (tokens[0], tokens[1], many)), digests, encoder.links[place].tobytes(), many.astype(np.int32).tobytes(), times.astype(np.int32).tobytes(), units.astype(np.int32).tobytes(), sizes.astype(np.int32).tobytes()]
                kinds = [pa.list_(batch["__key"].type), *[pa.list_(pa.int64())] * 3, pa.list_(pa.string()), *[pa.binary()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=["ids", "n_a", "n_b", "n_groups", "digests", "links", "many", "times", "units", "n_units"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    return rows.mapInArrow(align, f"ids array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, digests array<string>, links binary, many binary, times binary, units binary, n_units binary")


def _ints(row: pa.Scalar) -> np.ndarray:
    return np.frombuffer(row.as_buffer(), np.int32).astype(np.int64)


def _run_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of each run of ``values``, so many at a time."""
    running, ends = np.concatenate([[0], np.cumsum(values)]), np.cumsum(sizes)
    return running[ends] - running[ends - sizes]


def link_counts(slices: DataFrame, possible: int) -> np.ndarray:
    """How many links of all rows hold each possible pair; a task sends what it has counted once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(possible, np.int64)
        for batch in batches:
            for links, many, times in zip(batch["links"], batch["many"], batch["times"], strict=True):
                np.add.at(total, _ints(links), np.repeat(_ints(times), _ints(many)))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["pair", "n"])

    counted = slices.select("links", "many", "times").mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found, out = written(counted, "links", FEW_ROWS), np.zeros(possible, np.int64)
    rows = found.toArrow()  # as many as there are possible pairs, at most
    out[np.asarray(rows["pair"])] = np.asarray(rows["n"])
    dropped(found)
    return out


def best_of(counts: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs have the highest count that their id ``b`` has."""
    most = np.zeros(int(b.max(initial=-1)) + 1, np.int64)
    np.maximum.at(most, b, counts)
    return counts == most[b]


def aligned(docs: DataFrame, key: str = "doc_id", text: str = "text", known: Vocabularies | None = None) -> DataFrame:
    """Per row: its key, ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``n_best`` counts links whose pair occurs as often in the corpus as any
    that its B id has; ``count_sum`` adds up the corpus counts of a row's
    links. Null and empty texts, and texts that either tokenizer does not give
    back byte for byte, have no tokens: zeros, and no digest. Rows that repeat
    count each; columns beyond the two are not read.
    """
    known = known or vocabularies()
    slices = written(aligned_slices(docs.select(key, text), key, text, known), "aligned")
    counts = link_counts(slices, len(known.pairs))
    table = docs.sparkSession.sparkContext.broadcast((counts, best_of(counts, known.pairs % max(len(known.b_bytes), 1))))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = table.value
        for batch in batches:
            for row in range(batch.num_rows):
                links, many, units, n_units = (_ints(batch[c][row]) for c in ("links", "many", "units", "n_units"))
                sums = []
                for each in (best[links].astype(np.int64), count[links]):
                    per = np.append(_run_sums(each, many), 0)  # the last one is that of pieces of rows without tokens, -1
                    sums.append(_run_sums(per[units], n_units))
                flat = [batch[c][row].values for c in ("ids", "n_a", "n_b", "n_groups", "n_groups")]
                yield pa.RecordBatch.from_arrays([*flat, *map(pa.array, sums), batch["digests"][row].values], names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    found = slices.select("ids", "n_a", "n_b", "n_groups", "digests", "links", "many", "units", "n_units").mapInArrow(look, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    found = written(found.withColumnRenamed("id", key), "alignment", FEW_ROWS)
    dropped(slices)
    return found
