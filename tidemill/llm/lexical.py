"""Ranked lexical search: impact-sorted postings read by NRA, slice of the corpus after slice.

Postings of the items' terms are kept by slices of the corpus, a list for each
term, highest impact first. Within a slice, an item's lists are read from
their heads, block after block. A document's score lies between what has been
read of it and that plus the last value read from each list in which it was
not met. Reading goes on until every document that may still be among the
best, or tie with them, has one possible score. What a task has found so far
bounds what later slices have to offer; the best of all tasks are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .store import ARROW_BYTES, dropped, written

#: Bytes of text in a slice, terms of a batch of items on average, and postings of a list that the first read takes.
SLICE, BATCH_TERMS, BLOCK = 1 << 22, 200_000, 32
#: Slices are long rows: few of them in a batch.
FEW_ROWS = {ARROW_BYTES: str(1 << 23), "spark.sql.parquet.columnarReaderBatchSize": "4"}


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``number, id, terms, times`` per item: its distinct terms and how often it has each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, bounds in T.chunks(batch["__text"]):
                found = T.words(data, bounds, T.MARKS)
                n = len(bounds) - 1
                terms, times = [], []
                for b, e in zip(found.first[:-1], found.first[1:], strict=True):
                    words = [found.low[s:t].tobytes() for s, t in zip(found.start[b:e], found.end[b:e], strict=True)]
                    own = {w: words.count(w) for w in dict.fromkeys(words)} if len(words) < 64 else dict(zip(*(x.tolist() for x in np.unique(np.array(words, object), return_counts=True)), strict=True))
                    terms.append([*own])
                    times.append([*own.values()])
                part = batch.slice(at, n)
                yield pa.RecordBatch.from_arrays([part["number"], part["__key"], pa.array(terms, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))], names=["number", "id", "terms", "times"])

    kind = items.schema[key].dataType.simpleString()
    rows = items.select(F.monotonically_increasing_id().alias("number"), F.col(key).alias("__key"), F.col(text).alias("__text"))
    return rows.mapInArrow(cut, f"number long, id {kind}, terms array<binary>, times array<long>")


class Lexicon:
    """Terms that are searched for, by hash, with their bytes."""

    def __init__(self, terms: list[bytes]):
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64)
        data = np.frombuffer(b"".join(terms) + bytes(8), np.uint8)
        hashes = T.word_hashes(data, bounds[:-1], bounds[1:])
        order = np.argsort(hashes)
        self.hashes, self.begin, self.size, self.data = hashes[order], bounds[:-1][order], np.diff(bounds)[order], data
        self.at = {terms[k]: place for place, k in enumerate(order.tolist())}

    def find(self, found: T.Words) -> tuple[np.ndarray, np.ndarray]:
        """(word, term) of all words that are terms, compared byte by byte."""
        if not len(self.hashes) or not len(found.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        term = np.minimum(np.searchsorted(self.hashes, found.hash), len(self.hashes) - 1)
        word = np.flatnonzero(self.hashes[term] == found.hash)
        term = term[word]
        size = found.end[word] - found.start[word]
        same = size == self.size[term]
        word, term, size = word[same], term[same], size[same]
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        differ = found.low[np.repeat(found.start[word], size) + step] != self.data[np.repeat(self.begin[term], size) + step]
        wrong = np.zeros(len(word), bool)
        wrong[np.repeat(np.arange(len(word)), size)[differ]] = True
        return word[~wrong], term[~wrong]


def postings(docs: DataFrame, key: str, text: str, lexicon) -> DataFrame:
    """A row per slice: ``ids``, ``sizes`` (terms of each document), and its postings by term, ``term, doc, tf``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, bounds in T.chunks(batch["__text"], SLICE):
                found, n = T.words(data, bounds, T.MARKS), len(bounds) - 1
                word, term = lexicon.value.find(found)
                doc = np.searchsorted(found.first, word, side="right") - 1
                both, tf = np.unique(term * n + doc, return_counts=True)
                row = [batch["__key"].slice(at, n).to_pylist(), np.diff(found.first).astype(np.int64).tobytes(), *(x.astype(np.int32).tobytes() for x in (both // n, both % n, tf))]
                yield pa.RecordBatch.from_arrays([pa.array([row[0]], pa.list_(batch["__key"].type)), *(pa.array([x], pa.binary()) for x in row[1:])], names=["ids", "sizes", "term", "doc", "tf"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    return rows.mapInArrow(scan, f"ids array<{kind}>, sizes binary, term binary, doc binary, tf binary")


def _array(value: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind).astype(np.int64)


def statistics(slices: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """(documents with a term, terms of all documents, documents that hold each searched term), over all slices."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms + 2, np.int64)
        for batch in batches:
            for term, sizes in zip(batch["term"], batch["sizes"], strict=True):
                n = _array(sizes, np.int64)
                total[:terms] += np.bincount(_array(term, np.int32), minlength=terms)
                total[terms:] += (n > 0).sum(), n.sum()
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["term", "n"])

    out = np.zeros(terms + 2, np.int64)
    counted = written(slices.select("term", "sizes").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")), "terms", FEW_ROWS)
    for row in counted.collect():  # a row per term of a batch of items
        out[row["term"]] = row["n"]
    dropped(counted)
    return int(out[terms]), int(out[terms + 1]), out[:terms]


def weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df.astype(np.float64) + 1))).astype(np.int64)


def impacts(tf: np.ndarray, size: np.ndarray, n: int, total: int) -> np.ndarray:
    """What one occurrence of a term in an item adds for each unit of the term's weight."""
    m = 75 + 25 * size * n // max(total, 1)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def nra(begin: np.ndarray, end: np.ndarray, scale: np.ndarray, doc: np.ndarray, impact: np.ndarray, n: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the ``n`` that reach the ``k``-th best score, at least ``floor`` and above 0; all of them, where scores tie.

    List i is ``doc`` and ``impact`` from ``begin[i]`` to ``end[i]``, highest
    first, times ``scale[i]``.
    """
    some = (end > begin) & (scale > 0)
    begin, end, scale = begin[some], end[some], scale[some]
    lower, seen = np.zeros(n, np.int64), np.zeros((len(begin), n), bool)
    last, depth, block = impact[begin] * scale, 0, BLOCK
    while True:
        total = int(last.sum())
        upper = lower + total - last @ seen
        least = max(floor, 1, int(np.partition(lower, n - k)[n - k]) if n >= k else 0)
        may = upper >= least
        if not (may & (upper > lower)).any():
            best = np.flatnonzero(may)
            return best, lower[best]
        size = np.clip(end - begin - depth, 0, block)
        of = np.repeat(np.arange(len(begin)), size)
        at = np.repeat(begin + depth - (np.cumsum(size) - size), size) + np.arange(len(of))
        np.add.at(lower, doc[at], impact[at] * scale[of])
        seen[of, doc[at]] = True
        depth += block
        block *= 2
        last = np.where(begin + depth < end, impact[np.minimum(begin + depth, end) - 1] * scale, 0)


def _order(found: tuple) -> tuple:
    return -found[0], found[1] is None, found[1] if found[1] is not None else 0


def found_in(slices: DataFrame, kind: str, numbers: list[int], asked, n: int, total: int, k: int) -> DataFrame:
    """``number, id, score``: the ``k`` best documents of each item among the slices of a task; ``asked`` holds each item's terms and scales."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = asked.value
        best: list[list[tuple]] = [[] for _ in lists]
        key = pa.int64()
        for batch in batches:
            key = batch["ids"].type.value_type
            for row in range(batch.num_rows):
                ids, size = batch["ids"][row].values, _array(batch["sizes"][row], np.int64)
                term, doc, tf = (_array(batch[c][row], np.int32) for c in ("term", "doc", "tf"))
                impact = impacts(tf, size[doc], n, total)
                order = np.lexsort((-impact, term))
                term, doc, impact = term[order], doc[order], impact[order]
                for own, (terms, scale) in zip(best, lists, strict=True):
                    begin, end = np.searchsorted(term, terms), np.searchsorted(term, terms, side="right")
                    docs, scores = nra(begin, end, scale, doc, impact, len(size), k, own[-1][0] if len(own) == k else 0)
                    if len(docs):
                        own += zip(scores.tolist(), ids.take(pa.array(docs)).to_pylist(), strict=True)
                        own.sort(key=_order)
                        del own[k:]
        rows = [(number, doc, score) for number, own in zip(numbers, best, strict=True) for score, doc in own]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), key, pa.int64()), strict=True)], names=["number", "id", "score"])

    return slices.mapInArrow(search, f"number long, id {kind}, score long")


def ranked(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", k: int = 20) -> DataFrame:
    """``item_key, rank, key, score``: the ``k`` documents of highest score above 0 for each item.

    Terms are runs of bytes other than ASCII marks, A-Z as a-z. Equal scores
    are ranked by key, null last. Null and empty texts have no terms, so they
    are not found and find nothing; rows that repeat are found, or ask, each
    for itself. Items are taken in batches of bounded size, each a pass over
    the documents; extra columns are not read.
    """
    asked_all = written(item_terms(items, item_key, item_text), "items")
    total_terms = asked_all.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    batches = max(1, -(-total_terms // BATCH_TERMS))
    kind, context, found = docs.schema[key].dataType.simpleString(), docs.sparkSession.sparkContext, []
    for part in range(batches):
        rows = asked_all.where(F.pmod(F.xxhash64("number"), F.lit(batches)) == part).select("number", "terms", "times").collect()  # BATCH_TERMS terms on average
        lexicon = Lexicon(sorted({bytes(t) for r in rows for t in r["terms"]}))
        slices = written(postings(docs.select(key, text), key, text, context.broadcast(lexicon)), "postings")
        n, total, df = statistics(slices, len(lexicon.hashes))
        w, lists = weights(n, df), []
        for r in rows:
            terms = np.array([lexicon.at[bytes(t)] for t in r["terms"]], np.int64)
            lists.append((terms, w[terms] * np.array(r["times"], np.int64)))
        found.append(written(found_in(slices, kind, [r["number"] for r in rows], context.broadcast(lists), n, total, k), "found", FEW_ROWS))
        dropped(slices)
    first = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    best = reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    named = best.join(asked_all.select("number", F.col("id").alias("item")), "number")
    return named.select(F.col("item").alias(item_key), "rank", F.col("id").alias(key), "score")
