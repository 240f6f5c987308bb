"""Benchmark decontamination: a prefix-filtered containment join of item windows and documents.

An item's windows are its runs of ``window`` words; each must occur in a
document as a whole. A window's shingles are ordered by how often they occur
in the corpus and the rarest is its prefix: a document that contains the
window contains that shingle, so the join is on it alone. Where it occurs
gives the only place at which the window can stand, which is checked against
the document's bounds (length and position) and then word by word, on the
words themselves. The words around a shingle leave the scan with it, so no
document is read or joined again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .store import dropped, written

#: The filter that keeps shingles which no item has from leaving their task has so many bits a shingle, of these sizes at least and at most. A fuller one lets more through, with the same result.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 26


def item_windows(items: DataFrame, key: str, text: str, window: int, shingle: int) -> DataFrame:
    """A row per item and place: ``item, words`` (joined by spaces), ``size`` and ``parts`` (hash of each shingle, by place)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, bounds in T.chunks(batch["__text"]):
                found = T.words(data, bounds, T.MARKS)
                plain, begin, end = found.joined()
                sizes = np.diff(found.first)
                of = np.repeat(np.arange(len(sizes)), np.where(sizes > 0, np.maximum(sizes - window + 1, 1), 0))
                first = found.first[of] + np.arange(len(of)) - np.searchsorted(of, of)
                wide = np.minimum(sizes[of], window)
                narrow = np.minimum(wide, shingle)
                runs = {int(n): T.runs(found.hash, int(n)).view(np.int64) for n in np.unique(narrow)}
                words = [plain[begin[b] : end[b + w - 1]].tobytes() for b, w in zip(first, wide, strict=True)]
                parts = [runs[int(s)][b : b + w - s + 1] for b, w, s in zip(first, wide, narrow, strict=True)]
                yield pa.RecordBatch.from_arrays([batch["__key"].slice(at, len(sizes)).take(pa.array(of)), pa.array(words, pa.binary()).cast(pa.string()), pa.array(wide.astype(np.int32)), pa.array(parts, pa.list_(pa.int64()))], names=["item", "words", "size", "parts"])

    kind = items.schema[key].dataType.simpleString()
    rows = items.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    return rows.mapInArrow(cut, f"item {kind}, words string, size int, parts array<long>")


def _filter(windows: DataFrame) -> np.ndarray:
    """A bit at each shingle's hash; made up of 64-bit pieces, so that the driver gets as many bytes at most."""
    parts = windows.select(F.explode("parts").alias("part"))
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * parts.count()).bit_length()))
    pieces = parts.select(F.expr(f"part & {bits - 1}").alias("bit")).groupBy(F.expr("bit div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("mask"))
    out = np.zeros(bits // 64, np.int64)
    for row in pieces.collect():
        out[row["word"]] = row["mask"]
    return out.view(np.uint8)


def scanned(docs: DataFrame, key: str, text: str, windows: DataFrame, window: int, shingle: int) -> DataFrame:
    """A row per document, ``row, id, n_words``, and one per place where a shingle may be an item's.

    The latter have no id but ``place, part`` (its hash), and ``around``, the
    words that a window over it may have, of which ``before`` precede it.
    """
    lengths = sorted(r[0] for r in windows.select(F.least("size", F.lit(shingle))).distinct().collect())
    known = docs.sparkSession.sparkContext.broadcast(_filter(windows))
    kind = docs.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = known.value
        mask = T.U(8 * len(bits) - 1)
        for batch in batches:
            for at, data, bounds in T.chunks(batch["__text"]):
                found = T.words(data, bounds, T.MARKS)
                n, part = len(bounds) - 1, batch.slice(at, len(bounds) - 1)
                sizes = pa.array(np.diff(found.first).astype(np.int64))
                blank = [pa.nulls(n, t) for t in (pa.int32(), pa.int64(), pa.int32(), pa.string())]
                yield pa.RecordBatch.from_arrays([part["__row"], part["__key"], sizes, *blank], names=["row", "id", "n_words", "place", "part", "before", "around"])
                of = np.repeat(np.arange(n), np.diff(found.first))
                places, parts = [np.zeros(0, np.int64)], [np.zeros(0, T.U)]
                for length in lengths:
                    runs = T.runs(found.hash, length)
                    spot = (runs & mask).astype(np.int64)
                    hit = np.flatnonzero(bits[spot >> 3] >> (spot & 7).astype(np.uint8) & 1)
                    hit = hit[of[hit] == of[hit + length - 1]]
                    places.append(hit)
                    parts.append(runs[hit])
                place, runs = np.concatenate(places), np.concatenate(parts)
                if not len(place):
                    continue
                plain, begin, end = found.joined()
                low, high = np.maximum(found.first[of[place]], place - window + 1), np.minimum(found.first[of[place] + 1], place + window)
                around = pa.array([plain[b:e].tobytes() for b, e in zip(begin[low], end[high - 1], strict=True)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part["__row"].take(pa.array(of[place])), pa.nulls(len(place), part["__key"].type), pa.nulls(len(place), pa.int64()), pa.array((place - found.first[of[place]]).astype(np.int32)), pa.array(runs.view(np.int64)), pa.array((place - low).astype(np.int32)), around],
                    names=["row", "id", "n_words", "place", "part", "before", "around"],
                )

    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), F.monotonically_increasing_id().alias("__row"))
    return rows.mapInArrow(scan, f"row long, id {kind}, n_words long, place int, part long, before int, around string")


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = 13, shingle: int = 5, percent: int = 5) -> DataFrame:
    """Per row of ``docs``: its key, ``n_words, n_hit, n_items, items, contaminated``.

    Words are runs of digits, letters and non-ASCII characters, A-Z counting
    as a-z. A word is hit if it lies in an occurrence of an item's window; an
    item of fewer words than ``window`` is one window, one without words none.
    ``contaminated``: n_hit > 0 and 100 n_hit >= percent n_words. ``items`` are
    the keys, sorted as strings, of items with an occurring window. A null or
    empty text has no words; windows of items with a null key hit words but
    are not listed; equal items and repeated rows count each under their keys;
    without items nothing is hit. Only places that may begin an item's shingle
    leave the scan.
    """
    cuts = written(item_windows(items, item_key, item_text, window, shingle), "cuts")
    windows = written(cuts.groupBy("words").agg(F.first("size").alias("size"), F.first("parts").alias("parts")).withColumn("window", F.monotonically_increasing_id()), "windows")
    rows = written(scanned(docs, key, text, windows, window, shingle), "scanned")
    spots = rows.where("part is not null").select("row", "place", "part", "before", "around")
    counts = spots.groupBy("part").agg(F.count("*").alias("places"))
    rarity = windows.select("window", F.posexplode("parts").alias("at", "part")).join(counts, "part", "left")
    rarest = rarity.groupBy("window").agg(F.min(F.struct(F.coalesce("places", F.lit(0)).alias("places"), "at", "part")).alias("rare")).where("rare.places > 0")
    prefix = written(rarest.select("window", F.col("rare.part").alias("part"), F.col("rare.at").alias("at")).join(windows.select("window", "words", "size"), "window"), "prefix")
    starts = spots.join(prefix, "part").where("before >= at")
    same = F.array_join(F.slice(F.split("around", " "), F.col("before") - F.col("at") + 1, F.col("size")), " ") == F.col("words")
    start = F.col("place") - F.col("at")
    placed = written(starts.where(same).select("row", "window", start.alias("start"), (start + F.col("size")).alias("end")), "placed")
    spans = placed.groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    covered = F.expr("aggregate(array_sort(spans), struct(0L as n, 0 as until), (s, x) -> struct(s.n + greatest(0, x.end - greatest(x.start, s.until)) as n, greatest(s.until, x.end) as until), s -> s.n)")
    owners = cuts.where("item is not null").select("item", "words").distinct().join(windows.select("words", "window"), "words").select("window", F.col("item").cast("string").alias("item"))
    listed = placed.select("row", "window").distinct().join(owners, "window").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    per = written(spans.select("row", covered.cast("long").alias("n_hit")).join(listed, "row", "left"), "hits")
    dropped(placed, prefix)
    out = rows.where("part is null").select("row", "id", "n_words").join(per, "row", "left")
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(F.col("id").alias(key), "n_words", hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), ((hit > 0) & (100 * hit >= percent * F.col("n_words"))).alias("contaminated"))
