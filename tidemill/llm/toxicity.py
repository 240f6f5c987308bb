"""Toxicity: a factorization machine over hashed terms.

Besides a weight per term, each term has a short vector, and the inner product
of two terms' vectors is the weight of their meeting in one text, so an insult
with a group mention can score high where neither does alone. Terms take part
as far as their tie to the label exceeds what chance would give the best of so
many terms; without that, a model of few labels learns rare words by heart.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .store import dropped, written

BITS, FACTORS, PREFIXES = 17, 8, (4, 6)
BUCKETS = 1 << BITS
#: Rows that a model is fitted on at most; of more labelled rows, those with the least hash of their key are taken. Terms of fewer rows than the least take no part.
FIT_ROWS, LEAST_ROWS = 20_000, 3


class Model(NamedTuple):
    """4.7 MB: ``bias``, a weight and ``FACTORS`` numbers per place; ``terms``, hashes in order, have the first places, and their values are scaled by ``share``."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray
    terms: np.ndarray = np.zeros(0, np.uint64)
    share: np.ndarray = np.zeros(0)


def _hashes(found: T.Words) -> list[np.ndarray]:
    """Hashes of words and of their first bytes, by ``PREFIXES``, which bring forms of one stem together."""
    return [found.hash] + [T.mixed(found.prefixes(k) + T.U(k)) for k in PREFIXES]


def terms(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, terms per text, hashes): each text's distinct terms, over whole texts."""
    for at, data, bounds in T.chunks(texts):
        found = T.words(data, bounds, T.MARKS)
        n = len(bounds) - 1
        hashes, of = np.concatenate(_hashes(found)), np.tile(np.repeat(np.arange(n), np.diff(found.first)), 1 + len(PREFIXES))
        order = np.lexsort((hashes, of))
        hashes, of = hashes[order], of[order]
        new = np.ones(len(of), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
        yield at, np.bincount(of[new], minlength=n), hashes[new]


def known_terms(texts: pa.Array, model: Model) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of the first text, terms per text, places, values) of the terms that ``model`` has; one that occurs c times has the value 1 + ln c, scaled."""
    many = max(1, len(model.terms))
    for at, data, bounds in T.chunks(texts):
        found = T.words(data, bounds, T.MARKS)
        n, both = len(bounds) - 1, [np.zeros(0, np.int64)]
        of = np.repeat(np.arange(n), np.diff(found.first))
        for hashes in _hashes(found) if len(model.terms) else ():
            place = np.minimum(np.searchsorted(model.terms, hashes), many - 1)
            hit = model.terms[place] == hashes
            both.append(of[hit] * many + place[hit])
        both, times = np.unique(np.concatenate(both), return_counts=True)
        yield at, np.bincount(both // many, minlength=n), both % many, (1 + np.log(times)) * model.share[both % many] if len(both) else np.zeros(0)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each row's ``values``, which stand row after row."""
    out = np.zeros((len(sizes), *values.shape[1:]))
    some = sizes > 0
    if some.any():
        out[some] = np.add.reduceat(values, np.concatenate([[0], np.cumsum(sizes[some])[:-1]]), axis=0)
    return out


def margins(model: Model, sizes: np.ndarray, buckets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """bias + weights + pairwise products, in time linear in the terms: half of (sum of vectors)^2 less the sum of squares."""
    v = model.factor[buckets] * values[:, None]
    return model.bias + _sums(model.weight[buckets] * values, sizes) + 0.5 * (_sums(v, sizes) ** 2 - _sums(v**2, sizes)).sum(axis=1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fitted(sizes: np.ndarray, buckets: np.ndarray, values: np.ndarray, label: np.ndarray, epochs: int = 40, rate: float = 0.1, shrink: float = 2e-3, least: int = 5, seed: int = 11) -> Model:
    """Adagrad on logistic loss in a fixed order, with L2 shrinkage, twelve steps a pass; terms of fewer than ``least`` rows are left out."""
    batch = max(32, len(label) // 12)
    random = np.random.default_rng(seed)
    share = np.clip(label.mean() if len(label) else 0.0, 1e-3, 1 - 1e-3)
    bias, weight = float(np.log(share / (1 - share))), np.zeros(BUCKETS)
    seen = np.bincount(buckets, minlength=BUCKETS) >= least
    factor = random.normal(0, 0.01, (BUCKETS, FACTORS)) * seen[:, None]
    keep = seen[buckets]
    of = np.repeat(np.arange(len(sizes)), sizes)[keep]
    buckets, values, sizes = buckets[keep], values[keep].astype(np.float64), np.bincount(of, minlength=len(sizes))
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    g_weight, g_factor, g_bias = np.full(BUCKETS, 1e-2), np.full((BUCKETS, FACTORS), 1e-2), 1e-2
    for _ in range(epochs):
        order = random.permutation(len(label))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            n = sizes[rows]
            where = np.repeat(first[rows], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            x, value = buckets[where], values[where]
            v = factor[x] * value[:, None]
            total = _sums(v, n)
            z = bias + _sums(weight[x] * value, n) + 0.5 * (total**2 - _sums(v**2, n)).sum(axis=1)
            error = (sigmoid(z) - label[rows]) / len(rows)
            each = np.repeat(error, n) * value
            used, place = np.unique(x, return_inverse=True)
            d_weight = np.bincount(place, each, len(used)) + shrink * weight[used] / len(rows)
            pull = each[:, None] * (np.repeat(total, n, axis=0) - v)
            d_factor = np.stack([np.bincount(place, pull[:, k], len(used)) for k in range(FACTORS)], axis=1) + shrink * factor[used] / len(rows)
            g_weight[used] += d_weight**2
            g_factor[used] += d_factor**2
            g_bias += error.sum() ** 2
            weight[used] -= rate * d_weight / np.sqrt(g_weight[used])
            factor[used] -= 0.2 * rate * d_factor / np.sqrt(g_factor[used])
            bias -= rate * error.sum() / np.sqrt(g_bias)
    return Model(bias, weight.astype(np.float32), factor.astype(np.float32))


def telling(rows: DataFrame, label: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, shares) of the terms that go with ``label`` beyond chance.

    Of M terms that ``LEAST_ROWS`` rows have, the largest chi-squared statistic
    comes to about 2 ln M by chance. A term's share is 1 less that over its own
    statistic, and terms at or below it have none. Of more than ``BUCKETS``
    the strongest are taken. Counts are added up by task, then by term.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mark = np.asarray(batch[label], np.int64)
            for at, sizes, hashes in terms(batch[text]):
                found, place, n = np.unique(hashes, return_inverse=True, return_counts=True)
                pos = np.bincount(place, np.repeat(mark[at : at + len(sizes)], sizes), len(found)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(pos), pa.array(n)], names=["term", "pos", "n"])

    total, marked = rows.agg(F.count("*"), F.coalesce(F.sum(label), F.lit(0))).first()
    if not 0 < marked < total:
        return np.zeros(0, np.uint64), np.zeros(0)
    per = written(rows.select(label, text).mapInArrow(count, "term long, pos long, n long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")).where(F.col("n") >= LEAST_ROWS), "terms")
    chance = 2 * np.log(max(2, per.count()))
    share = marked / total
    due = F.col("n") * F.lit(share)
    chi = F.pow(F.col("pos") - due, F.lit(2)) / (due * F.lit(1 - share) * (1 - F.col("n") / F.lit(total)) + 1e-9)
    best = per.select("term", chi.alias("chi")).where(F.col("chi") > float(chance)).orderBy(F.desc("chi"), "term").limit(BUCKETS).collect()
    dropped(per)
    hashes, found = np.array([r["term"] for r in best], np.int64).view(np.uint64), np.array([1 - chance / r["chi"] for r in best])
    order = np.argsort(hashes)
    return hashes[order], found[order]


def trained(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int = FIT_ROWS) -> Model:
    """A model of ``label`` (0 or 1), fitted on at most ``rows`` labelled rows of ``docs``.

    Rows are picked by a hash of their key, before their texts are read; of
    labels that differ for one key the larger counts, and of rows of one key
    the one with the least text. Terms are chosen over all of these rows on
    Spark; the fit itself takes one task, which gets the chosen terms of each
    row and nothing else.
    """
    wanted = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).cast("int").alias("__label"))
    wanted = wanted.orderBy(F.xxhash64(key), key).limit(rows)
    found = docs.select(key, F.col(text).alias("__text")).join(F.broadcast(wanted), key)
    found = written(found.groupBy(key).agg(F.min("__text").alias("__text"), F.max("__label").alias("__label")), "labelled")
    hashes, share = telling(found, "__label", "__text")
    none = np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32)
    chosen = docs.sparkSession.sparkContext.broadcast(Model(0.0, *none, hashes, share))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sizes, places, values in known_terms(batch["__text"], chosen.value):
                part = batch.slice(at, len(sizes))
                yield pa.RecordBatch.from_arrays([part[key].cast(pa.string()), part["__label"].cast(pa.int32()), T.lists(places.astype(np.int32), sizes), T.lists(values, sizes)], names=["key", "label", "terms", "values"])

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by("key")
        lists = group["terms"].combine_chunks()
        sizes = np.asarray(lists.value_lengths(), np.int64)
        values = np.asarray(group["values"].combine_chunks().flatten(), np.float64)
        model = fitted(sizes, np.asarray(lists.flatten(), np.int64), values, np.asarray(group["label"], np.float64), least=1)
        return pa.table({"bias": [model.bias], "weight": [model.weight.tobytes()], "factor": [model.factor.tobytes()]})

    cuts = found.mapInArrow(cut, "key string, label int, terms array<int>, values array<double>")
    out = cuts.groupBy().applyInArrow(fit, "bias double, weight binary, factor binary").first()
    dropped(found)
    if out is None:
        return Model(-3.0, *none)
    return Model(out["bias"], np.frombuffer(out["weight"], np.float32), np.frombuffer(out["factor"], np.float32).reshape(BUCKETS, FACTORS), hashes, share)


def scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, from 0 to 1, of each whole text; a null or empty text has the score of no terms."""
    rest = [c for c in docs.columns if c not in ("score", text)]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*rest, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__text").schema) + ", score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sizes, buckets, values in known_terms(batch["__text"], shared.value):
                part = batch.slice(at, len(sizes))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(sigmoid(margins(shared.value, sizes, buckets, values)))], names=[*rest, "score"])

    return rows.mapInArrow(score, schema)


def in_hold_out(key: Column, folds: int = 5) -> Column:
    """Whether CRC-32 of the key as text is divisible by ``folds``; false for null."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Per row of ``docs``: its key, ``held_out``, ``score`` and ``predicted`` (1 if score >= 0.5, else 0).

    Labels of keys in the hold-out are not learned from, nor is anything but
    the text an input of a score. Without labelled rows every score is the
    same low one. Repeated rows are scored each, and learned from once.
    """
    model = trained(docs, labels.where(~in_hold_out(F.col(key))), key, text, label)
    out = scores(docs.select(key, text), model, text)
    return out.select(key, in_hold_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
