"""Approximate nearest neighbours by inner product: randomly rotated one-bit codes with error bounds.

A vector's code is the signs of its rotated unit vector, packed, with two
scalars: its norm and the inner product of the unit vector with its code. For
a query they give an estimate of the inner product and a bound on the error
that holds with high probability, so only vectors whose upper bound reaches
the k-th best exact score are looked at again with the original numbers.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import ARROW_BYTES, written

#: Bits of a code for each number of a vector: it is padded with zeros before the rotation, and errors shrink as the root of this.
EXPAND = 4
#: Half-width of error bounds in standard deviations.
EPSILON = 2.0
#: Single-precision scores of unit vectors are off by less than this.
ROUNDING = 1e-4
#: Blocks are long rows: few of them in a batch.
FEW_ROWS = {ARROW_BYTES: str(1 << 23), "spark.sql.parquet.columnarReaderBatchSize": "4"}
#: Signs of the eight bits of each byte, the highest bit first.
SIGNS = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32) * 2 - 1).T


@functools.cache
def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random rotation of ``EXPAND dim`` dimensions, up to a multiple of 8, cut to vectors of ``dim``; the same in every task."""
    wide = -(-EXPAND * dim // 8) * 8
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((wide, wide)))
    return (q * np.sign(np.diag(r)))[:dim].astype(np.float32)


def units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of length 1 in single precision, lengths in double), however large or small the numbers are."""
    scale = np.abs(vectors).max(axis=1, keepdims=True).astype(np.float64)
    scaled = vectors / scale
    length = np.sqrt((scaled**2).sum(axis=1))
    return (scaled / length[:, None]).astype(np.float32), length * scale[:, 0]


def encoded(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed signs of rotated unit vectors, inner product of each with its code of length 1)."""
    turned = unit @ turn
    return np.packbits(turned > 0, axis=1), (np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[1])).astype(np.float32)


def estimates(unit: np.ndarray, turn: np.ndarray, bits: np.ndarray, fit: np.ndarray) -> np.ndarray:
    """Estimated inner products of unit queries with unit vectors, a row per query: for each byte of the packed codes one sum is looked up."""
    wide = turn.shape[1]
    tables = (unit @ turn).reshape(len(unit), wide // 8, 8) @ SIGNS / np.float32(np.sqrt(wide))
    out = np.zeros((len(unit), len(bits)), np.float32)
    for k in range(wide // 8):
        out += tables[:, k, :][:, bits[:, k]]
    return out / fit


def errors(fit: np.ndarray, wide: int) -> np.ndarray:
    """Half-width of the error bound of each unit vector's estimates."""
    return np.sqrt(np.maximum(1 - fit**2, 0)) / fit * np.float32(EPSILON / np.sqrt(max(wide - 1, 1)))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in the same order for each row."""
    return (vectors.astype(np.float64) * query.astype(np.float64)).sum(axis=1)


def best_in_block(query: np.ndarray, own: int, guess: np.ndarray, wide: np.ndarray, ids: np.ndarray, vectors: np.ndarray, unit: np.ndarray, norms: np.ndarray, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``k`` nearest of a block, and how many were looked at again: all whose upper bound reaches the k-th best score known, and the best estimates.

    ``guess`` and ``wide`` are of inner products, and ``floor`` is a k-th best
    score from elsewhere. Equal vectors have equal estimates, so a group of
    copies that is underestimated stays in by its estimates alone. Reranking is
    by single precision first; those within its rounding of the k-th score are
    scored in double precision, ties among them.
    """
    near = np.flatnonzero(ids != own)
    asked, length = (x[0] for x in units(query[None]))
    if len(near) > 4 * k:
        first = near[np.argpartition(-guess[near], 2 * k)[: 2 * k]]
        known = max(floor, np.partition((unit[first] @ asked) * norms[first] * length, -k)[-k] - ROUNDING * norms[first].max() * length)
        near = np.flatnonzero(((guess + wide >= known) | (guess >= guess[first].min())) & (ids != own))
    looked = len(near)
    if len(near) > k:
        rough = (unit[near] @ asked) * norms[near] * length
        near = near[rough >= np.partition(rough, -k)[-k] - 2 * ROUNDING * length * norms[near].max()]
    scores = exact(query, vectors[near])
    order = np.lexsort((ids[near], -scores))[:k]
    return ids[near][order], scores[order], looked


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """Distinct ``vec_id, vec, dim`` of rows with a key and a finite vector that isn't all zeros; of vectors with the same key, the least."""
    v = F.col(vector)
    fine = F.col(key).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return table.where(fine).groupBy(F.col(key).cast("long").alias("vec_id")).agg(F.min(v).alias("vec")).withColumn("dim", F.size("vec"))


def nearest(table: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding", block: int = 16384, queries_block: int = 16384) -> DataFrame:
    """Per query its ``k`` nearest other rows: ``query_id, rank, vec_id, score``.

    Codes, norms and vectors are packed into blocks of about ``block`` rows,
    which stay where they are: queries come to them, about ``queries_block``
    at a time by broadcast, each time in a pass over all blocks. A task keeps
    the ``k`` best of each query over its blocks, and the last of them is the
    threshold for the next block; so it sends ``k`` rows a query, and those of
    all tasks are merged. Memory is bounded by the two sizes. Null keys, and
    vectors that are null, zero, or hold null or non-finite numbers, take no
    part; keys are taken as unique, so rows of one key count once; vectors are
    compared with those of their own length, in the precision that they have.
    Score ties go to the smaller key; an empty table gives no rows.
    """
    vectors = written(usable(table, key, vector), "vectors")
    kind = np.float64 if "double" in vectors.schema["vec"].dataType.simpleString() else np.float32
    rows, asked = vectors.agg(F.count("*"), F.count_if(is_query(F.col("vec_id")))).first()
    parts, asks = max(1, -(-rows // block)), max(1, -(-asked // queries_block))

    def numbered(n: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    def pack(keys: tuple, group: pa.Table) -> pa.Table:
        v = np.ascontiguousarray(_matrix(group["vec"].combine_chunks()), kind)
        unit, norms = units(v)
        bits, fit = encoded(unit, rotation(v.shape[1]))
        return pa.table({"dim": pa.array([v.shape[1]], pa.int32()), "ids": [np.asarray(group["vec_id"], np.int64).tobytes()], "vecs": [v.tobytes()], "bits": [bits.tobytes()], "fit": [fit.tobytes()], "norms": [norms.tobytes()]})

    blocks = vectors.withColumn("part", numbered(parts)).groupBy("dim", "part").applyInArrow(pack, "dim int, ids binary, vecs binary, bits binary, fit binary, norms binary")
    blocks = written(blocks, "codes")

    def found_by(shared):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[int, list] = {}
            for batch in batches:
                for row in range(batch.num_rows):
                    if (dim := batch["dim"][row].as_py()) not in shared.value:
                        continue
                    of = lambda c, t: np.frombuffer(batch[c][row].as_buffer(), t)  # noqa: B023, E731
                    ids, vecs, fit, norms = of("ids", np.int64), of("vecs", kind).reshape(-1, dim), of("fit", np.float32), of("norms", np.float64)
                    bits, turn, unit = of("bits", np.uint8).reshape(len(ids), -1), rotation(dim), (vecs / norms[:, None]).astype(np.float32)
                    qids, qvecs = shared.value[dim]
                    (asked_, length), wide = units(qvecs), errors(fit, turn.shape[1])
                    known = best.setdefault(dim, [(np.zeros(0, np.int64), np.zeros(0), 0, 0)] * len(qids))
                    for at in range(0, len(qids), 64):
                        guess = estimates(asked_[at : at + 64], turn, bits, fit)
                        for q in range(at, min(at + 64, len(qids))):
                            mine, scores, looked, seen = known[q]
                            floor = scores[-1] if len(scores) == k else -np.inf
                            near, more, n = best_in_block(qvecs[q], qids[q], guess[q - at] * norms * length[q], wide * norms * length[q], ids, vecs, unit, norms, k, floor)
                            mine, scores = np.concatenate([mine, near]), np.concatenate([scores, more])
                            order = np.lexsort((mine, -scores))[:k]
                            known[q] = mine[order], scores[order], looked + n, seen + len(ids)
            for dim, known in best.items():
                qids = shared.value[dim][0]
                for at in range(0, len(known), 1024):
                    some = known[at : at + 1024]
                    n = [len(x[0]) for x in some]
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qids[at : at + 1024], n)), pa.array(np.concatenate([x[0] for x in some])), pa.array(np.concatenate([x[1] for x in some])), pa.array(np.repeat([x[2] / max(1, x[3]) for x in some], n))], names=["query_id", "vec_id", "score", "looked"])

        return search

    found = []
    for ask in range(asks):
        some = vectors.where(is_query(F.col("vec_id")) & (numbered(asks) == ask)).toArrow()  # queries_block rows on average
        dims = np.asarray(some["dim"])
        questions = {int(d): (np.asarray(mine["vec_id"], np.int64), np.ascontiguousarray(_matrix(mine["vec"].combine_chunks()), kind)) for d in np.unique(dims) for mine in [some.filter(pa.array(dims == d))]}
        shared = table.sparkSession.sparkContext.broadcast(questions)
        found.append(written(blocks.mapInArrow(found_by(shared), "query_id long, vec_id long, score double, looked double"), "near", FEW_ROWS))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return reduce(DataFrame.union, found).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "looked")
