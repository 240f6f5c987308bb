"""N-gram Jaccard join: rare-first prefix filtering, and components of the links it verifies.

A document's set is its distinct ``k``-word shingles. Sets that reach the
threshold share a token in their prefixes, whatever total order the tokens
are in; the order here is by how often a token's bucket occurs in the corpus,
so prefixes hold rare tokens. Equal sets are one class from the start. Within
the documents that share a prefix token, pairs are never listed all: each is
compared with one pivot, then with several. Of what is still apart after that,
the documents of a rare token meet each other, and those of a common one are
cut once more: two sets that reach the threshold differ in few tokens, so of
slightly more parts of the hash range one at least holds the same tokens in
both, and only documents that agree in such a part meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .store import ARROW_BYTES, dropped, written

#: Buckets of the frequency table: four a document between these bounds, so that its broadcast has 16 MB at most. Pieces bound what one task adds up.
LEAST_BUCKETS, MOST_BUCKETS, PIECES = 1 << 20, 1 << 24, 64
#: Parts of the hash range whose counts bound an overlap.
RANGES = 64
#: Tables of at most so many rows of two numbers are broadcast.
SMALL_ROWS = 500_000
#: Documents of a token, still apart, that may meet each other directly.
FEW = 256
#: Prefix tokens that are dealt by token at once, where ``ROUNDS`` rounds at most allow it.
ROUND_TOKENS, ROUNDS = 4_000_000, 4


def _distinct(found: T.Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, token, first word) of each text's distinct tokens, ascending, text after text."""
    of, tokens, begin = T.shingles(found, k)
    order = np.lexsort((tokens, of))
    of, tokens, begin = of[order], tokens[order], begin[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (tokens[1:] != tokens[:-1])
    return of[new], tokens[new], begin[new]


def _sets(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, sizes, tokens) of a slice's distinct tokens."""
    for at, data, bounds in T.chunks(texts):
        of, tokens, _ = _distinct(T.words(data, bounds, T.SPACES), k)
        yield at, np.bincount(of, minlength=len(bounds) - 1), tokens


def _sums(tokens: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
    """Two sums over each text's tokens, which stand for its set."""
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    sums = np.zeros((2, len(tokens) + 1), T.U)
    np.cumsum(tokens, out=sums[0, 1:])
    np.cumsum(T.mixed(tokens ^ T.U(0x5DEECE66D1234567)), out=sums[1, 1:])
    return [pa.array((s[first[1:]] - s[first[:-1]]).view(np.int64)) for s in sums]


def _bucket(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return (tokens >> T.U(65 - buckets.bit_length())).astype(np.int64)


def levels(docs: DataFrame, text: str, k: int) -> np.ndarray:
    """For each bucket of tokens, a level from 0 to 255 that grows with the number of documents' tokens in it.

    Counts cover all documents. A task counts its own rows into one table of
    bounded size; tables are added up in pieces, in two steps. The result has
    a byte per bucket.
    """
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << (4 * docs.count() - 1).bit_length()))
    wide = buckets // PIECES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int32)
        for batch in batches:
            for _, _, tokens in _sets(batch[0], k):
                np.add.at(total, _bucket(tokens, buckets), 1)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(PIECES), pa.int32()), pa.array([x.tobytes() for x in total.reshape(PIECES, wide)])], names=["piece", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(wide, np.int64)
        for x in group["counts"]:
            raw = np.frombuffer(x.as_buffer(), np.uint8)
            total += raw.view(np.int64 if len(raw) == 8 * wide else np.int32)
        return pa.table({"piece": group["piece"][:1], "counts": [total.tobytes()]})

    pieces = docs.select(text).mapInArrow(count, "piece int, counts binary").withColumn("part", F.spark_partition_id() % 64)
    once = pieces.groupBy("piece", "part").applyInArrow(lambda t: add(t.select(["piece", "counts"])), "piece int, counts binary")
    total = np.zeros((PIECES, wide), np.int64)
    for row in once.groupBy("piece").applyInArrow(add, "piece int, counts binary").collect():
        total[row["piece"]] = np.frombuffer(row["counts"], np.int64)
    return np.minimum(255, np.round(6 * np.log2(1 + total.reshape(-1)))).astype(np.uint8)


def profiles(docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """Per row: its number, key, set size ``n``, two sums that stand for the set, its prefix in rare-first order, and its counts by hash range."""
    order = docs.sparkSession.sparkContext.broadcast(levels(docs, text, k))

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = order.value
        for batch in batches:
            for at, sizes, tokens in _sets(batch["__text"], k):
                n = len(sizes)
                first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                of = np.repeat(np.arange(n), sizes)
                rare = np.lexsort((tokens, level[_bucket(tokens, len(level))], of))
                place = np.arange(len(of)) - first[of]
                keep = np.where(sizes > 0, sizes - (percent * sizes + 99) // 100 + 1, 0)
                prefix = tokens[rare][place < keep[of]]
                ranges = np.bincount(of * RANGES + (tokens >> T.U(58)).astype(np.int64), minlength=n * RANGES)
                part = batch.slice(at, n)
                yield pa.RecordBatch.from_arrays(
                    [part["__row"], part[key], pa.array(sizes, pa.int32()), *_sums(tokens, sizes), T.lists(prefix.view(np.int64), keep), T.lists(np.minimum(ranges, 32767).astype(np.int16), np.full(n, RANGES))],
                    names=["row", "id", "n", "s1", "s2", "prefix", "ranges"],
                )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key), F.col(text).alias("__text"), F.monotonically_increasing_id().alias("__row"))
    return rows.mapInArrow(profile, f"row long, id {kind}, n int, s1 long, s2 long, prefix array<long>, ranges array<smallint>")


def connected(links: DataFrame) -> DataFrame:
    """``node, label`` for all ends of ``links`` (a, b): the least node that each reaches.

    Large-star and small-star steps in turn, each table written to the shared
    folder; least neighbours are found by aggregation and joined back, so a
    node with very many links is split like any other skewed key.
    """
    edges = written(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            break
        before = seen
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m")).distinct()
        small = written(small, "edges")
        dropped(edges)
        edges = small
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(edges.select("v", "v").distinct())


def possible(n: tuple[str, str], at: tuple[str, str], percent: int) -> Column:
    """Length and positional filters for two sets that share the token at places ``at`` of their orders.

    Were it their first common token, the overlap would be at most what is
    left of either set. A pair that links passes at its first common token, so
    no link is lost where another common token does not pass.
    """
    (a, b), (i, j) = map(F.col, n), map(F.col, at)
    length = F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)
    most = F.least(a - i, b - j)
    return length & (F.lit(100 + percent) * most >= F.lit(percent) * (a + b))


def shared_words(a: pa.Array, b: pa.Array, k: int, percent: int) -> np.ndarray:
    """For each pair of texts, words joined by spaces, whether their sets reach the threshold.

    Tokens are matched by hash, and a match counts if the words are the same.
    """
    pairs, out = len(a), []
    texts = pa.concat_arrays([a, b]).take(pa.array(np.arange(2 * pairs).reshape(2, -1).T.reshape(-1)))
    bounds = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(texts), np.int64).reshape(-1, 2).sum(axis=1))])
    at = 0
    while at < pairs:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + T.CHUNK_BYTES, side="right")) - 1)
        _, data, edges = next(T.chunks(texts.slice(2 * at, 2 * (to - at)), int(bounds[to] - bounds[at])))
        found = T.words(data, edges, T.SPACES)
        of, tokens, begin = _distinct(found, k)
        sizes = np.bincount(of, minlength=2 * (to - at)).reshape(-1, 2).sum(axis=1)
        last = np.minimum(begin + k, found.first[of + 1]) - 1
        order = np.lexsort((of, tokens, of // 2))
        of, tokens, start, end = of[order], tokens[order], found.start[begin[order]], found.end[last[order]]
        both = np.flatnonzero((tokens[1:] == tokens[:-1]) & (of[1:] // 2 == of[:-1] // 2))
        wide = end[both] - start[both]
        keep = wide == end[both + 1] - start[both + 1]
        both, wide = both[keep], wide[keep]
        step = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
        differ = found.low[np.repeat(start[both], wide) + step] != found.low[np.repeat(start[both + 1], wide) + step]
        wrong = np.zeros(len(both), bool)
        wrong[np.repeat(np.arange(len(both)), wide)[differ]] = True
        same = np.bincount(of[both[~wrong]] // 2, minlength=to - at)
        out.append(100 * same >= percent * (sizes - same))
        at = to
    return np.concatenate(out) if out else np.zeros(0, bool)


def part_sums(tokens: np.ndarray, percent: int) -> np.ndarray:
    """A sum for each part of the hash range, for the set's length class and the next.

    Two sets that reach the threshold are of one class or of neighbours, and
    differ in fewer tokens than the higher class has parts, so a sum of that
    class is the same for both.
    """
    sums, ratio = [], 100.1 / percent
    own = int(np.floor(np.log(len(tokens)) / np.log(ratio)))
    for c in (own, own + 1):
        parts = int((100 - percent) * 2 * ratio ** (c + 1) / (100 + percent)) + 1
        total, number = np.zeros(parts, T.U), np.arange(parts, dtype=T.U)
        np.add.at(total, (tokens % T.U(parts)).astype(np.int64), T.mixed(tokens))
        sums.append(T.mixed(total ^ T.mixed(number * T.U(0x9FB21C651E98DF25) + T.U(c + 1))))
    return np.concatenate(sums)


class Join:
    """One run over ``docs``. What its result is made of stays in the shared folder; other tables go once they are read."""

    def __init__(self, docs: DataFrame, key: str, text: str, k: int, percent: int):
        self.docs, self.key, self.text, self.k, self.percent = docs, key, text, k, percent
        self.rows = written(profiles(docs, key, text, k, percent), "profiles")
        classes = self.rows.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("row").alias("row"), F.min("id").alias("least"))
        self.classes = written(classes, "classes")
        self.labels, self.tried = None, []

    def postings(self) -> list[DataFrame]:
        """Prefix tokens that two classes or more have, with the place of each and the token's first pivot, in tables by remainder of the token.

        All prefix tokens have to be dealt by token, though few are shared;
        rounds bound the disk that takes.
        """
        mine = written(self.rows.join(self.classes.select("row"), "row", "left_semi").select("row", "n", "prefix"), "prefixes")
        total = mine.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
        rounds = min(ROUNDS, max(1, -(-total // ROUND_TOKENS)))
        pivot = F.min(F.struct("at", "n", "row")).alias("pivot")  # where it comes earliest, fewest rare tokens precede it: the row nearest to all others
        found = []
        for k in range(rounds):
            every = mine.select("row", "n", F.posexplode("prefix").alias("at", "token")).where(F.pmod("token", F.lit(rounds)) == k)
            shared = every.groupBy("token").agg(F.count("*").alias("docs"), pivot).where("docs > 1")
            found.append(written(every.join(shared, "token"), "postings"))
        dropped(mine)
        return found

    def again(self, wanted: DataFrame, make, columns: str) -> DataFrame:
        """``row`` and ``columns``, which ``make`` gives for the texts of the rows in ``wanted`` (row, id, s1, s2), read again."""
        few = wanted.select(F.col("id").alias("__id")).distinct()
        if wanted.count() <= SMALL_ROWS:
            few = F.broadcast(few)
        k, key = self.k, self.key
        names = [c.split()[0] for c in columns.split(", ")]

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, data, bounds in T.chunks(batch["__text"]):
                    found = T.words(data, bounds, T.SPACES)
                    of, tokens, _ = _distinct(found, k)
                    sizes = np.bincount(of, minlength=len(bounds) - 1)
                    yield pa.RecordBatch.from_arrays([batch["__key"].slice(at, len(sizes)), *_sums(tokens, sizes), *make(found, sizes, tokens)], names=["id", "s1", "s2", *names])

        kind = self.docs.schema[key].dataType.simpleString()
        texts = self.docs.select(F.col(key).alias("__key"), F.col(self.text).alias("__text"))
        found = texts.join(few, F.col("__key").eqNullSafe(F.col("__id")), "left_semi").mapInArrow(whole, f"id {kind}, s1 long, s2 long, {columns}")
        of = wanted.withColumnRenamed("id", "__id")
        found = found.join(of, (found["id"].eqNullSafe(of["__id"])) & (found["s1"] == of["s1"]) & (found["s2"] == of["s2"]))
        return found.select("row", *names).dropDuplicates(["row"])

    def wanted(self, rows: DataFrame) -> DataFrame:
        return written(self.rows.select("row", "id", "s1", "s2").join(rows.select("row").distinct(), "row", "left_semi"), "wanted")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Of distinct ``pairs`` (a, b) of rows, those whose sets reach the threshold, compared once each.

        First the counts by hash range bound each overlap (the suffix filter).
        The texts of the rest are read again and compared by their words.
        """
        of = self.rows.select("row", "n", "ranges")
        near = pairs.join(of.toDF("a", "na", "ra"), "a").join(of.toDF("b", "nb", "rb"), "b")
        most = F.expr("aggregate(zip_with(ra, rb, (x, y) -> if(x = 32767S or y = 32767S, 1000000000, cast(least(x, y) as int))), 0L, (s, x) -> s + x)")
        near = written(near.where(F.lit(100 + self.percent) * most >= F.lit(self.percent) * (F.col("na") + F.col("nb"))).select("a", "b"), "near")
        if near.isEmpty():
            return near
        wanted = self.wanted(near.select(F.col("a").alias("row")).union(near.select("b")))

        def plain(found: T.Words, sizes: np.ndarray, tokens: np.ndarray) -> list[pa.Array]:
            text, _, end = found.joined()
            edges = np.concatenate([[0], end])[found.first]
            return [pa.array([text[b:e].tobytes() for b, e in zip(edges[:-1], edges[1:], strict=True)], pa.binary())]

        texts = written(self.again(wanted, plain, "words binary"), "words")
        k, percent = self.k, self.percent

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.select(["a", "b"]).filter(pa.array(shared_words(batch["words_a"], batch["words_b"], k, percent)))

        both = near.join(texts.toDF("a", "words_a"), "a").join(texts.toDF("b", "words_b"), "b")
        links = written(both.select("a", "b", "words_a", "words_b").mapInArrow(compare, "a long, b long"), "links", {ARROW_BYTES: str(1 << 23)})
        dropped(near, wanted, texts)
        return links

    def compared(self, pairs: DataFrame) -> None:
        """Verify ``pairs`` (a, b) not tried before, and let links merge labels."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for before in self.tried:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        self.tried.append(pairs)
        if self.labels is not None and pairs.isEmpty():
            return
        links = self.verified(pairs)
        if self.labels is None:
            self.labels = written(connected(links), "labels")
            return
        if links.isEmpty():
            return
        old = self.labels
        merged = links.join(old.toDF("a", "la"), "a", "left").join(old.toDF("b", "lb"), "b", "left")
        merged = merged.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
        new = written(connected(merged), "labels")
        moved = old.join(new.toDF("label", "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        fresh = new.join(old.select("node"), "node", "left_anti")
        self.labels = written(moved.union(fresh), "labels")
        dropped(links, old, new)

    def apart(self, postings: DataFrame) -> DataFrame:
        """``postings`` with labels, of tokens whose rows are not all of one component yet."""
        named = postings.join(self.labels.toDF("row", "label"), "row", "left").withColumn("label", F.coalesce("label", "row"))
        open_tokens = named.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("token")
        return written(named.join(open_tokens, "token", "left_semi"), "apart")

    def alike_in_part(self, left: DataFrame) -> DataFrame:
        """``left`` with ``sum``, a row for each part of a document's hash range in which one of another component that shares the token holds the same tokens."""
        percent = self.percent

        def cut(found: T.Words, sizes: np.ndarray, tokens: np.ndarray) -> list[pa.Array]:
            ends = np.cumsum(sizes)
            each = [part_sums(tokens[e - n : e], percent) if n else np.zeros(0, T.U) for e, n in zip(ends, sizes, strict=True)]
            return [T.lists(np.concatenate(each).view(np.int64), np.array([len(x) for x in each]))]

        wanted = self.wanted(left)
        sums = written(self.again(wanted, cut, "sums array<long>"), "sums")
        named = written(left.join(sums, "row").withColumn("sum", F.explode("sums")).drop("sums"), "parts")
        open_sums = named.groupBy("token", "sum").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("token", "sum")
        out = written(named.join(open_sums, ["token", "sum"], "left_semi"), "parts")
        dropped(wanted, sums, named)
        return out

    def met(self, left: DataFrame, on: list[str]) -> DataFrame:
        """Pairs (a, b) of rows of ``left`` that are equal in ``on``, of two components, and pass the length and positional filters."""
        other = left.toDF(*(c if c in on else f"o_{c}" for c in left.columns))
        fits = possible(("n", "o_n"), ("at", "o_at"), self.percent)
        return left.join(other, on).where((F.col("row") < F.col("o_row")) & (F.col("label") != F.col("o_label")) & fits).select(F.col("row").alias("a"), F.col("o_row").alias("b"))

    def link(self, pivots: int = 8) -> None:
        """Compare pairs until every two rows that link have one label."""
        pieces = self.postings()
        postings = reduce(DataFrame.union, pieces)
        fits = possible(("n", "pivot.n"), ("at", "pivot.at"), self.percent)
        self.compared(postings.where((F.col("row") != F.col("pivot.row")) & fits).select(F.col("row").alias("a"), F.col("pivot.row").alias("b")))
        left = self.apart(postings.where("docs > 2").select("token", "row", "n", "at"))
        dropped(*pieces)
        if left.isEmpty():
            return
        several = left.groupBy("token", F.pmod(F.xxhash64("row"), F.lit(pivots)).alias("s")).agg(F.min(F.struct("at", "n", "row", "label")).alias("p")).select("token", "p")
        fits = possible(("n", "p.n"), ("at", "p.at"), self.percent)
        self.compared(left.join(several, "token").where((F.col("label") != F.col("p.label")) & fits).select(F.col("row").alias("a"), F.col("p.row").alias("b")))
        before, left = left, self.apart(left.select("token", "row", "n", "at"))
        dropped(before)
        if left.isEmpty():
            return
        common = written(left.groupBy("token").count().where(F.col("count") > FEW).select("token"), "common")
        pairs = self.met(left.join(common, "token", "left_anti"), ["token"])
        if not common.isEmpty():
            pairs = pairs.union(self.met(self.alike_in_part(left.join(common, "token", "left_semi")), ["token", "sum"]))
        self.compared(pairs)

    def run(self) -> DataFrame:
        self.link()
        dropped(*self.tried)
        members = self.classes.join(self.labels.toDF("row", "label"), "row", "left").withColumn("label", F.coalesce("label", "row"))
        least = members.groupBy("label").agg(F.min("least").alias("component"))
        members = members.join(least, "label").select("s1", "s2", "n", "component")
        found = self.rows.select("row", "id", "n", "s1", "s2").join(members, ["s1", "s2", "n"], "left")
        return found.select(F.col("id").alias(self.key), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component_id"))


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """Per row: its key, ``n_shingles`` and ``component_id``, the least key that links reach.

    Texts are lower-cased (A-Z) and split at spaces and tabs to carriage
    returns. A text of fewer than ``k`` words is one shingle as a whole; a
    null or empty text, or one of separators only, has none and no link. Two
    rows link when 100 |A and B| >= percent |A or B|. Rows of equal sets,
    repeated rows among them, are one class. Null keys come after all others.
    """
    return Join(docs.select(key, text), key, text, k, percent).run()
