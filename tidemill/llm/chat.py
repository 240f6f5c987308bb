"""Chat formatting: reply trees, their root-to-leaf paths, and each chosen path as one conversation."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

#: What a chat model's tokenizer may take as control; the first two mark turns here.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_BEFORE = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL)
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escaped(text: Column) -> Column:
    r"""Backslashes doubled, and ``\-`` put after the first character of each control string, so that none is left."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), f"({_BEFORE})", r"$1\\-")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"-": "", "n": "\n"}.get(m[1], m[1]), text, flags=re.S)


def dealt(rows: DataFrame, by: list[Column], name: str) -> DataFrame:
    """``rows``, written in ranges of ``by``, with the number of the range in ``__task``."""
    return written(rows.repartitionByRange(*by).withColumn("__task", F.spark_partition_id()), name)


def carried(ends: DataFrame, group: str, what: str, add: bool) -> DataFrame:
    """``__task, __group, __before`` from ``ends``, a row per range and group: ``what`` of the group's last range before, or of all of them, added up.

    A range goes on with one group of earlier ranges at most, so the result
    has a row per range at most, and is broadcast.
    """
    along = Window.partitionBy(group).orderBy("__task")
    before = F.sum(what).over(along.rowsBetween(Window.unboundedPreceding, -1)) if add else F.lag(what).over(along)
    found = ends.select("__task", F.col(group).alias("__group"), before.alias("__before")).where("__before is not null")
    return F.broadcast(found.withColumnRenamed("__task", "__range"))


def _continued(rows: DataFrame, before: DataFrame, group: str) -> DataFrame:
    same = (F.col("__task") == F.col("__range")) & F.col(group).eqNullSafe(F.col("__group"))
    return rows.join(before, same, "left").drop("__range", "__group", "__task")


def numbered(rows: DataFrame, group: str, order: list[Column], name: str = "ranked") -> DataFrame:
    """``rows`` with ``rank`` from 1 within ``group``, which may hold most of them: ranges are numbered apart and shifted by the sizes of those before."""
    parts = dealt(rows, [F.col(group), *order], name)
    inside = F.row_number().over(Window.partitionBy("__task", group).orderBy(*order))
    sizes = parts.groupBy("__task", group).agg(F.count("*").alias("__n"))
    before = carried(sizes, group, "__n", add=True)
    return _continued(parts.withColumn("rank", inside), before, group).withColumn("rank", F.col("rank") + F.coalesce("__before", F.lit(0)).cast("int")).drop("__before")


def paths(nodes: DataFrame, top: int | None = None) -> DataFrame:
    """``leaf, node, depth, rank, path_score`` for every node of each chosen root-to-leaf path.

    ``nodes`` has unique ``node``, ``parent`` and ``score``. A node whose
    parent is null or absent is a root; nodes on a cycle, and below one, are on
    no path. Self-joins double the reach of every node's pointer, so a tree of
    depth d takes log2(d) of them, of the nodes that have not met their root;
    the same tables then spread each chosen leaf to its ancestors. Paths of a root are ranked by the sum of their scores,
    ties to the smaller leaf; ``top`` keeps the first ones, None all.
    """
    known = nodes.select(F.col("node").alias("parent")).distinct()
    linked = written(nodes.where("parent is not null").join(known, "parent", "left_semi").select("node", "parent"), "links")
    state = nodes.select("node", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total")).join(linked, "node", "left")
    state = written(state.select("node", F.col("parent").alias("far"), F.coalesce("parent", "node").alias("root"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth"), "total"), "reach")
    columns, jumps, limit = state.columns, [], state.count()
    settled, moving = state.where("far is null"), state.where("far is not null")
    while not moving.isEmpty() and 2 ** len(jumps) <= 2 * limit:
        jumps.append(moving.select("node", "far"))
        up = settled.union(moving).toDF("far", "far2", "root2", "depth2", "total2")
        reach = moving.join(up, "far").select("node", F.col("far2").alias("far"), F.col("root2").alias("root"), (F.col("depth") + F.col("depth2")).alias("depth"), (F.col("total") + F.col("total2")).alias("total"))
        reach = written(reach.select(*columns), "reach")
        settled, moving = settled.union(reach.where("far is null")), reach.where("far is not null")
    leaves = settled.join(linked.select(F.col("parent").alias("node")).distinct(), "node", "left_anti")
    leaves = numbered(leaves, "root", [F.desc("total"), F.col("node")])
    if top is not None:
        leaves = leaves.where(F.col("rank") <= top)
    chosen = written(leaves.select(F.col("node").alias("leaf"), "rank", F.col("total").alias("path_score")), "leaves")
    on_path = chosen.select("leaf", F.col("leaf").alias("node"))
    for jump in jumps:
        on_path = written(on_path.union(on_path.join(jump, "node").select("leaf", F.col("far").alias("node"))), "paths")
    return on_path.join(settled.select("node", "depth"), "node").join(chosen, "leaf").select("leaf", "node", "depth", "rank", "path_score")


def formatted(turns: DataFrame, path: str = "leaf", place: str = "depth", learn: str = "assistant") -> DataFrame:
    """One conversation per path: ``n_turns``, ``formatted``, and ``loss``, the spans (start, end) of the turns by ``learn``.

    Turns stand in order of ``place``. Null roles and texts are empty. Spans
    are code points of ``formatted``, end exclusive, and hold a turn's escaped
    text only. A conversation is one value, so its turns meet in one task.
    """
    role = F.regexp_replace(escaped(F.coalesce("role", F.lit(""))), "\n", r"\\\\n")
    marked = turns.select(path, place, "role", F.concat(F.lit(CONTROL[0]), role, F.lit("\n")).alias("head"), escaped(F.coalesce("text", F.lit(""))).alias("body"))
    marked = marked.withColumn("turn", F.concat("head", "body", F.lit(CONTROL[1] + "\n")))
    end = F.sum(F.length("turn")).over(Window.partitionBy(path).orderBy(place).rowsBetween(Window.unboundedPreceding, 0))
    marked = marked.withColumn("start", end - F.length("turn") + F.length("head"))
    span = F.when(F.col("role") == learn, F.struct(F.col("start").alias("start"), (F.col("start") + F.length("body")).alias("end")))
    per = marked.groupBy(path).agg(F.count("*").alias("n_turns"), F.array_sort(F.collect_list(F.struct(place, "turn"))).alias("turns"), F.array_sort(F.collect_list(span)).alias("loss"))
    return per.select(path, "n_turns", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"), "loss")


def parsed(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn; ValueError if anything stands between turns."""
    turns, at = [], 0
    while at < len(text):
        found = TURN.match(text, at)
        if not found:
            raise ValueError(f"no turn begins at {at}")
        turns.append((unescaped(found[1]), unescaped(found[2])))
        at = found.end()
    return turns


def read_back(chats: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns with ``n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of ``formatted`` and ``loss``."""
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chats.select(*keep).schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch["formatted"], batch["loss"], strict=True):
                text = text.as_py()
                turns = parsed(text)
                loss = "".join(unescaped(text[s["start"] : s["end"]]) for s in spans.as_py())
                whole = sha256("".join(f"{role}\n{body}\n" for role, body in turns).encode()).hexdigest()
                rows.append((len(turns), whole, len(loss), sha256(loss.encode()).hexdigest(), len(text)))
            made = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays([*(batch[k] for k in keep), *made], names=[*keep, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return chats.select(*keep, "formatted", "loss").mapInArrow(digest, kind + ", n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def threads(rows: DataFrame, tree: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Rows of linear conversations as reply trees: each replies to the one before it by ``turn``, then role and text.

    Adds ``node`` and ``parent``. Rows of a null key are a conversation of
    their own, and repeated rows are turns each. Rows are dealt out in ranges,
    so a conversation that holds most of them is many tasks'; the first row of
    a range replies to the last one of the range before. Rows of one turn and
    role whose texts begin alike stay together.
    """
    order = [F.col(tree), F.col(turn), F.col("role"), F.substring("text", 1, 32)]
    parts = dealt(rows.withColumn("node", F.monotonically_increasing_id()), order, "messages")
    inside = F.lag("node").over(Window.partitionBy("__task", tree).orderBy(turn, "role", "text", "node"))
    last = parts.groupBy("__task", tree).agg(F.max_by("node", F.struct(turn, "role", "text", "node")).alias("__last"))
    linked = _continued(parts.withColumn("parent", inside), carried(last, tree, "__last", add=False), tree)
    return linked.withColumn("parent", F.coalesce("parent", "__before")).drop("__before")
