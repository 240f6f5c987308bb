"""Secret scans: fixed patterns plus a randomness test battery, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

#: Kind, pattern, cheap test that every text with a match passes. Group V of a pattern, where it has one, is what ``LEAST`` measures.
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{32,}",
}
HINTS = {"assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", "access": "AKIA", "hex": r"[0-9a-f]{32}"}
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: A token that may be random: so many characters of a base64 or base64url alphabet.
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
TOKEN_HINT = r"[A-Za-z0-9+/_-]{20}"

#: Alphabets, by size, in the order in which an encoding is inferred, and the share of prose in each.
ALPHABETS = (
    ("decimal", r"^[0-9]+$", "0123456789", 0.3),
    ("hex", r"^[0-9a-f]+$", "0123456789abcdef", 0.3),
    ("HEX", r"^[0-9A-F]+$", "0123456789ABCDEF", 0.3),
    ("base32", r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.9),
    ("base36", r"^[a-z0-9]+$", "abcdefghijklmnopqrstuvwxyz0123456789", 0.97),
    ("base64", r"^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.99),
    ("base64url", r"^[A-Za-z0-9_/+-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_+/", 1.0),
)
#: Sum of squared letter frequencies of prose, as in English.
PROSE = 0.0655


def _cells(text: Column, pattern: str, group: int | None) -> Column:
    """Leftmost non-overlapping matches: code points between the last match and this one, in it, and in its group.

    ``\\G`` ties each match to the last one's end, so that what follows the last match is read once.
    """
    gap = F.regexp_extract_all(text, F.lit(rf"(?s)\G(.*?)(?:{pattern})"), F.lit(1))
    hit = F.regexp_extract_all(text, F.lit(rf"(?s)\G.*?({pattern})"), F.lit(1))
    value = F.regexp_extract_all(text, F.lit(rf"(?s)\G.*?{pattern}"), F.lit(group)) if group else hit
    return F.zip_with(F.zip_with(gap, hit, lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit"))), value, lambda x, v: F.struct(x["gap"].alias("gap"), F.length(x["hit"]).alias("len"), F.length(v).alias("value"), x["hit"].alias("hit")))


_CELLS = "array<struct<gap:int,len:int,value:int,hit:string>>"


def _found(text: Column, kind: str) -> Column:
    pattern, hint = (TOKEN, TOKEN_HINT) if kind == "token" else (PATTERNS[kind], HINTS[kind])
    first = text.contains(hint) if hint.isalnum() else text.rlike(hint)
    return F.when(first, _cells(text, pattern, 1 if kind == "assign" else None)).otherwise(F.array().cast(_CELLS))


def _labelled(cells: Column, kind: str) -> Column:
    tested = kind == "token"
    return F.transform(cells, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), x["gap"].alias("gap"), x["len"].alias("len"), x["value"].alias("value"), (x["hit"] if tested else F.lit(None).cast("string")).alias("token")))


def phi(z: Column) -> Column:
    """The normal distribution function, within 0.0002."""
    z = F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    return 1 / (1 + F.exp(-1.5976 * z - 0.07056 * F.pow(z, 3)))


def battery(tokens: DataFrame, token: str = "token") -> DataFrame:
    """``tokens`` with ``encoding, n, p_chi, p_runs, p_serial, p_random, p_prose``.

    The smallest alphabet that holds a token is its encoding. Under a uniform
    draw from it: the chi-squared statistic of its characters (upper tail,
    Wilson-Hilferty), the number of runs above and below the alphabet's middle,
    and the correlation of neighbours (both two-sided). p_random is three times
    the least of the three p-values (Bonferroni). p_prose is the chance that
    prose of this length would look as uniform, as its chi-squared statistic
    has mean (A-1) + n d and variance 2(A-1) + 4 n d, where d = A PROSE - 1,
    times the chance that so many characters of prose keep to the alphabet.
    """
    t = F.col(token)
    encoding = F.coalesce(*[F.when(t.rlike(pattern), F.struct(F.lit(name).alias("name"), F.lit(letters).alias("letters"), F.lit(share).alias("share"))) for name, pattern, letters, share in ALPHABETS])
    df = tokens.withColumn("__as", encoding).withColumns({"encoding": F.col("__as.name"), "__letters": F.col("__as.letters"), "n": F.length(t).cast("long")})
    df = df.withColumn("__codes", F.expr(f"transform(split({token}, ''), c -> cast(instr(__letters, c) - 1 as double))"))
    df = df.withColumn("__counts", F.expr(f"transform(split(__letters, ''), c -> cast(length({token}) - length(replace({token}, c, '')) as double))"))
    df = df.withColumn("__a", F.length("__letters").cast("double"))
    n, a = F.col("n").cast("double"), F.col("__a")
    chi, free = a * F.aggregate("__counts", F.lit(0.0), lambda x, c: x + c * c) / n - n, a - 1
    df = df.withColumn("__chi", chi)
    z_chi = (F.pow(F.greatest(F.col("__chi"), F.lit(1e-9)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    df = df.withColumn("p_chi", 1 - phi(z_chi))
    low = "cast(ceil(__a / 2) as int)"
    df = df.withColumn("__sides", F.expr(f"translate({token}, __letters, concat(repeat('0', {low}), repeat('1', cast(__a as int) - {low})))"))
    df = df.withColumn("__high", F.expr("cast(n - length(replace(__sides, '1', '')) as double)"))
    changes = " + ".join(f"(n - length(replace(__sides, '{x}', ''))) / 2" for x in ("01", "10"))
    df = df.withColumn("__runs", F.expr(f"1D + {changes}"))
    h = F.col("__high")
    mean = 2 * h * (n - h) / n + 1
    var = F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9))
    df = df.withColumn("p_runs", F.when((h == 0) | (h == n), F.pow(F.lit(2.0), 1 - n)).otherwise(2 * (1 - phi(F.abs(F.col("__runs") - mean) / F.sqrt(var)))))
    placed = "sequence(0, size(__counts) - 1)"
    df = df.withColumn("__mean", F.expr(f"aggregate({placed}, 0D, (s, c) -> s + c * __counts[c]) / n"))
    df = df.withColumn("__var", F.expr(f"aggregate({placed}, 0D, (s, c) -> s + power(c - __mean, 2) * __counts[c])"))
    df = df.withColumn("__lag", F.expr("aggregate(sequence(1, cast(n as int) - 1), 0D, (s, i) -> s + (__codes[i] - __mean) * (__codes[i - 1] - __mean))"))
    df = df.withColumn("p_serial", F.when(F.col("__var") == 0, F.lit(0.0)).otherwise(2 * (1 - phi(F.abs(F.col("__lag") / F.col("__var") + 1 / n) * F.sqrt(n)))))
    df = df.withColumn("p_random", F.least(F.lit(1.0), 3 * F.least("p_chi", "p_runs", "p_serial")))
    prose = n * F.greatest(a * PROSE - 1, F.lit(0.01))
    df = df.withColumn("p_prose", phi((F.col("__chi") - free - prose) / F.sqrt(2 * free + 4 * prose)) * F.pow(F.col("__as.share"), n))
    return df.drop("__as", "__letters", "__codes", "__a", "__counts", "__sides", "__chi", "__high", "__runs", "__mean", "__var", "__lag")


def discovered(tested: DataFrame, rate: float = 0.01, level: float = 0.01, usual: int = 32) -> DataFrame:
    """Rows of ``battery`` that pass for random at ``level`` and are discoveries at false-discovery ``rate``.

    Weighted Benjamini-Hochberg over all tokens. All three tests are in the
    value that is ranked: the chance of prose, divided by how well the token
    fits a random one, so that a token whose runs or neighbours are odd needs
    the stronger chi-squared. It is divided by the token's length over
    ``usual`` (0.5 to 2 at most), scaled to mean 1, since longer tokens tell
    more. The ranks come from a histogram of 640 bins of
    log p, so the table that the threshold is read from is of fixed size.
    """
    weight = F.greatest(F.lit(0.5), F.least(F.lit(2.0), F.col("n") / usual))
    bin_of = F.least(F.lit(639), F.greatest(F.lit(0), F.floor(-40 * F.log10(F.greatest(F.col("p_prose") / F.greatest(F.col("p_random"), F.lit(max(level, 1e-9))) / weight, F.lit(1e-16)))))).cast("int")
    binned = tested.withColumn("__bin", bin_of)
    counts = binned.groupBy("__bin").agg(F.count("*").alias("tokens"), F.sum(weight).alias("weights"))
    all_rows = Window.orderBy(F.desc("__bin"))
    ranks = counts.select("__bin", F.sum("tokens").over(all_rows).alias("rank"), F.sum("weights").over(all_rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all"))
    least = ranks.where(F.pow(F.lit(10.0), -F.col("__bin") / 40) <= rate * F.col("rank") / F.col("all")).agg(F.min("__bin").alias("__least"))
    return binned.join(F.broadcast(least), F.col("__bin") >= F.col("__least")).where(F.col("p_random") >= level).drop("__bin", "__least")


def secret_spans(docs: DataFrame, text: str = "text", rate: float = 0.01) -> DataFrame:
    """``docs`` without ``text``, with ``spans``, an array of ``(start, end, kind)`` by start, then kind.

    Positions are code points, end exclusive. Kinds assign, access and hex are
    matches of ``PATTERNS`` with at least ``LEAST`` characters; kind random are
    tokens that ``battery`` and ``discovered`` single out and that meet no
    other span. A null or empty text has no spans; repeated rows are scanned
    each. Spans of a text are few and gathered by row, while the tokens of all
    texts take part in false-discovery control.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rest = [c for c in docs.columns if c not in (text, "__row", "spans")]
    cells = F.concat(*[_labelled(_found(body, k), k) for k in (*KINDS, "token")])
    scanned = written(docs.select(*rest, F.monotonically_increasing_id().alias("__row"), cells.alias("__cells")), "secrets")
    each = scanned.where(F.size("__cells") > 0).select("__row", F.explode("__cells").alias("c")).select("__row", "c.*")
    end = F.sum(F.col("gap") + F.col("len")).over(Window.partitionBy("__row", "kind").orderBy("at")).cast("long")
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("len"))
    least = F.element_at(F.create_map(*[F.lit(x) for k in KINDS for x in (k, LEAST[k])]), F.col("kind"))
    base = placed.where((F.col("kind") != "token") & (F.col("value") >= least)).select("__row", "start", "end", "kind")
    tokens = placed.where("kind = 'token'").select("__row", "start", "end", "token")
    tested = written(battery(tokens), "tokens")  # else filters on test results are pushed below the tests and repeat them
    extra = discovered(tested, rate).select("__row", "start", "end", F.lit("random").alias("kind"))
    order = F.struct("start", "end", "kind")
    rows = base.union(extra).groupBy("__row").agg(F.collect_list(order).alias("found"))
    kept = F.expr("filter(found, s -> s.kind != 'random' or not exists(found, b -> b.kind != 'random' and b.start < s.end and s.start < b.end))")
    by_start = F.expr("transform(array_sort(transform(kept, s -> struct(s.start as start, array_position(array('assign', 'access', 'hex', 'random'), s.kind) as rank, s.end as end, s.kind as kind))), s -> struct(s.start as start, s.end as end, s.kind as kind))")
    rows = rows.select("__row", kept.alias("kept")).select("__row", by_start.alias("spans"))
    none = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")
    return scanned.drop("__cells").join(rows, "__row", "left").withColumn("spans", F.coalesce("spans", none)).drop("__row")


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """``text`` with each stretch that spans cover replaced by ``mark``; unchanged without spans, null if null."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))
    step = F.aggregate(
        spans, start,
        lambda acc, s: F.struct(
            F.when(s["start"] >= acc["at"], F.concat(acc["done"], F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))).otherwise(acc["done"]).alias("done"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        ),
        lambda acc: F.concat(acc["done"], F.substr(text, (acc["at"] + 1).cast("int"))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(step)
