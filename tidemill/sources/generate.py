"""Synthetic metric and log rows from a range of numbers; every value follows from the row number and a seed, by MD5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.spec import TableSpec, field, tag, timestamp

#: Sizes of the tag spaces, and the first instant.
REGIONS, DATACENTERS, SERVICES = 5, 10, 20
BEGIN_MS = 1_704_067_200_000
#: What logs pick from.
LOG_SERVICES = ("orders", "stock", "mail", "login", "quotes", "maps")
LOG_REGIONS = ("coast", "delta", "harbor", "ridge")
LOG_ENVS = ("live", "trial", "drill", "lab")
LOG_LEVELS = ("DEBUG", "INFO", "WARN", "ERROR")
METHODS = ("GET", "HEAD", "POST", "PATCH")
AGENTS = ("agent-a", "agent-b", "agent-c", "agent-d", "agent-e")
CLASSES = ("2xx", "3xx", "4xx", "5xx")

CPU = TableSpec("cpu", (tag("host"), tag("region"), tag("datacenter"), tag("service"), *(field(n, "Float64") for n in ("cpu", "memory", "disk_util", "net_in", "net_out")), timestamp("ts")))


def _digest(i: Column, salt: int) -> Column:
    return F.md5(F.concat(F.lit(f"{salt}:"), i.cast("string")))


def _number(digest: Column, place: int, width: int = 4) -> Column:
    """``width`` hex digits of a digest as a number; ``place`` counts such groups from 0."""
    return F.conv(F.substring(digest, place * width + 1, width), 16, 10).cast("long")


def _pick(number: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def cpu_rows(numbers: DataFrame, hosts: int, number: str = "id", seed: int = 1) -> DataFrame:
    """A metric row per row number: tags by mixed radix over host, region, datacenter and service, a millisecond apart."""
    if hosts < 1:
        raise ValueError("hosts must be at least 1")
    i = F.col(number).cast("long")
    series = F.pmod(i, F.lit(hosts * REGIONS * DATACENTERS * SERVICES))
    host, rest = F.pmod(series, F.lit(hosts)), F.floor(series / hosts)
    region, rest = F.pmod(rest, F.lit(REGIONS)), F.floor(rest / REGIONS)
    center, service = F.pmod(rest, F.lit(DATACENTERS)), F.floor(rest / DATACENTERS)
    first = _digest(i, seed)
    measures = [(_number(first, k, 6) / float(1 << 24) * size).alias(n) for k, (n, size) in enumerate((("cpu", 100.0), ("memory", 100.0), ("disk_util", 100.0), ("net_in", 1e9), ("net_out", 1e9)))]
    tags = [F.concat(F.lit("host-"), host.cast("string")), F.concat(F.lit("region-"), region.cast("string")), F.concat(F.lit("dc-"), center.cast("string")), F.concat(F.lit("svc-"), F.lpad(service.cast("string"), 2, "0"))]
    named = [t.alias(n) for t, n in zip(tags, ("host", "region", "datacenter", "service"), strict=True)]
    return numbers.select(*named, *measures, F.timestamp_millis(F.lit(BEGIN_MS) + i).alias("ts"))


LOG = TableSpec("log", (
    *(tag(n) for n in ("service", "host", "region", "env")), *(field(n, "String") for n in ("pod", "log_level", "message", "trace_id", "span_id", "http_method", "http_path", "http_status_class", "user_agent", "client_ip", "caller")),
    field("latency_ms", "Float64"), field("bytes_in", "Int64"), field("bytes_out", "Int64"), field("error_flag", "Bool"), field("retry_flag", "Bool"), timestamp("log_ts"), field("ingest_ts", "Int64"),
))


def log_rows(numbers: DataFrame, number: str = "id", seed: int = 2) -> DataFrame:
    """A log row of 22 columns per row number."""
    i = F.col(number).cast("long")
    rows = numbers.select(i.alias("i"), _digest(i, seed).alias("a"), _digest(i, seed + 1).alias("b"))
    n = {name: _number(F.col("a" if k < 8 else "b"), k % 8) for k, name in enumerate(("service", "host", "region", "env", "pod", "level", "method", "class", "agent", "caller", "latency", "in", "out", "retry"))}
    i, level = F.col("i"), _pick(n["level"], LOG_LEVELS)
    made = {
        "service": _pick(n["service"], LOG_SERVICES), "host": F.concat(F.lit("host-"), (n["host"] % 32).cast("string")), "region": _pick(n["region"], LOG_REGIONS), "env": _pick(n["env"], LOG_ENVS),
        "pod": F.concat(F.lit("pod-"), (n["pod"] % 64).cast("string")), "log_level": level, "message": F.concat(F.lit("request "), i.cast("string"), F.lit(" handled")),
        "trace_id": F.col("a"), "span_id": F.substring("b", 1, 16), "http_method": _pick(n["method"], METHODS), "http_path": F.concat(F.lit("/api/v1/items/"), (i % 1000).cast("string")),
        "http_status_class": _pick(n["class"], CLASSES), "user_agent": _pick(n["agent"], AGENTS), "client_ip": F.concat(F.lit("10.0."), (i % 256).cast("string"), F.lit("."), (F.floor(i / 256) % 256).cast("string")),
        "caller": F.concat(F.lit("caller-"), (n["caller"] % 16).cast("string")), "latency_ms": n["latency"] / 65536.0 * 200, "bytes_in": n["in"] % 10_000, "bytes_out": n["out"],
        "error_flag": level == "ERROR", "retry_flag": n["retry"] < 3277, "log_ts": F.timestamp_millis(F.lit(BEGIN_MS) + i), "ingest_ts": F.lit(BEGIN_MS) + i,
    }
    return rows.select(*[c.alias(name) for name, c in made.items()])
