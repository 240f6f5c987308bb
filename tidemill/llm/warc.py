"""Zstandard WARC archives: one frame per record, and the dictionary in a leading skippable frame.

Archives are written by Spark's own file writer, so they land in any file
system that Spark reaches and survive lost executors: a row is an archive of
bounded size in a file of its own, and what the writer puts after it is an
empty skippable frame, which every Zstandard reader passes over.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import small, written

#: Magic numbers of a data frame, of skippable frames (the last four bits vary) and of the frame that holds a dictionary.
FRAME, SKIPPABLE, DICTIONARY = 0xFD2FB528, 0x184D2A50, 0x184D2A5D
BETWEEN = struct.pack("<II", SKIPPABLE, 0).decode("ascii")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A dictionary is made from so many bytes of an archive's first records at most, and has so many.
SAMPLE_BYTES, DICTIONARY_BYTES = 1 << 20, 1 << 15
#: An archive ends with the record that makes it longer than this.
ARCHIVE_BYTES = 1 << 25

RECORD = "record_id string, record_type string, target_uri string, payload_digest string, payload_bytes long, refers_to string, payload binary, error string"


def base32_digest(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a string's UTF-8 or of bytes."""
    hex_digits = F.sha1(payload.cast("binary"))
    letters, out = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), []
    for k in range(8):
        bits = F.conv(F.substring(hex_digits, 5 * k + 1, 5), 16, 10).cast("int")
        out += [F.substr(letters, F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def revisits(pages: DataFrame, key: str = "page_id", payload: str = "html", least: int = 0) -> DataFrame:
    """``pages`` with ``payload, payload_digest, payload_bytes, record_type, refers_to``.

    Of rows with equal payloads of at least ``least`` bytes, those with the
    largest key are responses and the others revisit it; all other rows are
    responses. A null payload is empty. Null keys are below all others. A row
    that repeats the response's key and payload is a response as well. Keys
    per payload are compared before the join, which reads one row per shared
    payload: as a broadcast if those, counted here, are few.
    """
    pages = pages.withColumn("payload", F.coalesce(F.col(payload), F.lit("")).cast("binary"))
    pages = pages.withColumns({"payload_digest": base32_digest(F.col("payload")), "payload_bytes": F.octet_length("payload").cast("long")})
    shared = pages.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.max(key).alias("__kept"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    joined = pages.join(small(written(shared, "shared")), "payload_digest", "left")
    again = F.col("__kept").isNotNull() & ~F.col("__kept").eqNullSafe(F.col(key)) & (F.col("payload_bytes") >= least)
    return joined.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn("refers_to", F.when(again, F.col("__kept"))).drop("__kept")


def _urn(key: object) -> str:
    return f"<urn:page:{'null' if key is None else key}>"


def _line(value: str) -> str:
    """A header value on one line: controls and percent signs as percent codes."""
    return "".join(f"%{ord(c):02X}" if c < " " or c in "%\x7f" else c for c in value)


def _unline(value: str) -> str:
    parts = value.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def record_bytes(key: object, url: str | None, payload: bytes, digest: str, size: int, refers_to: object, date: str) -> bytes:
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block += b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(key)}", f"WARC-Date: {date}"]
    head += [] if url is None else [f"WARC-Target-URI: {_line(url)}"]
    head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"] if revisit else []
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on ``samples``; where they are too few to train on, their own beginning."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES].ljust(8, b" "), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archives(records: DataFrame, path: str, key: str = "page_id", url: str = "url", date: str = "2024-01-01T00:00:00Z", level: int = 3) -> None:
    """Archives in ``path``, at least one per partition of ``records`` (rows of ``revisits``) that has any, one record per frame.

    An archive's dictionary comes from its own first records, up to
    ``SAMPLE_BYTES``. A task holds one archive, of ``ARCHIVE_BYTES`` and one
    record at most, and the slice of rows that it reads.
    """
    columns = records.select(key, F.col(url).alias("url"), F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload")).alias("payload"), "payload_digest", "payload_bytes", "refers_to")

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        done: list[bytes] = []
        coder, size, sample = None, 0, 0

        def begun() -> zstandard.ZstdCompressor:
            shared = dictionary([x[: 1 << 14] for x in held])
            data = shared.as_bytes()
            coder = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True, write_content_size=True)
            done.extend([struct.pack("<II", DICTIONARY, len(data)) + data, *map(coder.compress, held)])
            held.clear()
            return coder

        def ended() -> pa.RecordBatch:
            whole = pa.RecordBatch.from_arrays([pa.array([b"".join(done)], pa.binary())], names=["archive"])
            done.clear()
            return whole

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True):
                    record = record_bytes(*row, date)
                    if coder:
                        done.append(coder.compress(record))
                    else:
                        held.append(record)
                        sample += len(record)
                        coder = begun() if sample >= SAMPLE_BYTES else None
                    size += len(done[-1]) if coder else 0
                    if size > ARCHIVE_BYTES:
                        yield ended()
                        coder, size, sample = None, 0, 0
        if held:
            begun()
        if done:
            yield ended()

    whole = columns.mapInArrow(archives, "archive binary").select(F.col("archive").cast("string"))
    whole.write.option("lineSep", BETWEEN).option("maxRecordsPerFile", 1).text(path)


def frame_end(data: memoryview, at: int) -> int:
    """Where the data frame that begins at ``at`` ends, from its block sizes."""
    checksum = data[at + 4] >> 2 & 1
    at += zstandard.frame_header_size(data[at : at + 18])
    last = 0
    while not last:
        head = int.from_bytes(data[at : at + 3], "little")
        last, kind = head & 1, head >> 1 & 3
        at += 3 + (1 if kind == 1 else head >> 3)
    return at + 4 * checksum


def frames_of(data: memoryview) -> Iterator[tuple[int, memoryview]]:
    """(magic, content of a skippable frame or whole data frame), in order; ValueError where one is cut short."""
    at = 0
    while at < len(data):
        if at + 8 > len(data):
            raise ValueError("a frame header is cut short")
        magic, size = struct.unpack_from("<II", data, at)
        if magic & ~0xF == SKIPPABLE:
            end, content = at + 8 + size, data[at + 8 : at + 8 + size]
        elif magic == FRAME:
            end = frame_end(data, at)
            content = data[at:end]
        else:
            raise ValueError(f"no frame begins at byte {at}")
        if end > len(data):
            raise ValueError("a frame is cut short")
        yield magic, content
        at = end


def _headers(lines: list[bytes]) -> dict[str, str]:
    """Header fields by name in lower case; lines that begin with a blank go on with the last, and repeated ones are joined by commas."""
    out: dict[str, str] = {}
    last = ""
    for line in lines:
        text = line.decode("utf-8", "replace")
        name, colon, value = text.partition(":")
        if text[:1] in (" ", "\t") and last:
            out[last] += " " + text.strip()
            continue
        if not colon or not name.strip():
            raise ValueError(f"bad header: {name[:40]}")
        last = name.strip().lower()
        out[last] = f"{out[last]}, {value.strip()}" if last in out else value.strip()
    return out


def _whole(text: str, what: str) -> int:
    if not (text.isascii() and text.isdigit()):
        raise ValueError(f"{what} is not a number: {text[:40]}")
    return int(text)


def _same_digest(given: str, data: bytes) -> bool:
    """Whether a SHA-1 in base32 or hex is that of ``data``; other algorithms are not checked."""
    name, _, value = given.partition(":")
    if name.lower() != "sha1":
        return True
    found = hashlib.sha1(data)
    return value.upper() in (base64.b32encode(found.digest()).decode(), found.hexdigest().upper())


def parsed(record: bytes) -> dict[str, object]:
    """One record's fields, of any type; ValueError where a header, a length or a digest is wrong.

    The payload of an HTTP response is what follows its headers; of other
    records, the block. A revisit has none, and its length is what its HTTP
    headers say, null if nothing.
    """
    head, blank, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not blank or first not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("no WARC header")
    fields = _headers(lines)
    if missing := {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys():
        raise ValueError(f"missing {min(missing)}")
    size = _whole(fields["content-length"], "content-length")
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("content-length differs from the block")
    kind, payload, length = fields["warc-type"].lower(), rest[:size], None
    if not _same_digest(fields.get("warc-block-digest", ""), payload):
        raise ValueError("block digest differs")
    if kind in ("response", "revisit") and fields.get("content-type", "").lower().startswith("application/http"):
        http, blank, payload = payload.partition(b"\r\n\r\n")
        if not blank:
            raise ValueError("no HTTP header in the block")
        said = _headers(http.split(b"\r\n")[1:])
        coded = "transfer-encoding" in said
        if "content-length" in said and not coded:
            length = _whole(said["content-length"].partition(",")[0], "HTTP content-length")
        if kind == "response" and "warc-truncated" not in fields:
            if length is not None and len(payload) != length:
                raise ValueError("HTTP content-length differs from the payload")
            if not coded and not _same_digest(fields.get("warc-payload-digest", ""), payload):
                raise ValueError("payload digest differs")
    if kind == "revisit" and payload:
        raise ValueError("a revisit has a payload")
    uri, refers = fields.get("warc-target-uri"), fields.get("warc-refers-to")
    if uri is not None:
        uri = _unline(uri) if fields["warc-record-id"].startswith("<urn:page:") else uri.removeprefix("<").removesuffix(">")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    return {"record_id": fields["warc-record-id"], "record_type": kind, "target_uri": uri, "payload_digest": digest, "payload_bytes": length if kind == "revisit" else len(payload), "refers_to": refers, "payload": None if kind == "revisit" else payload, "error": None}


def _decoded(decoder: zstandard.ZstdDecompressor, frame: memoryview) -> bytes:
    """A frame's content; a streaming writer leaves its size out of the header."""
    if zstandard.frame_content_size(frame) >= 0:
        return decoder.decompress(frame)
    stream = decoder.decompressobj()
    out = stream.decompress(frame)
    if not stream.eof:
        raise ValueError("a frame is cut short")
    return out


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Every record of the archives in ``path``, a row each; with ``error`` set where it can't be read.

    A task holds one archive in its compressed form (2 GB at most, which is
    Spark's limit for a value) and decodes one frame at a time. The leading
    dictionary may be compressed itself. Records of all types are rows. A frame
    that isn't a valid record gives a row with ``error``; after a damaged frame
    boundary the rest of that archive is one such row.
    """
    kind = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in RECORD.split(", "))])
    blank = dict.fromkeys(kind.names)

    def records(data: memoryview) -> Iterator[dict[str, object]]:
        decoder = None
        try:
            for k, (magic, content) in enumerate(frames_of(data)):
                if magic == DICTIONARY and k == 0:
                    raw = bytes(content)
                    raw = _decoded(zstandard.ZstdDecompressor(), memoryview(raw)) if raw[:4] == struct.pack("<I", FRAME) else raw
                    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
                elif magic == FRAME:
                    decoder = decoder or zstandard.ZstdDecompressor()
                    try:
                        yield parsed(_decoded(decoder, content)) | ({} if payload else {"payload": None})
                    except (ValueError, KeyError, zstandard.ZstdError) as wrong:
                        yield blank | {"error": str(wrong) or type(wrong).__name__}
        except (ValueError, zstandard.ZstdError) as wrong:
            yield blank | {"error": str(wrong)}

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch["content"]:
                held, size = [], 0
                for record in records(memoryview(row.as_buffer())):
                    held.append(record)
                    size += 500 + len(record["payload"] or b"")
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(held, schema=kind)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=kind)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(decode, RECORD)


def urn_key(urn: Column) -> Column:
    """The key in a record id that ``write_archives`` gave; null for a null key."""
    return F.regexp_extract(urn, "^<urn:page:(.*)>$", 1).try_cast("long")
