import base64
import hashlib
import random
import re
import struct
import time

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemill.llm import chat, queries, urlfilter, warc
from tidemill.llm.store import new_path

PAGES = "page_id long, url string, html string"


def pages(spark):
    rows = [(1, "http://a/\r\nX: y%", "<p>é😀</p>"), (2, None, "<p>é😀</p>"), (3, "u", None), (4, "u", ""), (None, "u", "solo"), (5, "u", "z" * 300_000), (6, "u", "z" * 300_000), (6, "u", "z" * 300_000), (7, "u", "a\r\n\r\nb")]
    return spark.createDataFrame(rows, PAGES), rows


def test_warc_round_trip(spark):
    df, rows = pages(spark)
    path = new_path(spark, "t")
    warc.write_archives(warc.revisits(df.withColumns({"payload": F.lit(1), "error": F.lit(2), "record_type": F.lit(3)})), path)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(rows) and not any(r["error"] for r in got)
    best = {}
    for p, _, h in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if p is None else p)
    urls = sorted(str(r["target_uri"]) for r in got)
    assert urls == sorted(str(u) for _, u, _ in rows)
    for p, _, h in rows:
        body = (h or "").encode()
        mine = [r for r in got if r["record_id"] == f"<urn:page:{'null' if p is None else p}>"]
        for r in mine:
            assert r["payload_bytes"] == len(body) and r["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
            first = best[h or ""] in (p, -1)
            assert r["record_type"] == ("response" if first else "revisit") and r["refers_to"] == (None if first else f"<urn:page:{best[h or '']}>")
            assert (bytes(r["payload"]) == body) if first else r["payload"] is None


def test_warc_reader_names_damage(spark, tmp_path):
    good = warc.record_bytes(1, "u", b"abc", base64.b32encode(hashlib.sha1(b"abc").digest()).decode(), 3, None, "2024-01-01T00:00:00Z")
    code = zstandard.ZstdCompressor(write_checksum=True).compress
    shared = zstandard.ZstdCompressionDict(b"WARC/1.1\r\nWARC-Type: response\r\n" * 4, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    lead = struct.pack("<II", warc.DICTIONARY, len(shared.as_bytes())) + shared.as_bytes()
    with_dictionary = zstandard.ZstdCompressor(dict_data=shared).compress(good)
    files = [lead + with_dictionary, code(good), code(good.replace(b"abc", b"abd")), code(good.replace(b"Length: 7", b"Length: 6")), code(good[:-4]), code(good)[:-3], b"junk bytes", b""]
    (tmp_path / "w").mkdir()
    for k, data in enumerate(files):
        (tmp_path / "w" / f"{k}.warc.zst").write_bytes(data)
    got = warc.read_archives(spark, f"file://{tmp_path}/w").collect()
    assert sum(r["error"] is None for r in got) == 3 and len(got) == 7


def test_warc_reads_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2\r\nX-Long: one\r\n two\r\n\r\nbody"
    digest = base64.b32encode(hashlib.sha1(b"body").digest()).decode()

    def record(kind, block, *more):
        return "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{kind}>", "WARC-Date: 2020-01-01T00:00:00Z", *more, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"

    web = "Content-Type: application/http;msgtype=response"
    records = [
        record("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields"), record("request", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http;msgtype=request"),
        record("response", http, web, "WARC-Target-URI: <http://a/%20b>", f"WARC-Payload-Digest: sha1:{digest}"), record("metadata", b""), record("resource", b"\x00\xff", "WARC-Payload-Digest: md5:zz"),
        record("revisit", b"", "WARC-Refers-To: <urn:uuid:response>"), record("response", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Length: 9\r\n\r\n4\r\nbody\r\n0\r\n\r\n", web, f"WARC-Payload-Digest: sha1:{digest}"),
        record("response", http, web, "WARC-Block-Digest: sha1:" + hashlib.sha1(http).hexdigest()), record("response", http, web, "WARC-Payload-Digest: sha1:AAAA"),
    ]
    shared = zstandard.train_dictionary(1 << 12, [x + bytes(f"{k}", "ascii") * 40 for k in range(200) for x in records[:3]])
    held = zstandard.ZstdCompressor().compress(shared.as_bytes())
    lead = struct.pack("<II", warc.DICTIONARY, len(held)) + held
    frames = []
    for k, x in enumerate(records):
        coder = zstandard.ZstdCompressor(dict_data=shared, write_content_size=k % 2 == 0)
        stream = coder.compressobj()
        frames.append(coder.compress(x) if k % 2 == 0 else stream.compress(x) + stream.flush())
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc.zst").write_bytes(lead + b"".join(frames))
    got = warc.read_archives(spark, f"file://{tmp_path}/w").collect()
    assert [r["error"] for r in got] == [None] * 8 + ["payload digest differs"]
    assert [r["record_type"] for r in got[:8]] == ["warcinfo", "request", "response", "metadata", "resource", "revisit", "response", "response"]
    assert (got[2]["target_uri"], bytes(got[2]["payload"]), got[2]["payload_bytes"]) == ("http://a/%20b", b"body", 4) and bytes(got[4]["payload"]) == b"\x00\xff"
    assert got[5]["payload_bytes"] is None and got[5]["refers_to"] == "<urn:uuid:response>"


def test_warc_archives_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 5_000)
    df = spark.range(300, numPartitions=1).selectExpr("id as page_id", "concat('u', id) as url", "concat_ws(' ', transform(sequence(1, 60), k -> md5(concat(id, ':', k)))) as html")
    warc.write_archives(warc.revisits(df), path := new_path(spark, "t"))
    sizes = [r["length"] for r in spark.read.format("binaryFile").load(path).collect()]
    assert len(sizes) > 10 and max(sizes) < 45_000
    got = warc.read_archives(spark, path).collect()
    assert len(got) == 300 and not any(r["error"] for r in got)


def test_warc_empty_and_query(spark):
    path = new_path(spark, "t")
    empty = spark.createDataFrame([], PAGES)
    warc.write_archives(warc.revisits(empty), path)
    assert warc.read_archives(spark, path).count() == 0
    got = queries.op1_warc(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/pages.parquet").count() and got.where("error is not null").count() == 0


GLOBS = ["**.ex.com/*", "*/ads/*", "**.a**.org/x?z*", "*.zip", "**.q", "*" + "ab" * 40 + "*"]


def as_regex(glob):
    out = re.escape(glob).replace(r"\*\*", "[^/]*").replace(r"\*", ".*").replace(r"\?", ".")
    return re.compile(out + r"\Z", re.S)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abexcomqz.orgds/?*", max_size=40), min_size=1, max_size=20))
def test_automaton_equals_regular_expressions(urls):
    urls = [u.encode() for u in urls] + [b".ex.com/", b".www.ex.com/ads/1.zip", b".abc.org/xyz", b".q", b"", b"/" + b"ab" * 40, b".ex.com/" + b"x/ads/" * 300, b".ex.com/" + b"y" * 3000 + b".zip"]
    got = urlfilter.Automaton([urlfilter.glob_pieces(g) for g in GLOBS]).matches(urls)
    for k, glob in enumerate(GLOBS):
        assert got[:, k].tolist() == [bool(as_regex(glob).match(u.decode())) for u in urls], glob


def test_a_url_of_megabytes_is_read_in_time():
    automaton = urlfilter.Automaton([urlfilter.glob_pieces(g) for g in urlfilter.GLOBS])
    urls = [b".ex.com/" + b"abc/" * 500_000 + b"ads/x", b".ex.com/a"]
    began = time.time()
    got = automaton.matches(urls)
    assert time.time() - began < 3 and got[0].sum() == 1 and not got[1].any()


def test_url_rules(spark):
    cases = {
        None: ("", "", None, "allow"), "no scheme org/": ("", "", None, "allow"), "http://EXAMPLE.org": ("example.org", "", None, "allow"), "http://a.example.org/es/x?q": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "x://b.org/fr": ("b.org", "/fr", "org/", "allow"), "h://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"), "h://c.com/de/1#f": ("c.com", "/de/1", "com/de/", "block"), "h://c.com/x/ads/1": ("c.com", "/x/ads/1", None, "block"),
        "h://c.net/a.org/es/": ("c.net", "/a.org/es/", None, "allow"), "://": ("", "", None, "allow"), "h://é.com/fr/ü\n": ("é.com", "/fr/ü\n", "com/fr/", "allow"), "h://example.org/en/10": ("example.org", "/en/10", "example.org/en/1", "block"),
        "h://l.net/" + "a" * 20_000 + ".exe": ("l.net", "/" + "a" * 20_000 + ".exe", None, "block"),
    }
    rows = [(i, u) for i, u in enumerate(cases)] + [(0, None)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit(1), "rule": F.lit(2), "verdict": F.lit(3)})
    got = urlfilter.judged(df, queries.RULES, urlfilter.GLOBS).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == cases[r["url"]], r["url"]
    assert urlfilter.judged(df.limit(0), queries.RULES, urlfilter.GLOBS).count() == 0


def test_rules_are_literal(spark):
    rules = [urlfilter.Rule("block", "é.com", "/ü"), urlfilter.Rule("block", "a.org", "/x*y"), urlfilter.Rule("allow", "a.org", "/?"), urlfilter.Rule("block", "b.org", "/[1] 2")]
    cases = {"h://www.é.com/üx": "é.com/ü", "h://é.com/u": None, "h://a.org/x*y1": "a.org/x*y", "h://a.org/xzy": None, "h://a.org/q": None, "h://b.org/[1] 23": "b.org/[1] 2"}
    df = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string")
    for r in urlfilter.judged(df, rules, ["*/ü*"]).collect():
        assert r["rule"] == cases[r["url"]], r["url"]
        assert r["globs_hit"] == ("ü" in r["url"])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb", "\\n", "[INST]"]), st.text(alphabet="<>|/[]INSTs\\n-im_end a\n", max_size=40) | st.sampled_from(chat.CONTROL)), max_size=6))
def test_escape_is_reversible(turns):
    pattern = re.compile(f"({chat._BEFORE})")
    esc = lambda t: pattern.sub(r"\1\\-", t.replace("\\", "\\\\"))
    text = "".join(f"<|im_start|>{esc(r).replace(chr(10), chr(92) + 'n')}\n{esc(t)}<|im_end|>\n" for r, t in turns)
    assert chat.parsed(text) == turns
    for _, t in turns:
        assert not any(c in esc(t) for c in chat.CONTROL) and chat.unescaped(esc(t)) == t


def test_paths_are_ranked_and_whole(spark):
    edges = [(1, None, 1.0), (2, 1, 5.0), (3, 1, 2.0), (4, 2, None), (5, 3, 9.0), (6, 3, 9.0), (10, 99, 1.0), (20, 21, 1.0), (21, 20, 1.0), (22, 20, 1.0)] + [(100 + i, 99 + i if i else None, 1.0) for i in range(40)]
    nodes = spark.createDataFrame(edges, "node long, parent long, score double")
    got = {}
    for r in chat.paths(nodes).collect():
        got.setdefault((r["leaf"], r["rank"]), []).append((r["depth"], r["node"]))
    order = {k: [n for _, n in sorted(v)] for k, v in got.items()}
    assert order == {(5, 1): [1, 3, 5], (6, 2): [1, 3, 6], (4, 3): [1, 2, 4], (10, 1): [10], (139, 1): list(range(100, 140))}
    assert {r["leaf"] for r in chat.paths(nodes, top=1).collect()} == {5, 10, 139}
    assert chat.paths(nodes.limit(0)).count() == 0


def test_branching_trees_equal_brute_force(spark):
    r = random.Random(11)
    parent, score = {0: None, 1: None}, {}
    for k in range(2, 600):
        parent[k] = r.choice([0] * 3 + [1] + list(range(max(0, k - 40), k)))
    for k in parent:
        score[k] = r.choice([None, 0.0, 0.5, 1.0, 2.0])
    nodes = spark.createDataFrame([(k, parent[k], score[k]) for k in parent], "node long, parent long, score double").repartition(5)
    leaves = sorted(set(parent) - set(parent.values()))

    def up(k):
        return [] if k is None else [*up(parent[k]), k]

    ranks, by_root = {}, {}
    for leaf in leaves:
        by_root.setdefault(up(leaf)[0], []).append((-sum(score[x] or 0.0 for x in up(leaf)), leaf))
    for each in by_root.values():
        ranks |= {leaf: n for n, (_, leaf) in enumerate(sorted(each), 1)}
    for top in (None, 3):
        got = {}
        for x in chat.paths(nodes, top).collect():
            got.setdefault((x["leaf"], x["rank"], x["path_score"]), []).append((x["depth"], x["node"]))
        want = {(leaf, ranks[leaf], sum(score[x] or 0.0 for x in up(leaf))): up(leaf) for leaf in leaves if top is None or ranks[leaf] <= top}
        assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == want


def test_one_conversation_of_very_many_turns(spark):
    rows = spark.range(100_000, numPartitions=6).selectExpr("if(id % 50 = 0, id % 7, null) as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('t', id) as text")
    nodes = chat.threads(rows.repartition(6, "text"))
    linked = nodes.alias("a").join(nodes.alias("b"), F.col("a.parent") == F.col("b.node"))
    assert nodes.where("parent is null").count() == 8 and linked.count() == 100_000 - 8
    gaps = linked.where("a.conv_id is null and b.conv_id is null").select((F.col("a.turn") - F.col("b.turn")).alias("gap")).groupBy("gap").count().collect()
    assert {x["gap"]: x["count"] for x in gaps} == {1: 96_000, 2: 1_999}


def test_chat_with_clashing_columns_and_long_texts(spark):
    long = "<s> [INST] \\ " * 40_000
    rows = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", long), (2, 0, "assistant", None), (2, 1, "user", "")], "conv_id long, turn long, role string, text string")
    clash = {c: F.lit(9) for c in ("far", "root", "depth", "total", "rank", "leaf", "path_score", "parent", "start", "head", "body")}
    nodes = chat.threads(rows.withColumns(clash)).withColumns({"score": F.lit(1.0)})
    turns = chat.paths(nodes).join(nodes.select("node", "role", "text"), "node").withColumns({c: F.lit(9) for c in ("head", "body", "start", "n_turns")})
    chats = chat.formatted(turns).join(nodes.select(F.col("node").alias("leaf"), "conv_id"), "leaf").withColumn("loss_chars", F.lit(3))
    got = {r["conv_id"]: r for r in chat.read_back(chats, "conv_id").collect()}
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (2, len(long), hashlib.sha256(long.encode()).hexdigest()) and (got[2]["n_turns"], got[2]["loss_chars"]) == (2, 0)


def test_chat_query(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    whole = {-1: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"])):
        whole.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    got = queries.op6_chat(spark, SF).collect()
    assert len(got) == len(whole)
    for r in got:
        turns = whole[r["conv_id"]]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_threads_with_null_keys_and_ties(spark):
    rows = spark.createDataFrame([(None, 1, "user", "a"), (None, 1, "user", "a"), (1, None, None, None), (1, 2, "assistant", "x")], "conv_id long, turn long, role string, text string")
    nodes = chat.threads(rows).withColumn("score", F.lit(None).cast("double"))
    turns = chat.paths(nodes).join(nodes.select("node", "role", "text"), "node")
    got = chat.read_back(chat.formatted(turns).join(nodes.select(F.col("node").alias("leaf"), "conv_id"), "leaf"), "conv_id").collect()
    assert sorted((r["conv_id"] or 0, r["n_turns"], r["loss_chars"]) for r in got) == [(0, 2, 0), (1, 2, 1)]


def test_bad_frames_raise():
    with pytest.raises(ValueError):
        list(warc.frames_of(memoryview(b"\x50\x2a")))
