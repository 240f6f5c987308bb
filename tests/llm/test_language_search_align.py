import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.data import edge_docs, empty_docs, prose
from tidemill.llm import align, langid, lexical, queries
from tidemill.llm import text as T

LANGS = {
    "en": "the of and to in is it was for on are with this that thing making other there",
    "de": "der die und das nicht ist ein eine mit sich auch werden schon über zwischen gegen",
    "ru": "и в не на что он как это все она так его только было",
}


def said(lang, n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(LANGS[lang].split()) for _ in range(n))


# Language


def plain_path(scores, prior):
    """The best path by dynamic programming over one text, word by word."""
    states, back = np.maximum(prior, prior.max() - langid.PENALTY) + scores[0], []
    for row in scores[1:]:
        change = states.max() - langid.PENALTY
        back.append([int(np.argmax(states)) if change > states[k] else k for k in range(len(row))])
        states = np.maximum(states, change) + row
    out = [int(np.argmax(states))]
    for step in reversed(back):
        out.append(step[out[-1]])
    return out[::-1]


def test_path_is_the_best_one_across_pieces(monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 7)
    r = np.random.default_rng(3)
    sizes = [0, 1, 5, 7, 8, 40, 0, 23]
    first = np.concatenate([[0], np.cumsum(sizes)])
    scores, prior = r.normal(0, 9, (first[-1], 3)), np.array([0.0, -1.0, -2.0])
    got = langid.path(scores, first, prior)
    for b, e in zip(first[:-1], first[1:], strict=True):
        if e > b:
            assert got[b:e].tolist() == plain_path(scores[b:e], prior)


def test_words_are_runs_of_one_script():
    texts = ["abc ДЕЖ,漢字kana", "", "Épée 12 x1y", "ไทย"]
    at, data, bounds = next(T.chunks(pa.array(texts)))
    found = langid.words(data, bounds)
    raw = data.tobytes()
    assert [raw[b:e].decode() for b, e in zip(found.start, found.end, strict=True)] == ["abc", "ДЕЖ", "漢字", "kana", "Épée", "x", "y", "ไทย"]
    assert found.letters.tolist() == [3, 3, 2, 4, 4, 1, 1, 3] and np.diff(found.first).tolist() == [4, 0, 3, 1]
    assert found.low[found.start[4] : found.end[4]].tobytes().decode() == "épée"


@pytest.fixture(scope="module")
def model(spark):
    rows = [(k, said(lang, 60, k), lang) for k, lang in enumerate(["en", "de", "ru"] * 4)] + [(99, "nothing to learn", None), (98, None, "en")]
    return langid.trained(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_spans_of_mixed_text(spark, model):
    assert model.names == ["de", "en", "ru"]
    parts = [said("en", 30, 51), said("de", 50, 52), said("ru", 10, 53)]
    text = ". ".join(parts)
    rows = [(1, text), (1, text), (2, None), (3, ""), (4, "12 34 !? 😀"), (None, parts[0]), (5, parts[2]), (6, said("de", 9_000, 54)), (7, "Ꭰ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang_pred", F.lit("x")).withColumn("spans", F.lit(1))
    got = [(r.doc_id, r.lang_pred, r.score, [tuple(s) for s in r.spans]) for r in langid.identified(docs, model).collect()]
    assert got[0] == got[1] and len(got) == len(rows)
    _, lang, score, spans = got[0]
    assert [s[2] for s in spans] == ["en", "de", "ru"] and lang == "de" and 0 < score < 1
    assert [text[b:e] for b, e, _ in spans] == parts
    by = {(r[0], n): r for n, r in enumerate(got)}
    assert [by[k, n][1] for k, n in ((2, 2), (3, 3), (4, 4))] == ["und"] * 3 and by[2, 2][2:] == (0.0, [])
    assert by[None, 5][1] == "en" and by[5, 6][1] == "ru" and by[6, 7][1] == "de" and by[6, 7][2] > 0.99
    assert by[7, 8][1] in model.names and by[7, 8][2] == 0.0


def test_script_narrows_candidates(model):
    at, data, bounds = next(T.chunks(pa.array(["бвгд the"])))
    scores = langid.word_scores(langid.words(data, bounds), model)
    assert np.argmax(scores[0]) == 2 and scores[0][2] - scores[0][0] > langid.FOREIGN - 25 and np.argmax(scores[1]) == 1


def test_nothing_learned(spark):
    none = langid.trained(empty_docs(spark))
    assert none.names == [] and {r.lang_pred for r in langid.identified(edge_docs(spark), none).collect()} == {"und"}
    assert langid.identified(empty_docs(spark), none).count() == 0


def test_language_query_on_held_out_rows(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op11_language(spark, SF).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in rows)


# Search


def plain_terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain_search(docs, items, k):
    cut = [(key, Counter(w), len(w)) for key, text in docs for w in [plain_terms(text)] if w]
    n, total, df = len(cut), sum(x[2] for x in cut), Counter(t for _, c, _ in cut for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, counts, size in cut:
            m = 75 + 25 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m)) for t in plain_terms(text) if counts[t])
            if s > 0:
                scores.append((-s, key is None, key or 0))
        out += [(item, rank, None if null else key, -s) for rank, (s, null, key) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def test_search_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SLICE", 3000)
    monkeypatch.setattr(lexical, "BLOCK", 2)
    rows = [(r.doc_id, r.text) for r in edge_docs(spark).collect()] + [(100 + k, prose(20 + k % 7 * 9, k % 40)) for k in range(150)] + [(None, prose(20, 3))]
    items = [(1, prose(25, 5)), (1, prose(25, 5)), (None, "the THE the, of!"), (2, None), (3, ""), (4, "nowhere_at_all"), (5, prose(39, 1)), (6, "漢字 é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("id", F.lit(3)).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0))
    for terms in (200_000, 20):
        monkeypatch.setattr(lexical, "BATCH_TERMS", terms)
        got = [tuple(r) for r in lexical.ranked(docs, asked, k=7).collect()]
        assert sorted(got, key=repr) == plain_search(rows, items, 7)
    assert lexical.ranked(empty_docs(spark), asked).count() == 0 and lexical.ranked(docs, empty_docs(spark), item_key="doc_id").count() == 0


def test_search_by_text_keys(spark):
    docs = spark.createDataFrame([("b", "red fox"), ("a", "red fox"), ("c", "blue")], "doc_id string, text string").repartition(6)
    items = spark.createDataFrame([("q", "fox")], "item_id string, text string")
    assert [tuple(r)[:3] for r in lexical.ranked(docs, items).orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b")]


def test_nra_stops_at_resolved_scores_and_keeps_ties():
    r = np.random.default_rng(1)
    for trial in range(60):
        n, lists, k = 90, 5, 4
        parts = [np.sort(r.choice(n, r.integers(0, n), replace=False)) for _ in range(lists)]
        values = [np.sort(r.integers(1, 6 if trial % 2 else 1000, len(p)))[::-1] for p in parts]
        parts = [r.permutation(p) for p in parts]
        end = np.cumsum([len(p) for p in parts])
        begin, doc, impact, scale = end - [len(p) for p in parts], np.concatenate(parts), np.concatenate(values), r.integers(0, 5, lists)
        exact = np.zeros(n, np.int64)
        for p, v, s in zip(parts, values, scale, strict=True):
            exact[p] += v * s
        for floor in (0, int(np.sort(exact)[-2])):
            got = dict(zip(*(x.tolist() for x in lexical.nra(begin, end, scale, doc, impact, n, k, floor)), strict=True))
            least = max(1, floor, int(np.sort(exact)[-k]))
            assert got == {d: s for d, s in enumerate(exact.tolist()) if s >= least}


def test_search_query_against_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    want = con.execute(queries.ORACLE_SQL["op12_search"]).fetchall()
    assert sorted(tuple(r) for r in queries.op12_search(spark, SF).collect()) == sorted(want)


# Alignment


@pytest.fixture(scope="module")
def known():
    return align.vocabularies()


def plain_alignment(known, encoder, rows):
    """Whole texts encoded one by one; cuts by set intersection."""
    each = []
    for _, text in rows:
        groups, links, n = [], [], (0, 0)
        if text:
            sides = encoder.a.encode(" " + text, add_special_tokens=False).ids, encoder.b.encode(text)
            raw = [[(names[i] or b"") for i in ids] for names, ids in zip((known.a_bytes, known.b_bytes), sides, strict=True)]
            if all(b"".join(x) == (" " + text).encode() for x in raw):
                n = tuple(map(len, sides))
                ends = [np.cumsum([len(x) for x in side]).tolist() for side in raw]
                at = [0, 0]
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    to = [e.index(cut) + 1 for e in ends]
                    groups.append("|".join(",".join(map(str, side[b:e])) for side, b, e in zip(sides, at, to, strict=True)))
                    links.append((sides[0][to[0] - 1], sides[1][to[1] - 1]))
                    at = to
        each.append((n, groups, links))
    counts = Counter(x for _, _, links in each for x in links)
    most = {}
    for (_, b), c in counts.items():
        most[b] = max(most.get(b, 0), c)
    digest = lambda groups: hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
    return sorted(((key, *n, len(g), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest(g)) for (key, _), (n, g, links) in zip(rows, each, strict=True)), key=repr)


def test_alignment_against_whole_texts(spark, known, monkeypatch):
    monkeypatch.setattr(align, "SLICE", 4000)
    r = random.Random(7)
    marks = ["a", "b", " ", "  ", "\n", "\t", "é", "漢字", "😀", "▁", " ", "　", "<s>", "</s>", "<|endoftext|>", "'s", "the", "ing", "23", "!", "...", "\x00", "\xa0", "́", "ß", "Ж", "don't", " x"]
    rows = [(k, "".join(r.choice(marks) for _ in range(r.randrange(30)))) for k in range(200)]
    rows += [(x.doc_id, x.text) for x in edge_docs(spark).collect() if x.doc_id != 8] + [(8, prose(2500, 3)), (300, "x" * 3000), (301, " "), (302, "a▁b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_a", F.lit("x")).withColumn("id", F.lit(3)).repartition(3)
    got = align.aligned(docs, known=known)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(x) for x in got.collect()), key=repr) == plain_alignment(known, align.Encoder(known), rows)
    assert align.aligned(empty_docs(spark), known=known).count() == 0


def test_alignment_without_shortcuts(spark, known, monkeypatch):
    rows = [(k, prose(200, k)) for k in range(4)]
    whole = known._replace(cut=False, ranked=False)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(x) for x in align.aligned(docs, known=whole).collect()) == plain_alignment(known, align.Encoder(whole), rows)


def test_shared_cuts_by_halves():
    r = np.random.default_rng(2)
    for rate in (0.02, 0.3, 0.9):
        sides, firsts = ([], []), ([0], [0])
        base = 0
        for _ in range(30):
            n = int(r.integers(1, 300))
            for ends, first in zip(sides, firsts, strict=True):
                own = np.append(np.flatnonzero(r.random(n) < rate) + 1, n)
                ends.append(base + np.unique(own))
                first.append(first[-1] + len(ends[-1]))
            base += n
        a, b = map(np.concatenate, sides)
        at, to = align.shared_cuts(a, b, *map(np.array, firsts))
        both, i, j = np.intersect1d(a, b, return_indices=True)
        assert at.tolist() == i.tolist() and to.tolist() == j.tolist()


def test_possible_pairs_hold_every_suffix():
    got = align.suffix_pairs([b"ab", b"b", None, b""], [b"b", b"xab", b"c", b"ab"])
    assert got.tolist() == [0, 1, 3, 4, 5, 7]


def test_alignment_query_covers_every_row(spark):
    got = queries.op13_alignment(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count() and got.where("n_a = 0 and groups_sha256 != ''").isEmpty()
