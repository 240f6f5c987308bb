import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF
from tests.llm.data import DOCS, edge_docs, empty_docs, prose
from tidemill.llm import ann, decontam, ngram_join, quality, queries, text, toxicity
from tidemill.llm.store import written

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
MARKED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aAbZ09 \t\n\x0b.-éß😀", max_size=30), max_size=8), st.sampled_from([(text.SPACES, SPACED), (text.MARKS, MARKED)]), st.integers(1, 40))
def test_words_equal_regular_expressions(texts, kind, limit):
    between, pattern = kind
    seen = {}
    for at, data, bounds in text.chunks(pa.array(texts, pa.string()), limit):
        found = text.words(data, bounds, between)
        for k in range(len(bounds) - 1):
            words = pattern.findall((texts[at + k] or "").translate(LOWER))
            hashes = found.hash[found.first[k] : found.first[k + 1]].tolist()
            assert len(words) == len(hashes)
            for w, h in zip(words, hashes, strict=True):
                assert seen.setdefault(w, h) == h
            plain, begin, end = found.joined()
            mine = slice(found.first[k], found.first[k + 1])
            assert [plain[b:e].tobytes().decode() for b, e in zip(begin[mine], end[mine], strict=True)] == words
            assert not words or plain[begin[mine][0] : end[mine][-1]].tobytes().decode() == " ".join(words)
            assert dict(zip((w.encode()[:4] for w in words), found.prefixes(4)[mine].tolist(), strict=True)).keys() == {w.encode()[:4] for w in words}
    assert len(set(seen.values())) == len(seen)


def shingle_set(t, k=4):
    w = SPACED.findall((t or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def near_copies(n, base, seed, words):
    out = []
    for i in range(n):
        w = prose(words, base).split()
        for j in range((seed * 7 + i * 5) % (words // 12)):
            w[(i * 31 + j * 17) % words] = f"edit{i}x{j}"
        out.append(" ".join(w))
    return out


def thue_morse(n, first):
    """A word on which sums of powers of any odd base agree, modulo 2^64, with those of its complement."""
    return "".join("ab"[(i.bit_count() + first) % 2] for i in range(n))


def test_components_equal_brute_force(spark):
    texts = near_copies(60, 1, 1, 120) + near_copies(40, 2, 2, 60) + [prose(80, 50 + i) for i in range(20)] + ["same words here"] * 5 + ["Same  WORDS here"]
    texts += [" ".join([*prose(40, 90).split(), thue_morse(2048, k), *prose(40, 91).split()]) for k in (0, 1)] + [thue_morse(1024, k) for k in (0, 1)]
    rows = [(1000 - i, t, None, None, None) for i, t in enumerate(texts)]
    docs = edge_docs(spark).union(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    docs = docs.withColumns({"row": F.lit(1), "token": F.lit(2), "n": F.lit(3), "label": F.lit(4)})
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        same = len(sets[a] & sets[b])
        if same and 100 * same >= 85 * (len(sets[a]) + len(sets[b]) - same):
            parent[find(b)] = find(a)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), math.inf), math.inf if d is None else d)
    expected = Counter((d, len(sets[i]), None if least[find(i)] == math.inf else least[find(i)]) for i, (d, _) in enumerate(rows))
    got = ngram_join.components(docs)
    assert Counter(map(tuple, got.collect())) == expected
    assert ngram_join.components(empty_docs(spark)).count() == 0


def test_parts_lose_no_link(spark):
    texts = [t for base in range(4) for t in near_copies(25, base, base + 1, 60 + 30 * base)] + [prose(n, 300 + n) for n in range(1, 30)] + [prose(n, 1) for n in range(55, 75)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    join = ngram_join.Join(docs, "doc_id", "text", 4, 85)
    rows = join.rows.where("n > 0").select("row", "n", F.col("row").alias("label"), F.lit(0).alias("at"), F.lit(7).cast("long").alias("token"))
    number = {x["row"]: x["id"] for x in join.rows.collect()}
    met = {tuple(sorted((number[x["a"]], number[x["b"]]))) for x in join.met(join.alike_in_part(rows), ["token", "sum"]).collect()}
    sets = [shingle_set(t) for t in texts]
    links = {(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if 100 * (same := len(sets[a] & sets[b])) >= 85 * (len(sets[a]) + len(sets[b]) - same)}
    assert len(links) > 200 and links <= met and len(met) < len(texts) ** 2 / 4
    a, b = zip(*sorted(met), strict=True)
    got = ngram_join.shared_words(pa.array([" ".join(SPACED.findall(texts[i].lower())).encode() for i in a]), pa.array([" ".join(SPACED.findall(texts[i].lower())).encode() for i in b]), 4, 85)
    assert {p for p, linked in zip(sorted(met), got.tolist(), strict=True) if linked} == links


def test_common_tokens_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FEW", 3)
    shared = prose(30, 5)
    texts = [shared + " " + t for base in range(8) for t in near_copies(6, base, base + 1, 40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    few = {r["doc_id"]: r["component_id"] for r in ngram_join.components(docs, percent=60).collect()}
    monkeypatch.setattr(ngram_join, "FEW", 10_000)
    assert few == {r["doc_id"]: r["component_id"] for r in ngram_join.components(docs, percent=60).collect()}
    assert 1 < len(set(few.values())) < len(texts)


def test_postings_in_rounds_equal_a_loop(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "ROUND_TOKENS", 50)
    texts = [t for base in range(6) for t in near_copies(20, base, base + 1, 90)] + ["two words", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    join = ngram_join.Join(docs, "doc_id", "text", 4, 85)
    sets = {(x["s1"], x["s2"]): x["prefix"] for x in join.rows.collect()}
    kept = Counter(t for prefix in sets.values() for t in prefix)
    expected = Counter({t: n for t, n in kept.items() if n > 1})
    pieces = [[(x["token"], x["docs"]) for x in df.collect()] for df in join.postings()]
    assert len(pieces) == 4 and all(0 < len(p) < expected.total() / 2 for p in pieces)
    assert all(docs == expected[t] for p in pieces for t, docs in p)
    assert sum((Counter(t for t, _ in p) for p in pieces), Counter()) == expected


def test_near_copy_stage_equals_brute_force(spark):
    base = prose(200, 71).split()
    texts = [" ".join(base)] + [" ".join(base[:60] + [f"new{n}x{j}" for j in range(n)] + base[60:]) for n in (27, 38, 60)] + [" ".join(f"odd{i}" if i % 45 == 20 else w for i, w in enumerate(base))]
    texts += near_copies(30, 72, 3, 120) + [prose(60, 80 + i) for i in range(10)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    sets = [shingle_set(t, 5) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    alike = lambda a, b: (same := len(sets[a] & sets[b])) / (len(sets[a]) + len(sets[b]) - same)
    for a, b in itertools.combinations(range(len(texts)), 2):
        if alike(a, b) >= 0.8:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    assert any(0.8 <= alike(a, b) < 0.85 for a, b in itertools.combinations(range(5), 2))
    got = {r["doc_id"] for r in corpus_pipeline.ngram_jaccard_join(spark, docs, SF).collect()}
    assert got == {find(i) for i in range(len(texts))}


def test_contamination_equals_brute_force(spark):
    item = prose(40, 9)
    words = item.split()
    items = [(1, item), (2, "  two Words, "), (3, None), (4, "..."), (5, item), (10, " ".join(words[20:33])), (None, prose(20, 4)), (6, prose(14, 77)), (9, thue_morse(2048, 0)), (11, "a " + thue_morse(1024, 1) + " b")]
    docs = [(20, thue_morse(2048, 1)), (21, f"x {thue_morse(2048, 0)} y"), (22, f"a {thue_morse(1024, 0)} b"), (23, prose(20, 4)), (1, f"start {item} end"), (2, " ".join(words[:12])), (3, " ".join(words[5:18]).upper() + " tail" * 300), (4, "x two words y two-words"), (5, None), (6, ""), (7, " ".join(words[3:30] + words[10:25])), (7, item), (None, item), (8, prose(20_000, 6) + " " + item)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"row": F.lit(0), "items": F.lit(1), "words": F.lit(2)})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({"parts": F.lit(1)})
    windows = {}
    for k, t in items:
        w = MARKED.findall((t or "").translate(LOWER))
        for at in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[at : at + 13]), set()).update([] if k is None else [str(k)])
    expected = Counter()
    for k, t in docs:
        w, hit, mine = MARKED.findall((t or "").translate(LOWER)), set(), set()
        for size in {len(x) for x in windows}:
            for at in range(len(w) - size + 1):
                if tuple(w[at : at + size]) in windows:
                    hit |= set(range(at, at + size))
                    mine |= windows[tuple(w[at : at + size])]
        expected[k, len(w), len(hit), len(mine), tuple(sorted(mine)), bool(hit) and 20 * len(hit) >= len(w)] += 1
    got = Counter((r[0], r[1], r[2], r[3], tuple(r[4]), r[5]) for r in decontam.contamination(d, i).collect())
    assert got == expected
    assert decontam.contamination(d, i.limit(0)).where("n_hit > 0").count() == 0 and decontam.contamination(d.limit(0), i).count() == 0


def test_decontamination_query(spark):
    got = queries.op5_decontamination(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count() and got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_nearest(spark):
    r = np.random.default_rng(3)
    v = r.standard_normal((1500, 32)).astype(np.float32)
    v[100:140] = v[100]
    rows = [(i, [float(x) for x in v[i]]) for i in range(1500)] + [(5, [float(x) for x in v[5]]), (2000, None), (2020, [0.0] * 32), (2040, [float("nan")] * 32), (2060, [1.0, None]), (None, [1.0] * 32), (2080, [1.0, 2.0]), (2081, [3.0, 1.0]), (2100, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"dim": F.lit(1), "part": F.lit(2), "rank": F.lit(0)})
    got = {}
    for x in ann.nearest(df, lambda key: key % 20 == 0, k=20, block=400, queries_block=30).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    assert set(got) == {*range(0, 1500, 20), 2080}
    assert [(n, i) for n, i, _ in got.pop(2080)] == [(1, 2081)]
    hits = 0
    for q, found in got.items():
        found.sort()
        scores = (v.astype(np.float64) * v[q].astype(np.float64)).sum(axis=1)
        best = [i for i in np.lexsort((np.arange(1500), -scores)) if i != q][:20]
        assert [n for n, _, _ in found] == list(range(1, 21)) and all(abs(s - scores[i]) < 1e-12 for _, i, s in found)
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & set(best))
    assert hits >= 0.97 * 20 * len(got)
    assert ann.nearest(df.limit(0), lambda key: key % 20 == 0).count() == 0


def test_underestimated_copies_stay():
    r = np.random.default_rng(2)
    v = r.standard_normal((900, 16)).astype(np.float32)
    v[300:600] = v[300] * 3
    ids, query, wide = r.permutation(900).astype(np.int64), v[300], np.full(900, 0.1, np.float32)
    guess = (v @ query).astype(np.float32)
    guess[300:600] -= 1
    found, scores, _ = ann.best_in_block(query, int(ids[300]), guess, wide, ids, v, *ann.units(v), 20)
    assert found.tolist() == np.sort(ids[301:600])[:20].tolist() and np.allclose(scores, float(query @ query), rtol=1e-5)


def test_nearest_of_given_vectors(spark):
    got = queries.op2_nearest(spark, SF.replace("0.001", "0.1")).collect()
    table = spark.read.parquet(SF.replace("0.001", "0.1") + "/embeddings.parquet").where("embedding is not null").collect()
    ids, v = np.array([x["vec_id"] for x in table]), np.array([x["embedding"] for x in table], np.float64)
    hits = asked = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = (v * v[q]).sum(axis=1)
        best = set(ids[[i for i in np.lexsort((ids, -scores)) if i != q][:20]].tolist())
        hits += len(best & {x["vec_id"] for x in got if x["query_id"] == ids[q]})
        asked += 20
    assert hits >= 0.98 * asked and np.mean([x["looked"] for x in got]) < 0.1


def test_nearest_of_very_large_and_exact_numbers(spark):
    r = np.random.default_rng(5)
    for size, kind in ((1e20, "float"), (1e-20, "float"), (1e120, "double"), (1 / 3, "double")):
        v = (r.standard_normal((200, 8)) * size).astype(np.float32 if kind == "float" else np.float64).astype(np.float64)
        df = spark.createDataFrame([(i, [float(x) for x in v[i]]) for i in range(200)], f"vec_id long, embedding array<{kind}>")
        got = ann.nearest(df, lambda key: key % 20 == 0, k=20, block=70).collect()
        assert Counter(x["query_id"] for x in got) == {q: 20 for q in range(0, 200, 20)}
        assert all(math.isclose(x["score"], float((v[x["query_id"]] * v[x["vec_id"]]).sum()), rel_tol=1e-12) for x in got)


def test_nearest_among_copies(spark):
    r = np.random.default_rng(4)
    v = r.standard_normal((1200, 32)).astype(np.float32)
    v[200:600] = v[200] + np.float32(0.2) * v[1]
    df = spark.createDataFrame([(i, [float(x) for x in v[i]]) for i in range(1200)], "vec_id long, embedding array<float>")
    got = Counter(x["query_id"] for x in ann.nearest(df, lambda key: key % 20 == 0, k=20, block=600, queries_block=30).collect())
    assert got == {q: 20 for q in range(0, 1200, 20)}


def test_model_learns_a_pair(spark):
    r = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(1600):
        insult, group = r.random() < 0.5, r.random() < 0.5
        rows.append((i, prose(20, i) + " filth" * insult + " " + prose(20, i + 9000) + " newcomers" * group))
        labels.append((i, int(insult and group), 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(1))
    known = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    got = toxicity.toxicity(docs, known).join(known, "doc_id").collect()
    assert all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 5 == 0) for x in got)
    held = [x for x in got if x["held_out"]]
    assert np.mean([x["predicted"] == x["toxic"] for x in held]) > 0.93
    assert all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.5) for x in got)


def test_repeated_keys_are_learned_from_once(spark):
    r = random.Random(2)
    rows = [(i, prose(30, i) + (" vile" if i % 4 == 0 else " kind") * r.randrange(1, 3)) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    many = once.union(spark.createDataFrame([(8, "zz only noise")], "doc_id long, text string").crossJoin(spark.range(10_000)).select("doc_id", "text"))
    models = [toxicity.trained(x, labels, "doc_id", "text", "toxic") for x in (once, many.repartition(5))]
    assert all(np.array_equal(a, b) for a, b in zip(models[0], models[1], strict=True))
    assert len(models[0].terms) and (models[0].share > 0).all() and (np.diff(models[0].terms.astype(object)) > 0).all()


def test_chosen_terms_equal_a_plain_chi_squared(spark):
    texts = [prose(25, i % 30) + (" vile" if i % 5 == 0 else "") for i in range(150)]
    marks = [int(i % 5 == 0 or i % 17 == 0) for i in range(150)]
    rows = spark.createDataFrame(list(zip(texts, marks, strict=True)), "t string, y int").repartition(3)
    hashes, share = toxicity.telling(rows, "y", "t")
    each = [set(h.tolist()) for t in texts for _, _, h in toxicity.terms(pa.array([t]))]
    n, pos = Counter(h for e in each for h in e), Counter(h for e, y in zip(each, marks, strict=True) if y for h in e)
    often, p = [h for h in n if n[h] >= toxicity.LEAST_ROWS], sum(marks) / len(marks)
    chance, want = 2 * math.log(len(often)), {}
    for h in often:
        chi = (pos[h] - n[h] * p) ** 2 / (n[h] * p * (1 - p) * (1 - n[h] / len(texts)) + 1e-9)
        if chi > chance:
            want[h] = 1 - chance / chi
    assert hashes.tolist() == sorted(want) and want and np.allclose(share, [want[h] for h in sorted(want)])
    assert len(toxicity.telling(rows.where("y = 1"), "y", "t")[0]) == 0


def test_held_out_toxic_texts_are_found(spark):
    known = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = [x for x in queries.op3_toxicity(spark, "/root/testdata/sf0.01").where("held_out").collect() if x["doc_id"] in known]
    hits = [x["predicted"] for x in got if known[x["doc_id"]]]
    assert sum(hits) >= 4 and len(hits) == 6 and not any(x["predicted"] for x in got if not known[x["doc_id"]])


def test_margins_equal_a_double_loop():
    r = np.random.default_rng(6)
    model = toxicity.Model(0.3, r.standard_normal(toxicity.BUCKETS).astype(np.float32), r.standard_normal((toxicity.BUCKETS, toxicity.FACTORS)).astype(np.float32))
    sizes = np.array([0, 1, 7, 30])
    buckets, values = r.integers(0, toxicity.BUCKETS, sizes.sum()), r.random(sizes.sum()).astype(np.float32)
    got, at = toxicity.margins(model, sizes, buckets, values), 0
    for n, z in zip(sizes, got, strict=True):
        mine = range(at, at + n)
        want = 0.3 + sum(float(model.weight[buckets[i]]) * values[i] for i in mine) + sum(float(model.factor[buckets[i]].astype(float) @ model.factor[buckets[j]]) * values[i] * values[j] for i, j in itertools.combinations(mine, 2))
        assert math.isclose(z, want, rel_tol=1e-4, abs_tol=1e-4)
        at += n


def test_one_step_equals_finite_differences():
    r = np.random.default_rng(7)
    sizes = np.full(20, 6)
    buckets, values, label = r.integers(0, 9, 120), r.random(120), r.integers(0, 2, 20).astype(float)
    rate, shrink = 0.1, 2e-3
    got = toxicity.fitted(sizes, buckets, values, label, epochs=1, rate=rate, shrink=shrink, least=1, seed=3)
    factor = np.random.default_rng(3).normal(0, 0.01, (toxicity.BUCKETS, toxicity.FACTORS)) * (np.bincount(buckets, minlength=toxicity.BUCKETS) >= 1)[:, None]
    bias, weight = float(np.log(label.mean() / (1 - label.mean()))), np.zeros(toxicity.BUCKETS)

    def loss():
        z = toxicity.margins(toxicity.Model(bias, weight, factor), sizes, buckets, values)
        return float(np.mean(np.log1p(np.exp(z)) - label * z))

    def slope(array, at):
        array[at] += 1e-5
        up = loss()
        array[at] -= 2e-5
        down = loss()
        array[at] += 1e-5
        return (up - down) / 2e-5

    for b in range(9):
        g = slope(weight, b)
        assert math.isclose(got.weight[b], -rate * g / math.sqrt(1e-2 + g * g), rel_tol=1e-3, abs_tol=1e-6)
        for k in range(toxicity.FACTORS):
            g = slope(factor, (b, k)) + shrink * factor[b, k] / len(label)
            assert math.isclose(got.factor[b, k], factor[b, k] - 0.2 * rate * g / math.sqrt(1e-2 + g * g), rel_tol=1e-3, abs_tol=1e-6)


def test_toxicity_edges(spark):
    docs, labels = edge_docs(spark), spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (8, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(x["score"] is not None and x["held_out"] is not None for x in got)
    assert len({x["score"] for x in toxicity.toxicity(docs, labels.limit(0)).collect()}) == 1
    assert toxicity.toxicity(empty_docs(spark), labels).count() == 0


def test_kneser_ney_is_a_distribution():
    counts = np.zeros((64, 64, 64), np.int64)
    r = np.random.default_rng(0)
    np.add.at(counts, tuple(r.integers(0, 9, (3, 500))), 1)
    for c in (counts, counts * 0, counts * 7):
        assert np.allclose((2.0 ** quality.kneser_ney(c)).sum(axis=-1), 1) and np.isfinite(quality.kneser_ney(c)).all()


def test_codes_equal_a_loop():
    data = "Ab é\n9!|".encode() + b"" + b"zz"
    bounds = np.array([0, 9, 9, len(data)])
    s = quality.SYMBOL[np.frombuffer(data, np.uint8)].astype(int)
    expected = []
    for a, b in itertools.pairwise(bounds):
        for i in range(a, b):
            expected.append((s[i - 2] if i - 2 >= a else 29) * 4096 + (s[i - 1] if i - 1 >= a else 29) * 64 + s[i])
    assert quality.codes(np.frombuffer(data, np.uint8), bounds).tolist() == expected


def test_quality_keeps_prose_and_drops_junk(spark):
    good = [(i, prose(60, i), ("en", "xx", None)[i % 3], "s", 1) for i in range(90)]
    junk = [(100 + i, "%%% $$$ " + "Q!!ZX&&#" * 20, "en", "s", 1) for i in range(10)]
    docs = edge_docs(spark).union(spark.createDataFrame(good + junk, "doc_id long, text string, lang string, source string, n_chars long")).withColumn("threshold", F.lit("clash"))
    trusted = spark.createDataFrame([(i,) for i in range(90) if i > 9] + [(None,)], "doc_id long")
    got = quality.classified(docs, trusted).collect()
    assert len(got) == 112
    by = {x["doc_id"]: x["accepted"] for x in got}
    assert not any(by[100 + i] for i in range(10)) and sum(by[i] for i in range(10, 90)) >= 78 and by[3] and by[4]
    assert quality.classified(empty_docs(spark), trusted).count() == 0
    assert all(x["accepted"] and x["threshold"] is None for x in quality.classified(docs, trusted.limit(0)).collect())


def test_quality_drops_shuffled_words(spark):
    r = random.Random(5)
    vocabulary = [f"{a}{b}" for a in ("ta", "ro", "mi", "ne", "su", "la") for b in ("do", "ki", "ran", "sel", "po", "vi")]
    after = {w: r.sample(vocabulary, 2) for w in vocabulary}

    def chain(n):
        w = [r.choice(vocabulary)]
        while len(w) < n:
            w.append(r.choice(after[w[-1]]))
        return w

    good = [(i, " ".join(chain(120)), "en") for i in range(120)]
    bad = [(200 + i, " ".join(r.sample(w := chain(120), len(w))), "en") for i in range(15)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string")
    by = {x["doc_id"]: x["accepted"] for x in quality.classified(docs, docs.where("doc_id < 80").select("doc_id")).collect()}
    assert sum(by[i] for i in range(80, 120)) >= 38 and not any(by[200 + i] for i in range(15))


def test_quality_drops_shuffled_characters(spark):
    r = random.Random(6)
    signs = [chr(0x4E00 + 37 * k) for k in range(60)]
    after = {c: r.sample(signs, 3) for c in signs}

    def chain(n):
        c = [r.choice(signs)]
        while len(c) < n:
            c.append(r.choice(after[c[-1]]))
        return c

    good = [(i, "".join(chain(150)) + "。", "zh") for i in range(120)]
    bad = [(200 + i, "".join(r.sample(c := chain(150), len(c))) + "。", "zh") for i in range(20)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string")
    by = {x["doc_id"]: x["accepted"] for x in quality.classified(docs, docs.where("doc_id < 80").select("doc_id")).collect()}
    assert sum(by[i] for i in range(80, 120)) >= 38 and not any(by[200 + i] for i in range(20))


def test_characters_of_unspaced_scripts_are_words():
    at, data, bounds = next(text.chunks(pa.array(["ab漢字c か ไทย", "漢", "", "é 𠀀x"])))
    found = text.words(data, bounds, text.SPACES, True)
    raw = data.tobytes()
    assert [raw[b:e].decode() for b, e in zip(found.start, found.end, strict=True)] == ["ab", "漢", "字", "c", "か", "ไ", "ท", "ย", "漢", "é", "𠀀", "x"] and np.diff(found.first).tolist() == [8, 1, 0, 3]


def loop_perplexity(counted, table):
    """Perplexity per character by interpolated modified Kneser-Ney bigrams of the texts ``counted``, one word after another."""

    def log2_letters(t):
        data = np.frombuffer(t.encode(), np.uint8)
        return table[quality.codes(data, np.array([0, len(data)]))]

    pairs = Counter(p for t in counted for p in itertools.pairwise([None, *t.split()]))
    tails = Counter(c for _, c in pairs)
    d2, d1 = (quality.discounts(np.array(list(x.values()) or [0])) for x in (pairs, tails))

    def single(c):
        letters = 2 ** log2_letters(c).sum()
        if not tails:
            return letters
        back = sum(d1[min(k, 3)] for k in tails.values()) / tails.total()
        return max(tails[c] - d1[min(tails[c], 3)], 0) / tails.total() + back * letters

    def of(t):
        bits = log2_letters(t)[[x == " " for x in t]].sum()
        for b, c in itertools.pairwise([None, *t.split()]):
            follow = [n for (x, _), n in pairs.items() if x == b]
            n = pairs[b, c]
            bits += math.log2((max(n - d2[min(n, 3)], 0) + sum(d2[min(k, 3)] for k in follow) * single(c)) / sum(follow) if follow else single(c))
        return 2 ** (-bits / len(t))

    return of


def test_word_probabilities_equal_a_loop(spark):
    good = ["a b a c b a", "b a b c", "c a b", "a a b d"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*good, "a b z", " c a", "zz"])], "doc_id long, text string, lang string")
    trusted = docs.where(F.col("doc_id") < len(good))
    got = {x["doc_id"]: x["perplexity"] for x in quality.classified(docs, trusted.select("doc_id"), shards=3).collect()}
    of = loop_perplexity(good, quality.letter_table(trusted).astype(float))
    for i, t in enumerate([*good, "a b z", " c a", "zz"]):
        assert math.isclose(got[i], of(t), rel_tol=1e-4), (i, t)


def test_words_of_several_parts_are_added_up_in_one_task(spark):
    texts = [prose(60, i) for i in range(20)]
    trusted = spark.createDataFrame([("=en", t, False) for t in texts], "name string, text string, held boolean")
    got = quality.word_counts([quality.bigram_counts(trusted, shard, 2, 8, 1) for shard in range(2)], 8)
    assert "Coalesce 2" in got._jdf.queryExecution().optimizedPlan().toString().replace("Repartition 2, false", "Coalesce 2")
    rows = got.collect()
    words = [SPACED.findall(t.translate(LOWER)) for t in texts]
    assert len({r["w"] for r in rows}) == len(rows) == len({w for x in words for w in x}) + 1
    assert sum(r["s_n"] for r in rows) == sum(r["s_t"] for r in rows) == sum(map(len, words))
    assert sum(r["k_n"] for r in rows) == sum(r["a_n"] for r in rows) == len({p for x in words for p in zip([None, *x], x)})


def test_shards_counted_together_and_words_given_packed(spark):
    texts = [prose(60, i) for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    trusted = docs.where("doc_id < 10")
    one, four = ({x["doc_id"]: x["perplexity"] for x in quality.classified(docs, trusted.select("doc_id"), shards=n).collect()} for n in (1, 4))
    of = loop_perplexity(texts[:10], quality.letter_table(trusted).astype(float))
    assert all(math.isclose(one[i], four[i], rel_tol=1e-9) and math.isclose(four[i], of(t), rel_tol=1e-4) for i, t in enumerate(texts))
    named = trusted.selectExpr("'=en' as name", "text", "false as held")
    apart = [quality.bigram_counts(named, k, 4, 3, 1) for k in range(4)]
    together = quality.bigram_counts(named, 0, 1, 3, 1, 4)
    rows = {3 * k + x["part"]: bytes(x["c"]) for k, df in enumerate(apart) for x in df.collect()}
    assert rows == {x["part"]: bytes(x["c"]) for x in together.collect()} and len(rows) > 9
    keys = np.sort(np.random.default_rng(5).integers(0, 2**64, 1000, np.uint64))
    assert (quality._opened(pa.py_buffer(quality._closed(keys))) == keys).all()


def test_questions_are_not_stored_and_meet_parts_in_several_tasks_and_batches(spark, monkeypatch):
    texts = [prose(60, i) + " the" * (300 * (i == 3)) for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    trusted, names, keep = docs.where("doc_id < 10"), [], quality.written
    monkeypatch.setattr(quality, "written", lambda df, name, conf=None: names.append(name) or keep(df, name, conf))
    monkeypatch.setattr(quality, "TASK_PAIRS", 40)
    monkeypatch.setattr(quality, "SLICE", 1000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        got = {x["doc_id"]: x["perplexity"] for x in quality.classified(docs, trusted.select("doc_id"), shards=2).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    of = loop_perplexity(texts[:10], quality.letter_table(trusted).astype(float))
    assert all(math.isclose(got[i], of(t), rel_tol=1e-4) for i, t in enumerate(texts))
    assert names.count("sums") == 2 and not {"asked", "parts", "tasks"} & set(names)


def test_orders_marks_and_short_numbers():
    r = np.random.default_rng(7)
    many = r.integers(0, 2**64, 5000, np.uint64)
    for keys in (many, many[r.integers(0, 90, 5000)], many >> np.uint64(60), many[:1], many[:0]):
        assert (text.ordered(keys) == np.argsort(keys, kind="stable")).all()
    for table in (text.SPACES, text.MARKS, np.ones(256, bool), np.zeros(256, bool)):
        assert (text.among(np.arange(256, dtype=np.uint8), table) == table).all()
    for numbers in ([], [0, 255], [1, 256], [70_000], [2**40]):
        assert quality._long(pa.py_buffer(quality._short(np.array(numbers, np.int64)))).tolist() == numbers


def test_each_distinct_word_is_spelled_once(monkeypatch):
    table, spelled, keep = np.random.default_rng(3).random(quality.CELLS).astype(np.float32), [], quality.codes
    _, data, bounds = next(text.chunks(pa.array(["ab ab c AB", "", " c é漢ab", "ab"])))
    found = text.words(data, bounds, text.SPACES, True)
    monkeypatch.setattr(quality, "codes", lambda d, b: spelled.append(len(b) - 1) or keep(d, b))
    got = quality.every_word_bits(found, table)
    assert spelled == [4] and len(got) == 9
    for bits, b, e in zip(got, found.start, found.end, strict=True):
        letters = found.low[b:e]
        assert math.isclose(bits, table[keep(letters, np.array([0, len(letters)]))].astype(float).sum(), rel_tol=1e-6)


def test_thresholds_and_verdicts_equal_a_loop(spark):
    r = random.Random(9)
    words = {"en": "the cat sat on a mat and saw one dog run by".split(), "xx": "lo mi ra tu se".split()}
    rows = [(i, " ".join(r.choice(words["en"]) for _ in range(12)), "en") for i in range(60)] + [(100 + i, " ".join(r.choice(words["xx"]) for _ in range(9)), "xx") for i in range(10)]
    rows += [(200, "the the the the the the the the", "en"), (201, "qqq zzz vvv", "en"), (202, "xq7 %% zz", "xx"), (203, "lo mi ra", "xx"), (204, "the cat", None), (205, "the cat sat on a mat", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = docs.where("doc_id < 200")
    got = {x["doc_id"]: x for x in quality.classified(docs, trusted.select("doc_id"), shards=2).collect()}
    held = {x["doc_id"] for x in trusted.where(F.pmod(F.xxhash64("text", F.lit(1)), F.lit(quality.FOLDS)) == 0).collect()}
    table = quality.letter_table(trusted).astype(float)
    for lang in ("en", "xx"):
        mine = [(i, t) for i, t, x in rows if x == lang]
        good = [(i, t) for i, t in mine if i < 200]
        by_all, by_rest = loop_perplexity([t for _, t in good], table), loop_perplexity([t for i, t in good if i not in held], table)
        out = sorted(by_rest(t) for i, t in good if i in held) or sorted(by_all(t) for _, t in good)
        cut = 1.2 * out[math.ceil(0.95 * len(out)) - 1]
        for i, t in mine:
            assert math.isclose(got[i]["perplexity"], by_all(t), rel_tol=1e-4) and math.isclose(got[i]["threshold"], cut, rel_tol=1e-4) and got[i]["accepted"] == (by_all(t) <= cut), (i, t)
    assert not got[201]["accepted"] and not got[202]["accepted"] and got[204]["accepted"] and got[204]["threshold"] is None


def test_pipeline_keys_and_repeats(spark):
    rows = [(5, "b"), (-3, "a"), (-5, "a"), (None, "z"), (40, None), (2**63 - 1, "c"), (-(2**63), "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = [r["doc_id"] for r in docs.orderBy(corpus_pipeline.row_key()).collect()]
    assert order == [-(2**63), -5, -3, 5, 40, 2**63 - 1, None]
    twice = spark.createDataFrame([(1, "one two", "fr", "s", 7), (1, "one two", "de", "t", 7), (2, "three", "en", "s", 5)], DOCS).withColumns({"row": F.lit(1), "component_id": F.lit(0)})
    got = corpus_pipeline.ngram_jaccard_join(spark, twice, SF)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "one two", "de", "t", 7), (2, "three", "en", "s", 5)]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").union(edge_docs(spark).withColumn("n_chars", F.length("text").cast("long")))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, SF), "stage")
        seen[name] = (before, docs)
        if name != names[-1]:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        assert stage(spark, before.limit(0), SF).count() == 0
    before, after = (x.collect() for x in seen[names[1]])
    kept = [shingle_set(r["text"]) for r in after]
    for a, b in itertools.combinations(kept, 2):
        assert not (same := len(a & b)) or 100 * same < 85 * (len(a) + len(b) - same)
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before} and sum(r["text"] is None for r in after) == 1
    before, after = seen[names[2]]
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert after.count() == decontam.contamination(before, items).where("not contaminated").count()
    before, after = (x.collect() for x in seen[names[3]])
    assert len(before) == len(after)
    for x, y in zip(sorted(before, key=repr), sorted(after, key=repr), strict=False):
        if "<secret>" in (y["text"] or ""):
            assert y["n_chars"] == len(y["text"])
    assert hashlib.sha256("".join(sorted(str(r["doc_id"]) for r in before)).encode()).hexdigest() == hashlib.sha256("".join(sorted(str(r["doc_id"]) for r in after)).encode()).hexdigest()
    assert not any(re.search("[0-9a-f]{32}|AKIA[A-Z0-9]{12}", r["text"] or "") for r in after)
    assert seen[names[4]][1].groupBy("doc_id", "text", "copy").count().where("copy > 3").count() == 0


def test_join_without_pairs_reads_no_text_again(spark, monkeypatch):
    names = []
    monkeypatch.setattr(ngram_join, "written", lambda df, name, *a: (names.append(name), written(df, name, *a))[1])
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(9))) for i in range(6)], "doc_id long, text string")
    got = {(x["doc_id"], x["n_shingles"], x["component_id"]) for x in ngram_join.components(docs).collect()}
    assert got == {(i, 6, i) for i in range(6)} and not {"wanted", "words", "links"} & set(names), names
