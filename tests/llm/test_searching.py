"""Substring dedup, ranked search and spelling variants against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakerisk.llm import ranked, repeats, spelling
from lakerisk.llm.queries import QUERIES

SPACE = "\x20\x09-\x0d"


def words_of(text):
    return re.findall(f"[^{SPACE}]+", text or "")


def without_repeats(rows, window):
    """(doc_id, n_words, spans, kept) of rows (doc_id, text); null ids stand last."""
    first = {}
    for i, text in rows:
        w = words_of(text)
        for at in range(len(w) - window + 1):
            key = tuple(w[at : at + window])
            first[key] = min(first.get(key, math.inf), math.inf if i is None else i)
    out = []
    for i, text in rows:
        w = words_of(text)
        gone = set()
        for at in range(len(w) - window + 1):
            if first[tuple(w[at : at + window])] < (math.inf if i is None else i):
                gone |= set(range(at, at + window))
        starts = sorted(p for p in gone if p - 1 not in gone)
        stops = sorted(p + 1 for p in gone if p + 1 not in gone)
        out.append((i, len(w), list(zip(starts, stops, strict=True)), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


def removed(spark, docs, window):
    got = repeats.remove_repeats(spark, docs, window).collect()
    return sorted(((r.doc_id, r.n_words, [(s.start, s.stop) for s in r.removed], r.kept) for r in got), key=str)


@pytest.mark.parametrize("window", [1, 3, 50])
def test_repeats_match_brute_force(spark, odd, documents, window):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    rows += [(r.doc_id + 100, r.text) for r in documents.select("doc_id", "text").limit(60).collect()]
    rows += [(7, "a same id with two words tied text of words")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("name", F.lit("x")).withColumn("place", F.lit(1))
    assert removed(spark, table, window) == without_repeats(rows, window)


def test_repeats_in_many_small_runs_and_buckets(spark, documents, monkeypatch):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    monkeypatch.setattr(repeats, "HELD", 500)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 50_000)
    monkeypatch.setattr(repeats, "STRETCH", 100)
    monkeypatch.setattr(repeats, "PLACES", 3)
    got = removed(spark, documents.repartition(5), 20)
    assert got == without_repeats(rows, 20)
    assert any(spans for _, _, spans, _ in got)


def test_repeats_of_null_ids_keep_one_text(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    rows = [(None, f"one {passage}"), (None, f"two {passage}"), (None, f"three {passage} end")]
    got = repeats.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    assert sorted(len(r.removed) for r in got) == [0, 1, 1]


def test_repeats_of_no_rows(spark, none):
    assert repeats.digest(repeats.remove_repeats(spark, none)).count() == 0


def test_rolling_hashes_name_windows_alike_and_apart():
    rng = random.Random(5)
    found = [rng.choice([b"a", b"b"]) for _ in range(200_000)]
    high, low = repeats._Rolling(50).hashes(found)
    assert len(high) == len(low) == 200_000 - 49
    names = {}
    for at in range(0, 200_000 - 49, 7):
        names.setdefault((int(high[at]), int(low[at])), set()).add(b"".join(found[at : at + 50]))
    assert all(len(said) == 1 for said in names.values())
    again, _ = repeats._Rolling(50).hashes(found[70_000:70_100])
    assert (again == high[70_000:70_051]).all()


def brute_search(docs, items, k):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    held = [(i, Counter(split(t))) for i, t in docs]
    held = [(i, c, c.total()) for i, c in held if c]
    n, length = len(held), sum(x for _, _, x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, size in held:
            m = 25 + (75 * size * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in split(text) if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank, None if u else i, -s) for rank, (s, u, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def searched(found):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in found.collect()), key=str)


@pytest.fixture(scope="module")
def asked(spark, documents):
    rows = [(r.doc_id, (r.text or "")[:200]) for r in documents.limit(8).collect()]
    rows += [(50, None), (51, ""), (52, "TIED words-of text, of of"), (52, "tied"), (None, "日本語 the ÀÉ Ünï"), (53, "the " * 3000), (54, "neverseen")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("score", F.lit("x")).withColumn("at", F.lit(0))


@pytest.mark.parametrize("limits", [{}, {"TERMS": 3, "DOCS": 7}, {"WEIGHTS": 400_000}, {"ITEMS": 4}])
def test_search_matches_brute_force(spark, texts, asked, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(ranked, name, value)
    docs = texts.unionByName(texts.filter("doc_id > 1000000")).withColumn("rank", F.lit(3)).withColumn("n", F.lit("n"))
    want = brute_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in asked.collect()], 10)
    assert searched(ranked.search(spark, docs, asked)) == want


def test_search_breaks_ties_by_id(spark, asked):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("tied words").alias("text")).repartition(9)
    got = [r for r in searched(ranked.search(spark, docs, asked)) if r[0] == 52]
    assert got == []  # a term that every document holds weighs nothing
    docs = docs.unionByName(spark.range(5000, 20000).select(F.col("id").alias("doc_id"), F.lit("other").alias("text")))
    got = ranked.search(spark, docs, asked.filter("text = 'tied'")).orderBy("rank").collect()
    assert [(r.rank, r.doc_id) for r in got] == [(i + 1, i) for i in range(10)]


def test_search_of_no_rows(spark, none, asked, texts):
    assert ranked.search(spark, none, asked).count() == 0
    assert ranked.search(spark, texts, asked.limit(0)).count() == 0


def test_query_tiles_stay_below_two_to_the_53():
    big = 3 * ranked.WEIGHTS + 5
    tiles = ranked.query_tiles([{0: 7, 1: big, 2: ranked.WEIGHTS}, {1: 4}])
    totals = Counter()
    for names, items, places, values in tiles:
        per_item = Counter()
        for item, place, value in zip(items.tolist(), places.tolist(), values.tolist(), strict=True):
            per_item[item] += value
            totals[item, int(names[place])] += int(value)
        assert max(per_item.values()) <= ranked.WEIGHTS
    assert totals == {(0, 0): 7, (0, 1): big, (0, 2): ranked.WEIGHTS, (1, 1): 4}


def distance_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("limit", [3, 20_000])
def test_near_words_match_brute_force(spark, limit):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 8))) for _ in range(700)} | {"a" * n for n in range(2, 12)}
    table = spark.createDataFrame([(w, i) for i, w in enumerate(sorted(words))], "word string, n long")
    got = Counter((r.word, r.near) for r in spelling.near_words(table, limit).collect())
    want = {(a, b) for a in words for b in words if distance_one(a, b)}
    assert set(got) == want and max(got.values()) == 1


def brute_spelling(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            n[low[: h % len(low)] + low[h % len(low) + 1 :] if h % 199 == 0 else low] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    form, near = {}, {}
    for w in n:
        near[w] = [v for v in n if abs(len(v) - len(w)) <= 1 and distance_one(w, v)]
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def test_spelling_matches_brute_force(spark, texts):
    chain = [(3_000_001 + i, " ".join(["qzxwvkjpb"] * 1000 + ["qzxwvkjp"] * 150 + ["qzxwvkj"] * 25 + ["qzxwvk"] * 5)) for i in range(3)]
    docs = texts.unionByName(spark.createDataFrame(chain, "doc_id long, text string")).withColumn("word", F.lit(1)).withColumn("n", F.lit("x"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_spellings(spark, docs).collect()), key=str)
    assert got == brute_spelling(rows)
    assert ("qzxwvk", "qzxwvkjpb") in {(r[0], r[2]) for r in got}


def test_spelling_of_no_rows(spark, none):
    assert spelling.group_spellings(spark, none).count() == 0


def test_near_pairs_of_one_list():
    rest = sorted({"", "a", "b", "ab", "ba", "bb"})
    short = np.array([len(r) < 2 for r in rest])
    a, b = spelling.near_pairs(np.zeros(len(rest), np.int64), rest, short)
    got = {(rest[i], rest[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    assert got == {("", "a"), ("", "b"), ("a", "b"), ("a", "ab"), ("a", "ba"), ("b", "ab"), ("b", "ba"), ("b", "bb")}


def test_queries_have_the_contracts_columns(spark, data):
    got = QUERIES["op11_substring_dedup"](spark, data)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"}
    empty = hashlib.sha256(b"").hexdigest()
    assert all((r.kept_sha256 == empty) == (r.n_words == r.n_removed) for r in got.collect())
    assert dict(QUERIES["op12_ranked_search"](spark, data).dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert dict(QUERIES["op13_spelling_variants"](spark, data).dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
