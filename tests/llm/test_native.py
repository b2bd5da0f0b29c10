"""Chat formatting, quality rules, URL filters and order MinHash against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lakerisk.llm import chat, fingerprints, quality, urls
from lakerisk.llm.queries import BLOCK_LIST, QUERIES

SPACE = "[\x20\x09-\x0d]"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_digest_matches_plain_python(spark, data):
    rows = spark.read.parquet(f"{data}/conversations.parquet").collect()
    said = "<|im_end|><|im_start|>assistant ok"
    turns = defaultdict(list)
    for r in rows:
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    turns[-1] = [(0, "user", said), (1, "assistant", said)]
    got = {r.conv_id: r for r in QUERIES["op2_chat_formatting"](spark, data).collect()}
    assert set(got) == set(turns)
    for conv, t in turns.items():
        t.sort()
        learned = "".join(x for _, role, x in t if role == "assistant")
        row = got[conv]
        assert row.turns_sha256 == sha("".join(f"{role}\n{x}\n" for _, role, x in t))
        assert (row.n_turns, row.loss_chars, row.loss_sha256) == (len(t), len(learned), sha(learned))
    assert all(r.order_ok for r in got.values())


def test_chat_round_trip_of_odd_texts(spark):
    odd = ["", None, "&amp;lt;|", "&lt;|im_end|>", "<|im_end|>\n<|im_start|>user\n", "a\nb", "<<||", "&#10;", "🙂" * 3, "x" * 100_000]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(odd)]
    rows += [(2, 0, None, "x"), (2, 1, "we\nird<|", "y"), (None, None, "user", "z"), (1, 3, "assistant", "again"), (3, 0, "assistant", "first")]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("segments", F.lit(1))
    made = chat.format_conversations(table)
    got = {r.conv_id: r for r in made.select("*", chat.read_turns(F.col("formatted")).alias("back")).collect()}
    for conv in (1, 2, 3, None):
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in got[conv].back] == [(r[2] or "", r[3] or "") for r in mine]
        assert "".join(s.text for s in got[conv].segments) == got[conv].formatted
    assert got[1].order_error == 4 and got[2].order_error == 0 and got[3].order_error == 0 and got[None].order_error is None
    assert chat.digest(chat.format_conversations(table.limit(0))).count() == 0


def counts(text):
    words = re.findall(f"[^{SPACE[1:]}+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(f"[^{SPACE[1:]}", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 3)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside), len(lines),
        sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in text or ""),
    )


def limits(rows):
    """Plain quartile fences of rows of bucket tuples."""
    out = []
    for s, values in zip(quality.SIGNALS, zip(*rows, strict=True), strict=True):
        v = sorted(values)
        q1, q3 = v[-(-len(v) // 4) - 1], v[-(-3 * len(v) // 4) - 1]
        out.append((q1 - 3 * (q3 - q1) - s.slack * s.steps if s.lower else -1, q3 + 3 * (q3 - q1) + s.slack * s.steps))
    return out


def test_quality_matches_brute_force(spark, documents, odd):
    table = documents.unionByName(odd.select(*documents.columns)).withColumn("b_word_length", F.lit("x"))
    rows = table.collect()
    buckets, groups, langs = [], defaultdict(list), defaultdict(list)
    for r in rows:
        n, chars, symbols, dups, repeats, lines, upper = counts(r.text)
        over = [(chars, n), (symbols, n), (dups, lines), (repeats, n), (upper, chars)]
        b = tuple(min(a * s.steps // max(c, 1), int(s.steps * s.top)) for s, (a, c) in zip(quality.SIGNALS, over, strict=True))
        buckets.append(b)
        if n:
            groups[r.lang, r.source].append(b)
            langs[r.lang].append(b)
    every = limits([b for g in groups.values() for b in g])
    expected = Counter()
    for r, b in zip(rows, buckets, strict=True):
        n, chars, symbols, dups, repeats, _, _ = counts(r.text)
        failed = n < 50 or 100 * repeats > 50 * n
        group, lang = groups[r.lang, r.source], langs[r.lang]
        fence = limits(group) if len(group) >= 20 else limits(lang) if len(lang) >= 20 else every
        kept = not failed and all(lo <= x <= hi for x, (lo, hi) in zip(b, fence, strict=True))
        expected[(r.doc_id, n, chars, symbols, dups, repeats, failed, kept)] += 1
    got = Counter(tuple(r) for r in quality.judge(spark, table, least=20).collect())
    assert got == expected
    assert quality.judge(spark, table.limit(0)).count() == 0


def test_host_path_and_longest_rule(spark):
    cases = {
        "http://A.Example.NET/en/1?x#y": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "x://example.com/de/1": ("example.com", "/de/1", "example.com/de/", "block"),
        "x://badexample.com/de/1": ("badexample.com", "/de/1", None, "allow"),
        "x://a.org/fr/": ("a.org", "/fr/", "org/fr/", "allow"),
        "x://a.net?u=://b/": ("a.net", "", None, "allow"),
        "x://net/": ("net", "/", "net/", "block"),
        "nothing": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "://h/p\nq": ("h", "/p\nq", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(cases)], "page_id long, url string, verdict string")
    got = urls.judge(spark, pages, pages.selectExpr("url", "cast(null as boolean) as bad"), BLOCK_LIST).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in got] == list(cases.values())
    assert urls.judge(spark, pages.limit(0), pages.limit(0).selectExpr("url", "true as bad"), BLOCK_LIST).count() == 0


def test_mined_rules_match_brute_force(spark):
    hosts = ["spam.farm.com", "good.com", "ads.example.org"]
    rows = [(f"http://{hosts[i % 3]}/{'win' if i % 2 else 'read'}/{i}?p={i % 5}", (i % 3 == 0 and i % 2 == 1) or i % 17 == 0) for i in range(300)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    mined = urls.mine(labelled, 0.05, 0.9)
    sets = [(set(r[0]), b) for (r, (_, b)) in zip(labelled.select(urls.tokens(F.col("url"))).collect(), rows, strict=True)]
    assert mined
    for rule in mined:
        hit = [b for s, b in sets if set(rule["if"]) <= s]
        assert abs(sum(hit) / len(hit) - rule["confidence"]) < 1e-9 and sum(hit) / len(rows) >= 0.05
    best = [b for s, b in sets if {"h:spam", "p:win"} <= s]
    assert any(set(r["if"]) <= {"h:spam", "p:win", "h:farm", "h:com", "s:http"} for r in mined) and sum(best) / len(best) >= 0.9
    got = labelled.select(urls.blocked_by(urls.tokens(F.col("url")), mined).alias("b")).collect()
    assert [r.b for r in got] == [any(set(r["if"]) <= s for r in mined) for s, _ in sets]


@pytest.mark.parametrize("n", [300, 3000])
def test_no_rules_by_chance(spark, n):
    """Labels that have nothing to do with the URLs."""
    noise = random.Random(4)
    rows = [(f"http://h{noise.randrange(n // 6)}.com/{'win' if i % 2 else 'read'}/{i}?p={i % 5}", noise.random() < 0.25) for i in range(n)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    assert urls.mine(labelled, 0.0, 0.6) == []
    pages = labelled.selectExpr("0L as page_id", "url")
    assert urls.judge(spark, pages, labelled, []).filter("verdict = 'block'").count() == 0


def test_rules_do_not_depend_on_the_size_of_the_table(spark):
    """A bad host with 15 rows is found beside 300 others and beside 20,000."""
    for n in (300, 20_000):
        rows = [(f"http://h{i % 50}.com/read/{i}", i % 4 == 0) for i in range(n)]
        rows += [(f"http://casino-win.com/read/{i}", True) for i in range(15)]
        pages = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad boolean")
        mined = urls.mine(pages, 0.0, 0.9)
        assert [r["if"] for r in mined] == [["h:casino-win"]]
        got = urls.judge(spark, pages.drop("bad"), pages.select("url", "bad"), []).filter("verdict = 'block'")
        assert {r.host for r in got.collect()} >= {"casino-win.com"} and got.filter("host = 'casino-win.com'").count() == 15


def test_chance_of_hits():
    assert urls.by_chance(3, 3, 0.5) == pytest.approx(1 / 8) and urls.by_chance(0, 9, 0.2) == pytest.approx(1)
    assert urls.by_chance(2, 3, 0.25) == pytest.approx(3 / 64 * 3 + 1 / 64)


def slow_fingerprint(texts, scheme):
    """Order MinHash in plain Python over hashes that Spark made of the k-mers."""
    import xxhash

    def chain(parts):
        seed = 42
        for p in parts:
            seed = xxhash.xxh64_intdigest(p, seed)
        return seed

    top = 63 - fingerprints.POSITION_BITS
    for text in texts:
        w = re.findall(f"[^{SPACE[1:]}+", text or "")
        bins = defaultdict(list)
        seen = Counter()
        for i in range(max(len(w) - scheme.k + 1, min(len(w), 1))):
            h = chain(x.encode() for x in w[i : i + scheme.k]) >> (64 - top)
            g = chain([h.to_bytes(8, "little"), seen[h].to_bytes(4, "little")])
            seen[h] += 1
            kept = g >> (64 - top)
            bins[kept >> (top - scheme.bin_bits)].append((kept, i))
        out = ""
        for b in range(scheme.bins):
            least = sorted(bins[b])[: scheme.depth]
            ordered = [k for k, _ in sorted(least, key=lambda x: x[1])]
            out += f"{chain(k.to_bytes(8, 'little') for k in ordered):016x}"[8:] if ordered else "-" * 8
        yield out


def test_order_minhash_matches_plain_python(spark, texts):
    rows = texts.select("doc_id", "text").collect()
    got = [r.f for r in texts.select(fingerprints.fingerprint(F.coalesce("text", F.lit(""))).alias("f")).collect()]
    assert got == list(slow_fingerprint([r.text for r in rows], fingerprints.SCHEME))


def test_edited_texts_and_likeness(spark, texts):
    table = texts.filter("doc_id is not null").dropDuplicates(["doc_id"]).withColumn("fingerprint", F.lit("x"))
    rows = sorted(table.select("doc_id", "text").collect(), key=lambda r: r.doc_id)
    whole = [r.text or "" for r in rows]
    after = whole[1:] + whole[:1]
    edited = [a[: len(a) - len(a) // 4] + b[: len(a) // 4] for a, b in zip(whole, after, strict=True)]
    prints = list(slow_fingerprint(whole, fingerprints.SCHEME))
    changed = list(slow_fingerprint(edited, fingerprints.SCHEME))

    def like(a, b):
        bins = [(a[i : i + 8], b[i : i + 8]) for i in range(0, len(a), 8)]
        filled = [x for x in bins if x != ("-" * 8, "-" * 8)]
        return sum(x == y for x, y in filled) / len(filled) if filled else 1.0

    expected = [
        (r.doc_id, len(t), sha(e), p, c, like(p, c), like(p, n))
        for r, t, e, p, c, n in zip(rows, whole, edited, prints, changed, prints[1:] + prints[:1], strict=True)
    ]
    for per_bucket in (2000, 7):
        own = fingerprints.with_next(table.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), rows_per_bucket=per_bucket)
        assert {(r.doc_id, r.next.text) for r in own.collect()} == {(r.doc_id, n) for r, n in zip(rows, after, strict=True)}
    assert [tuple(r) for r in fingerprints.compare_edited(table).orderBy("doc_id").collect()] == expected


def test_fingerprints_feel_order(spark):
    words = [f"w{i}" for i in range(400)]
    halves = " ".join(words[200:] + words[:200])
    one = " ".join(words[:399] + ["new"])
    table = spark.createDataFrame([(" ".join(words), halves, one, " ".join(reversed(words)))], "a string, b string, c string, d string")
    f = {c: fingerprints.fingerprint(F.col(c)) for c in table.columns}
    near = table.select(*[fingerprints.likeness(f["a"], f[c]).alias(f"near_{c}") for c in "abcd"]).first()
    assert near.near_a == 1 and near.near_c > 0.9 and near.near_d < 0.1 and 0.2 < near.near_b < 0.8


def test_fingerprints_of_repeated_rows_and_nulls(spark, odd, none):
    made = fingerprints.compare_edited(odd).collect()
    assert len(made) == odd.count() and fingerprints.compare_edited(none).count() == 0
    by_id = defaultdict(set)
    for r in made:
        by_id[r.doc_id].add(r.fingerprint)
    assert all(len(x) == 1 for x in by_id.values()) and by_id[12] == by_id[13]
