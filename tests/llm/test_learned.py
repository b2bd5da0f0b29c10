"""Language model, packing, BPE, toxicity, language ID, SimHash and pipeline against plain Python."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lakerisk.llm import bpe, langid, lm, packing, similar, simhash, toxicity
from lakerisk.llm.bits import sieve
from lakerisk.llm.queries import QUERIES
from lakerisk.llm.text import fold


def words(text):
    return [w for w in re.findall("[^\x20\x09-\x0d]+", text or "")]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# Language model ----------------------------------------------------------------------


class SlowModel:
    """Modified Kneser-Ney bigrams in dictionaries."""

    def __init__(self, texts):
        self.uni, self.bi = Counter(), Counter()
        for t in texts:
            w = [*words(lower(t)), None]
            self.uni.update(w)
            self.bi.update(zip([None, *w[:-1]], w, strict=True))
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        of = lambda values: lm.discounts(*[sum(x == k for x in values) for k in (1, 2, 3, 4)])
        self.upper = of(self.bi.values())
        self.before, self.follow, self.total = Counter(), defaultdict(list), Counter()
        for (a, b), n in self.bi.items():
            self.before[b] += 1
            self.follow[a].append(n)
            self.total[a] += n
        self.under = of(self.before.values())
        self.left = sum(self.under[min(x, 3) - 1] for x in self.before.values()) / len(self.bi) / (self.v + 1)

    def lower_p(self, w):
        c = self.before.get(w, 0)
        return (c - self.under[min(c, 3) - 1]) / len(self.bi) + self.left if c else self.left

    def p(self, context, w):
        if context not in self.total:
            return self.lower_p(w)
        n, total = self.bi.get((context, w), 0), self.total[context]
        rest = sum(self.upper[min(x, 3) - 1] for x in self.follow[context]) / total
        return (n - self.upper[min(n, 3) - 1] if n else 0) / total + rest * self.lower_p(w)


@pytest.mark.parametrize("per_file", [1_500_000, 1000])
def test_language_model_matches_brute_force(spark, texts, per_file):
    rows = texts.select("*", F.lit("x").alias("score")).collect()
    settings = lm.Settings(per_file=per_file, text_bytes=50_000, cache=500)
    held = fold("doc_id", 7) == 2
    key = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2
    slow = SlowModel([r.text for r in rows if not key(r.doc_id)])
    for context in (None, "the", "never seen"):
        assert abs(sum(slow.p(context, w) for w in slow.uni) + slow.p(context, "unseen word") - 1) < 1e-9
    expected = []
    for r in rows:
        w = [*words(lower(r.text)), None]
        base = sum(math.log10((slow.uni.get(x, 0) + 1) / (slow.n + slow.v + 1)) for x in w)
        score = sum(math.log10(slow.p(a, b)) for a, b in zip([None, *w[:-1]], w, strict=True))
        expected.append((r.doc_id, key(r.doc_id), len(w), sum(x in slow.uni for x in w), slow.n, base, score))
    got = [tuple(r)[:7] for r in lm.score_documents(spark, texts.withColumn("score", F.lit("x")), held, settings).collect()]
    order = lambda r: (r[0] is not None, *r[:1], *r[2:])
    for a, b in zip(sorted(got, key=order), sorted(expected, key=order), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_language_model_beats_the_base_on_held_out_texts(spark, data):
    rows = [r for r in QUERIES["op1_lm_scoring"](spark, data).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_language_model_without_training_rows(spark, odd, none):
    assert lm.score_documents(spark, none, F.lit(False)).count() == 0
    got = lm.score_documents(spark, odd, F.lit(True)).collect()
    assert len(got) == odd.count() and {(r.n_known, r.train_tokens, r.score) for r in got} == {(0, 0, 0.0)}


def test_mix_is_a_bijection():
    keys = np.random.default_rng(1).integers(0, 2**63, 1000, np.uint64) * np.uint64(2) + np.uint64(1)
    assert (lm.unmix(lm.mix(keys)) == keys).all()


# Tokenizers --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digest(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("common", [65536, 50])
def test_bpe_matches_the_library(spark, texts, library, common):
    rows = texts.select("*", F.lit("x").alias("ids"), F.lit("x").alias("word"))
    noise = np.random.default_rng(3)
    strange = ["".join(chr(int(c)) for c in noise.choice([97, 98, 32, 10, 39, 115, 48, 233, 0x4E2D, 0x1F600, 33, 9, 160], 60)) for _ in range(60)]
    strange += ["a" * n for n in range(1, 40)] + ["aaab" * 9, "banana" * 12, "'s't're", "\r\n\r\n x"]
    rows = rows.unionByName(spark.createDataFrame([(5_000_000 + i, t, "", "") for i, t in enumerate(strange)], "doc_id long, text string, ids string, word string"))
    encoded, codec = bpe.encode_documents(spark, rows, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, bpe.Settings(common))
    got = Counter(tuple(r) for r in bpe.digest(encoded, codec).collect())
    assert got == Counter((r.doc_id, *digest(library, r.text)) for r in rows.collect())


def test_bpe_folds_any_word_as_the_library_does(library):
    """Random bytes of few kinds, repeats that overlap, and a run that pairwise folding would take hours for."""
    codec = bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    noise = np.random.default_rng(21)
    made = ["".join(noise.choice(list(kinds), noise.integers(1, 90))) for kinds in ("ab", "aabn", "theraingo", "éa中🙂") for _ in range(200)]
    for word in [*made, "the" * 60, "x" * 100_000]:
        assert codec.fold(word.encode()) == library._encode_single_piece(word)


def test_bpe_splits_letters_as_the_library_does(library):
    """One letter of each Unicode block, those newer than tiktoken's tables included."""
    split = bpe.splitter(public_tokenizers.PATTERN)
    letters = [chr(c) for c in range(0xA0, 0x40000, 37) if not 0xD800 <= c < 0xE000] + ["\x85", "\u2003", "\U00010940", "\U000323b0", "\u0558"]
    codec = bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    for text in (f"a{c}b 1{c}2 {c}{c} !{c}s  {c}\n" for c in letters):
        words = split(text)
        assert "".join(words) == text and [i for w in words for i in codec.fold(w.encode())] == library.encode_ordinary(text)


def test_bpe_of_no_rows(spark, none):
    encoded, codec = bpe.encode_documents(spark, none, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert bpe.digest(encoded, codec).count() == 0


def test_packing_holds_every_id_once(spark, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    rows = texts.select("*", F.lit("x").alias("ids"), F.lit("x").alias("start")).collect()
    want = Counter((r.doc_id, tuple(t.encode(r.text or "", add_special_tokens=False).ids) + (1,)) for r in rows)
    pieces = packing.pack(texts.withColumns({"ids": F.lit("x"), "start": F.lit("x")}), path).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    assert all(p.offset == 0 and p.length == len(p.ids) <= 2048 and p.length & (p.length - 1) == 0 for p in pieces)
    assert all(p.ids_crc32 == zlib.crc32(struct.pack(f"<{p.length}I", *p.ids)) for p in pieces)
    docs, got = [], Counter()
    for p in pieces:  # the pieces of a row follow each other
        if p.start == 0:
            docs.append((p.doc_id, p.doc_tokens, []))
        assert docs[-1][0] == p.doc_id and p.start == len(docs[-1][2])
        docs[-1][2].extend(p.ids)
    for doc_id, n, ids in docs:
        assert len(ids) == n
        got[doc_id, tuple(ids)] += 1
    assert got == want
    assert packing.pack(texts.limit(0), path).count() == 0


def test_encoder_cuts_only_where_it_may():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, whole = packing.Encoder(path, 100), Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    noise = np.random.default_rng(5)
    chars = [97, 66, 32, 32, 32, 10, 9, 39, 115, 48, 233, 0x2003, 0xA0, 0x4E2D, 33, 0x1C, 0x85, 0x200B]
    for text in ["", " ", "  a", "a  ", " a b ", *("".join(chr(int(c)) for c in noise.choice(chars, 30)) for _ in range(3000))]:
        assert "".join(encoder.cut(text)) == text
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_query_reads_added_tokens_as_the_library_does(spark, tmp_path):
    """Against the library at its default setting."""
    planted = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y  <|endoftext|> ", "<|endoftext", "no \n <|endoftext|>\n\n it's <|ENDOFTEXT|>", "", None]
    noise = np.random.default_rng(9)
    planted += ["".join(noise.choice(["<|endoftext|>", " ", "  ", "word", "\n", "<|", "é", "'s"], 12)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(planted)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(planted)}
    for packed in (QUERIES["op5_packing"](spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, str(tmp_path))):
        rows = packed.collect()
        assert {r.doc_id for r in rows} == set(ids)
        for r in rows:
            own = ids[r.doc_id]
            assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *own[r.start : r.start + r.length]))


@pytest.mark.parametrize("n,lengths", [(1, [1]), (2048, [2048]), (2049, [2048, 1]), (7, [4, 2, 1]), (4096 + 1025, [2048, 2048, 1024, 1])])
def test_piece_lengths(n, lengths):
    assert packing.piece_lengths(n, 2048) == lengths


# Toxicity ----------------------------------------------------------------------------


def test_toxicity_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    made = QUERIES["op6_toxicity"](spark, d).filter("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    hits = Counter((r.toxic, r.predicted) for r in made.collect())
    assert hits[1, 1] / (hits[1, 1] + hits[1, 0]) > 0.9 and hits[0, 1] <= 0.03 * hits[0, 0]


@pytest.fixture(scope="module")
def toxic_model(spark):
    clean = "the thing and other words of no harm stand in this sentence with some more of them".split()
    noise = np.random.default_rng(11)
    said = lambda n: " ".join(noise.choice(clean, n))
    rows = [(i, said(20), 0) for i in range(400)]
    rows += [(1000 + i, f"{said(8)} {('idiot', 'stupid', 'moron')[i % 3]} {said(8)}", 1) for i in range(120)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return toxicity.fit(spark, docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))


@pytest.mark.parametrize(
    "said",
    ["idiot", "1d10t", "i d i o t", "s.t.u.p.i.d", "stuuuupid", "$tup1d!", "IIDDIIOOTT", "m0r0n", "an 1d!ot.", "s t u p i d", "st*pid", "i-d-i-o-t", "(moron)", "mmooorrroonn"],
)
def test_hidden_words_are_restored(toxic_model, said):
    assert toxic_model.score(f"the other thing, {said} and words") >= 0.3


@pytest.mark.parametrize(
    "said",
    ["nice,idiot", "nice/idiot", "the—idiot", "thing,1d10t,other", "other/m0r0n", "thing:idiot;words", "_".join(["thing"] * 100 + ["idiot"]), ".".join(["other"] * 100 + ["m0r0n"] + ["words"] * 50), ",".join(["thing"] * 200 + ["$tup1d"])],
)
def test_words_in_long_and_joined_tokens_are_found(toxic_model, said):
    assert toxic_model.score(f"the other thing {said} words") >= 0.3


def test_toxicity_learns_from_every_labelled_row(spark):
    """No class is cut, however many rows it has: a word of the last of 30,000 clean texts is counted."""
    labels = spark.range(30_000).selectExpr("id as doc_id", "0 as toxic")
    docs = labels.selectExpr("doc_id", "concat('clean words of text ', doc_id) as text")
    learned = toxicity._learned(docs, labels)
    assert learned.count() == labels.filter("crc32(cast(doc_id as string)) % 4 <> 2").count() > 20_000


@pytest.mark.parametrize("step", [1, 2**40, -3])
def test_texts_stay_where_they_are_while_labels_are_found(spark, step, monkeypatch):
    """Repeated rows, null and repeated labels; by bits where ids lie close, by shuffle where they do not."""
    monkeypatch.setattr(toxicity, "MOST_PIECES", 30)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        ids = [i * step for i in range(200)]
        docs = spark.createDataFrame([(i, f"text {i}") for i in [*ids, *ids[:20], None]] + [(ids[50], None)], "doc_id long, text string")
        told = [(i, k % 2) for k, i in enumerate(ids[:150])] + [(ids[4], 1), (ids[6], None), (None, 1), (ids[90], 2)]
        learned = toxicity._learned(docs, spark.createDataFrame(told, "doc_id long, toxic int"))
        toxic = {i: max(t for j, t in told if j == i and t is not None) == 1 for i in ids[:150]}
        of = lambda i: zlib.crc32(str(i).encode()) % 4
        want = Counter((f"text {i}", toxic[i]) for i in [*ids, *ids[:20]] if i in toxic and of(i) != 2)
        assert Counter((r.text, r.toxic == 1) for r in learned.collect()) == want
        assert ("SortMergeJoin" in learned._jdf.queryExecution().executedPlan().toString()) == (step == 2**40)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sieve_keeps_all_wanted_rows_and_few_others(spark):
    rows = spark.range(40_000).selectExpr("if(id = 7, null, id) as doc_id", "id as n")
    wanted = rows.filter("n % 100 = 7").select("doc_id")
    kept = {r.n for r in sieve(rows, wanted, "doc_id").collect()}
    assert {n for n in range(40_000) if n % 100 == 7} <= kept and len(kept) < 400 + 40_000 / 16
    assert sieve(rows, wanted.limit(0), "doc_id").count() == 0


def test_tokens_without_letters_are_decoded(spark):
    """A word that digits and signs alone can spell."""
    noise = np.random.default_rng(11)
    clean = "the thing and other words of no harm stand in this sentence with some more of them".split()
    rows = [(i, " ".join(noise.choice(clean, 20)), 0) for i in range(400)]
    rows += [(1000 + i, f"{' '.join(noise.choice(clean, 8))} sless {' '.join(noise.choice(clean, 8))}", 1) for i in range(120)]
    model = toxicity.fit(spark, spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    assert model.score("the other sless thing") >= 0.3
    assert model.score("the other 51355 thing") >= 0.3 and model.score("the other $1€5$ thing") >= 0.3
    assert model.score("the other 2024 thing, 10,000 and 3.5") < 0.3


@pytest.mark.parametrize("said", ["", None, "the other 123 words 4-5", "a b c d e f", "x" * 100_000, "1 2 3 4 5 6", "!!! $$$ ***", "thing thing", "10% of 3.5"])
def test_clean_texts_stay(toxic_model, said):
    assert 0 <= toxic_model.score(said) < 0.3


def test_decoding_finds_the_best_path(toxic_model):
    """Viterbi against all paths of short lattices."""
    from itertools import product

    spelling, settings = toxic_model.spelling, toxic_model.settings
    for word in ("1d10t", "m0r0nn", "s7up1d"):
        steps = toxicity.lattice(word, settings)

        def value(path):
            made, total = "", 0.0
            context = "^^"
            for out, cost in (*path, ("^", 0.0)):
                total += cost
                for c in out:
                    total += spelling.log_p(context, c)
                    context = "^^" if c == "^" else context[1] + c
                made += out
            return total, made.strip("^")

        assert spelling.decode(steps) == max(map(value, product(*steps)))[1]


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (6, 0, "x"), (None, 1, "x"), (7, None, "x"), (99, 1, "x")], "doc_id long, toxic int, text string")
    for told in (labels, labels.limit(0)):
        got = toxicity.judge(spark, odd, told).collect()
        assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
        kept = toxicity.keep_clean(spark, odd, told)
        assert kept.columns == odd.columns and kept.count() == sum(r.predicted == 0 for r in got)
    assert toxicity.judge(spark, none, labels).count() == 0


# Language ID -------------------------------------------------------------------------


def test_language_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    made = QUERIES["op7_language_id"](spark, d).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in made) / len(made) > 0.95
    kept = langid.keep_known(spark, docs)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * docs.count()


def test_nearest_centroid_is_brute_force_cosine(spark, documents):
    model = langid.fit(spark, documents)
    texts = [r.text for r in documents.limit(20).collect()]
    best, similar = model.nearest(texts)
    for text, k, s in zip(texts, best, similar, strict=True):
        v = np.log1p(langid.counts(text)) * model.idf
        cosines = [float(v @ c / np.linalg.norm(v) / np.linalg.norm(c)) for c in model.centroids]
        assert max(cosines) == pytest.approx(s, abs=1e-5) and cosines[k] == pytest.approx(max(cosines), abs=1e-5)
    assert max(Counter(model.langs).values()) > 1
    assert sum(langid.counts("ab")) == 4 + 3 + 2


def test_language_of_odd_rows(spark, documents, odd, none):
    got = langid.identify(spark, odd).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert all((r.lang_pred == "und") == (r.doc_id in (2, 3, 4, 14) and r.doc_id != 14) for r in got if r.doc_id)
    assert {r.lang_pred for r in langid.identify(spark, odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(spark, none).count() == 0 and langid.keep_known(spark, none).count() == 0
    model = langid.fit(spark, documents)
    far = spark.createDataFrame([("Съешь же ещё этих мягких французских булок да выпей чаю",), ("123 456",)], "text string")
    assert all(r.rejected for r in langid.predict(far, model, ["text"]).collect())


# SimHash -----------------------------------------------------------------------------


def slow_simhash(text):
    w = words(lower(text))
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(ids, pairs):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_duplicates_match_all_pairs(spark, texts):
    rows = texts.withColumns({"fp": F.lit("x"), "root": F.lit("x")})
    prints = {r.doc_id: slow_simhash(r.text) for r in rows.collect() if r.doc_id is not None}
    pairs = [(a, b) for a, b in combinations(sorted(prints), 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    found = smallest(prints, pairs)
    for r in simhash.near_duplicates(spark, rows).collect():
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", found[r.doc_id])
        else:
            assert r.component_id in found.values()


def test_links_of_planted_fingerprints(spark):
    """Chains, groups around one point and far values, against all pairs."""
    noise = np.random.default_rng(7)
    fps = [int(x) for x in noise.integers(0, 2**63, 40)]
    for base in list(fps[:8]):
        for k in (1, 2, 3, 4, 5, 6, 9):
            x = base
            for b in noise.choice(64, k, replace=False):
                x ^= 1 << int(b)
            fps.append(x)
    chain = fps[20]
    for i in range(0, 60, 4):
        chain ^= 15 << i
        fps.append(chain)
    signed = sorted({x - (1 << 64) if x >> 63 else x for x in fps})
    table = spark.createDataFrame([(x,) for x in signed], "fp long")
    near = [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    links = simhash.links(spark, table)
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 4 for r in links.collect())
    roots = {r.node: r.root for r in simhash.components(spark, links).collect()}
    expected = smallest(signed, near)
    assert {x: roots.get(x, x) for x in signed} == expected


def test_one_of_each_keeps_one_row_per_group(spark, odd, none):
    kept = simhash.one_of_each(spark, odd)
    assert kept.columns == odd.columns and simhash.one_of_each(spark, none).count() == 0
    ids = sorted(r.doc_id for r in kept.collect())
    groups = {r.component_id for r in simhash.near_duplicates(spark, odd).collect()}
    assert ids == sorted(groups)
    bare = odd.withColumn("doc_id", F.lit(None).cast("long"))
    assert simhash.one_of_each(spark, bare).count() == len(groups)


# Pipeline ----------------------------------------------------------------------------


def test_near_duplicate_stage_goes_by_five_word_similarity(spark, data):
    """Edited copies at 0.6 to 1, and a large group around one text, against all pairs."""
    noise = np.random.default_rng(13)
    vocabulary = [f"w{i}" for i in range(3000)]
    docs: list[list[str]] = []
    for i in range(40):
        text = list(noise.choice(vocabulary, 150))
        for edits in (0, 1, 2, 3, 4, 5, 6, 9) if i else (0, *[k % 4 for k in range(120)]):
            edited = list(text)
            for at in noise.choice(len(edited), edits, replace=False):
                edited[at] = f"x{noise.integers(1_000_000)}"
            docs.append(edited)
    order = noise.permutation(len(docs))
    sets = {int(i): {tuple(d[k : k + 5]) for k in range(len(d) - 4)} for i, d in zip(order, docs, strict=True)}
    near = [(a, b) for a, b in combinations(sorted(sets), 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    expected = set(smallest(sorted(sets), near).values())
    assert 40 < len(expected) < len(docs) - 100
    table = spark.createDataFrame([(int(i), " ".join(d)) for i, d in zip(order, docs, strict=True)], "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, table, data).collect()
    assert sorted(r.doc_id for r in kept) == sorted(expected)


@pytest.mark.parametrize(("own", "shared"), [(28, 4), (26, 1)])
def test_near_duplicate_stage_in_groups_of_one_template(spark, data, own, shared):
    """Pairs just above 0.8 in a group whose other texts are just below: none is lost, none is added."""
    noise = np.random.default_rng(14)
    template = [f"t{i}" for i in range(200)]
    docs = []
    for _ in range(150):
        both = [f"p{x}" for x in noise.integers(10**15, size=shared)]
        docs += [template + both + [f"o{x}" for x in noise.integers(10**15, size=own - shared)] for _ in range(2)]
    sets = {i: set(d) for i, d in enumerate(docs)}
    near = [(a, b) for a, b in combinations(sets, 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    assert near == [(i, i + 1) for i in range(0, 300, 2)]
    table = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    kept = similar.one_of_each(spark, table, similarity=0.8, size=1).collect()
    assert sorted(r.doc_id for r in kept) == list(range(0, 300, 2))


def test_near_duplicate_stage_finds_pairs_that_share_no_band(spark):
    """Every pair at 0.8 is a link, also those of which no MinHash band agrees."""
    noise = np.random.default_rng(15)
    docs = []
    for _ in range(12_000):
        both = [f"s{x}" for x in noise.integers(10**15, size=8)]
        pair = [" ".join([*both, f"o{noise.integers(10**15)}"]) for _ in range(2)]
        one, two = (set(similar.bands(similar.shingle_set(text, 1))) for text in pair)
        if not one & two:
            docs += pair
    assert len(docs) >= 4
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    kept = similar.one_of_each(spark, table, similarity=0.8, size=1).collect()
    assert sorted(r.doc_id for r in kept) == list(range(0, len(docs), 2))


def test_steps_before_whole_sets_lose_nothing(spark, monkeypatch):
    """Coarse forms share no less than the sets do, and each shingle of two prefixes is found."""
    noise = np.random.default_rng(17)
    tight = [np.unique(noise.integers(0, 2**48, 300).astype(np.uint64)) for _ in range(20)]
    for one, two in combinations(tight, 2):
        forms = similar.coarse(one).tolist(), similar.coarse(two).tolist()
        assert [len(set(f)) for f in forms] == [len(one), len(two)]
        assert len(set(forms[0]) & set(forms[1])) >= len(np.intersect1d(one, two))
    assert similar.coarse(np.empty(0, np.uint64)).tolist() == []
    monkeypatch.setattr(similar, "AT_ONCE", 700)
    lists = [np.unique(noise.integers(-3000, 3000, noise.integers(0, 40))).tolist() for _ in range(200)]
    made = spark.createDataFrame([(x,) for x in lists], "prefix array<long>").repartition(3)
    times = np.unique(np.concatenate(lists), return_counts=True)
    assert sorted(r.token for r in similar._common(spark, made).collect()) == times[0][times[1] > 1].astype(int).tolist()
    assert similar._common(spark, made.limit(0)).count() == 0


@pytest.mark.parametrize("often", [1, 10**9])
def test_pairs_do_not_depend_on_which_shingles_are_called_frequent(spark, monkeypatch, often):
    """All pairs of texts with a passage in common, by one order of the shingles or another."""
    noise = np.random.default_rng(16)
    monkeypatch.setattr(similar, "WATCHED", 1)
    monkeypatch.setattr(similar, "OFTEN", often)
    passage = [f"p{i}" for i in range(60)]
    docs = [passage[: noise.integers(40, 60)] + [f"o{x}" for x in noise.integers(40, size=noise.integers(1, 14))] for _ in range(120)]
    sets = {i: set(d) for i, d in enumerate(docs)}
    near = [(a, b) for a, b in combinations(sets, 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    table = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    ids = {r.fp: r.doc_id for r in similar.keys(table).collect()}
    linked = [(ids[r.a], ids[r.b]) for r in similar.links(spark, table, 0.8, 1).collect()]
    assert set(map(frozenset, linked)) <= set(map(frozenset, near))
    assert smallest(list(sets), linked) == smallest(list(sets), near)


def test_stages_follow_each_other(spark, data, documents):
    docs = documents.withColumn("score", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, data)
        assert after.columns == docs.columns
        kept, before = after.collect(), docs.collect()
        assert set(kept) <= set(before), name
        assert {r.doc_id for r in kept}
        docs = spark.createDataFrame(kept, docs.schema)
    expected = sorted((p.doc_id, p.start, p.length, p.ids_crc32) for p in corpus_pipeline.pack(spark, docs, data).collect())
    got = sorted((p.doc_id, p.start, p.length, p.ids_crc32) for p in corpus_pipeline.run(spark, data).collect())
    assert got == expected and len({p[0] for p in got}) == docs.count()


def test_pipeline_of_odd_and_no_rows(spark, data, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, data)
            assert after.columns == odd.columns and after.count() <= docs.count()
        assert corpus_pipeline.pack(spark, docs, data).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
