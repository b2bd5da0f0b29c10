"""Interpolated modified Kneser-Ney bigram model in sorted hash arrays.

Spark counts words and pairs of words. The counts lie in files under the shared
scratch folder, each a sorted array of hashes with arrays of numbers beside it, cut
by the hashes' leading bits. Workers map the files into memory and search them; nothing
of the model passes through the driver but a few totals.

A word's id is its place in the sorted word hashes. A pair's hash is its two ids mixed by
a bijection, so pairs do not collide. The end of a text is a token, and is the context
of a text's first word.
"""

import os
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.llm.text import fold, whole
from lakerisk.session import scratch_path
from lakerisk.sources.tables import staged

END = b" "  # no word holds a space
U = np.uint64


@dataclass(frozen=True)
class Settings:
    """Entries to a file (bounds what a task holds), bytes of text handled at once, words a task remembers."""

    per_file: int = 1_500_000
    text_bytes: int = 4_000_000
    cache: int = 300_000


SETTINGS = Settings()


def tokenize(text: bytes) -> list[bytes]:
    """Words, ASCII letters in lower case: bytes know no other case and only the six ASCII spaces."""
    return text.lower().split()


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 7)


def mix(key: np.ndarray) -> np.ndarray:
    """Bijection of 64 bits that spreads neighbours."""
    with np.errstate(over="ignore"):
        key = (key ^ (key >> U(31))) * U(0x7FB5D329728EA185)
        key = (key ^ (key >> U(27))) * U(0x81DADEF4BC2DD44D)
    return key ^ (key >> U(33))


def unmix(key: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = (key ^ (key >> U(33))) * U(pow(0x81DADEF4BC2DD44D, -1, 1 << 64))
        key = (key ^ (key >> U(27)) ^ (key >> U(54))) * U(pow(0x7FB5D329728EA185, -1, 1 << 64))
    return key ^ (key >> U(31)) ^ (key >> U(62))


def _file_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U(64 - bits)).astype(np.int32) if bits else np.zeros(len(hashes), np.int32)


def _bits(entries: int, per_file: int) -> int:
    return max(0, (max(1, entries) - 1) // per_file).bit_length()


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Whole or not at all: a task that is run again leaves the same file."""
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}-{os.getpid()}-{os.urandom(4).hex()}.npy"
    np.save(part, array)
    os.replace(part, f"{folder}/{name}.npy")


class Arrays:
    """Arrays of one kind, cut into files; mapped when first used."""

    def __init__(self, folder: str, bits: int) -> None:
        self.folder, self.bits, self.open = folder, bits, {}

    def part(self, file: int, name: str) -> np.ndarray:
        key = (file, name)
        if key not in self.open:
            path = f"{self.folder}/{name}-{file}.npy"
            self.open[key] = np.load(path, mmap_mode="r") if os.path.exists(path) and os.path.getsize(path) > 128 else None
        return self.open[key]

    def find(self, ordered: np.ndarray) -> list[tuple[slice, int, np.ndarray, np.ndarray]]:
        """For sorted hashes: (their slice, file, places in it, found?) of each file they fall in."""
        out = []
        files = _file_of(ordered, self.bits)
        edges = np.concatenate(([0], np.flatnonzero(np.diff(files)) + 1, [len(files)]))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            keys = self.part(int(files[a]), "keys") if b > a else None
            if keys is not None:
                at = np.minimum(np.searchsorted(keys, ordered[a:b]), len(keys) - 1)
                out.append((slice(a, b), int(files[a]), at, keys[at] == ordered[a:b]))
        return out


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the totals. ``offsets``: the id of each word file's first word."""

    folder: str
    settings: Settings
    word_bits: int
    pair_bits: int
    offsets: tuple[int, ...]
    tokens: int
    distinct: int
    discounts: tuple[float, float, float]
    unknown: float

    def words(self) -> Arrays:
        return Arrays(f"{self.folder}/words", self.word_bits)

    def pairs(self) -> Arrays:
        return Arrays(f"{self.folder}/pairs", self.pair_bits)


class Ids:
    """Ids of words, by the mapped arrays; -1 for words that were not in training."""

    def __init__(self, arrays: Arrays, offsets: tuple[int, ...], cache: int) -> None:
        self.arrays, self.offsets, self.cache, self.known = arrays, offsets, cache, {}

    def of(self, texts: list[list[bytes]]) -> np.ndarray:
        """Ids of all words in order, each text closed by the end token."""
        if len(self.known) > self.cache:
            self.known.clear()
        known = self.known
        new = list({w for text in [*texts, [END]] for w in text if w not in known})
        if new:
            hashes = np.fromiter(map(_hash, new), U, len(new))
            order = np.argsort(hashes)
            ids = np.full(len(new), -1, np.int64)
            for part, file, at, hit in self.arrays.find(hashes[order]):
                ids[order[part]] = np.where(hit, at + self.offsets[file], -1)
            known.update(zip(new, ids.tolist(), strict=True))
        get, end = known.__getitem__, known[END]
        return np.array([i for text in texts for i in (*map(get, text), end)], np.int64)


def _portions(batches, size: int):
    """(first columns, token lists) of about ``size`` bytes of text; text is the last column, binary."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        rest = batch.drop_columns([batch.schema.names[-1]]) if batch.num_columns > 1 else None
        start, held = 0, 0
        ends = []
        for i, n in enumerate(pa.compute.binary_length(texts).to_pylist()):
            held += n
            if held >= size:
                ends.append(i + 1)
                held = 0
        for end in [*ends, batch.num_rows]:
            if end > start:
                yield (rest.slice(start, end - start) if rest else None), [tokenize(t) for t in texts[start:end].to_pylist()]
            start = end


def _count_words(batches):
    held: dict[bytes, int] = {}

    def out():
        hashes = np.fromiter(map(_hash, held), U, len(held))
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(list(held.values()), pa.int64())], ["h", "n"])
        held.clear()

    for _, texts in _portions(batches, 1_000_000):
        for text in texts:
            for w in text:
                held[w] = held.get(w, 0) + 1
        held[END] = held.get(END, 0) + len(texts)
        if len(held) > 400_000:
            yield from out()
    if held:
        yield from out()


def _train_words(spark: SparkSession, train: DataFrame, folder: str, s: Settings) -> tuple[int, tuple[int, ...], int, int]:
    counted = staged(spark, train.mapInArrow(_count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "words")
    total = counted.agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).first()
    bits = _bits(total["v"], s.per_file)

    def write(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["h"].to_numpy().view(U)
        order = np.argsort(keys)
        file = int(group["file"].iloc[0])
        _save(folder, f"keys-{file}", keys[order])
        _save(folder, f"n-{file}", group["n"].to_numpy()[order])
        return pd.DataFrame({"file": [file], "size": [len(keys)]})

    file = F.shiftrightunsigned("h", 64 - bits).cast("int") if bits else F.lit(0)
    sizes = {r["file"]: r["size"] for r in counted.withColumn("file", file).groupBy("file").applyInPandas(write, "file int, size long").collect()}
    offsets = np.concatenate(([0], np.cumsum([sizes.get(i, 0) for i in range(1 << bits)])))
    return bits, tuple(offsets[:-1].tolist()), total["n"] or 0, total["v"] or 0


def _train_pairs(train: DataFrame, words: Arrays, offsets: tuple[int, ...], folder: str, bits: int, s: Settings) -> DataFrame:
    """Writes the pair arrays. Returns per id what the files say of it: as a context the
    total and how many followers once, twice, more often; as a follower its contexts.
    Row -1 has the number of pairs seen once to four times."""

    def count(batches):
        ids = Ids(words, offsets, s.cache)
        held, size = [], 0

        def out():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            for at in range(0, len(keys), 100_000):
                part = keys[at : at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_file_of(part, bits)), pa.array(part.view(np.int64)), pa.array(n[at : at + 100_000].astype(np.int32))], ["file", "h", "n"]
                )

        for _, texts in _portions(batches, s.text_bytes):
            found = ids.of(texts)
            context = np.concatenate(([ids.known[END]], found[:-1]))
            held.append(mix((context.astype(U) << U(32)) | found.astype(U)))
            size += len(found)
            if size > 3_000_000:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    def write(group: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(group["h"].to_numpy().view(U))
        keys, n = group["h"].to_numpy().view(U)[order], group["n"].to_numpy()[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        keys, n = keys[first], np.add.reduceat(n.astype(np.int64), first)
        file = int(group["file"].iloc[0])
        _save(folder, f"keys-{file}", keys)
        _save(folder, f"n-{file}", n.astype(np.uint32))
        pair = unmix(keys)
        context, word = (pair >> U(32)).astype(np.int64), (pair & U(0xFFFFFFFF)).astype(np.int64)
        every, at = np.unique(np.concatenate([context, word]), return_inverse=True)
        c, w, size = at[: len(keys)], at[len(keys) :], len(every)
        times = [np.bincount(c, n == k, size).astype(np.int64) for k in (1, 2)]
        out = pd.DataFrame({"id": every, "total": np.bincount(c, n, size).astype(np.int64), "n1": times[0], "n2": times[1], "n3": np.bincount(c, n >= 3, size).astype(np.int64), "contexts": np.bincount(w, minlength=size)})
        tail = pd.DataFrame({"id": [-1], "total": [int((n == 1).sum())], "n1": [int((n == 2).sum())], "n2": [int((n == 3).sum())], "n3": [int((n == 4).sum())], "contexts": [len(n)]})
        return pd.concat([out, tail])

    dealt = train.mapInArrow(count, "file int, h long, n int")
    return dealt.groupBy("file").applyInPandas(write, "id long, total long, n1 long, n2 long, n3 long, contexts long")


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from the number of entries
    counted once to four times; kept within the count where a small corpus gives odd numbers."""
    if not n1 or not n2:
        return (0.5, 0.75, 0.9)
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), 0.95 * k) for k, d in enumerate(raw, 1))


def train(spark: SparkSession, docs: DataFrame, s: Settings = SETTINGS) -> Model | None:
    """Model of the texts; None if there are no rows.

    The arrays are files that tasks write, replace whole and map, so the scratch
    folder must be one that executors see as a folder (a local path or ``file:``).
    """
    folder = scratch_path(spark, "lm")
    at = urlparse(folder)
    if at.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped arrays need spark.checkpoint.dir on a mounted file system, not {at.scheme}:")
    folder = at.path
    rows = docs.select(whole("text").cast("binary").alias("text"))
    bits, offsets, tokens, distinct = _train_words(spark, rows, f"{folder}/words", s)
    if tokens == 0:
        return None
    if distinct >= 1 << 32:
        raise ValueError("a pair of ids takes 64 bits: at most 2**32 distinct words")
    words = Arrays(f"{folder}/words", bits)
    pair_bits = _bits(tokens, s.per_file)
    told = _train_pairs(rows, words, offsets, f"{folder}/pairs", pair_bits, s)
    sums = staged(spark, told.groupBy("id").agg(*[F.sum(c).alias(c) for c in ("total", "n1", "n2", "n3", "contexts")]), "ids")

    pairs = sums.filter("id = -1").first()
    upper = discounts(pairs["total"], pairs["n1"], pairs["n2"], pairs["n3"])
    kinds = sums.filter("id >= 0").agg(*[F.sum(F.when(F.col("contexts") == k, 1).otherwise(0)).alias(f"c{k}") for k in (1, 2, 3, 4)], F.sum(F.when(F.col("contexts") > 2, 1).otherwise(0)).alias("more")).first()
    lower = discounts(kinds["c1"], kinds["c2"], kinds["c3"], kinds["c4"])
    every = pairs["contexts"]
    left = (lower[0] * kinds["c1"] + lower[1] * kinds["c2"] + lower[2] * kinds["more"]) / every
    unknown = left / (distinct + 1)

    def write(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        file = int(group["file"].iloc[0])
        contexts, total = group["contexts"].to_numpy(), group["total"].to_numpy()
        cut = np.array([0.0, *lower])[np.minimum(contexts, 3)]
        rest = group[["n1", "n2", "n3"]].to_numpy() @ np.array(upper)
        _save(f"{folder}/words", f"lower-{file}", (contexts - cut) / every + unknown)
        _save(f"{folder}/words", f"total-{file}", total.astype(np.float64))
        _save(f"{folder}/words", f"rest-{file}", np.where(total > 0, rest / np.maximum(total, 1), 1.0))
        return pd.DataFrame({"file": [file], "size": [len(group)]})

    starts = F.array(*[F.lit(o).cast("long") for o in offsets])
    # Files without words share an offset with the next; the last one that starts at or before an id has it.
    placed = sums.filter("id >= 0").withColumn("file", F.size(F.filter(starts, lambda o: o <= F.col("id"))) - 1)
    placed.groupBy("file").applyInPandas(write, "file int, size long").agg(F.sum("size")).first()
    return Model(folder, s, bits, pair_bits, offsets, tokens, distinct, upper, unknown)


class Scorer:
    def __init__(self, model: Model) -> None:
        self.m = model
        self.words, self.pairs = model.words(), model.pairs()
        self.ids = Ids(self.words, model.offsets, model.settings.cache)
        self.starts = np.array(model.offsets, np.int64)

    def of_words(self, ids: np.ndarray, names: tuple[str, ...]) -> list[np.ndarray]:
        """Numbers of sorted ids (all known)."""
        out = [np.empty(len(ids)) for _ in names]
        files = np.searchsorted(self.starts, ids, side="right") - 1
        for file in np.unique(files):
            part = files == file
            for k, name in enumerate(names):
                out[k][part] = self.words.part(int(file), name)[ids[part] - self.starts[file]]
        return out

    def score(self, texts: list[list[bytes]]) -> dict[str, np.ndarray]:
        m = self.m
        ids = self.ids.of(texts)
        lengths = np.array([len(t) + 1 for t in texts])
        first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        context = np.concatenate(([0], ids[:-1]))
        context[first] = self.ids.known[END]
        known = ids >= 0

        distinct, at = np.unique(ids, return_inverse=True)
        own = distinct >= 0
        n, lower, total, rest = np.zeros(len(distinct)), np.full(len(distinct), m.unknown), np.zeros(len(distinct)), np.ones(len(distinct))
        n[own], lower[own], total[own], rest[own] = self.of_words(distinct[own], ("n", "lower", "total", "rest"))
        c_at = np.searchsorted(distinct, context)  # every context is a token here too: the end closes each text

        both = known & (context >= 0)
        hashes = mix((context[both].astype(U) << U(32)) | ids[both].astype(U))
        ordered, back = np.unique(hashes, return_inverse=True)
        counts = np.zeros(len(ordered))
        for part, file, place, hit in self.pairs.find(ordered):
            counts[part] = np.where(hit, self.pairs.part(file, "n")[place], 0)
        pair = np.zeros(len(ids))
        pair[both] = counts[back]
        cut = np.array([0.0, *m.discounts])[np.minimum(pair, 3).astype(int)]
        p = (pair - cut) / np.maximum(total[c_at], 1) + rest[c_at] * lower[at]
        base = np.log10((n[at] + 1) / (m.tokens + m.distinct + 1))
        return {
            "n_tokens": lengths,
            "n_known": np.add.reduceat(known.astype(np.int64), first),
            "base_score": np.add.reduceat(base, first),
            "score": np.add.reduceat(np.log10(p), first),
        }


def score_documents(spark: SparkSession, docs: DataFrame, held_out, s: Settings = SETTINGS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row.

    ``held_out`` is a boolean column of ``docs``; rows where it is false are learned from.
    Null text is empty and has one token, its end; repeated rows count and are scored
    each; other columns are ignored. If nothing is left to learn from, every row has no
    known token, base_score 0 (one possible token) and the same score; no rows give no rows.
    """
    rows = docs.select("doc_id", held_out.alias("held_out"), whole("text").cast("binary").alias("text"))
    model = train(spark, rows.filter(~F.col("held_out")), s)
    size = s.text_bytes

    def of(batches):
        scorer = Scorer(model) if model else None
        for rest, texts in _portions(batches, size):
            if scorer:
                made = scorer.score(texts)
            else:
                none = np.zeros(len(texts))
                made = {"n_tokens": np.array([len(t) + 1 for t in texts]), "n_known": none.astype(np.int64), "base_score": none, "score": none}
            perplexity = np.power(10.0, -made["score"] / made["n_tokens"])
            train_tokens = np.full(len(texts), model.tokens if model else 0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(made["n_tokens"]), pa.array(made["n_known"]), pa.array(train_tokens), pa.array(made["base_score"]), pa.array(made["score"]), pa.array(perplexity)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
            )

    return rows.mapInArrow(of, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
