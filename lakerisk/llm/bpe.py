"""Byte-level BPE encoding and decoding.

Spark counts the matches of the pattern over all texts; the most frequent are folded once, any other once per task. A
match's bytes are folded by ranked merges: the pair of lowest rank is joined until no pair is a token.
"""

import base64
import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.llm.text import whole
from lakerisk.sources.tables import staged

#: Letters and numbers that joined Unicode after version 16, which tiktoken's pattern goes by.
NEWER = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee "
    "11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda "
    "18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de "
    "1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)
#: Bytes up to which a word's pairs are searched one by one; those of longer ones lie in a heap.
SHORT = 64
NO_RANK = 1 << 40
#: Neither a letter, a number nor white space.
PRIVATE = "\ue000"


@dataclass(frozen=True)
class Settings:
    """The ``common`` most frequent words of the corpus are folded once; a task remembers so many others (``cache``)."""

    common: int = 65536
    cache: int = 400_000


SETTINGS = Settings()


def java_pattern(pattern: str) -> str:
    """The tokenizers' pattern for Java, whose ``\\s`` knows only ASCII."""
    return pattern.replace(r"[^\s", r"[^\p{IsWhite_Space}").replace(r"\s", r"\p{IsWhite_Space}").replace(r"\S", r"\P{IsWhite_Space}")


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Function from a text to the matches of the tokenizers' pattern, as tiktoken finds them."""
    import regex

    matches = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
    ranges = [[chr(int(x, 16)) for x in part.split("-")] for part in NEWER.split()]
    newer = re.compile(f"[{''.join('-'.join(r) for r in ranges)}]")
    # A single range is searched at a fiftieth of the time.
    maybe = re.compile(f"[{ranges[0][0]}-{ranges[-1][-1]}]")

    def split(text: str) -> list[str]:
        if maybe.search(text) and newer.search(text):
            return [text[m.start() : m.end()] for m in matches.finditer(newer.sub(PRIVATE, text))]
        return matches.findall(text)

    return split


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encodes and decodes by one rank file; tasks get a copy."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, pattern
        self.pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.pieces[rank] = token

    def fold(self, word: bytes) -> list[int]:
        """Ids of one match of the pattern: joins the pair of lowest rank, the first of equal ones, until none is a token."""
        if word in self.ranks:
            return [self.ranks[word]]
        return self._fold_short(word) if len(word) <= SHORT else self._fold_long(word)

    def _fold_short(self, word: bytes) -> list[int]:
        """Keeps the rank of each pair of neighbours beside the parts."""
        rank = self.ranks.get
        parts = [word[i : i + 1] for i in range(len(word))]
        pairs = [rank(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
        while pairs and (lowest := min(pairs)) < NO_RANK:
            at = pairs.index(lowest)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], NO_RANK)
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], NO_RANK)
        return [self.ranks[part] for part in parts]

    def _fold_long(self, word: bytes) -> list[int]:
        ranks = self.ranks
        n = len(word)
        # Where the part that begins at a byte ends (0: none begins there), and where the part before it begins.
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
        heapify(pairs)
        while pairs:
            _, start, end = heappop(pairs)
            middle = ends[start]
            if not 0 < middle < end or ends[middle] != end:
                continue  # one of the two has been joined to another since
            ends[start], ends[middle] = end, 0
            left = before[start]
            if left >= 0 and word[left:end] in ranks:
                heappush(pairs, (ranks[word[left:end]], left, end))
            if end < n:
                before[end] = start
                if word[start : ends[end]] in ranks:
                    heappush(pairs, (ranks[word[start : ends[end]]], start, ends[end]))
        return [ranks[word[start:end]] for start, end in enumerate(ends) if end]

    def packed(self, word: str) -> bytes:
        """The ids of one match as little-endian 32-bit numbers."""
        return np.array(self.fold(word.encode()), "<u4").tobytes()

    def common_words(self, spark: SparkSession, docs: DataFrame, s: Settings = SETTINGS) -> dict[str, bytes]:
        """The packed ids of the most frequent words, counted over all texts."""
        found = F.regexp_extract_all(whole("text"), F.lit(f"({java_pattern(self.pattern)})"))
        words = docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        top = staged(spark, words.orderBy(F.desc("n"), "word").limit(s.common).select("word"), "words")

        def of(batches):
            for batch in batches:
                ids = [self.packed(w) for w in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["word", "ids"])

        folded = top.repartition(spark.sparkContext.defaultParallelism).mapInArrow(of, "word string, ids binary")
        return {r["word"]: bytes(r["ids"]) for r in folded.collect()}

    def encode(self, docs: DataFrame, common: dict[str, bytes], s: Settings = SETTINGS) -> DataFrame:
        """(doc_id, ids) of every row; no ids for empty text."""

        def of(batches):
            split, known = splitter(self.pattern), dict(common)
            for batch in batches:
                for at in range(0, batch.num_rows, 128):
                    made = []
                    for text in batch.column(1)[at : at + 128].to_pylist():
                        words = split(text)
                        for word in set(words).difference(known):
                            known[word] = self.packed(word)
                        made.append(b"".join(map(known.__getitem__, words)))
                        if len(known) > len(common) + s.cache:
                            known = dict(common)
                    cuts = np.concatenate(([0], np.cumsum([len(m) // 4 for m in made])))
                    ids = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(np.frombuffer(b"".join(made), "<i4")))
                    yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + 128], ids], ["doc_id", "ids"])

        rows = docs.select("doc_id", whole("text").alias("text"))
        return rows.mapInArrow(of, T.StructType([rows.schema["doc_id"]]).add("ids", T.ArrayType(T.IntegerType())))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def encode_documents(spark: SparkSession, docs: DataFrame, rank_file: str, pattern: str, s: Settings = SETTINGS) -> tuple[DataFrame, Codec]:
    """(doc_id, ids) of every row of ``docs``, and the codec.

    Null text is empty; repeated rows are encoded each; other columns are ignored; no rows
    give no rows. Which words are common changes the time, never the ids.
    """
    codec = Codec(read_ranks(rank_file), pattern)
    return codec.encode(docs, codec.common_words(spark, docs, s), s), codec


def digest(encoded: DataFrame, codec: Codec) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, and decoded_sha256 of the bytes that the ids stand for."""
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]

    def of(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                rows = []
                for ids in batch.column(1)[at : at + 128]:
                    numbers = ids.values.to_numpy()
                    rows.append((len(numbers), hashlib.sha256(numbers.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(codec.decode(numbers.tolist())).hexdigest()))
                made = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + 128], *made], ["doc_id", *names])

    schema = T.StructType([encoded.schema["doc_id"]]).add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return encoded.select("doc_id", "ids").mapInArrow(of, schema)
