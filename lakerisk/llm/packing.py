"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the powers of two in n
(as many of the largest as fit), longest first. Pieces of one length form a bucket;
each piece is a sequence of its own, so none is padded and none crosses documents.
"""

import json
import re
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.llm.text import whole

ASCII_SPACES = "\t\n\x0b\x0c\r"
OTHER_SPACES = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: A space beside other white space.
CROWDED = ("  ", *(f" {c}" for c in ASCII_SPACES), *(f"{c} " for c in ASCII_SPACES))


#: The split of byte-level tokenizers (fixed).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Settings:
    """Longest sequence (a power of two), the id that ends a document, and words a task remembers.

    ``read_added``: the file's added tokens inside texts are their one id, as the
    tokenizers library reads them by default; else they are spelled out.
    """

    longest: int = 2048
    end_id: int = 1
    cache: int = 400_000
    read_added: bool = False


SETTINGS = Settings()
#: The ids of the tokenizers library at its default setting.
LIBRARY = Settings(read_added=True)


def piece_lengths(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of n tokens, longest first."""
    lengths = [longest] * (n // longest)
    rest, size = n % longest, longest // 2
    while rest:
        if rest >= size:
            lengths.append(size)
            rest -= size
        size //= 2
    return lengths


def byte_letters() -> dict[str, int]:
    """Byte of each letter in a byte-level vocabulary: printable bytes stand for themselves, the others follow from 256 on."""
    printable = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids by a byte-level tokenizer, with the ids of space-led words remembered.

    Its pattern never joins what stands on the two sides of a single space between
    two other characters: the space always begins a match. So a text may be cut
    there. Where a space has white space beside it, no cut is made. The file's
    ids are in the order of its merges, so tiktoken gives the ids that the tokenizers
    library gives, at a third of its time; tests compare the two. With ``read_added``
    the text is first split at the file's added tokens, and what stands between
    them is encoded as a text of its own.
    """

    def __init__(self, path: str, cache: int, read_added: bool = False) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        special = {t["content"] for t in held["added_tokens"]}
        letters = byte_letters()
        ranks = {bytes(map(letters.__getitem__, token)): i for token, i in held["model"]["vocab"].items() if token not in special}
        self.ids = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.cache, self.known = cache, {}
        self.added: dict[str, int] = {}
        if read_added:
            if any(t[flag] for t in held["added_tokens"] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError(f"{path}: added tokens that take in what stands beside them are not supported")
            self.added = {t["content"]: t["id"] for t in held["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.at_added = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self.added else None

    def parts(self, text: str) -> list[str]:
        """The parts of ``cut``; each added token is a part of its own."""
        if self.at_added is None or not self.at_added.search(text):
            return self.cut(text)
        return [p for x in self.at_added.split(text) if x for p in ([x] if x in self.added else self.cut(x))]

    def cut(self, text: str) -> list[str]:
        """Parts that are encoded one by one; joined, they are the text."""
        if " " not in text:
            return [text]
        crowded = text[0] == " " or text[-1] == " " or any(c in text for c in CROWDED)
        if not crowded and (text.isascii() or not any(c in text for c in OTHER_SPACES)):
            head, *rest = text.split(" ")
            return [head, *[" " + w for w in rest]]
        parts, start = [], 0
        at = text.find(" ", 1)
        while 0 < at < len(text) - 1:
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                parts.append(text[start:at])
                start = at
            at = text.find(" ", at + 1)
        return [*parts, text[start:]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        parts = [self.parts(t) for t in texts]
        if len(self.known) > self.cache:
            self.known.clear()
        known = self.known
        for part in set().union(*parts).difference(known):
            known[part] = array("I", [self.added[part]] if part in self.added else self.ids(part)).tobytes()
        return [b"".join(map(known.__getitem__, part)) for part in parts]


def pack(docs: DataFrame, tokenizer: str, s: Settings = SETTINGS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    ``tokenizer`` is a file that every executor has. A null text is empty and its
    document is the end id alone; every row of ``docs``, repeated or without id, is
    a document of its own. sequence_id holds the bucket (power of two), the
    partition and a count, so equal lengths stand together; offset is 0. Columns other than
    doc_id and text are ignored; no rows give no rows.
    """

    def of(batches):
        encoder = Encoder(tokenizer, s.cache, s.read_added)
        task = TaskContext.get().partitionId()
        used: dict[int, int] = {}
        for batch in batches:
            doc_ids = batch.column(0)
            for at in range(0, batch.num_rows, 128):
                part = doc_ids[at : at + 128]
                rows, starts, lengths, crcs, totals, names, pieces = [], [], [], [], [], [], []
                for i, encoded in enumerate(encoder.encode(batch.column(1)[at : at + 128].to_pylist())):
                    ids = encoded + s.end_id.to_bytes(4, "little")
                    start, total = 0, len(ids) // 4
                    for length in piece_lengths(total, s.longest):
                        piece = ids[4 * start : 4 * (start + length)]
                        bucket = length.bit_length() - 1
                        used[bucket] = used.get(bucket, -1) + 1
                        rows.append(i)
                        starts.append(start)
                        lengths.append(length)
                        crcs.append(zlib.crc32(piece))
                        totals.append(total)
                        names.append(bucket << 58 | task << 34 | used[bucket])
                        pieces.append(piece)
                        start += length
                flat = pa.array(np.frombuffer(b"".join(pieces), "<i4"))
                cuts = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.take(pa.array(rows, pa.int64())),
                        *[pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals, names, [0] * len(rows))],
                        pa.ListArray.from_arrays(cuts, flat),
                    ],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    rows = docs.select("doc_id", whole("text").alias("text"))
    schema = T.StructType([rows.schema["doc_id"]])
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"):
        schema = schema.add(name, "long")
    return rows.mapInArrow(of, schema.add("ids", T.ArrayType(T.IntegerType())))


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", F.size("ids").cast("long").alias("sequence_tokens"))
