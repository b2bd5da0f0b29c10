"""Repeated passages across documents, by Rabin-Karp hashes of every window of words.

Tasks hash every window of a fixed number of words in a rolling way and keep, per run
of texts, the least document of each window; these meet in buckets by hash, where
Spark's grouping finds windows that start in several documents. The windows of all
documents but the first are marked, and marked windows of a text merge into maximal
intervals of words.

A window's name has 80 bits: two rolling sums modulo 2**64 over 128-bit hashes of the
words, one kept whole and one cut to 16 bits. Among 2.6e13 windows (some 100 TB of text)
about 300 pairs of different windows are expected to share a name, below 1e-10 of them.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.llm.text import whole
from lakerisk.sources.tables import staged

WINDOW = 50
#: Text of one bucket of window hashes, and windows that a task holds before it hands them on.
BUCKET_BYTES = 16 << 20
HELD = 1_000_000
#: Words of one text that are hashed at once.
STRETCH = 1 << 16
#: Words whose hashes a task remembers.
REMEMBERED = 1 << 17
#: Places of the filter that lets texts without repeats skip the join: the bound of what is broadcast.
PLACES = 1 << 20
#: Stands for a null id: larger than any id.
UNKNOWN = 2**63 - 1

MET = "bucket int, ids binary, texts binary, owners binary, high binary, low binary"
MARKS = "id long, text long, high long"


class _Words(dict):
    """Places of words in two tables of 64-bit hashes."""

    def __init__(self):
        self.hashes = np.empty((2, 1024), np.uint64)

    def __missing__(self, word: bytes) -> int:
        at = len(self)
        if at == self.hashes.shape[1]:
            self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)], axis=1)
        both = xxhash.xxh128_intdigest(word)
        self.hashes[0, at], self.hashes[1, at] = both & 0xFFFFFFFFFFFFFFFF, both >> 64
        self[word] = at
        return at


class _Rolling:
    """Window hashes of texts: prefix sums of word hashes times powers of an odd base;
    a difference of two sums, times the inverse power of its start, names a window."""

    BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)

    def __init__(self, window: int):
        self.window = window
        self.words = _Words()
        self.size = STRETCH + window
        self.powers = [self._powers(base) for base in self.BASES]
        self.inverse = [self._powers(pow(base, -1, 2**64)) for base in self.BASES]

    def _powers(self, base: int) -> np.ndarray:
        factors = np.full(self.size, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def _sums(self, hashes: np.ndarray, which: int) -> np.ndarray:
        n = len(hashes)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * self.powers[which][:n], dtype=np.uint64)])
        count = n - self.window + 1
        found = (sums[self.window :] - sums[:count]) * self.inverse[which][:count]
        found ^= found >> np.uint64(32)  # the low bits of a sum know only the low bits of its words
        found *= np.uint64(0xD6E8FEB86659FD93)
        return found ^ (found >> np.uint64(32))

    def hashes(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The 64 and the 16 bits of the windows of a text's words, in order."""
        if len(self.words) > REMEMBERED:
            self.words = _Words()
        high, low = [np.empty(0, np.uint64)], [np.empty(0, np.uint16)]
        for at in range(0, len(found) - self.window + 1, STRETCH):
            part = found[at : at + STRETCH + self.window - 1]
            places = np.fromiter(map(self.words.__getitem__, part), np.int64, len(part))
            high.append(self._sums(self.words.hashes[0][places], 0))
            low.append((self._sums(self.words.hashes[1][places], 1) >> np.uint64(48)).astype(np.uint16))
        return np.concatenate(high), np.concatenate(low)


def _ranked(ids: np.ndarray, texts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (id, text hash) in order, and owners as places among them."""
    order = np.lexsort((texts, ids))
    ids, texts = ids[order], texts[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (texts[1:] != texts[:-1])
    place = np.empty(len(ids), np.int64)
    place[order] = np.cumsum(new) - 1
    return ids[new], texts[new], place[owner]


def _judged(high: np.ndarray, low: np.ndarray, owner: np.ndarray, ids: np.ndarray):
    """The rows in order of window and owner, one per pair; whether each is marked, because the
    window has an owner of a smaller id (among null ids: an earlier owner)."""
    order = np.argsort(high)
    twin = np.zeros(len(high) + 1, bool)
    twin[1:-1] = high[order][1:] == high[order][:-1]
    several = np.flatnonzero(twin[1:] | twin[:-1])
    rows = order[several]
    order[several] = rows[np.lexsort((owner[rows], low[rows], high[rows]))]
    high, low, owner = high[order], low[order], owner[order]
    new = np.ones(len(high), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    least = owner[new][np.cumsum(new) - 1]
    marked = (ids[owner] > ids[least]) | ((ids[owner] == UNKNOWN) & (owner != least))
    once = new
    once[1:] |= owner[1:] != owner[:-1]
    return high[once], low[once], owner[once], marked[once]


def _per_owner(owner: np.ndarray, high: np.ndarray):
    """(owner, its window hashes as bytes), for every owner."""
    order = np.argsort(owner, kind="stable")
    owner, high = owner[order], high[order]
    cuts = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(owner)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield int(owner[a]), high[a:b].tobytes()


def _hand_on(buckets: int, window: int):
    """Arrow batches of (id, text hash, text) to rows of MET: per bucket, the windows of some
    texts with their least owner; without owners, windows of one text that are marked already."""

    def flush(held, ids, texts):
        high, low, owner = (np.concatenate(x) for x in zip(*held, strict=True))
        ids, texts, owner = _ranked(np.array(ids, np.int64), np.array(texts, np.int64), owner)
        high, low, owner, marked = _judged(high, low, owner, ids)
        rows = []
        for k, found in _per_owner(owner[marked], high[marked]):
            rows.append((int(texts[k] % buckets), ids[k : k + 1].tobytes(), texts[k : k + 1].tobytes(), None, found, None))
        high, low, owner = high[~marked], low[~marked], owner[~marked]
        bucket = (high >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[k], cuts[k + 1]
            used, at = np.unique(owner[a:b], return_inverse=True)
            rows.append((k, ids[used].tobytes(), texts[used].tobytes(), at.astype(np.uint16).tobytes(), high[a:b].tobytes(), low[a:b].tobytes()))
        yield from _batches(rows, MET_SCHEMA)

    def of(batches):
        rolling = _Rolling(window)
        held, ids, texts, size = [], [], [], 0
        for batch in batches:
            for i, name, text in zip(*(batch.column(c).to_pylist() for c in range(2)), batch.column(2), strict=True):
                high, low = rolling.hashes(text.as_py().encode().split())  # bytes know only the six ASCII spaces
                # A very long text is handed on in parts; parts of one text do not mark each other.
                for at in range(0, len(high), HELD):
                    part = high[at : at + HELD]
                    held.append((part, low[at : at + HELD], np.full(len(part), len(ids), np.int64)))
                    ids.append(i)
                    texts.append(name)
                    size += len(part)
                    if size >= HELD or len(ids) == 1 << 16:
                        yield from flush(held, ids, texts)
                        held, ids, texts, size = [], [], [], 0
        if held:
            yield from flush(held, ids, texts)

    return of


MET_SCHEMA = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("ids", "texts", "owners", "high", "low"))])
MARKS_SCHEMA = pa.schema([(c, pa.int64()) for c in ("id", "text", "high")])


def _batches(rows: list[tuple], schema: pa.Schema):
    for at in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at : at + 64], strict=True), schema, strict=True)], schema=schema)


def _mark(met: pa.Table) -> pa.Table:
    """Rows of MET of one bucket to rows of MARKS: windows whose words start in a smaller id."""
    marks, parts, ids, texts, count = [np.empty((3, 0), np.int64)], [], [], [], 0
    for row in met.to_pylist():
        own = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["texts"], np.int64)
        high = np.frombuffer(row["high"], np.uint64)
        if row["owners"] is None:
            marks.append(np.stack([np.repeat(own[0], len(high)), np.repeat(own[1], len(high)), high.view(np.int64)]))
            continue
        parts.append((high, np.frombuffer(row["low"], np.uint16), np.frombuffer(row["owners"], np.uint16).astype(np.int64) + count))
        ids.append(own[0])
        texts.append(own[1])
        count += len(own[0])
    if parts:
        high, low, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
        ids, texts, owner = _ranked(np.concatenate(ids), np.concatenate(texts), owner)
        high, low, owner, marked = _judged(high, low, owner, ids)
        # Side by side by text, so that files and shuffles repeat their names cheaply.
        order = np.argsort(owner[marked], kind="stable")
        owner = owner[marked][order]
        marks.append(np.stack([ids[owner], texts[owner], high[marked][order].view(np.int64)]))
    return pa.Table.from_arrays([pa.array(c) for c in np.concatenate(marks, axis=1)], schema=MARKS_SCHEMA)


def marked_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, text, high): a hash of each window that also starts in a smaller id; texts are named by
    doc_id (null: the largest) and their own 64-bit hash. Rows may repeat."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, min(1 << 30, -(-total // BUCKET_BYTES)))
    met = _named(docs).select("id", "name", "text").mapInArrow(_hand_on(buckets, window), MET)
    return met.groupBy("bucket").applyInArrow(_mark, MARKS)


def _named(docs: DataFrame) -> DataFrame:
    text = whole("text")
    return docs.select("doc_id", text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(UNKNOWN)).alias("id"), F.xxhash64(text).alias("name"))


def _cut(window: int):
    """Arrow batches of (doc_id, text, marked hashes) to the operator's rows."""
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])

    def of(batches):
        rolling = _Rolling(window)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n_words, removed, kept = [], [], []
                for text, marks in zip(part.column(1), part.column(2), strict=True):
                    found = text.as_py().encode().split()
                    n_words.append(len(found))
                    spans = []
                    if marks.is_valid:
                        marked = marks.values.to_numpy().view(np.uint64)
                        starts = np.flatnonzero(np.isin(rolling.hashes(found)[0], marked))
                        # Windows that touch or overlap merge.
                        if len(starts):
                            gap = np.flatnonzero(np.diff(starts) > window)
                            first, last = starts[np.concatenate(([0], gap + 1))], starts[np.concatenate((gap, [-1]))]
                            spans = list(zip(first.tolist(), (last + window).tolist(), strict=True))
                    removed.append([{"start": a, "stop": b} for a, b in spans])
                    for a, b in reversed(spans):
                        del found[a:b]
                    kept.append(b" ".join(found).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_words, pa.int64()), pa.array(removed, pa.list_(span)), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "removed", "kept"],
                )

    return of


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, removed and kept of every row: the maximal intervals (start, stop) of word
    positions that are covered by windows of ``window`` words which also start in a document with
    a smaller doc_id, and the other words joined by single spaces.

    Reads doc_id (an integer) and text. Null, empty and blank texts have no words; texts with
    fewer words than a window keep them all. A window found twice in one document alone
    stays. Rows that share an id do not mark each other; repeated rows each get their row. A
    null id counts as larger than any other, and among null ids the text of the smallest hash
    as first; the largest long counts as null. Other columns are ignored; no rows give no rows.

    Marked windows are written to the shared scratch folder. Only texts whose row may be
    marked are joined to them; the others are told apart by a broadcast table of at most
    ``PLACES`` numbers, beyond which more texts join but results stay the same.
    """
    marks = staged(spark, marked_windows(docs, window), "marks")
    place = F.pmod(F.xxhash64("id", "name"), F.lit(PLACES))
    places = F.broadcast(marks.select(F.pmod(F.xxhash64("id", "text"), F.lit(PLACES)).alias("place")).distinct())
    rows = _named(docs).withColumn("place", place)
    plain = rows.join(places, "place", "left_anti").select("doc_id", "text", F.lit(None).cast("array<long>").alias("marks"))
    sets = marks.groupBy("id", F.col("text").alias("name")).agg(F.collect_set("high").alias("marks"))
    joined = rows.join(places, "place", "left_semi").join(sets, ["id", "name"], "left").select("doc_id", "text", "marks")
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = f"doc_id {kind}, n_words long, removed array<struct<start: long, stop: long>>, kept string"
    return plain.unionByName(joined).mapInArrow(_cut(window), made)


def digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of ``remove_repeats``."""
    n = F.aggregate("removed", F.lit(0).cast("long"), lambda total, span: total + span["stop"] - span["start"])
    return removed.select("doc_id", "n_words", n.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM texts WHERE len(ws) >= 50),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS said FROM starts),
firsts AS (SELECT said, min(doc_id) AS first_id FROM windows GROUP BY said),
covered AS (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (said) WHERE first_id < doc_id),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM covered GROUP BY doc_id),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM texts),
kept AS (SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.p) AS said
         FROM words w ANTI JOIN (SELECT DISTINCT doc_id, p FROM covered) c ON w.doc_id = c.doc_id AND w.p = c.p GROUP BY w.doc_id)
SELECT t.doc_id, CAST(len(t.ws) AS BIGINT) AS n_words, CAST(coalesce(len(g.ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.said, '')) AS kept_sha256
FROM texts t LEFT JOIN gone g ON t.doc_id = g.doc_id LEFT JOIN kept k ON t.doc_id = k.doc_id
"""
