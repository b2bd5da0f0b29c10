"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within 2r bits of each other have a point within r bits of both.
Every fingerprint emits all points of its ball of radius r; fingerprints that meet
in a point are linked. Points are dealt by their leading 16 bits, and a fingerprint is
sent once to each of the 137 leading parts its points have (r = 2), where the
task spells the 2081 points out: that moves a tenth of the bytes.
"""

from collections.abc import Callable
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.llm.bits import sieve
from lakerisk.llm.text import boxed, unboxed, whole
from lakerisk.sources.tables import staged

LEAD = 16
REST = 64 - LEAD
POINTS_AT_ONCE = 2_000_000


def shingles(text: str | None, size: int = 4) -> np.ndarray:
    """Unsigned 64-bit hashes of a text's word shingles; of a shorter text, of all its words."""
    found = (text or "").encode().lower().split()  # bytes know only ASCII letters and the six ASCII spaces
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(found) - size + 1)
    stops = ends[size - 1 :] if len(found) >= size else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:last].tolist(), stops.tolist(), strict=True)), np.uint64, last)


def simhash(text: str | None, size: int = 4) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if it is in over half of the shingles' hashes."""
    hashes = shingles(text, size)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and fp, the fingerprint's 64 bits as a signed long, of every row."""

    def of(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                values = [simhash(t) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(np.array(values, np.uint64).view(np.int64))], [*keep, "fp"]
                )

    rows = docs.select(whole("text").alias("text"), *keep)
    return rows.mapInArrow(of, T.StructType([rows.schema[c] for c in keep]).add("fp", "long"))


def _flips(bits: int, radius: int) -> list[np.ndarray]:
    """For each number of flips up to ``radius``: the masks of ``bits`` bits with that many set."""
    return [np.array([sum(1 << b for b in c) for c in combinations(range(bits), k)], np.uint64) for k in range(radius + 1)]


def _deal(radius: int):
    masks = _flips(LEAD, radius)
    lead_masks = np.concatenate(masks)
    used = np.concatenate([np.full(len(m), k) for k, m in enumerate(masks)])

    def of(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fps = batch.column(0)[at : at + 4096].to_numpy(zero_copy_only=False).view(np.uint64)
                leads = (fps >> np.uint64(REST))[:, None] ^ lead_masks[None, :]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(leads.ravel().astype(np.int32)),
                        pa.array(np.tile(used, len(fps)).astype(np.int8)),
                        pa.array(np.repeat(fps.view(np.int64), len(lead_masks))),
                    ],
                    ["lead", "flips", "fp"],
                )

    return of


def _meet(radius: int):
    rest = _flips(REST, radius)
    tails = [np.concatenate(rest[: radius - k + 1]) for k in range(radius + 1)]

    def links(lead: np.ndarray, flips: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each fingerprint with the smallest one that it meets in a point, once per pair."""
        low = np.uint64((1 << REST) - 1)
        top = lead.astype(np.uint64) << np.uint64(REST)
        points, owners = [], []
        for k, masks in enumerate(tails):
            who = np.flatnonzero(flips == k)
            points.append((top[who, None] | ((fps[who] & low)[:, None] ^ masks[None, :])).ravel())
            owners.append((who, len(masks)))
        every = np.concatenate(points)
        ordered = np.sort(every)
        shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(shared):
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        at, who = [], []
        for (rows, width), made in zip(owners, points, strict=True):
            slot = np.minimum(np.searchsorted(shared, made), len(shared) - 1)
            hit = np.flatnonzero(shared[slot] == made)
            at.append(slot[hit])
            who.append(fps[rows[hit // width]])
        slot, fp = np.concatenate(at), np.concatenate(who)
        least = np.full(len(shared), np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least, slot, fp)
        pairs = np.stack([least[slot], fp], axis=1)
        pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
        return pairs[:, 0], pairs[:, 1]

    def of(batches):
        held, size = [], 0
        weight = np.array([len(t) for t in tails])

        def flush(rows):
            a, b = links(*rows)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            lead, flips = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            fps = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            held.append((lead, flips, fps))
            size += int(weight[flips].sum())
            if size < POINTS_AT_ONCE:
                continue
            # Rows are sorted by leading part; whole parts are spelled out, the last may go on in the next batch.
            rows = [np.concatenate(x) for x in zip(*held, strict=True)]
            done = int(np.searchsorted(rows[0], rows[0][-1]))
            if done:
                yield from flush([x[:done] for x in rows])
            held = [tuple(x[done:] for x in rows)]
            size = int(weight[held[0][1]].sum())
        if held:
            yield from flush([np.concatenate(x) for x in zip(*held, strict=True)])

    return of


def links(spark: SparkSession, prints: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b) links between distinct fingerprints ``fp``, at most ``distance`` (even) bits apart.

    Fingerprints that meet in a point form a clique; each is linked to the
    smallest of it, so no group is spelled out as pairs, and every pair within the
    distance is connected through its point. Both ends are checked bit by bit.
    """
    radius = distance // 2
    dealt = prints.select("fp").distinct().mapInArrow(_deal(radius), "lead int, flips tinyint, fp long")
    met = dealt.repartition("lead").sortWithinPartitions("lead").mapInArrow(_meet(radius), "a long, b long")
    return met.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an edge (a, b).

    Alternates the two star steps: hang larger neighbours on a node's smallest
    neighbour, then smaller ones. Edges are written to the shared scratch folder
    each round; it ends when a round changes nothing.
    """
    now = staged(spark, edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        tops = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(tops, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        flat = small.unionByName(tops.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        now = staged(spark, flat, "edges")
        state = now.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")
        ).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def _grouped(spark: SparkSession, prints: DataFrame, linked: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, root, component_id) of every fingerprint."""
    prints = staged(spark, prints, "fingerprints")
    groups = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(spark, linked(groups))
    named = groups.join(roots, groups["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = staged(spark, named, "groups")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints, named.join(ids, "root").select(F.col("fp").alias("_fp"), "root", "component_id")


def near_duplicates(spark: SparkSession, docs: DataFrame, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id reachable.

    Reads doc_id and text. Null, empty and blank texts have fingerprint zero and are
    linked like any other; texts with equal fingerprints are linked; repeated rows
    each get their row; rows without doc_id get their group's smallest id, null if
    the group has none. Other columns are ignored; no rows give no rows.
    """
    prints, of = _grouped(spark, fingerprints(docs), lambda groups: links(spark, groups, distance))
    return prints.join(of, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    spark: SparkSession,
    docs: DataFrame,
    distance: int = 4,
    prints: Callable[..., DataFrame] = fingerprints,
    linked: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their group: one row with the group's
    smallest doc_id, or one row if none has an id.

    An id that one row has is enough to find the row; rows that share an id or have
    none are told apart by their text's fingerprint, made once more for them alone.
    Other names of texts than fingerprints (``prints``) and other links between them
    (``linked``) may be given.
    """
    named, of = _grouped(spark, prints(docs), linked or (lambda groups: links(spark, groups, distance)))
    rows = boxed(docs).select("_row", "doc_id", "text")
    times = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("fp"))
    single = (F.col("n") == 1) & F.col("doc_id").isNotNull()
    first = times.filter(single).join(of, F.col("fp") == F.col("_fp")).filter("doc_id = component_id").select("doc_id")
    plain = rows.join(first, "doc_id", "left_semi").select("_row")

    repeated = staged(spark, times.filter(~single).select("doc_id"), "repeated")
    shared = repeated.select(F.col("doc_id").alias("_id"))
    some = sieve(rows, repeated, "doc_id")
    odd = some.join(shared, some["doc_id"].eqNullSafe(shared["_id"]), "left_semi")
    odd = prints(odd, ("_row", "doc_id")).join(of, F.col("fp") == F.col("_fp"))
    odd = odd.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    rank = F.row_number().over(Window.partitionBy("root").orderBy(F.xxhash64("_row")))
    return unboxed(plain.unionByName(odd.withColumn("_rank", rank).filter("_rank = 1").select("_row")))
