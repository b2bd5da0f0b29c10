"""Ranked lexical search by dense blocked matrix products.

Documents are reduced to the terms that the queries hold. Tasks fill tiles of at most
``TERMS`` terms by ``DOCS`` documents with impacts and multiply them, in float64, with tiles of
query weights. A query tile is cut where a partial sum could reach 2**53, so products are
exact whatever the order of additions; tiles are added as 64-bit integers.
"""

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakerisk.llm.text import whole
from lakerisk.sources.tables import staged

TERMS = 1024
DOCS = 1024
#: Queries and their bytes of text per pass over the documents.
ITEMS = 512
ITEM_BYTES = 4 << 20
#: An impact is below 1000000, so a tile's weights of one query may add up to this much.
WEIGHTS = (2**53 - 1) // 1_000_000

#: Fixed values of the score: thousandths of the weight, impact's scale, saturation and length shares.
SCALE, IMPACT, SATURATION, SHARE = 1000, 1_000_000_000, 8, 75

_BETWEEN = bytes(b for b in range(128) if chr(b) not in string.ascii_letters + string.digits)
_FOLDED = bytes.maketrans(_BETWEEN + string.ascii_uppercase.encode(), b" " * len(_BETWEEN) + string.ascii_lowercase.encode())


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all other characters beyond ASCII; only A-Z lower-cased."""
    return (text or "").encode().translate(_FOLDED).split()


def _held(vocabulary: dict[bytes, int]):
    """Arrow batches of (doc_id, text) to doc_id, n and the query terms held, with their counts."""

    def of(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                lengths, held, counts = [], [], []
                for text in part.column(1):
                    found = terms(text.as_py())
                    lengths.append(len(found))
                    places = np.array([vocabulary[t] for t in found if t in vocabulary], np.int32)
                    places, often = np.unique(places, return_counts=True)
                    held.append(places)
                    counts.append(often)
                columns = [pa.array(lengths, pa.int64()), pa.array(held, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "n", "terms", "counts"])

    return of


def query_tiles(weights: list[dict[int, int]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Tiles of (terms, query places, columns, weights) for queries given as term -> weight.

    A weight that is too large for one tile is spread over several.
    """
    by_term: dict[int, list[tuple[int, int]]] = {}
    for item, held in enumerate(weights):
        for term, weight in held.items():
            if weight:
                by_term.setdefault(term, []).append((item, weight))
    tiles, sums, tile = [], {}, []

    def close():
        if tile:
            rows = [(item, at, weight) for at, (_, entries) in enumerate(tile) for item, weight in entries]
            items, places, values = zip(*rows, strict=True)
            tiles.append((np.array([t for t, _ in tile]), np.array(items), np.array(places), np.array(values, np.float64)))
            tile.clear()
            sums.clear()

    for term in sorted(by_term):
        left = by_term[term]
        while left:
            if len(tile) == TERMS or any(sums.get(item, 0) + min(weight, WEIGHTS) > WEIGHTS for item, weight in left):
                close()
            now = [(item, min(weight, WEIGHTS)) for item, weight in left]
            for item, weight in now:
                sums[item] = sums.get(item, 0) + weight
            tile.append((term, now))
            left = [(item, weight - WEIGHTS) for item, weight in left if weight > WEIGHTS]
    close()
    return tiles


def _best(rows: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """Of rows (item, score, null id, doc_id) the first k of each item: highest score, then smallest id."""
    item, score, unknown, doc = rows
    order = np.lexsort((doc, unknown, -score, item))
    item = item[order]
    starts = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1]))) if len(item) else np.empty(0, np.int64)
    rank = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
    return tuple(x[order[rank < k]] for x in rows)


def _multiply(tiles: list, n_items: int, n_terms: int, documents: int, length: int, k: int):
    """Arrow batches of ``_held`` to each task's best documents of every query."""

    def scores(part: pa.RecordBatch) -> np.ndarray:
        n = part.column("n").to_pylist()
        # 64-bit integers by contract; Python's own never overflow on the way.
        m = np.array([100 - SHARE + (SHARE * x * documents) // length for x in n], np.int64)
        held, counts = part.column("terms"), part.column("counts")
        doc = np.repeat(np.arange(len(n)), np.diff(held.offsets.to_numpy()))
        term, often = held.flatten().to_numpy(), counts.flatten().to_numpy()
        impact = (IMPACT * often) // (SCALE * often + SATURATION * m[doc])
        place = np.full(n_terms, -1, np.int64)
        total = np.zeros((n_items, len(n)), np.int64)
        for names, items, places, values in tiles:
            # Only columns of terms that some document of the tile holds.
            place[names] = np.arange(len(names))
            at = place[term]
            inside = at >= 0
            present, column = np.unique(at[inside], return_inverse=True)
            compact = np.full(len(names), -1, np.int64)
            compact[present] = np.arange(len(present))
            place[names] = -1
            if not len(present):
                continue
            documents_tile = np.zeros((len(present), len(n)))
            documents_tile[column, doc[inside]] = impact[inside]
            used = compact[places] >= 0
            queries_tile = np.zeros((n_items, len(present)))
            queries_tile[items[used], compact[places[used]]] = values[used]
            total += (queries_tile @ documents_tile).astype(np.int64)
        return total

    def of(batches):
        best = tuple(np.empty(0, kind) for kind in (np.int32, np.int64, np.int8, np.int64))
        least = np.ones(n_items, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                part = batch.slice(at, DOCS)
                total = scores(part)
                # A score that only ties the k-th best may still win by its id.
                item, column = np.nonzero(total >= least[:, None])
                ids = part.column("doc_id")
                unknown = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int8)
                known = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                more = item.astype(np.int32), total[item, column], unknown[column], known[column]
                best = _best(tuple(np.concatenate(x) for x in zip(best, more, strict=True)), k)
                found = np.bincount(best[0], minlength=n_items)
                full = np.flatnonzero(found >= k)
                least[full] = best[1][np.cumsum(found)[full] - 1]
        doc = pa.array(best[3], mask=best[2] == 1)
        yield pa.RecordBatch.from_arrays([pa.array(best[0]), pa.array(best[1]), doc], ["item", "score", "doc_id"])

    return of


def _search_block(spark: SparkSession, docs: DataFrame, items: list, k: int) -> DataFrame:
    """The k best documents of a bounded list of queries (item row, text)."""
    held = [terms(text) for _, text in items]
    names = sorted({t for found in held for t in found})
    vocabulary = {t: i for i, t in enumerate(names)}
    tables = staged(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text")).mapInArrow(_held(vocabulary), "doc_id long, n long, terms array<int>, counts array<long>"), "held")
    size = tables.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
    n, length = size["documents"], size["length"] or 1
    # As many rows as the queries have distinct terms.
    df = {r["term"]: r["n"] for r in tables.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = {t: int(np.floor(SCALE * np.log((2 * n + 2) / (2 * f + 1)))) for t, f in df.items()}
    weights = []
    for found in held:
        mine: dict[int, int] = {}
        for t in found:
            at = vocabulary[t]
            mine[at] = mine.get(at, 0) + weight.get(at, 0)
        weights.append(mine)
    tiles = query_tiles(weights)
    found = tables.filter(F.size("terms") > 0).mapInArrow(_multiply(tiles, len(items), len(names), n, length, k), "item int, score long, doc_id long")

    # First the best of some tasks each, so that no sort holds all tasks' rows of a query.
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("item", "task").orderBy(*order)
    first = found.withColumn("task", F.spark_partition_id() % 64).withColumn("r", F.row_number().over(some)).filter(F.col("r") <= k)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    ids = spark.createDataFrame([(i, row) for i, (row, _) in enumerate(items)], "item int, item_id long")
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def search(spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id and score: the k documents of highest score above 0 for every query.

    Reads doc_id and text of ``docs``, item_id and text of ``queries`` (ids are integers). Null and
    empty texts hold no terms: such documents are not counted and never found, such
    queries find nothing. Equal scores go by ascending doc_id, null last; repeated rows of documents
    are found once each, repeated rows of queries each get their ranks. Other columns are
    ignored; no documents or no queries give no rows.

    Queries are dealt by chance into blocks of some ``ITEMS`` rows and ``ITEM_BYTES`` of text,
    each a pass over all documents. A block's terms and weights go to every task.
    """
    stored = staged(spark, queries.select(F.col("item_id").cast("long").alias("item_id"), whole("text").alias("text"), F.monotonically_increasing_id().alias("at")), "queries")
    size = stored.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // ITEMS), -(-(size["bytes"] or 0) // ITEM_BYTES))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in range(blocks):
        rows = stored.filter(F.pmod(F.xxhash64("at"), F.lit(blocks)) == block).orderBy("at").collect()
        if rows:
            found = _search_block(spark, docs, [(r["item_id"], r["text"]) for r in rows], k)
            out = out.unionByName(found if blocks == 1 else staged(spark, found, "found"))
    return out


ORACLE = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
sizes AS (SELECT doc_id, CAST(len(ts) AS BIGINT) AS n FROM texts WHERE len(ts) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS len FROM sizes),
held AS (SELECT doc_id, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, unnest(ts) AS t FROM texts) GROUP BY doc_id, t),
asked AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM held, total GROUP BY t, docs),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // len)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (t) JOIN held USING (t) JOIN sizes USING (doc_id), total GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
