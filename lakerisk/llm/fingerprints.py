"""Order MinHash: document fingerprints that follow the order of a text.

Each text is cut into k-mers of words. A k-mer is numbered by how often it has
occurred before, so repetition counts. Hashes of (k-mer, number) are dealt into
bins; each bin keeps its ``depth`` smallest and hashes them in the order in which
they stand in the text. Two texts agree in a bin only if they share those k-mers
and their order.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakerisk.llm.text import let, whole, words

POSITION_BITS = 24


@dataclass(frozen=True)
class Scheme:
    """k words to a k-mer, a power of two of bins, ``depth`` k-mers to a bin."""

    k: int = 2
    bins: int = 64
    depth: int = 2

    @property
    def bin_bits(self) -> int:
        return self.bins.bit_length() - 1


SCHEME = Scheme()


def _packed(high: Column, position: Column, bits: int) -> Column:
    """``bits`` bits of a hash above the position: one long that sorts by hash, then position."""
    kept = F.shiftrightunsigned(high, 64 - bits)
    return F.shiftleft(kept, POSITION_BITS).bitwiseOR(position.cast("long"))


def _hash_part(value: Column) -> Column:
    return F.shiftright(value, POSITION_BITS)


def _position(value: Column) -> Column:
    return value.bitwiseAND(F.lit((1 << POSITION_BITS) - 1).cast("long"))


def _kmers(found: Column, k: int) -> Column:
    """Sorted packed (hash, position) of the k-mers; a text of fewer words is one k-mer."""
    count = F.greatest(F.size(found) - (k - 1), F.least(F.size(found), F.lit(1)))
    one = lambda i: _packed(F.xxhash64(*[F.get(found, i + j) for j in range(k)]), i, 63 - POSITION_BITS)
    at = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.sort_array(F.transform(at, one))


def _numbered(kmers: Column, scheme: Scheme) -> Column:
    """Sorted packed (bin, hash of k-mer and occurrence number, position)."""
    first = lambda e, i: (i == 0) | (_hash_part(F.get(kmers, i - 1)) != _hash_part(e))
    starts = F.filter(
        F.transform(kmers, lambda e, i: F.when(F.coalesce(first(e, i), F.lit(True)), i)), lambda i: i.isNotNull()
    )

    def runs(at: Column) -> Column:
        def run(start: Column, r: Column) -> Column:
            end = F.coalesce(F.get(at, r + 1), F.size(kmers))
            return F.transform(
                F.sequence(F.lit(0), end - start - 1),
                lambda n: _packed(
                    F.xxhash64(_hash_part(F.get(kmers, start)), n), _position(F.get(kmers, start + n)), 63 - POSITION_BITS
                ),
            )

        return F.flatten(F.transform(at, run))

    return F.sort_array(let(starts, runs))


def fingerprint(text: Column, scheme: Scheme = SCHEME) -> Column:
    """Eight hexadecimal digits per bin, ``--------`` for a bin without k-mers.

    Null and empty texts, and texts of white space alone, have no k-mers.
    """
    bin_of = lambda e: F.shiftright(e, 63 - scheme.bin_bits)
    blank = F.array_repeat(F.lit("-" * 8), scheme.bins)

    def smallest(numbered: Column) -> Column:
        # Sorted by bin and hash: an entry is among the first of its bin if the one `depth` before is of another bin.
        earlier = lambda e, i: bin_of(F.get(numbered, i - scheme.depth)) == bin_of(e)
        kept = F.filter(numbered, lambda e, i: ~F.coalesce(earlier(e, i), F.lit(False)))
        return F.sort_array(F.transform(kept, lambda e: F.struct(bin_of(e).cast("int").alias("bin"), _position(e).alias("at"), _hash_part(e).alias("h"))))

    def tuples(kept: Column) -> Column:
        def of(b: Column) -> Column:
            mine = F.transform(F.filter(kept, lambda e: e["bin"] == b), lambda e: e["h"])
            value = lambda m: F.lower(F.substring(F.lpad(F.hex(F.xxhash64(m)), 16, "0"), 9, 8))
            return let(mine, lambda m: F.when(F.size(m) > 0, value(m)).otherwise(F.lit("-" * 8)))

        return F.transform(F.sequence(F.lit(0), F.lit(scheme.bins - 1)), of)

    made = let(
        words(text),
        lambda w: F.when(
            F.size(w) > 0,
            let(_kmers(w, scheme.k), lambda s: let(_numbered(s, scheme), lambda n: let(smallest(n), tuples))),
        ).otherwise(blank),
    )
    return F.array_join(made, "")


def likeness(left: Column, right: Column, scheme: Scheme = SCHEME) -> Column:
    """Share of equal bins among those that either fingerprint fills; 1 if neither fills any."""
    at = F.sequence(F.lit(0), F.lit(scheme.bins - 1))
    piece = lambda fp, b: F.substring(fp, b * 8 + 1, F.lit(8))
    blank = "-" * 8

    def count(test) -> Column:
        return F.aggregate(at, F.lit(0), lambda n, b: n + F.when(test(piece(left, b), piece(right, b)), 1).otherwise(0))

    equal = count(lambda a, b: (a == b) & (a != blank))
    filled = count(lambda a, b: (a != blank) | (b != blank))
    return F.when(filled == 0, F.lit(1.0)).otherwise(equal / filled)


def _bucket(cuts: list[int]) -> Column:
    """How many of the sorted cuts are at most the row's doc_id, by halving; 0 for a null id."""
    if not cuts:
        return F.lit(0)
    found = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]

    def halve(at: Column, step: Column) -> Column:
        # One beyond the end gives NULL, which no id reaches.
        return F.when(F.get(found, at + step - 1) <= F.col("doc_id"), at + step).otherwise(at)

    return F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), halve))


def with_next(rows: DataFrame, scheme: Scheme = SCHEME, rows_per_bucket: int = 2000, most_buckets: int = 4096) -> DataFrame:
    """Adds fingerprint, and ``next``: struct<text, fingerprint> of the next row by doc_id; the last row gets the first.

    ``rows`` has doc_id and text. The id range is cut into at most ``most_buckets`` buckets, so
    order is found inside buckets in parallel, after the one shuffle of the texts; the last row
    of a bucket takes the first row of the next, which is read from the same shuffle. The cuts
    come from a sketch of the ids, in a large table of some thousand ids per bucket; they
    decide how even the buckets are, not the result. Null ids come first; equal ids are
    ordered by text.
    """
    total = rows.select("doc_id").agg(F.count(F.lit(1)).alias("n")).first()["n"]
    n = min(most_buckets, max(1, -(-total // rows_per_bucket)))
    cuts = []
    if n > 1:
        ids = rows.select("doc_id").sample(min(1.0, 1000 * n / total), seed=1)
        found = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], max(10_000, 20 * n)).alias("c")).first()["c"]
        cuts = sorted(set(found or []))
    printed = rows.select("doc_id", "text", _bucket(cuts).alias("_b"), fingerprint(F.col("text"), scheme).alias("fingerprint"))

    # Rows of a bucket meet once: their order and the bucket's first row both come from this shuffle. The windows
    # use plain columns only, as Spark would compute anything else before the shuffle and send it too.
    inside = Window.partitionBy("_b").orderBy("doc_id", "text")
    lead = {"_text": F.lead("text").over(inside), "_print": F.lead("fingerprint").over(inside)}
    led = printed.withColumns({**lead, "_before": F.lag("_b").over(inside)})
    firsts = led.filter(F.col("_before").isNull()).select("_b", F.struct("text", "fingerprint").alias("_first"))
    # One row per bucket: the bucket before each, and for the first the last.
    every = Window.orderBy("_b")
    used = rows.select(_bucket(cuts).alias("_b")).distinct()
    before = used.select(F.col("_b").alias("_to"), F.lag("_b").over(every).alias("_from"), F.max("_b").over(Window.partitionBy()).alias("_end"))
    before = before.select("_to", F.coalesce("_from", "_end").alias("_from"))
    # A left join, as an inner one would put a filter of its own before the shuffle, which then is another.
    heir = firsts.join(F.broadcast(before), firsts["_b"] == before["_to"], "left").select(F.col("_from").alias("_of"), "_first")
    after = F.when(F.col("_print").isNotNull(), F.struct(F.col("_text").alias("text"), F.col("_print").alias("fingerprint")))
    return led.join(heir, led["_b"] == heir["_of"], "left").select(
        "doc_id", "text", "fingerprint", F.coalesce(after, F.col("_first")).alias("next")
    )


def compare_edited(docs: DataFrame, scheme: Scheme = SCHEME) -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next text, and their likeness.

    Reads doc_id and text; null text is empty; other columns are ignored; repeated
    rows are rows of their own (ordered as in ``with_next``); no rows give no rows.
    """
    own = docs.select("doc_id", whole("text").alias("text"))
    rows = with_next(own, scheme)
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next.text"), F.lit(1), cut))
    made = rows.select(
        "doc_id", n.cast("long").alias("n_chars"), edited.alias("_edited"), "fingerprint", F.col("next.fingerprint").alias("_next")
    )
    made = made.select(
        "doc_id",
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        "fingerprint",
        fingerprint(F.col("_edited"), scheme).alias("edited_fingerprint"),
        "_next",
    )
    return made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), scheme).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next"), scheme).alias("near_next"),
    )
