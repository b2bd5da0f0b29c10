"""Quality rules whose limits follow from quantile sketches per language and source.

A sketch is a histogram of fixed resolution: counts per (lang, source, signal,
bucket). Sketches merge by adding counts, in any order and with the same result,
so tasks sketch their rows, and a language or the corpus is the sum of its groups.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakerisk.llm.text import SPACES, let, whole, words
from lakerisk.sources.tables import staged

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Signal:
    """``steps`` buckets to 1.0, the last at ``top``; ``slack`` (in units of the signal) widens both limits."""

    name: str
    steps: int
    top: float
    slack: float
    lower: bool = False


SIGNALS = (
    Signal("word_length", 20, 200.0, 1.0, lower=True),
    Signal("symbol_share", 1000, 10.0, 0.05),
    Signal("dup_line_share", 1000, 1.0, 0.1),
    Signal("repeat_share", 1000, 1.0, 0.1),
    Signal("upper_share", 1000, 1.0, 0.1),
)


def _count_of(text: Column, chars: str) -> Column:
    """Characters of the text that are in ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def repeat_words(found: Column) -> Column:
    """Words that lie in a three-word window which occurs twice or more.

    Windows are compared by their 64-bit hash: sorted (hash, position) pairs whose
    hash equals a neighbour's are the repeated ones.
    """
    last = F.size(found) - 2

    def repeated(pairs: Column) -> Column:
        same = lambda e, k: (F.get(pairs, k - 1)["h"] == e["h"]) | (F.get(pairs, k + 1)["h"] == e["h"])
        at = F.transform(F.filter(pairs, lambda e, k: F.coalesce(same(e, k), F.lit(False))), lambda e: e["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2))))).cast("long")

    def windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), last - 1)
        pair = lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))
        return F.sort_array(F.transform(at, pair))

    return F.when(last > 1, let(windows(found), repeated)).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each whole text. A null or blank text has no words."""
    text = whole("text")

    def of(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
        dups = let(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("distinct")))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
            _count_of(text, SYMBOLS).alias("n_symbols"),
            dups.alias("lines"),
            repeat_words(w).alias("n_repeat_words"),
            _count_of(text, UPPER).alias("n_upper"),
        )

    return docs.select("doc_id", "lang", "source", let(words(text), of).alias("_m")).select(
        "doc_id",
        "lang",
        "source",
        "_m.n_words",
        "_m.word_chars",
        "_m.n_symbols",
        (F.col("_m.lines.all") - F.col("_m.lines.distinct")).cast("long").alias("n_dup_lines"),
        "_m.n_repeat_words",
        F.col("_m.lines.all").cast("long").alias("n_lines"),
        "_m.n_upper",
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _share(over: str, under: str, steps: int, top: float) -> Column:
    """Bucket of a ratio, in whole-number arithmetic; nothing over nothing is 0."""
    bucket = F.floor(F.col(over) * steps / F.greatest(F.col(under), F.lit(1))).cast("long")
    return F.least(bucket, F.lit(int(steps * top)).cast("long"))


def buckets(measured: DataFrame) -> DataFrame:
    over = {
        "word_length": ("word_chars", "n_words"),
        "symbol_share": ("n_symbols", "n_words"),
        "dup_line_share": ("n_dup_lines", "n_lines"),
        "repeat_share": ("n_repeat_words", "n_words"),
        "upper_share": ("n_upper", "word_chars"),
    }
    return measured.withColumns({f"b_{s.name}": _share(*over[s.name], s.steps, s.top) for s in SIGNALS})


def sketch(bucketed: DataFrame) -> DataFrame:
    """Counts per (lang, source, signal, bucket) of the texts that have words."""
    long = F.explode(
        F.array(*[F.struct(F.lit(s.name).alias("signal"), F.col(f"b_{s.name}").alias("bucket")) for s in SIGNALS])
    )
    rows = bucketed.filter("n_words > 0").select("lang", "source", long.alias("_s")).select("lang", "source", "_s.*")
    return rows.groupBy("lang", "source", "signal", "bucket").agg(F.count(F.lit(1)).alias("n"))


def limits(sketched: DataFrame, by: list[str], fence: float) -> DataFrame:
    """Per group: number of texts and, per signal, the highest and lowest bucket that passes.

    The highest is the upper quartile plus ``fence`` times the distance of the
    quartiles plus the slack; the lowest mirrors it.
    """
    key = Window.partitionBy(*by, "signal")
    merged = sketched.groupBy(*by, "signal", "bucket").agg(F.sum("n").alias("n"))
    ranked = merged.select(
        "*",
        F.sum("n").over(key.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("n").over(key).alias("total"),
    )
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bucket")))
    quartiles = ranked.groupBy(*by, "signal").agg(F.max("total").alias("total"), at(1).alias("q1"), at(3).alias("q3"))
    spread = F.lit(fence) * (F.col("q3") - F.col("q1"))
    of = lambda name, value: F.max(F.when(F.col("signal") == name, value))
    columns = [F.max("total").alias("texts")]
    for s in SIGNALS:
        columns.append(of(s.name, F.col("q3") + spread + s.slack * s.steps).alias(f"hi_{s.name}"))
        if s.lower:
            columns.append(of(s.name, F.col("q1") - spread - s.slack * s.steps).alias(f"lo_{s.name}"))
    return quartiles.groupBy(*by).agg(*columns)


def group_limits(sketched: DataFrame, fence: float = 3.0, least: int = 100) -> DataFrame:
    """Limits per (lang, source). A group of fewer than ``least`` texts takes those of its
    language's merged sketch, and that failing those of the whole corpus."""
    names = [f"hi_{s.name}" for s in SIGNALS] + [f"lo_{s.name}" for s in SIGNALS if s.lower]
    own = limits(sketched, ["lang", "source"], fence)
    wider = limits(sketched, ["lang"], fence).select(
        F.col("lang").alias("_lang"), F.col("texts").alias("_n"), *[F.col(c).alias(f"l_{c}") for c in names]
    )
    every = limits(sketched.withColumn("_all", F.lit(1)), ["_all"], fence).select("_all", *[F.col(c).alias(f"a_{c}") for c in names])
    joined = own.join(wider, own["lang"].eqNullSafe(wider["_lang"]), "left").withColumn("_all", F.lit(1))
    pick = lambda c: F.when(F.col("texts") >= least, F.col(c)).when(F.col("_n") >= least, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}"))
    return joined.join(every, "_all", "left").select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[pick(c).alias(c) for c in names]
    )


def judge(spark: SparkSession, docs: DataFrame, fence: float = 3.0, least: int = 100) -> DataFrame:
    """doc_id, the counts, base_failed, and kept: base rules passed and every signal inside
    the limits of the text's language and source.

    ``docs`` has doc_id, text, lang, source; other columns are ignored. Null lang or
    source is a group of its own, null text has no words and fails, repeated rows are
    judged each, and no rows give no rows. The counts are made once and stored in the
    shared scratch folder, since sketch and verdict both need them.
    """
    measured = buckets(staged(spark, measure(docs), "signals"))
    bounds = group_limits(sketch(measured), fence, least)
    inside = [F.col(f"b_{s.name}") <= F.coalesce(F.col(f"hi_{s.name}"), F.lit(0.0)) for s in SIGNALS]
    inside += [F.col(f"b_{s.name}") >= F.coalesce(F.col(f"lo_{s.name}"), F.lit(0.0)) for s in SIGNALS if s.lower]
    passes = ~base_failed()
    for test in inside:
        passes = passes & test
    same = measured["lang"].eqNullSafe(bounds["_lang"]) & measured["source"].eqNullSafe(bounds["_source"])
    return measured.join(bounds, same, "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        passes.alias("kept"),
    )
