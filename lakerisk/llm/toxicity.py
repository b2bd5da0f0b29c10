"""Toxicity of deobfuscated text.

Words that may hide another word (digits or signs among letters, runs of a letter,
letters spelled apart) become lattices of what each character may stand for. Viterbi
decoding under a character trigram model finds the likeliest plain spelling, and
scores are made from the restored words.
"""

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.llm.bits import gathered, is_set, piece
from lakerisk.llm.text import boxed, fold, unboxed, whole
from lakerisk.sources.tables import staged

EDGE = "^"
#: What a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "#": "h", "*": "aeiou", "%": "",
}
APART = re.compile(r"(?<!\w)[^\W_](?:[\s._\-*]+[\w@$!|+(]){2,}(?!\w)")
INSIDE = re.compile(r"[._\-*~'’·]+")
#: Where words that stand together without a blank end: at any sign, or at signs that stand for no letter.
ANY_SIGN = re.compile(r"[\W_]+")
BARE_SIGN = re.compile(rf"[^\w{re.escape(''.join(c for c in SIGNS if not c.isalnum()))}]+|_+")
LONGEST, STEP = 200, 150
PLAIN = ".,;:!?\"'()[]{}«»„“”‚‘’…"


@dataclass(frozen=True)
class Settings:
    """Bounds of what is learned, its smoothing, and costs of the channel (natural logs).

    ``features`` bounds the words and the beginnings kept, which are counted over all labelled
    rows. ``prior`` is the weight, in observations, of what is expected of a word before it is
    counted: the share of toxic sightings, at most ``most_expected``. A text is judged
    by the probability p that its worst word speaks for toxicity; the score is p to
    the power ``sharpness``, which puts p = 0.6 at 0.3.
    """

    features: int = 50_000
    prior: float = 8.0
    most_expected: float = 0.15
    sharpness: float = 2.357
    prefixes: tuple[int, ...] = (4, 5, 6)
    keep_sign: float = -3.0
    replaced: float = -1.0
    squeezed: float = -0.7
    joined: float = -0.3
    cache: int = 400_000


SETTINGS = Settings()
#: Beginnings that are at least this likely are kept, with all words under them.
NOTED = 0.25
#: Pieces of 32,768 ids up to which labels are broadcast as bits, two of 4 KB each.
MOST_PIECES = 4096
#: Chance at which some beginning of a table without toxic beginnings may be noted.
CHANCE = 0.05


@dataclass
class Spelling:
    """Character trigram model with add-one smoothing over contexts that back off to bigrams."""

    counts: dict[str, int] = field(default_factory=dict)
    memo: dict[tuple[str, str], float] = field(default_factory=dict)

    @staticmethod
    def grams(word: str) -> Iterable[str]:
        padded = f"{EDGE}{EDGE}{word}{EDGE}"
        for i in range(2, len(padded)):
            for n in range(3):
                yield padded[i - n : i + 1]
                yield f"{padded[i - n : i]}_"

    def log_p(self, context: str, char: str) -> float:
        key = (context, char)
        if key not in self.memo:
            p = 1e-4
            for n in range(3):
                held = context[len(context) - n :]
                total = self.counts.get(f"{held}_", 0)
                p = (self.counts.get(held + char, 0) + 5.0 * p) / (total + 5.0)
            self.memo[key] = math.log(p)
        return self.memo[key]

    def decode(self, lattice: list[list[tuple[str, float]]]) -> str:
        """Likeliest string through a lattice of (output, channel log probability) steps."""
        states: dict[str, tuple[float, str]] = {EDGE * 2: (0.0, "")}
        for options in [*lattice, [(EDGE, 0.0)]]:
            after: dict[str, tuple[float, str]] = {}
            for context, (score, made) in states.items():
                for output, cost in options:
                    now, held = score + cost, context
                    for char in output:
                        now += self.log_p(held, char)
                        held = EDGE * 2 if char == EDGE else held[1] + char
                    if held not in after or now > after[held][0]:
                        after[held] = (now, made + output)
            states = dict(sorted(after.items(), key=lambda x: -x[1][0])[:200])
        return max(states.values())[1].strip(EDGE)


def suspicious(word: str) -> bool:
    """Letters mixed with signs, or three or more signs alone, or a run of three of one letter, or mostly doubled letters."""
    letters = sum(map(str.isalpha, word))
    if letters and len(word) > 40:
        return True
    if letters < len(word):
        return letters + sum(c in SIGNS for c in word) >= 3
    doubled = sum(a == b for a, b in zip(word, word[1:], strict=False))
    return doubled >= 2 and (any(a == b == c for a, b, c in zip(word, word[1:], word[2:], strict=False)) or 2 * doubled >= len(word) - 2)


def lattice(word: str, s: Settings, apart: bool = False) -> list[list[tuple[str, float]]]:
    """One step per run of a character: what it may stand for, once or twice."""
    steps: list[list[tuple[str, float]]] = []
    for run in re.finditer(r"(.)\1*", word, re.DOTALL):
        char, n = run[1], len(run[0])
        plain = [(char, 0.0)] if char.isalpha() else [(c, s.replaced) for c in SIGNS.get(char, "")]
        if not char.isalnum():
            plain.append(("", s.keep_sign))
        options = list(plain)
        if n > 1:
            options += [(c * 2, p + (0.0 if n == 2 else s.squeezed)) for c, p in plain if c]
            options = [(c, p + s.squeezed if len(c) == 1 else p) for c, p in options]
        steps.append(options or [("", s.keep_sign)])
        if apart and run.end() < len(word):
            steps.append([("", s.joined), (EDGE, -1.5)])
    return steps


@dataclass
class Model:
    """``words``: (texts, toxic texts) of words; ``starts``: (words, sum of their toxic shares) of beginnings."""

    settings: Settings
    words: dict[str, tuple[float, float]]
    starts: dict[str, tuple[float, float]]
    spelling: Spelling
    base: float
    memo: dict[str, float] = field(default_factory=dict)

    def _plain(self, word: str) -> float:
        """Share of toxic texts expected of a word: from its count, smoothed by the share of the
        words that begin alike, the longer beginning smoothed by the shorter."""
        prior, share = self.settings.prior, self.base
        for n in self.settings.prefixes:
            if len(word) > n:
                held = self.starts.get(word[:n])
                if held:
                    share = (held[1] + prior * share) / (held[0] + prior)
                elif share < NOTED:
                    share = self.base
        held = self.words.get(word)
        return (held[1] + prior * share) / (held[0] + prior) if held else share

    def restore(self, word: str, apart: bool = False) -> list[str]:
        """Plain words that a lower-case word hides."""
        return self.spelling.decode(lattice(word, self.settings, apart)).split(EDGE)

    def windows(self, letters: str, apart: bool = True) -> list[str]:
        """Plain words that any length of letters hides, by overlapping windows."""
        if len(letters) <= LONGEST:
            return self.restore(letters, apart)
        return [w for i in range(0, len(letters) - LONGEST + STEP, STEP) for w in self.restore(letters[i : i + LONGEST], apart)]

    def _hidden(self, form: str) -> list[str]:
        """Words of a suspicious token: decoded joined, and of the parts between its signs."""
        tries = dict.fromkeys([form, INSIDE.sub("", form), *INSIDE.split(form)])
        parts = dict.fromkeys(p for cut in (BARE_SIGN, ANY_SIGN) for p in cut.split(form) if p not in tries)
        words = []
        for t in filter(None, (*tries, *parts)):
            if t.isalpha() and not suspicious(t):
                words.append(t)
            elif len(t) > 2 * LONGEST:
                words += self.windows(t)
            elif t in tries or suspicious(t):
                words += self.restore(t)
        return words

    def word(self, token: str) -> float:
        found = self.memo.get(token)
        if found is None:
            bare = token.strip(PLAIN)
            found = self._plain(bare)
            for form in dict.fromkeys((bare, token.rstrip(".,;:?")) if "!" in token else (bare,)):
                if suspicious(form):
                    found = max([found, *map(self._plain, self._hidden(form))])
            if len(self.memo) >= self.settings.cache:
                self.memo.clear()
            self.memo[token] = found
        return found

    def score(self, text: str | None) -> float:
        """By the strongest sign of toxicity among the restored words of the whole text."""
        if not text:
            return self.base**self.settings.sharpness
        low = text.lower()
        tokens = set(low.split())
        best = max(map(self.word, tokens), default=self.base)
        if sum(len(t) == 1 for t in tokens) >= 2 or any(len(t) > 4 and not t[1].isalnum() for t in tokens):
            for spelled in APART.finditer(low):
                letters = re.sub(r"[\s._\-*]+", "", spelled[0])
                best = max([best, *map(self._plain, (letters, *self.windows(letters)))])
        return best**self.settings.sharpness


def _learned(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of all labelled rows outside the held-out fold.

    Labels of whole-numbered ids that lie in few pieces are broadcast as bits, so that texts stay where they are; others
    are joined by shuffle.
    """
    told = labels.filter("doc_id is not null and toxic is not null").filter(fold("doc_id", 4) != 2)
    told = staged(docs.sparkSession, told.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "labels")
    rows = docs.select("doc_id", "text").filter("text is not null")
    whole_ids = all(isinstance(t.schema["doc_id"].dataType, T.IntegralType) for t in (rows, told))
    if not whole_ids or told.select(piece(_place())).distinct().count() > MOST_PIECES:
        return rows.join(told, "doc_id").select("text", "toxic")
    pieces = told.groupBy(piece(_place()).alias("_piece")).agg(
        gathered(_place()).alias("_told"), gathered(F.when(F.col("toxic") == 1, _place())).alias("_toxic")
    )
    found = rows.join(F.broadcast(pieces), piece(_place()) == F.col("_piece")).filter(is_set("_told", _place()))
    return found.select("text", is_set("_toxic", _place()).cast("int").alias("toxic"))


def _place() -> Column:
    return F.col("doc_id").cast("long")


def _sightings(rows: DataFrame) -> DataFrame:
    """(word, toxic, context) of the words of each text. The context is the least hash of the
    word and its neighbours, so that a word of a copied text is one sighting, however
    many copies there are."""

    def of(batches):
        for batch in batches:
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = ["", *(w.strip(PLAIN) for w in text.lower().split()), ""]
                least: dict[str, int] = {}
                for before, word, after in zip(tokens, tokens[1:], tokens[2:], strict=False):
                    if word.isalpha() and len(word) <= 40:
                        at = xxhash.xxh64_intdigest(f"{before} {word} {after}") >> 1
                        if at < least.get(word, 1 << 63):
                            least[word] = at
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(least), pa.string()), pa.array([int(toxic == 1)] * len(least), pa.int32()), pa.array(list(least.values()), pa.int64())],
                    ["word", "toxic", "context"],
                )

    return rows.mapInArrow(of, "word string, toxic int, context long").distinct()


def _grams(batches):
    held: dict[str, int] = {}
    for batch in batches:
        for word in batch.column(0).to_pylist():
            for gram in Spelling.grams(word):
                held[gram] = held.get(gram, 0) + 1
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["gram", "n"])


def _beyond_chance(bad: Column, n: Column, base: float, tried: int) -> Column:
    """Whether ``bad`` of ``n`` words would be toxic by chance, at the base share, in less than CHANCE of all
    cases with ``tried`` beginnings together (Chernoff's bound), so that a larger table notes no more by chance."""
    if not 0 < base < 1:
        return F.lit(False)
    share = bad / n
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / F.lit(1 - base))).otherwise(F.lit(0.0))
    return (share > base) & (n * (share * F.log(share / F.lit(base)) + rest) >= F.lit(math.log(max(tried, 1) / CHANCE)))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, s: Settings = SETTINGS) -> Model:
    """Learns words, beginnings of words, and spelling from labels.toxic. Without labelled rows every score is 0.

    What reaches the driver is bounded by ``s.features`` for each of the three.
    """
    words = staged(spark, _sightings(_learned(docs, labels)).groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad")), "words")
    total = words.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    base = min(s.most_expected, total["bad"] / total["n"]) if total["n"] else 0.0

    begun = words.select(F.explode(F.array(*[F.when(F.length("word") > n, F.substring("word", 1, n)) for n in s.prefixes])).alias("start"), (F.col("bad") / F.col("n")).alias("share"))
    starts = staged(spark, begun.filter("start is not null").groupBy("start").agg(F.count(F.lit(1)).alias("n"), F.sum("share").alias("bad")), "starts")
    likely = (F.col("bad") + s.prior * base) / (F.col("n") + s.prior)
    noted = starts.filter(likely >= NOTED).filter(_beyond_chance(F.col("bad"), F.col("n"), base, starts.count()))
    noted = noted.orderBy(F.desc("bad"), "start").limit(s.features).select(F.col("start").alias("noted"))
    noted = F.broadcast(staged(spark, noted, "noted"))

    def under(table: DataFrame, name: str) -> DataFrame:
        """Rows that begin with a noted beginning."""
        found = [table.join(noted, F.substring(name, 1, n) == F.col("noted"), "left_semi") for n in s.prefixes]
        return reduce(DataFrame.unionByName, found).distinct()

    kept = words.filter("bad >= 3 and bad >= n * 0.2").unionByName(under(words, "word")).distinct()
    known = {r["word"]: (r["n"], r["bad"]) for r in kept.orderBy(F.desc("bad"), F.desc("n"), "word").limit(s.features).collect()}
    begins = {r["start"]: (r["n"], r["bad"]) for r in under(starts, "start").orderBy(F.desc("bad"), "start").limit(s.features).collect()}
    counted = words.select("word").mapInArrow(_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    spelling = Spelling({r["gram"]: r["n"] for r in counted.orderBy(F.desc("n"), "gram").limit(s.features).collect()})
    model = Model(s, known, begins, spelling, base)
    for word in known:  # words of toxic texts are spelled as such
        if model._plain(word) >= 0.6:
            for gram in Spelling.grams(word):
                spelling.counts[gram] = spelling.counts.get(gram, 0) + 200
    return model


def predict(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``rows`` with score, from ``text``; null and empty texts get the base score."""

    def of(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for at in range(0, batch.num_rows, 256):
                scores = [model.score(t.as_py()) for t in texts[at : at + 256]]
                kept = [batch.column(batch.schema.get_field_index(c))[at : at + 256] for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], [*keep, "score"])

    schema = T.StructType([rows.schema[c] for c in keep])
    needed = rows.select(*keep, *[c for c in ("text",) if c not in keep])
    return needed.mapInArrow(of, schema.add("score", "double"))


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.3, s: Settings = SETTINGS) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted of every row of ``docs``.

    Learns from labelled rows whose id's crc32 modulo 4 is not 2. Null text is
    empty; repeated rows are judged each; a doc_id labelled twice counts once, as
    toxic if either is; other columns are ignored; no rows give no rows.
    """
    model = fit(spark, docs, labels, s)
    rows = docs.select("doc_id", "text", (fold("doc_id", 4) == 2).alias("held_out"))
    scored = predict(rows, model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.3, s: Settings = SETTINGS) -> DataFrame:
    """The rows of ``docs``, all columns, that score under ``threshold``."""
    model = fit(spark, docs, labels, s)
    judged = predict(boxed(docs).select("_row", whole("text").alias("text")), model, ["_row"])
    return unboxed(judged.filter(F.col("score") < threshold))
