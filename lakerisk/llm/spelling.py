"""Spelling variants: words one edit apart, found by edit-matrix rows along sorted lists.

One edit leaves the first or the last half of a word as it is. Words are dealt by each
half and by the shorter word's length, so two words one edit apart meet in one list at
least. There the rests of the words are sorted. Words that share a prefix form a range
of the list, and a matrix row for that prefix serves them all: rows go on from one
shared prefix to the next longer ones, three cells wide, and a range is left once all
cells exceed one edit. Lists with too many words are dealt anew by the halves of their rests.
"""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.llm.text import whole
from lakerisk.sources.tables import staged

#: Fixed values of the word rule: letters of a run, the share of runs with a lost letter.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOST = 199
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5

#: Distinct words that a task counts before it hands them on.
COUNTED = 500_000
#: Words of a list beyond which it is dealt anew, and (word, range) pairs that are followed at once.
LIST = 20_000
PAIRS = 400_000

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def corrupted(doc_id: int | None, run: str) -> str:
    """A lower-cased run of a document, without one letter where its crc32 says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % LOST:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def text_words(doc_id: int | None, text: str | None) -> Counter:
    """The words of a text, after lower-casing and loss, with their occurrences."""
    runs: Counter = Counter()
    for run, n in Counter(RUN.findall(text or "")).items():
        runs[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    words: Counter = Counter()
    for run, n in runs.items():
        words[corrupted(doc_id, run)] += n
    return words


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words with enough code points and occurrences in all texts."""

    def of(batches):
        held: Counter = Counter()

        def flush():
            words = [w for w in held if len(w) >= least_length]
            for at in range(0, len(words), 50_000):
                part = words[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([held[w] for w in part], pa.int64())], ["word", "n"])
            held.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.update(text_words(doc_id, text.as_py()))
                if len(held) >= COUNTED:
                    yield from flush()
        yield from flush()

    rows = docs.select(F.col("doc_id").cast("long"), whole("text")).mapInArrow(of, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _dealt(words: DataFrame) -> DataFrame:
    """One row per word and list: the list's key (side and unchanged half), the shorter word's length
    there, and the word's rest, read from the front."""
    length = F.length("word")
    classes = words.withColumn("least", F.explode(F.array(length, length - 1))).filter(F.col("least") >= 1)
    front = F.struct(F.concat(F.lit("<"), F.expr("substring(word, 1, shiftright(least, 1))")).alias("key"), F.expr("substring(word, shiftright(least, 1) + 1)").alias("rest"))
    back = F.struct(
        F.concat(F.lit(">"), F.expr("right(word, least - shiftright(least, 1))")).alias("key"),
        F.expr("left(word, length(word) - least + shiftright(least, 1))").alias("rest"),
    )
    sides = classes.withColumn("side", F.explode(F.array(front, back)))
    return sides.select("word", "n", "least", F.col("side.key").alias("key"), F.col("side.rest").alias("rest"))


def _dealt_anew(lists: DataFrame, limit: int) -> DataFrame:
    """Lists of over ``limit`` words dealt by the halves of their rests, the others as they are.

    Within a list all words are equal but for their rests, of least - k or one more letters, so that
    the same argument holds for the halves of the rests.
    """
    sizes = lists.groupBy("least", "key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > limit)
    large = lists.join(sizes.select("least", "key"), ["least", "key"], "left_semi")
    small = lists.join(sizes.select("least", "key"), ["least", "key"], "left_anti")
    # The shorter word's rest: at the front half of the word is gone, at the back the other half.
    shorter = F.expr("case when left(key, 1) = '<' then least - shiftright(least, 1) else shiftright(least, 1) end")
    rests = large.withColumn("m", shorter)
    front = F.struct(F.concat("key", F.lit("<"), F.expr("substring(rest, 1, shiftright(m, 1))")).alias("key"), F.expr("substring(rest, shiftright(m, 1) + 1)").alias("rest"))
    back = F.struct(
        F.concat("key", F.lit(">"), F.expr("right(rest, m - shiftright(m, 1))")).alias("key"),
        F.expr("left(rest, length(rest) - m + shiftright(m, 1))").alias("rest"),
    )
    sides = rests.withColumn("side", F.explode(F.array(front, back)))
    return small.unionByName(sides.select("word", "n", "least", F.col("side.key").alias("key"), F.col("side.rest").alias("rest")))


def near_pairs(group: np.ndarray, rest: list[str], short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of rests of one group that are exactly one edit apart, ``a`` a short one.

    Rows are sorted by group and rest, each group with rests of two neighbouring lengths, of which ``short``
    says the smaller; two short ones are reported once.
    """
    lengths = np.array([len(r) for r in rest])
    width = int(lengths.max(initial=0))
    letters = np.zeros((len(rest), width + 2), np.int32)
    for at in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == at)
        if at:
            letters[rows, :at] = np.array([rest[r] for r in rows]).view(np.int32).reshape(len(rows), at)
    # Ranges: the groups, and below each range those of the next letter; a word's end counts as letter 0.
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    found_a, found_b = [], []
    size = np.diff(np.append(starts, len(group)))
    mine = np.cumsum(np.concatenate(([True], group[1:] != group[:-1]))) - 1
    words = np.flatnonzero(short & (size[mine] > 1))
    # Level by level: where the ranges of each depth start, from the common prefixes of neighbours.
    differs = np.zeros(len(group), np.int64)
    differs[starts] = -1
    inner = np.flatnonzero(np.concatenate(([False], group[1:] == group[:-1])))
    if len(inner):
        unequal = letters[inner] != letters[inner - 1]
        differs[inner] = np.where(unequal.any(axis=1), unequal.argmax(axis=1), width + 2)
    for at in range(0, len(words), max(1, PAIRS // 64)):
        asked = words[at : at + max(1, PAIRS // 64)]
        low = starts[mine[asked]]
        high = low + size[mine[asked]]
        row = np.tile(np.array([9, 0, 1], np.int8), (len(asked), 1))
        for depth in range(width + 1):
            # Each followed range falls into the ranges that share one letter more.
            cuts = np.flatnonzero(differs <= depth)
            first, last = np.searchsorted(cuts, low), np.searchsorted(cuts, high)
            count = last - first
            parent = np.repeat(np.arange(len(asked)), count)
            child = np.arange(len(parent)) - np.repeat(np.cumsum(count) - count, count) + first[parent]
            low, end = cuts[child], np.append(cuts, len(group))[child + 1]
            high = np.minimum(end, high[parent])
            asked, row = asked[parent], row[parent]
            letter = letters[low, depth]
            # A word that ends here: its distance is the cell of the asked rest's own length.
            over = letter == 0
            if over.any():
                off = lengths[asked[over]] - depth + 1
                inside = (off >= 0) & (off <= 2)
                a, b = asked[over][inside], low[over][inside]
                near = row[over][inside, off[inside]] == 1
                a, b = a[near], b[near]
                once = ~short[b] | (a < b)
                found_a.append(a[once])
                found_b.append(b[once])
            go = ~over
            asked, low, high, row, letter = asked[go], low[go], high[go], row[go], letter[go]
            # The band's cells are the asked rest's prefixes of depth, depth + 1 and depth + 2 letters.
            theirs = letters[asked[:, None], np.clip(np.arange(depth - 1, depth + 2), 0, width + 1)]
            if depth == 0:
                theirs[:, 0] = -1
            step = np.full((len(asked), 3), 9, np.int8)
            for cell in range(3):
                value = row[:, cell] + (theirs[:, cell] != letter)
                if cell < 2:
                    value = np.minimum(value, row[:, cell + 1] + 1)
                if cell:
                    value = np.minimum(value, step[:, cell - 1] + 1)
                step[:, cell] = np.minimum(value, 9)
            alive = step.min(axis=1) <= 1
            asked, low, high, row = asked[alive], low[alive], high[alive], step[alive]
            if not len(asked):
                break
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _scan():
    """Sorted rows (least, key, rest, word, n) to near pairs in both directions."""

    def one(a: str, b: str, key: str, least: int) -> bool:
        """Whether the pair is this list's to report: other lists may hold it too."""
        front = a[: least // 2] == b[: least // 2]
        if key[0] == ">" and front:
            return False
        split = key[1:].find("<") if "<" in key[1:] else key[1:].find(">")
        if split < 0 or key[split + 1] == "<":
            return True
        # Dealt anew by the rests' last halves: left to the list of their first halves.
        m = least - least // 2 if key[0] == "<" else least // 2
        skip = least // 2 if key[0] == "<" else 0
        return a[skip : skip + m // 2] != b[skip : skip + m // 2]

    def flush(rows):
        least, key, rest, word, n = rows
        names = np.array([f"{a}{b}" for a, b in zip(least, key, strict=True)], object)
        group = np.cumsum(np.concatenate(([0], names[1:] != names[:-1])))
        length = np.array([len(w) for w in word])
        a, b = near_pairs(group, rest, length == np.array(least))
        mine = [(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True) if one(word[i], word[j], key[i], least[i])]
        both = mine + [(j, i) for i, j in mine]
        for at in range(0, len(both), 50_000):
            part = both[at : at + 50_000]
            columns = [[word[i] for i, _ in part], [n[i] for i, _ in part], [word[j] for _, j in part], [n[j] for _, j in part]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()) * 2, strict=True)], ["word", "n", "near", "near_n"])

    def of(batches):
        held = [[] for _ in range(5)]
        for batch in batches:
            for rows, column in zip(held, batch.columns, strict=True):
                rows.extend(column.to_pylist())
            if len(held[0]) < LIST:
                continue
            # Whole lists only; the last may go on in the next batch.
            done = len(held[0])
            while done and (held[0][done - 1], held[1][done - 1]) == (held[0][-1], held[1][-1]):
                done -= 1
            if done:
                yield from flush([rows[:done] for rows in held])
                held = [rows[done:] for rows in held]
        if held[0]:
            yield from flush(held)

    return of


def near_words(words: DataFrame, limit: int = LIST) -> DataFrame:
    """(word, n, near, near_n): every two of the words (word, n) that are one edit apart, in both directions."""
    lists = _dealt_anew(_dealt(words), limit).select("least", "key", "rest", "word", "n")
    return lists.repartition("least", "key").sortWithinPartitions("least", "key", "rest").mapInArrow(_scan(), "word string, n long, near string, near_n long")


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): forms followed to their end, twice as far in each round."""
    now = forms.select("word", F.col("form").alias("root"), F.lit(False).alias("ended"))
    while True:
        ahead = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        now = staged(
            spark,
            now.join(ahead, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNull().alias("ended")),
            "roots",
        )
        if now.filter("not ended").isEmpty():
            return now.select("word", "root")


def group_spellings(spark: SparkSession, docs: DataFrame, times: int = TIMES) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of at least 6 code points with at least
    5 occurrences.

    Words are runs of letters, A-Z lower-cased, without a letter where the crc32 of document and run
    says so. Near words are one inserted, deleted or replaced code point apart. A word's form
    is its near word of most occurrences (ties: the smallest), if these are at least ``times`` (over 1) its
    own; its root is where following forms ends, itself if it has none.

    Reads doc_id (an integer; null as empty text) and text. Null and empty texts have no words,
    repeated rows count again, other columns are ignored; no rows give no rows.
    """
    words = staged(spark, count_words(docs), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near")))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    judged = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.minus") >= times * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.minus")).alias("form_n"))).alias("found"),
    )
    judged = staged(spark, judged.select("word", "n", "n_near", "found.form", "found.form_n"), "forms")
    roots = _roots(spark, judged.filter(F.col("form").isNotNull()).select("word", "form"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = r"""
WITH RECURSIVE runs AS (
    SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents) GROUP BY ALL),
crc_steps AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, k:
    CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS steps FROM range(256) t(i)),
hashed AS (SELECT r, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(concat(doc_id, ':', r), ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [195, CAST(ord(c) AS BIGINT) - 64] END))),
    lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1]))) AS h FROM runs, crc_steps),
words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN left(r, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, n FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
shorter AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
    SELECT a.word AS word, b.word AS other FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.rest = w.word
    UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.rest = w.word),
best AS (SELECT near.word, count(*) AS n_near, arg_min(other, (-o.n, other)) AS other, max(o.n) AS other_n
    FROM near JOIN words o ON near.other = o.word GROUP BY near.word),
forms AS (SELECT w.word, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
        CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN best USING (word)),
ways AS (SELECT word, word AS root FROM forms UNION ALL
    SELECT ways.word, forms.form FROM ways JOIN forms ON ways.root = forms.word WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, ways.root, f.n, f.n_near, f.form_n
FROM forms f JOIN ways USING (word) JOIN forms ends ON ways.root = ends.word WHERE ends.form IS NULL
"""
