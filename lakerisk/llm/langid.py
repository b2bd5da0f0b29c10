"""Language ID by the nearest of several clustered centroids per language."""

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.llm.text import boxed, fold, unboxed, whole
from lakerisk.sources.tables import staged

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """Hashed n-gram features, centroids per language, and texts per language to learn from.

    ``sample`` bounds the learning rows of a language (in expectation; chosen by a
    hash of the row). ``reject`` is the share of its language's 0.1 % quantile of
    similarity under which a text is taken for none of the learned languages.
    """

    features: int = 4096
    orders: tuple[int, ...] = (1, 2, 3)
    centroids: int = 3
    sample: int = 1500
    rounds: int = 12
    reject: float = 0.5


SETTINGS = Settings()


def has_letter(text: str | None) -> bool:
    return bool(text) and (text.isalpha() or any(map(str.isalpha, text)))


def counts(text: str, s: Settings = SETTINGS) -> np.ndarray:
    """Hashed counts of the character n-grams of the lower-cased text, letters only."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes[(codes < 65) | ((codes > 90) & (codes < 97)) | ((codes > 122) & (codes < 170))] = 32
    total = np.zeros(s.features, np.float32)
    for n in s.orders:
        if len(codes) < n:
            continue
        value = np.full(len(codes) - n + 1, n, np.uint64)
        for i in range(n):
            value = (value ^ codes[i : len(codes) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        total += np.bincount((value >> np.uint64(20)).astype(np.int64) % s.features, minlength=s.features)
    return total


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Model:
    """Centroids (unit rows), the language of each, and the similarity under which each rejects."""

    settings: Settings
    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    least: np.ndarray

    def nearest(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        vectors = _unit(np.log1p(np.stack([counts(t, self.settings) for t in texts])) * self.idf)
        similar = vectors @ self.centroids.T
        best = similar.argmax(axis=1)
        return best, np.clip(similar[np.arange(len(best)), best], 0.0, 1.0)


def _sample(docs: DataFrame, s: Settings) -> DataFrame:
    """About ``s.sample`` learning rows per language, chosen by a hash of the row."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", 5) != 0))
    share = {r["lang"]: min(1.0, s.sample / r["n"]) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not share:
        return rows.select("lang", "text").limit(0)
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) / 1e6
    limits = F.create_map(*[F.lit(x) for pair in sorted(share.items()) for x in pair])
    return rows.filter(part < F.element_at(limits, F.col("lang"))).select("lang", "text")


def fit(spark: SparkSession, docs: DataFrame, s: Settings = SETTINGS) -> Model | None:
    """Model from the rows whose id's crc32 modulo 5 is not 0 and whose lang is given; None without any.

    What reaches the driver is bounded by the settings: document frequencies of the
    hashed features and the centroids.
    """

    def vectors(batches):
        for batch in batches:
            langs, at, tf = [], [], []
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if has_letter(text):
                    row = counts(text, s)
                    langs.append(lang)
                    at.append(np.flatnonzero(row).astype(np.int32))
                    tf.append(np.log1p(row[at[-1]]).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(at, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.float32()))], ["lang", "at", "tf"]
            )

    rows = staged(spark, _sample(docs, s).mapInArrow(vectors, "lang string, at array<int>, tf array<float>"), "vectors")
    total = rows.count()
    if total == 0:
        return None
    df = np.zeros(s.features)
    for r in rows.select(F.explode("at").alias("at")).groupBy("at").count().collect():
        df[r["at"]] = r["count"]
    idf = np.log((1 + total) / (1 + df)).astype(np.float32) + 1

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        dense = np.zeros((len(group), s.features), np.float32)
        for i, (at, tf) in enumerate(zip(group["at"], group["tf"], strict=True)):
            dense[i, at] = tf
        dense = _unit(dense * idf)
        dense = dense[np.lexsort(dense[:, :64].T)]  # the same start whatever order the rows come in
        centres = dense[np.linspace(0, len(dense) - 1, min(s.centroids, len(dense))).astype(int)]
        for _ in range(s.rounds):
            nearest = (dense @ centres.T).argmax(axis=1)
            centres = _unit(np.stack([dense[nearest == k].sum(axis=0) if (nearest == k).any() else centres[k] for k in range(len(centres))]))
        low = np.quantile((dense @ centres.T).max(axis=1), 0.001)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centre": list(centres), "least": float(low * s.reject)})

    found = rows.groupBy("lang").applyInPandas(cluster, "lang string, centre array<float>, least double").collect()
    found.sort(key=lambda r: (r["lang"], r["centre"]))
    return Model(
        s,
        idf,
        np.array([r["centre"] for r in found], np.float32),
        [r["lang"] for r in found],
        np.array([r["least"] for r in found]),
    )


def predict(rows: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``rows`` with lang_pred, score and rejected, from ``text``.

    lang_pred is the language of the nearest centroid and score its cosine. Null
    texts and texts without a letter are ``und``, score 0, rejected; so is every
    text if there is no model. A text with letters is rejected if its nearest
    centroid is further than that language's texts are.
    """

    def of(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for at in range(0, batch.num_rows, 256):
                part = texts[at : at + 256].to_pylist()
                lang, score, out = [UNKNOWN] * len(part), np.zeros(len(part)), np.ones(len(part), bool)
                told = [i for i, t in enumerate(part) if model is not None and has_letter(t)]
                if told:
                    best, similar = model.nearest([part[i] for i in told])
                    score[told], out[told] = similar, similar < model.least[best]
                    for i, k in zip(told, best, strict=True):
                        lang[i] = model.langs[k]
                kept = [batch.column(batch.schema.get_field_index(c))[at : at + 256] for c in keep]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(lang, pa.string()), pa.array(score), pa.array(out)], [*keep, "lang_pred", "score", "rejected"]
                )

    schema = T.StructType([rows.schema[c] for c in keep])
    needed = rows.select(*keep, *[c for c in ("text",) if c not in keep])
    schema = schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return needed.mapInArrow(of, schema)


def identify(spark: SparkSession, docs: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row; rows, nulls and empty tables as in
    ``predict``. Repeated rows are judged each; columns other than doc_id, text, lang are ignored."""
    model = fit(spark, docs.select("doc_id", "text", "lang"), s)
    rows = docs.select("doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out"))
    return predict(rows, model, ["doc_id", "held_out"])


def keep_known(spark: SparkSession, docs: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not rejected."""
    model = fit(spark, docs.select("doc_id", "text", "lang"), s)
    judged = predict(boxed(docs).select("_row", whole("text").alias("text")), model, ["_row"])
    return unboxed(judged.filter("not rejected"))
