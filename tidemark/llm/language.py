"""Language identification by nearest centroid.

A text is lower-cased, runs of other characters than letters become one space, and its 1- to 3-grams are hashed
into a fixed number of features. A vector holds log(1 + count) times the inverse document frequency, at unit
length. Each language has several centroids, found by spherical k-means; a text gets the language of the centroid
with the largest cosine, which is its score.

Rejection: for each size class of texts (the power of two of their n-grams) the smallest cosines seen in training
give a threshold; a text below half of them is far from every centroid and rejected.

Document frequencies, language counts and thresholds cover all training rows; the thresholds come from counts of rows
by size class and cosine, in steps of 1 / 4096. Centroids are fitted on a sample of about `sample_rows` different training
texts (chosen by a hash of the text, an equal share for each language; a text counts once, however often it is
repeated), and more than `most_languages` values of lang are a ValueError: the two bounds here. The model has 64 KB for each
language and goes to the workers as a broadcast.

Defined cases: null text, or one without a letter, is `und` with score 0 and rejected. Without training rows
everything is `und`. Rows with null doc_id or null lang are never trained on. Equal rows give equal results; ties
between centroids go to the language that sorts first.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cells, in_batches, map_arrow

DIMS = 4096
UNDETERMINED = "und"
_ROWS_AT_ONCE = 256
_CLASSES, _STEPS = 64, 4096


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str) -> np.ndarray | None:
    """Counts of hashed 1- to 3-grams over the whole text; None if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = _letters()[points]
    if not is_letter.any():
        return None
    space = np.uint32(32)
    points = np.where(is_letter, points, space)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    points = np.concatenate(([space], points[keep], [space])).astype(np.uint32)
    pairs = points[:-1] * np.uint32(0x9E3779B1) + points[1:]
    triples = pairs[:-1] * np.uint32(0x85EBCA6B) + points[2:]
    counts = np.zeros(DIMS, np.int64)
    for salt, grams in ((1, points[1:-1]), (2, pairs), (3, triples)):
        mixed = (grams ^ np.uint32(salt * 0x27D4EB2F & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35)
        mixed ^= mixed >> np.uint32(15)
        counts += np.bincount(mixed * np.uint32(0x165667B1) >> np.uint32(20), minlength=DIMS)
    return counts


@dataclass(frozen=True)
class Centroids:
    """A fitted model; languages[i] is the language of row i of matrix."""

    languages: list[str]
    matrix: np.ndarray
    idf: np.ndarray
    thresholds: np.ndarray

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest centroid and its cosine for each row."""
        cosines = _unit(np.log1p(counts).astype(np.float32) * self.idf) @ self.matrix.T
        best = cosines.argmax(axis=1)
        return best, np.clip(cosines[np.arange(len(best)), best], 0.0, 1.0)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _size_class(totals: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(totals, 1)).astype(np.int64)


def held_out() -> Column:
    """Whether a row is kept from training; null doc_id isn't, but is never trained on either."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")


_STATS_ARROW = pa.schema([("lang", pa.string()), ("feature", pa.int32()), ("n", pa.int64())])


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frequency, languages = np.zeros(DIMS, np.int64), {}
    for batch in batches:
        for text, lang in cells(batch, "text", "lang"):
            if (counts := gram_counts(text)) is not None:
                frequency += counts > 0
                languages[lang] = languages.get(lang, 0) + 1
    rows = [(None, k, n) for k, n in enumerate(frequency.tolist()) if n] + [(lang, -1, n) for lang, n in languages.items()]
    return in_batches(iter(rows), _STATS_ARROW)


_SAMPLE_ARROW = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("total", pa.int64()), ("features", pa.binary()), ("weights", pa.binary())])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features that a text has, with the logarithm of their counts."""

    def rows():
        for batch in batches:
            for doc_id, text, lang in cells(batch, "doc_id", "text", "lang"):
                if (counts := gram_counts(text)) is not None:
                    features = np.flatnonzero(counts)
                    yield doc_id, lang, int(counts.sum()), features.astype("<u2").tobytes(), np.log1p(counts[features]).astype("<f4").tobytes()

    return in_batches(rows(), _SAMPLE_ARROW)


def _cluster(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of spherical k-means; each start is the row farthest from those before it."""
    centres = [_unit(rows.mean(axis=0, keepdims=True))[0]]
    while len(centres) < min(k, len(rows)):
        centres.append(rows[(rows @ np.array(centres).T).max(axis=1).argmin()])
    found = np.array(centres)
    for _ in range(rounds):
        member = np.zeros((len(found), len(rows)), np.float32)
        member[(rows @ found.T).argmax(axis=1), np.arange(len(rows))] = 1
        moved = _unit(np.where(member.any(axis=1, keepdims=True), member @ rows, found))
        if np.allclose(moved, found):
            break
        found = moved
    return found


_COSINES_ARROW = pa.schema([("size", pa.int32()), ("step", pa.int32()), ("n", pa.int64())])


def _cosines(batches: Iterator[pa.RecordBatch], model: Broadcast[Centroids]) -> Iterator[pa.RecordBatch]:
    """Counts of texts by size class and by the step that their cosine falls in."""
    nearest = model.value.nearest
    seen = np.zeros((_CLASSES, _STEPS), np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
            found = [counts for text in batch.column("text").slice(at, _ROWS_AT_ONCE).to_pylist() if (counts := gram_counts(text)) is not None]
            if found:
                counts = np.array(found)
                steps = np.minimum((nearest(counts)[1] * _STEPS).astype(np.int64), _STEPS - 1)
                np.add.at(seen, (_size_class(counts.sum(axis=1)), steps), 1)
    rows = ((int(size), int(step), int(seen[size, step])) for size, step in np.argwhere(seen))
    return in_batches(rows, _COSINES_ARROW)


def _thresholds(seen: np.ndarray, enough: int = 20) -> np.ndarray:
    """Half the smallest cosines of each size class; a class without enough rows takes that of the next smaller one,
    and below the smallest the threshold falls with the square root of the size, as cosines of short texts do.

    seen: rows by size class and step of the cosine. The smallest cosines are the 1 % quantile, rounded down to a step.
    """
    up_to = seen.cumsum(axis=1)
    known = {size: 0.5 * int((up_to[size] > 0.01 * (n - 1)).argmax()) / _STEPS for size, n in enumerate(up_to[:, -1].tolist()) if n >= enough}
    if not known:
        return np.zeros(_CLASSES)
    first = min(known)
    return np.array([known[max(k for k in known if k <= size)] if size >= first else known[first] * 2 ** ((size - first) / 2) for size in range(_CLASSES)])


def fit(docs: DataFrame, per_language: int = 4, sample_rows: int = 2048, most_languages: int = 512) -> Centroids | None:
    """Centroids from training_rows(docs); None without training rows.

    The driver holds the sample's vectors once, sample_rows * DIMS * 4 bytes, a row of statistics for each feature,
    one for each language, and one for each size class and step of the cosine that occur.
    """
    training = training_rows(docs)
    stats = training.select("text", "lang").transform(map_arrow, _statistics, "lang string, feature int, n bigint").groupBy("lang", "feature").agg(F.sum("n").alias("n")).take(DIMS + most_languages + 1)
    if sum(row.feature < 0 for row in stats) > most_languages or len(stats) > DIMS + most_languages:
        raise ValueError(f"lang has more than {most_languages} values")
    rows_of = {row.lang: row.n for row in stats if row.feature < 0}
    if not rows_of:
        return None
    frequency = np.zeros(DIMS)
    for row in stats:
        if row.feature >= 0:
            frequency[row.feature] = row.n
    idf = (np.log((1 + sum(rows_of.values())) / (1 + frequency)) + 1).astype(np.float32)

    share = sample_rows / len(rows_of)
    chance = F.create_map(*(F.lit(x) for lang, n in sorted(rows_of.items()) for x in (lang, min(1.0, share / n))))
    draw = F.xxhash64("text").bitwiseAND((1 << 52) - 1) / float(1 << 52)
    drawn = training.where(draw < F.element_at(chance, F.col("lang"))).groupBy("lang", F.xxhash64("text").alias("h")).agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    sample = drawn.transform(map_arrow, _sampled, "doc_id bigint, lang string, total bigint, features binary, weights binary").collect()
    sample.sort(key=lambda row: (row.lang, row.doc_id, row.total, row.features, row.weights))
    if not sample:
        return None
    vectors = np.zeros((len(sample), DIMS), np.float32)
    for vector, row in zip(vectors, sample):
        features = np.frombuffer(row.features, "<u2")
        weighted = np.frombuffer(row.weights, "<f4") * idf[features]
        vector[features] = weighted / np.linalg.norm(weighted)
    langs = np.array([row.lang for row in sample])
    names, centroids = [], []
    for lang in sorted(set(langs.tolist())):
        first, stop = np.searchsorted(langs, lang), np.searchsorted(langs, lang, "right")
        found = _cluster(vectors[first:stop], per_language)
        names += [lang] * len(found)
        centroids.append(found)
    matrix = np.concatenate(centroids).astype(np.float32)
    model = Centroids(names, matrix, idf, np.zeros(_CLASSES))
    seen = np.zeros((_CLASSES, _STEPS), np.int64)
    for row in training.select("text").transform(map_arrow, partial(_cosines, model=docs.sparkSession.sparkContext.broadcast(model)), "size int, step int, n bigint").groupBy("size", "step").agg(F.sum("n").alias("n")).collect():
        seen[row["size"], row["step"]] = row["n"]
    return replace(model, thresholds=_thresholds(seen))


def _scored(texts: list[str | None], model: Centroids | None) -> list[tuple[str, float, bool]]:
    """Language, score and rejection for each text."""
    out: list[tuple[str, float, bool]] = [(UNDETERMINED, 0.0, True)] * len(texts)
    if model is None:
        return out
    found = [(i, counts) for i, text in enumerate(texts) if text and (counts := gram_counts(text)) is not None]
    if found:
        counts = np.array([c for _, c in found])
        limits = model.thresholds[_size_class(counts.sum(axis=1))]
        for (i, _), best, cosine, limit in zip(found, *(x.tolist() for x in model.nearest(counts)), limits.tolist()):
            out[i] = (model.languages[best], cosine, cosine <= 0 or cosine < limit)
    return out


def _predicted(batches: Iterator[pa.RecordBatch], model: Broadcast[Centroids | None], names: tuple[str, str, str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
            part = batch.slice(at, _ROWS_AT_ONCE)
            scored = _scored(part.column("text").to_pylist(), model.value)
            columns = [pa.array(x, kind) for x, kind in zip(zip(*scored), (pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *names])


def predict(docs: DataFrame, model: Centroids | None, names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """docs with three more columns: the language, its cosine, and whether the text is rejected.

    Only the text is looked at. Columns of docs with the same names give way; choose other names to keep them.
    """
    docs = docs.drop(*names)
    schema = ", ".join([*(f"`{field.name.replace('`', '``')}` {field.dataType.simpleString()}" for field in docs.schema), *(f"`{n}` {t}" for n, t in zip(names, ("string", "double", "boolean")))])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.transform(map_arrow, partial(_predicted, model=sent, names=names), schema)
