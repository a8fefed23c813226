"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Corpus statistics (document frequencies, rows per language) come from all training rows. The weights come from a bounded
sample of them, by follow-the-regularised-leader with elastic-net penalties, and a temperature fitted on a part of the
sample that the weights do not see. Prediction is one pass over all whole texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.llm.wordsplit import LETTER, char_classes, codes, segments

BITS = 14
DIM = 1 << BITS
ROWS = 48
BUFFER = 1 << 19
UNDECIDED = "und"


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 4000  #: labelled rows the weights are fitted on, over all languages
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01
    calibration_part: int = 5  #: every n-th sampled row fits the temperature only


def hashed_grams(text: str) -> np.ndarray:
    """Hashed 1-, 2- and 3-grams of the words of a text, lower-cased and parted by everything but letters."""
    points = codes(text.lower())
    letter = char_classes()[points] == LETTER
    spaced = np.where(letter, points, 0).astype(np.uint64)
    padded = np.zeros(spaced.size + 2, np.uint64)
    padded[1:-1] = spaced
    keep = np.ones(padded.size, bool)
    keep[1:] = (padded[1:] != 0) | (padded[:-1] != 0)
    c = padded[keep]
    if c.size < 3:
        return np.zeros(0, np.int64)
    one = c[c != 0] * np.uint64(0x9E3779B97F4A7C15)
    two = c[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + c[1:] * np.uint64(0x165667B19E3779F9)
    inner = c[1:-1] != 0
    three = (two[:-1] * np.uint64(0xFF51AFD7ED558CCD) + c[2:] * np.uint64(0x27D4EB2F165667C5))[inner]
    grams = np.concatenate([one, two ^ np.uint64(0x5851F42D4C957F2D), three])
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    return (grams >> np.uint64(64 - BITS)).astype(np.int64)


def count_blocks(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """Counts of each hashed n-gram, some texts at a time; a text of any length is one row."""
    block, row, held, size = np.zeros((ROWS, DIM), np.int64), 0, [], 0

    def pour():
        nonlocal held, size
        if held:
            block.ravel()[:] += np.bincount(np.concatenate(held), minlength=ROWS * DIM)
        held, size = [], 0

    for text in texts:
        for segment in segments(text or ""):
            grams = hashed_grams(segment)
            held.append(grams + row * DIM)
            size += grams.size
            if size > BUFFER:
                pour()
        row += 1
        if row == ROWS:
            pour()
            yield block
            block, row = np.zeros((ROWS, DIM), np.int64), 0
    pour()
    if row:
        yield block[:row]


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of unit length: damped counts times inverse document frequency."""
    x = np.zeros(counts.shape, np.float32)
    seen = counts > 0
    x[seen] = 1 + np.log(counts[seen])
    x *= idf
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.maximum(norm, 1e-12)


def held_out(id_col: str) -> Column:
    """Remainder 2 of the checksum of the id's text; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def training_rows(documents: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    rows = documents.filter(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull())
    return rows.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("_key"), F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text"))


def corpus_statistics(rows: DataFrame) -> tuple[np.ndarray, dict[str, int]]:
    """Document frequency of every hashed n-gram and rows with letters per language, over all rows."""
    narrow = rows.select("_lang", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, languages = np.zeros(DIM, np.int64), {}
        for batch in batches:
            done = 0
            for block in count_blocks(x.as_py() for x in batch.column(1)):
                seen = block > 0
                frequency += seen.sum(0)
                for has, lang in zip(seen.any(1).tolist(), batch.column(0).slice(done, len(block)).to_pylist()):
                    if has:
                        languages[lang] = languages.get(lang, 0) + 1
                done += len(block)
        used = np.flatnonzero(frequency)
        names = [None] * used.size + list(languages)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.concatenate([used, np.full(len(languages), -1)]), pa.int64()),
             pa.array(np.concatenate([frequency[used], np.array(list(languages.values()), np.int64)]), pa.int64())],
            ["lang", "feature", "n"])

    # at most DIM rows and one per language come back
    found = narrow.mapInArrow(run, "lang string, feature bigint, n bigint").groupBy("lang", "feature").agg(F.sum("n").alias("n")).collect()
    frequency = np.zeros(DIM, np.int64)
    for r in found:
        if r["feature"] >= 0:
            frequency[r["feature"]] = r["n"]
    return frequency, {r["lang"]: r["n"] for r in found if r["feature"] < 0}


class Leader:
    """Follow the regularised leader, one softmax over all languages."""

    def __init__(self, languages: int, settings: Settings):
        self.s = settings
        self.z = np.zeros((languages, DIM))
        self.n = np.zeros((languages, DIM))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n, s = self.z[:, at], self.n[:, at], self.s
        return -np.sign(z) * np.maximum(np.abs(z) - s.l1, 0) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(w @ x)
        p[label] -= 1
        g = p[:, None] * x
        n = self.n[:, at]
        self.z[:, at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha * w
        self.n[:, at] = n + g * g


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least loss, by narrowing a bracket of its logarithm.

    The targets leave one row's share to the other languages, so that faultless rows do not ask for endless certainty.
    """
    n, k = logits.shape if len(labels) else (0, 1)
    if not n or k < 2:
        return 1.0
    target = np.full((n, k), 1 / (n + 2) / (k - 1))
    target[np.arange(n), labels] = 1 - 1 / (n + 2)

    def loss(t):
        z = logits / np.exp(t)
        z = z - z.max(1, keepdims=True)
        return (np.log(np.exp(z).sum(1)) - (target * z).sum(1)).mean()

    low, high = np.log(0.02), np.log(50.0)
    for _ in range(60):
        a, b = low + (high - low) * 0.382, low + (high - low) * 0.618
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # over the temperature

    def predict(self, counts: np.ndarray) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNDECIDED] * len(counts), [0.0] * len(counts)
        p = softmax(weighted(counts, self.idf) @ self.weights.T)
        best, lettered = p.argmax(1), counts.any(1)
        names = [self.languages[b] if ok else UNDECIDED for b, ok in zip(best.tolist(), lettered.tolist())]
        return names, np.where(lettered, p[np.arange(len(p)), best], 0.0).tolist()


def fit_languages(
    documents: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> LanguageModel:
    """Learn from the rows that are not held out and have an id, a language and a letter.

    The sample takes the rows of least hash, as many of each language, ``settings.sample_rows`` together. Their sparse rows
    are learned from in one task, in the order of the hash, so that the model does not depend on the partitioning.
    """
    rows = training_rows(documents, id_col, text_col, lang_col)
    frequency, languages = corpus_statistics(rows)
    names = sorted(languages)
    if not names:
        return LanguageModel([], np.zeros(DIM, np.float32), np.zeros((0, DIM), np.float32))
    idf = (np.log((1 + sum(languages.values())) / (1 + frequency)) + 1).astype(np.float32)
    each = max(2, settings.sample_rows // len(names))
    spread = float(2**63)
    bound = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(min(1.0, 1.5 * each / languages[n])))])
    likely = rows.filter((F.col("_key") + spread) / (2 * spread) <= bound[F.col("_lang")])
    number = {n: i for i, n in enumerate(names)}

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for block in count_blocks(x.as_py() for x in batch.column(2)):
                x = weighted(block, idf)
                at = [np.flatnonzero(r).astype(np.int32) for r in x]
                part = batch.slice(done, len(block))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([a.tobytes() for a in at], pa.binary()),
                     pa.array([r[a].tobytes() for r, a in zip(x, at)], pa.binary())], ["key", "lang", "at", "x"])
                done += len(block)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        sample = [(number[lang], np.frombuffer(at, np.int32), np.frombuffer(x, np.float32)) for _, lang, at, x in rows if at]
        seen = [r for i, r in enumerate(sample) if i % settings.calibration_part]
        unseen = [r for i, r in enumerate(sample) if not i % settings.calibration_part]
        leader = Leader(len(names), settings)
        for _ in range(settings.epochs):
            for label, at, x in seen:
                leader.learn(at, x, label)
        w = leader.weights()
        t = temperature(np.array([w[:, at] @ x for _, at, x in unseen]), np.array([r[0] for r in unseen]))
        yield pa.RecordBatch.from_arrays([pa.array([(w / t).astype(np.float32).tobytes()], pa.binary())], ["w"])

    chosen = likely.mapInArrow(sparse, "key bigint, lang string, at binary, x binary")
    least = Window.partitionBy("lang").orderBy("key", "at")
    chosen = chosen.withColumn("_k", F.row_number().over(least)).filter(F.col("_k") <= each).drop("_k")
    raw = chosen.repartition(1).mapInArrow(fit, "w binary").first()
    weights = np.frombuffer(raw[0], np.float32).reshape(len(names), DIM)
    return LanguageModel(names, idf, weights)


def predict_languages(documents: DataFrame, model: LanguageModel, text_col: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``documents`` plus the predicted language and its calibrated probability, from the text alone.

    Null texts and texts without a letter get ``und`` and 0. Columns of ``documents`` named like a result are replaced.
    """
    rest = [c for c in documents.columns if c not in (pred, score)]
    narrow = documents.select(*rest)
    at = rest.index(text_col)
    # weights and frequencies: a fixed number of features for each language
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for block in count_blocks(x.as_py() for x in batch.column(at)):
                n, s = held.value.predict(block)
                names += n
                scores += s
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, pred, score])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema)
    return narrow.mapInArrow(run, f"{schema}, `{pred}` string, `{score}` double")


def identify_languages(
    documents: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``id, held_out, lang_pred, score`` of every document, by a model of those not held out.

    Without any training row every document is ``und`` with score 0. Repeated rows are predicted each.
    """
    model = fit_languages(documents, settings, id_col, text_col, lang_col)
    out = predict_languages(documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), model, "_text")
    return out.select(F.col("_id").alias(id_col), held_out("_id").alias("held_out"), "lang_pred", "score")
