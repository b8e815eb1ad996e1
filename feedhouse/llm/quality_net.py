"""Quality scores from random-indexing word vectors, pooled per document, and a small two-layer network.

Every word falls into one of a fixed number of buckets, each with a sparse random index vector. A pass over all
documents adds up, per bucket, the index vectors of the two words before and behind each occurrence: integer sums
that merge in any order. Their size is bounded by the settings (8 MB), whatever the corpus. A document is the mean
of its words' vectors, next to the mean of the index vectors of its words' shapes (case, trailing signs) and of two
pseudo words for a repeated word and a repeated line.

The network is fitted with numpy on a bounded sample of labelled rows, and its probabilities are calibrated by a
temperature on labelled rows it has not seen. Label, language, source and id are never inputs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedhouse.llm.common import arrow_pass, documents, fold_of, free_name, of_task, shared_partitions

FOLDS = 5
SLICE_BYTES = 1 << 20
CACHED_WORDS = 250_000
SLICE_BUCKETS = 32

# Shapes: 4 cases x 8 endings, and the two pseudo words.
SHAPES = 34
REPEATED_WORD, REPEATED_LINE = 32, 33


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 15
    dim: int = 64
    nonzero: int = 8
    window: int = 2
    hidden: int = 32
    # Bound on the labelled rows that the network is fitted and calibrated on.
    max_labelled: int = 20_000
    epochs: int = 30
    seed: int = 7
    cutoff: float = 0.3


# --- words --------------------------------------------------------------------------------------------------------


def shape_of(word: str) -> int:
    case = 2 if len(word) > 1 and word.isupper() else 1 if word[:1].isupper() else 0 if word.islower() else 3
    core = word.rstrip("!?.,;:#*$%&|<>\"')]}")
    tail = word[len(core):]
    if not core:
        end = 7
    elif not tail:
        end = 6 if any(c.isdigit() for c in core) else 0
    elif any(c in "#*$%&|<>" for c in tail):
        end = 5 if len(tail) > 2 else 4
    elif "!" in tail or "?" in tail:
        end = 3 if len(tail) > 1 else 2
    else:
        end = 1
    return case * 8 + end


class Codes(dict):
    """word -> bucket * 64 + shape, worked out once per word and task."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: str) -> int:
        core = word.lower().strip("!?.,;:#*$%&|<>\"'()[]{}") or word
        code = zlib.crc32(core.encode("utf-8", "replace")) % self.buckets * 64 + shape_of(word)
        if len(self) < CACHED_WORDS and len(word) <= 64:
            self[word] = code
        return code


_CODES: dict[int, Codes] = of_task({})


def codes_of(buckets: int) -> Codes:
    codes = _CODES.setdefault(buckets, Codes(buckets))
    if len(codes) >= CACHED_WORDS:
        codes.clear()
    return codes


def index_vectors(settings: Settings) -> np.ndarray:
    """Ternary rows with few entries that are not zero; the last row, for padding, is zero."""
    draw = np.random.default_rng(settings.seed)
    rows = np.zeros((settings.buckets + 1, settings.dim), np.int8)
    at = np.argsort(draw.random((settings.buckets, settings.dim)), axis=1)[:, : settings.nonzero]
    signs = draw.choice(np.array([-1, 1], np.int8), (settings.buckets, settings.nonzero))
    np.put_along_axis(rows[:-1], at, signs, axis=1)
    return rows


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about SLICE_BYTES of text."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= SLICE_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


# --- word vectors -------------------------------------------------------------------------------------------------


def context_sums(docs: DataFrame, settings: Settings) -> np.ndarray:
    """Per bucket, the sum of the index vectors around its occurrences in all documents."""
    width = SLICE_BUCKETS * settings.dim

    def count(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        index = index_vectors(settings).astype(np.int16)
        sums = np.zeros((settings.buckets + 1, settings.dim), np.int64)
        pad = np.full(settings.window, settings.buckets * 64, np.int64)
        codes = codes_of(settings.buckets)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in slices(texts):
                parts = [pad]
                for text in texts[a:b]:
                    words = (text or "").split()
                    parts += [np.fromiter(map(codes.__getitem__, words), np.int64, len(words)), pad]
                for at, row in windows_of(np.concatenate(parts) >> 6, index, settings.window):
                    sums[at] += row
        sums = sums[:-1]
        used = np.flatnonzero(sums.reshape(-1, width).any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array([sums.reshape(-1, width)[s].tobytes() for s in used], pa.binary())],
            names=["slice", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = np.frombuffer(sums, np.int64)
                totals[part] = totals[part] + row if part in totals else row
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([v.tobytes() for v in totals.values()], pa.binary())],
            names=["slice", "sums"])

    schema = "slice int, sums binary"
    partial = arrow_pass(docs.select("text"), count, schema)
    total = arrow_pass(partial.repartition(shared_partitions(docs.sparkSession), "slice"), add, schema)
    out = np.zeros((settings.buckets // SLICE_BUCKETS, width), np.int64)
    for row in total.collect():  # bounded by the settings
        out[row["slice"]] += np.frombuffer(row["sums"], np.int64)
    return out.reshape(settings.buckets, settings.dim)


def windows_of(
    buckets: np.ndarray, index: np.ndarray, window: int, chunk: int = 100_000
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and what their contexts add up to, chunk by chunk; both ends are padding."""
    for start in range(window, len(buckets) - window, chunk):
        stop = min(start + chunk, len(buckets) - window)
        around = np.zeros((stop - start, index.shape[1]), np.int16)
        for step in range(1, window + 1):
            around += index[buckets[start - step : stop - step]]
            around += index[buckets[start + step : stop + step]]
        own = buckets[start:stop].astype(np.uint16 if index.shape[0] <= 1 << 16 else np.uint32)
        order = np.argsort(own, kind="stable")
        own = own[order]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        yield own[first].astype(np.int64), np.add.reduceat(around[order], first, axis=0, dtype=np.int64)


def word_vectors(sums: np.ndarray, settings: Settings) -> np.ndarray:
    """Unit context vectors without what all words have in common, each with its own index vector added."""
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    unit = np.divide(sums, norm, out=np.zeros(sums.shape), where=norm > 0)
    used = norm[:, 0] > 0
    if used.any():
        unit[used] -= unit[used].mean(axis=0)
    own = index_vectors(settings)[:-1] / np.sqrt(settings.nonzero)
    return np.vstack([unit + own, np.zeros((1, settings.dim))]).astype(np.float32)


def shape_vectors(settings: Settings) -> np.ndarray:
    draw = np.random.default_rng(settings.seed + 1)
    return draw.choice(np.array([-1, 1], np.float32), (SHAPES, settings.dim)) / np.float32(np.sqrt(settings.dim))


def pool(texts: list[str | None], vectors: np.ndarray, shapes: np.ndarray, codes: Codes) -> np.ndarray:
    """One row per text: mean word vector, mean shape vector. Empty text gives zeros."""
    out = np.zeros((len(texts), vectors.shape[1] + shapes.shape[1]), np.float32)
    for row, text in enumerate(texts):
        text = text or ""
        words = text.split()
        if not words:
            continue
        code = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
        bucket = code >> 6
        total = np.zeros(vectors.shape[1])
        for a in range(0, len(code), 4096):
            total += vectors[bucket[a : a + 4096]].sum(axis=0)
        lines = [x for x in text.split("\n") if x.strip()]
        seen = np.bincount(code & 63, minlength=SHAPES).astype(np.float32)
        seen[REPEATED_WORD] = np.count_nonzero(bucket[1:] == bucket[:-1])
        seen /= len(words)
        seen[REPEATED_LINE] = 1 - len(set(lines)) / len(lines)
        out[row, : vectors.shape[1]] = total / len(words)
        out[row, vectors.shape[1] :] = seen @ shapes
    return out


# --- network ------------------------------------------------------------------------------------------------------


@dataclass
class Network:
    center: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((x - self.center) * self.scale) @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, settings: Settings) -> Network:
    """Adam on shuffled mini-batches with a little weight decay. Needs at least one row."""
    draw = np.random.default_rng(settings.seed)
    x = x.astype(np.float64)
    center, spread = x.mean(axis=0), x.std(axis=0)
    scale = np.where(spread > 1e-9, 1 / np.maximum(spread, 1e-9), 0.0)
    z = (x - center) * scale
    params = [draw.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], settings.hidden)), np.zeros(settings.hidden),
              draw.normal(0, 1 / np.sqrt(settings.hidden), settings.hidden), np.zeros(1)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for epoch in range(settings.epochs):
        rate = 0.01 * 0.5 * (1 + np.cos(np.pi * epoch / settings.epochs))
        for rows in np.array_split(draw.permutation(len(z)), max(1, len(z) // 256)):
            w1, b1, w2, b2 = params
            hidden = np.tanh(z[rows] @ w1 + b1)
            error = 1 / (1 + np.exp(-np.clip(hidden @ w2 + b2, -30, 30))) - y[rows]
            error /= len(rows)
            back = np.outer(error, w2) * (1 - hidden**2)
            grads = [z[rows].T @ back + 1e-4 * w1, back.sum(axis=0), hidden.T @ error + 1e-4 * w2,
                     np.array([error.sum()])]
            step += 1
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(center, scale, params[0], params[1], params[2], float(params[3][0]))


def calibrate(network: Network, x: np.ndarray, y: np.ndarray) -> Network:
    """The temperature between 1/4 and 8 with the least log loss on rows that the fit has not seen."""
    if len(y) == 0:
        return network
    logits = network.logits(x.astype(np.float64))

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, -logits / t) * y + np.logaddexp(0, logits / t) * (1 - y)))

    network.temperature = float(min(np.exp(np.linspace(np.log(0.25), np.log(8), 141)), key=loss))
    return network


# --- operator -----------------------------------------------------------------------------------------------------


def labelled_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, text, quality of labelled rows outside the held-out fold, about `max_labelled` at most.

    Rows are kept by a hash of their id, so the same rows come again.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), FOLDS) != 0))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    total = known.count()
    share = min(1.0, settings.max_labelled / max(1, total))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20))
    # At most about max_labelled rows of 12 bytes.
    picked = F.broadcast(known.where(drawn))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(picked, "doc_id")


def train(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[np.ndarray, Network | float]:
    """Word vectors, and the network; without labels of both kinds a constant score instead."""
    vectors = word_vectors(context_sums(docs, settings), settings)
    shapes = shape_vectors(settings)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        codes = codes_of(settings.buckets)
        for batch in batches:
            rows = pool(batch.column("text").to_pylist(), shared.value, shapes, codes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array([r.tobytes() for r in rows], pa.binary())],
                names=["doc_id", "quality", "x"])

    sample = arrow_pass(labelled_sample(docs, labels, settings), features, "doc_id bigint, quality int, x binary")
    # One row per id: a table with repeated rows must not outgrow the bound.
    rows = sorted(sample.groupBy("doc_id").agg(F.max("quality").alias("q"), F.min("x").alias("x")).collect())
    y = np.array([r["q"] for r in rows], np.float64)
    if len(set(y.tolist())) < 2:
        return vectors, float(y[0]) if len(y) else 0.5
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows])
    part = np.array([zlib.crc32(b"calibrate" + str(r["doc_id"]).encode()) % 5 == 0 for r in rows])
    if len(set(y[~part].tolist())) < 2:
        part[:] = False
    return vectors, calibrate(fit_network(x[~part], y[~part], settings), x[part], y[part])


def score_documents(docs: DataFrame, labels: DataFrame, name: str = "score", settings: Settings = Settings()) -> DataFrame:
    """`docs` plus the score `name`, 0 to 1, higher where label 1 is likelier.

    Word vectors are learned from all of `docs`. Null text counts as empty and is scored like it; labels that are
    null or other than 0 and 1 are not learned from; of several labels of one id the highest holds. `docs` is read
    three times: pass a written table.
    """
    vectors, network = train(docs, labels, settings)
    shapes = shape_vectors(settings)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    at = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        codes = codes_of(settings.buckets)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            if isinstance(network, float):
                scores = np.full(len(texts), network)
            else:
                scores = network.scores(pool(texts, shared.value, shapes, codes).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return arrow_pass(docs, score, schema)


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that the classifier accepts, with the columns they came with."""
    name = free_name(docs.columns, "_score")
    return score_documents(docs, labels, name, settings).where(F.col(name) >= settings.cutoff).drop(name)


def op5_random_indexing_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = Settings()
    scored = score_documents(documents(spark, sf_dir).select("doc_id", "text"),
                             spark.read.parquet(f"{sf_dir}/labels.parquet"), settings=settings)
    return scored.select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= settings.cutoff, 1).otherwise(0).alias("predicted"))
