"""Centroid clustering with heap-ordered bounds.

Vectors lie in written blocks. In a block each cluster keeps a heap of its vectors by the gap between the lower bound of
the distance to any other centroid and the upper bound of the distance to its own. When centroids move, no bound is
touched: a cluster accumulates its drift, its own centroid's way plus the longest way of another, and a vector's key is
its gap plus the drift at the time it was put in. While the least key of a heap lies above the drift, no vector of that
cluster can have changed; else vectors are popped until it does, and only those are compared with all centroids, exactly.

The driver holds the centroids and the drifts, a few numbers per cluster. Sums change by the vectors that move.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.llm.common import arrow_pass, settle
from feedhouse.session import delete_path, scratch_path

# Larger components have distances that need not fit a long.
LARGEST = 2.0**27
# Sums of squares below this are exact in doubles.
EXACT = 2.0**52

_NAMES = ("ids", "absent", "vectors", "labels", "keys", "places", "sizes")
_STATE = ", ".join(f"{name} binary" for name in _NAMES)
_MOVES = "moves array<struct<cluster:int,n:long,popped:long,sums:array<long>>>"


@dataclass(frozen=True)
class Settings:
    clusters: int = 40
    dimensions: int = 64
    rounds: int = 5
    # A component x stands for floor(scale * x).
    scale: int = 256
    seed: int = 2
    block_rows: int = 4096


@dataclass
class Centroids:
    """Whole numbers, and for each cluster the drift accumulated so far."""

    at: np.ndarray
    drift: np.ndarray
    # Vectors compared with all centroids, turn by turn.
    popped: list[int] = field(default_factory=list)


def whole_vector(column: str, settings: Settings) -> Column:
    """Components as whole numbers; null for a vector that takes no part.

    That is a null vector, one of another length, one with a null or non-finite component, and one with a component of
    2^27 or more once scaled, as its distances need not fit a long.
    """
    x = F.col(column).cast("array<double>")
    fits = lambda c: F.coalesce(F.abs(c) * settings.scale < LARGEST, F.lit(False))
    return F.when((F.size(x) == settings.dimensions) & F.forall(x, fits),
                  F.transform(x, lambda c: F.floor(c * settings.scale)))


# --- inside a block -------------------------------------------------------------------------------------------------


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole vectors to whole centroids."""
    reach = 2 * max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0))
    if float(reach) ** 2 * vectors.shape[1] < EXACT:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((v * v).sum(axis=1)[:, None] - 2.0 * (v @ c.T) + (c * c).sum(axis=1)[None, :]).astype(np.int64)
    out = np.empty((len(vectors), len(centroids)), dtype=np.int64)
    for j, centroid in enumerate(centroids):
        out[:, j] = ((vectors - centroid) ** 2).sum(axis=1)
    return out


class Block:
    """Vectors, the cluster of each, and one heap of (key, place) per cluster."""

    def __init__(self, row: dict, settings: Settings):
        self.row = row
        self.vectors = np.frombuffer(row["vectors"], np.int32).reshape(-1, settings.dimensions).astype(np.int64)
        self.labels = np.frombuffer(row["labels"], np.int32).copy()
        self.sizes = np.frombuffer(row["sizes"], np.int32)
        self.keys = np.frombuffer(row["keys"], np.float64)
        self.places = np.frombuffer(row["places"], np.int32)
        self.ends = np.cumsum(self.sizes)
        # Heaps are taken out of their arrays only where something expires or comes in.
        self.open: dict[int, list] = {}

    def heap(self, cluster: int) -> list:
        if cluster not in self.open:
            if cluster < len(self.sizes):
                at = slice(self.ends[cluster] - self.sizes[cluster], self.ends[cluster])
                self.open[cluster] = list(zip(self.keys[at].tolist(), self.places[at].tolist()))
            else:
                self.open[cluster] = []
        return self.open[cluster]

    def expired(self, drift: np.ndarray) -> np.ndarray:
        """Places of the vectors whose gap is used up, popped; all of them before the first assignment."""
        if not len(self.sizes):
            return np.arange(len(self.vectors))
        popped = []
        for cluster in np.flatnonzero(self.sizes):
            # Bounds are rounded: a gap counts as used up a little early.
            limit = drift[cluster] * (1 + 1e-12) + 1e-6
            if self.keys[self.ends[cluster] - self.sizes[cluster]] > limit:
                continue
            heap = self.heap(int(cluster))
            while heap and heap[0][0] <= limit:
                popped.append(heapq.heappop(heap)[1])
        return np.array(popped, dtype=np.int64)

    def assign(self, centroids: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bring all clusters up to date; the places compared with all centroids, and their clusters before (-1: none)."""
        popped = self.expired(drift)
        before = self.labels[popped]
        if len(popped):
            distances = squared_distances(self.vectors[popped], centroids)
            nearest = distances.argmin(axis=1)
            upper = np.sqrt(distances[np.arange(len(popped)), nearest].astype(np.float64))
            if len(centroids) > 1:
                lower = np.sqrt(np.partition(distances, 1, axis=1)[:, 1].astype(np.float64))
            else:
                lower = np.full(len(popped), np.inf)
            self.labels[popped] = nearest
            keys = lower - upper + drift[nearest]
            for key, place, cluster in zip(keys.tolist(), popped.tolist(), nearest.tolist()):
                heapq.heappush(self.heap(cluster), (key, place))
        return popped, before

    def state(self, clusters: int) -> dict:
        """The block's row, with its clusters and heaps as they stand."""
        keys, places, sizes = [], [], np.zeros(clusters, dtype=np.int32)
        for cluster in range(clusters):
            if cluster in self.open:
                heap = self.open[cluster]
                keys.append(np.array([k for k, _ in heap], dtype=np.float64))
                places.append(np.array([p for _, p in heap], dtype=np.int32))
            elif cluster < len(self.sizes):
                at = slice(self.ends[cluster] - self.sizes[cluster], self.ends[cluster])
                keys.append(self.keys[at])
                places.append(self.places[at])
            else:
                continue
            sizes[cluster] = len(keys[-1])
        return {**self.row, "labels": self.labels.tobytes(), "keys": np.concatenate(keys).tobytes(),
                "places": np.concatenate(places).tobytes(), "sizes": sizes.tobytes()}


# --- passes ---------------------------------------------------------------------------------------------------------


def _pack(settings: Settings):
    schema = pa.schema([(n, pa.binary()) for n in _NAMES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            vectors = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, settings.dimensions)
            ids = batch.column(0)
            for first in range(0, batch.num_rows, settings.block_rows):
                held = ids.slice(first, settings.block_rows)
                n = len(held)
                yield pa.RecordBatch.from_pylist([{
                    "ids": held.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
                    "absent": held.is_null().to_numpy(zero_copy_only=False).tobytes(),
                    "vectors": vectors[first : first + n].astype(np.int32).tobytes(),
                    "labels": np.full(n, -1, dtype=np.int32).tobytes(), "keys": b"", "places": b"", "sizes": b"",
                }], schema=schema)

    return run


def _assigned(centroids: Centroids, settings: Settings):
    """Blocks after an assignment, each with the counts and sums that it changes per cluster."""
    at, drift = centroids.at, centroids.drift
    schema = pa.schema([*[(n, pa.binary()) for n in _NAMES], ("moves", pa.list_(pa.struct([
        ("cluster", pa.int32()), ("n", pa.int64()), ("popped", pa.int64()), ("sums", pa.list_(pa.int64()))])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block({n: batch.column(j)[i].as_py() for j, n in enumerate(_NAMES)}, settings)
                popped, before = block.assign(at, drift)
                after = block.labels[popped]
                moves = []
                for cluster in range(len(at)):
                    came = popped[(after == cluster) & (before != cluster)]
                    went = popped[(before == cluster) & (after != cluster)]
                    compared = int((after == cluster).sum())
                    if compared or len(went):
                        sums = block.vectors[came].sum(axis=0) - block.vectors[went].sum(axis=0)
                        moves.append({"cluster": cluster, "n": len(came) - len(went), "popped": compared,
                                      "sums": sums.tolist()})
                yield pa.RecordBatch.from_pylist([{**block.state(len(at)), "moves": moves}], schema=schema)

    return run


def _results(centroids: np.ndarray, settings: Settings):
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                vectors = np.frombuffer(row["vectors"], np.int32).reshape(-1, settings.dimensions).astype(np.int64)
                labels = np.frombuffer(row["labels"], np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.frombuffer(row["ids"], np.int64), mask=np.frombuffer(row["absent"], np.bool_)),
                    pa.array(labels), pa.array(((vectors - centroids[labels]) ** 2).sum(axis=1)),
                ], schema=schema)

    return run


def first_centroids(kept: DataFrame, settings: Settings) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id, in order of hash; rows of one id in order of content."""
    name = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(name.alias("name"), "v").orderBy("name", "v").limit(settings.clusters).collect()
    return np.array([r.v for r in rows], dtype=np.int64).reshape(len(rows), settings.dimensions)


def moved(centroids: Centroids, sums: np.ndarray, counts: np.ndarray) -> None:
    """Replace each non-empty centroid by the floor of its vectors' mean, and add to the drifts."""
    new = centroids.at.copy()
    for cluster in np.flatnonzero(counts):
        new[cluster] = [int(s) // int(counts[cluster]) for s in sums[cluster]]
    way = np.sqrt(((new - centroids.at) ** 2).sum(axis=1).astype(np.float64))
    longest = np.array([np.delete(way, c).max(initial=0.0) for c in range(len(way))])
    centroids.drift = centroids.drift + (way + longest) * (1 + 1e-12)
    centroids.at = new


def cluster(rows: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, Centroids]:
    """vec_id, cluster, distance (squared) of each vector that takes part, and the final centroids.

    Assignments are exact, ties to the smaller number. Repeated rows and rows without id are vectors of their own. With
    fewer vectors than clusters each vector starts one. An empty table gives no rows.
    """
    spark = rows.sparkSession
    kept = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole_vector("embedding", settings).alias("v"))
    kept = kept.where(F.col("v").isNotNull())
    first = first_centroids(kept, settings)
    centroids = Centroids(first, np.zeros(len(first)))
    if not len(first):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    state = arrow_pass(kept, _pack(settings), _STATE)
    sums, counts = np.zeros((len(first), settings.dimensions), dtype=object), np.zeros(len(first), dtype=object)
    older = None
    for turn in range(settings.rounds + 1):
        path = scratch_path(spark, f"clusters-{turn}")
        passed = arrow_pass(state, _assigned(centroids, settings), f"{_STATE}, {_MOVES}")
        passed.write.parquet(path)
        written = spark.read.schema(passed.schema).parquet(path)
        if older:
            delete_path(spark, older)
        older = path
        change = written.select(F.explode("moves").alias("m")).groupBy("m.cluster").agg(
            F.sum("m.n").alias("n"), F.sum("m.popped").alias("popped"),
            *[F.sum(F.col("m.sums")[d]).alias(f"s{d}") for d in range(settings.dimensions)])
        popped = 0
        for row in change.collect():
            counts[row["cluster"]] += row["n"]
            sums[row["cluster"]] += np.array(row[3:], dtype=object)
            popped += row["popped"]
        centroids.popped.append(popped)
        state = written.drop("moves")
        if turn < settings.rounds:
            moved(centroids, sums, counts)
    return arrow_pass(state, _results(centroids.at, settings), "vec_id long, cluster int, distance long"), centroids


def with_inertia(assigned: DataFrame, centroids: Centroids) -> DataFrame:
    """The assignment with the distance summed over each cluster and over all, and a hash of the final centroid.

    A sum that does not fit a long is null.
    """
    spark = assigned.sparkSession
    table = settle(assigned, "assigned")
    # One row per cluster.
    sums = table.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia")).collect()
    total = sum(r.cluster_inertia for r in sums) if all(r.cluster_inertia is not None for r in sums) else None
    total = None if total is None or total >= 2**63 else total
    hashes = [hashlib.sha256(",".join(str(int(x)) for x in at).encode()).hexdigest() for at in centroids.at]
    few = spark.createDataFrame([(r.cluster, r.cluster_inertia, total, hashes[r.cluster]) for r in sums],
                                "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return table.join(F.broadcast(few), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_heap_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_inertia(*cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
