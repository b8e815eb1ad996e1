"""Exact top-k search by inner product, term by term.

A term is a component's place. Rows are packed into written blocks, and a block holds, per term, the postings of its
rows: place in the block and weight, zeros left out. Queries are sparse rows in chunks. A chunk meets every block once;
there each term of the chunk scatters its weighted postings into a dense array of scores, one row per query, one cell
per row of the block. Nothing is pruned: every cell gets its exact score. A partition selection keeps each query's
best `k` of the block, and the lists of the blocks merge in Spark.

Blocks are dealt into stripes, and chunks are copied to every stripe, where an equality join on the stripe pairs them:
a task holds one chunk and one block at a time, whatever the number of rows, and blocks move once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedhouse.llm.common import arrow_pass, settle, shared_partitions

_BLOCKS = "block long, ids binary, absent binary, ends binary, places binary, weights binary, norm double"
_CHUNKS = ("query_ids binary, homes binary, spots binary, starts binary, terms binary, weights binary, "
           "norm double")
_HITS = "home long, spot int, query_id long, vec_id long, score long"


@dataclass(frozen=True)
class Settings:
    k: int = 5
    # A component x stands for floor(scale * x).
    scale: int = 256
    # Rows in a block and queries in a chunk; their product is the size of a task's score array.
    block_rows: int = 2048
    chunk_queries: int = 256


def whole_vector(column: str, scale: int) -> Column:
    """Components as whole doubles; null for a vector that takes no part.

    That is a null vector, one with a null or non-finite component, and one whose squared length is 2^62 or more, as its
    scores need not fit a long. By the inequality of Cauchy and Schwarz every other score does.
    """
    x = F.col(column).cast("array<double>")
    scaled = F.transform(x, lambda c: F.floor(F.when(F.abs(c) < 2.0**52, c) * scale).cast("double"))
    length = F.aggregate(scaled, F.lit(0.0), lambda a, c: a + c * c)
    return F.when(F.coalesce(length < 2.0**62, F.lit(False)), scaled)


def _bytes(values, kind) -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()


def _pack(ids: list, vectors: list[np.ndarray], number: int) -> dict:
    """One block, its rows in order of id, rows without id last."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    sizes = np.array([len(vectors[i]) for i in order], dtype=np.int64)
    flat = np.concatenate([vectors[i] for i in order]).astype(np.int64)
    rows = np.repeat(np.arange(len(order)), sizes)
    terms = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    there = flat != 0
    rows, terms, flat = rows[there], terms[there], flat[there]
    by_term = np.argsort(terms, kind="stable")
    counts = np.bincount(terms, minlength=int(sizes.max(initial=0)))
    norms = np.bincount(rows, weights=flat.astype(np.float64) ** 2, minlength=len(order))
    return {
        "block": number,
        "ids": _bytes([0 if ids[i] is None else ids[i] for i in order], np.int64),
        "absent": _bytes([ids[i] is None for i in order], np.bool_),
        "ends": _bytes(np.cumsum(counts), np.int64),
        "places": _bytes(rows[by_term], np.int32),
        "weights": _bytes(flat[by_term], np.int64),
        "norm": float(np.sqrt(norms.max(initial=0.0))),
    }


def _blocks(block_rows: int):
    schema = pa.schema([("block", pa.int64()), *[(n, pa.binary()) for n in ("ids", "absent", "ends", "places", "weights")],
                        ("norm", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        ids: list = []
        vectors: list[np.ndarray] = []
        number = None

        def full():
            return pa.RecordBatch.from_pylist([_pack(ids, vectors, number)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            if number is None:
                number = batch.column(0)[0].as_py() << 32
            lists = batch.column(2)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            start = 0
            for vec_id, end in zip(batch.column(1).to_pylist(), ends):
                ids.append(vec_id)
                vectors.append(values[start:end])
                start = end
                if len(ids) == block_rows:
                    yield full()
                    number += 1
                    ids, vectors = [], []
        if ids:
            yield full()

    return run


def index_blocks(rows: DataFrame, settings: Settings = Settings(), id_column: str = "vec_id",
                 vector_column: str = "embedding") -> DataFrame:
    """Written blocks of postings over all rows that take part."""
    narrow = rows.select(
        F.spark_partition_id().cast("bigint").alias("part"), F.col(id_column).cast("bigint").alias("vec_id"),
        whole_vector(vector_column, settings.scale).alias("v"),
    ).where(F.col("v").isNotNull())
    return settle(arrow_pass(narrow, _blocks(settings.block_rows), _BLOCKS), "postings")


def _rows_of(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms and weights of a block's postings, in order of place, and where each place ends."""
    ends = np.frombuffer(block["ends"], np.int64)
    places = np.frombuffer(block["places"], np.int32)
    terms = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    order = np.argsort(places, kind="stable")
    n = len(block["ids"]) // 8
    return terms[order], np.frombuffer(block["weights"], np.int64)[order], np.cumsum(np.bincount(places, minlength=n))


def _chunks(every: int, chunk_queries: int):
    """Sparse rows of the queries of each block: the rows whose id is divisible by `every`."""
    names = ("query_ids", "homes", "spots", "starts", "terms", "weights")
    schema = pa.schema([*[(n, pa.binary()) for n in names], ("norm", pa.float64())])

    def chunk(held: list[tuple]) -> pa.RecordBatch:
        sizes = [len(h[3]) for h in held]
        return pa.RecordBatch.from_pylist([{
            "query_ids": _bytes([h[0] for h in held], np.int64),
            "homes": _bytes([h[1] for h in held], np.int64), "spots": _bytes([h[2] for h in held], np.int32),
            "starts": _bytes(np.cumsum([0, *sizes]), np.int64),
            "terms": _bytes(np.concatenate([h[3] for h in held]), np.int32),
            "weights": _bytes(np.concatenate([h[4] for h in held]), np.int64), "norm": max(h[5] for h in held),
        }], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for block in batch.to_pylist():
                ids = np.frombuffer(block["ids"], np.int64)
                asked = np.flatnonzero((ids % every == 0) & ~np.frombuffer(block["absent"], np.bool_))
                terms, weights, ends = _rows_of(block)
                for spot in asked:
                    at = slice(ends[spot - 1] if spot else 0, ends[spot])
                    held.append((ids[spot], block["block"], spot, terms[at], weights[at], block["norm"]))
                    if len(held) == chunk_queries:
                        yield chunk(held)
                        held = []
        if held:
            yield chunk(held)

    return run


def accumulate(queries: dict, block: dict) -> np.ndarray:
    """Scores of all queries of a chunk with all rows of a block, term by term."""
    n = len(block["ids"]) // 8
    starts = np.frombuffer(queries["starts"], np.int64)
    asked = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    terms, weights = np.frombuffer(queries["terms"], np.int32), np.frombuffer(queries["weights"], np.int64)
    ends, places = np.frombuffer(block["ends"], np.int64), np.frombuffer(block["places"], np.int32)
    # No partial sum is larger than the product of the two lengths.
    kind = np.int32 if queries["norm"] * block["norm"] < 2**30 else np.int64
    posted = np.frombuffer(block["weights"], np.int64).astype(kind, copy=False)
    scores = np.zeros((len(starts) - 1, n), dtype=kind)
    by_term = np.argsort(terms, kind="stable")
    asked, terms, weights = asked[by_term], terms[by_term], weights[by_term].astype(kind, copy=False)
    firsts = np.flatnonzero(np.diff(terms, prepend=-1))
    for first, last in zip(firsts, [*firsts[1:], len(terms)]):
        term = terms[first]
        if term >= len(ends):
            break
        at = slice(ends[term - 1] if term else 0, ends[term])
        rows, cells, posting = asked[first:last], places[at], posted[at]
        if len(cells) > n // 2:
            # A long posting list is spread over the row once, which saves an index per score.
            line = np.zeros(n, dtype=kind)
            line[cells] = posting
            for row, weight in zip(rows, weights[first:last]):
                scores[row] += weight * line
        else:
            for row, weight in zip(rows, weights[first:last]):
                scores[row, cells] += weight * posting
    return scores


def select(queries: dict, block: dict, k: int) -> dict[str, np.ndarray]:
    """The best `k` rows of the block for each query, ties to the smaller place, a query's own row left out."""
    scores = accumulate(queries, block).astype(np.int64, copy=False)
    count, n = scores.shape
    homes, spots = np.frombuffer(queries["homes"], np.int64), np.frombuffer(queries["spots"], np.int32)
    own = np.where(homes == block["block"], spots, -1)
    want = min(n, k + 1)
    # The selection takes whole rows; one place more makes up for a query's own row. Rows that tie with the last one
    # taken are looked up by place.
    cut = np.partition(scores, n - want, axis=1)[:, n - want]
    picked_rows, picked_cells = [], []
    for row in range(count):
        line = scores[row]
        above = np.flatnonzero(line >= cut[row])
        above = above[above != own[row]]
        best = above[np.lexsort((above, -line[above]))[:k]]
        picked_rows.append(np.full(len(best), row))
        picked_cells.append(best)
    rows, cells = np.concatenate(picked_rows), np.concatenate(picked_cells)
    return {"rows": rows, "cells": cells, "scores": scores[rows, cells]}


def _search(k: int):
    schema = pa.schema([("home", pa.int64()), ("spot", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
                        ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                queries = {name.removeprefix("q_"): pair[name] for name in pair if name.startswith("q_")}
                hits = select(queries, pair, k)
                rows, cells = hits["rows"], hits["cells"]
                absent = np.frombuffer(pair["absent"], np.bool_)[cells]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.frombuffer(queries["homes"], np.int64)[rows]),
                    pa.array(np.frombuffer(queries["spots"], np.int32)[rows]),
                    pa.array(np.frombuffer(queries["query_ids"], np.int64)[rows]),
                    pa.array(np.frombuffer(pair["ids"], np.int64)[cells], mask=absent),
                    pa.array(hits["scores"]),
                ], schema=schema)

    return run


def search(blocks: DataFrame, every: int, settings: Settings = Settings()) -> DataFrame:
    """The `k` rows of highest inner product for each row whose id is divisible by `every`, its own row left out.

    Returns query_id, rank (from 1), vec_id, score. Ties go to the smaller id, rows without id last. Rows that repeat an
    id are rows of their own: each asks, and each may be found by the other. A component that one of two vectors lacks
    counts as zero. An empty table, and one without queries, gives no rows; fewer than `k` others, all of them.
    """
    spark = blocks.sparkSession
    size = blocks.agg(F.count("*").alias("blocks"), F.sum(F.octet_length("ids")).alias("bytes")).first()
    # As few tasks as fill their chunks.
    full = max(1, (size["bytes"] or 0) // (8 * every * settings.chunk_queries))
    chunks = settle(arrow_pass(blocks.coalesce(full), _chunks(every, settings.chunk_queries), _CHUNKS), "queries")
    stripes = max(1, min(size["blocks"], 4 * shared_partitions(spark)))
    dealt = chunks.select(
        F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"),
        *[F.col(c).alias(f"q_{c}") for c in chunks.columns])
    pairs = (
        blocks.withColumn("stripe", F.pmod(F.xxhash64("block"), F.lit(stripes)).cast("int"))
        .join(dealt.hint("shuffle_merge"), "stripe").drop("stripe")
    )
    hits = arrow_pass(pairs, _search(settings.k), _HITS)
    # Rows beyond a task's best `k` of a query are dropped before the shuffle.
    best = Window.partitionBy("home", "spot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (
        hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= settings.k)
        .select("query_id", "rank", "vec_id", "score")
    )


def top_rows(rows: DataFrame, every: int, settings: Settings = Settings()) -> DataFrame:
    """`search` over the whole of a table with columns vec_id and embedding; further columns are left out."""
    return search(index_blocks(rows, settings), every, settings)


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=50)
