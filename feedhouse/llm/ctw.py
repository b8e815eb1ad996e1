"""Code lengths by context-tree weighting over binary-decomposed bytes.

A text is lower-case words with one blank after each, and a closing byte; every byte is eight binary decisions. A
decision's contexts are the last 0, 1 ... `depth` bytes of the running text, previous words included, blanks standing
before its start. (`score_documents` cuts contexts at the start of each word, `score_running` does not.) In each node
of the context tree the Krichevsky-Trofimov estimate of its own counts is mixed half and half with the product of its
children; so the prediction of a decision is a mixture over all depths, weighted by how well each explained the
training text. A context that never occurred adds nothing, its parent's estimate holds.

Trees are built from counts over all training documents and grow with them. The work is dealt by context: nodes
below one context of `depth - step` bytes are one group, bounded by 256^step contexts, whose root is then a leaf of
the group above, up to the empty context; weights go down the same way. A block of documents then meets the events, or
in the word model the words, that occur in it, and no vocabulary is ever sent whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.llm.common import arrow_pass, documents, drop, fold_of, settle, settle_alone, shared_partitions, ship_package

FOLDS, HELD_OUT = 7, 2
BLANK, END = 0x20, 0x0A
NODES = 256  # names of the binary decisions of a byte: 1 to 255

RESULT = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
          "score double, bits_per_byte double")


@dataclass(frozen=True)
class Settings:
    depth: int = 6  # at most 6: a context and the next byte share a signed 64-bit key
    step: int = 2
    block_bytes: int = 32 << 20
    words_per_block: int = 100_000
    # Rows that are worked on at once, plus the rest of the last group.
    chunk_rows: int = 200_000
    # Bytes of running text whose events are counted at once.
    slice_bytes: int = 1 << 20


# --- counts -------------------------------------------------------------------------------------------------------


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def in_blocks(batches: Iterator[pa.RecordBatch], size: int, text: int = 1) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of the batches with the number of their block; a block has about `size` bytes of text.

    Numbers follow from the partition and the order of its rows, which are the same whenever a table is read.
    """
    block, held = TaskContext.get().partitionId() << 24, 0
    for batch in batches:
        start = 0
        for i, length in enumerate(pa.compute.binary_length(batch.column(text)).to_pylist()):
            held += (length or 0) + 16
            if held >= size:
                yield block, batch.slice(start, i + 1 - start)
                block, held, start = block + 1, 0, i + 1
        if start < batch.num_rows:
            yield block, batch.slice(start)


def block_words(texts: DataFrame, settings: Settings) -> DataFrame:
    """block, word, n for the distinct words of each block: n occurrences in its training documents, or 0.

    The empty word stands for the end of a text, counted once per document.
    """

    def rows(block: int, seen: Counter, train: Counter) -> Iterator[pa.RecordBatch]:
        words = list(seen)
        for a in range(0, len(words), 100_000):
            part = words[a : a + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), block)), pa.array(part, pa.binary()),
                 pa.array([train.get(w, 0) for w in part], pa.int64())], names=["block", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        now, seen, train = None, set(), Counter()
        for block, part in in_blocks(batches, settings.block_bytes):
            if block != now:
                if now is not None:
                    yield from rows(now, seen, train)
                now, seen, train = block, {b""}, Counter()
            for text, held in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                words = text.lower().split()
                if held:
                    seen.update(words)
                else:
                    train.update(words)
                    train[b""] += 1
            seen.update(train)
        if now is not None:
            yield from rows(now, seen, train)

    return arrow_pass(texts, run, "block bigint, word binary, n bigint")


# --- bytes of words -----------------------------------------------------------------------------------------------


def spelled(words: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all byte events of the words, in order, and how many each word has.

    A key holds the context, the latest byte in front, and the coded byte last. The empty word is spelled END.
    """
    pad = bytes([BLANK]) * depth
    text = np.frombuffer(b"".join([pad + w + bytes([BLANK]) if w else pad + bytes([END]) for w in words]), np.uint8)
    sizes = np.fromiter((len(w) + 1 if w else 1 for w in words), np.int64, len(words))
    starts = np.cumsum(sizes + depth) - sizes
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    keys = np.zeros(len(at), np.int64)
    for back in range(1, depth + 1):
        keys = keys << 8 | text[at - back]
    return keys << 8 | text[at], sizes


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sum of each value over equal keys."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return (keys[first], *[np.add.reduceat(v[order], first) if len(keys) else v for v in values])


# --- trees --------------------------------------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x >= 0.5, by Stirling's series twelve steps further on."""
    shifted, below = x + 12, np.ones_like(x)
    for i in range(12):
        below = below * (x + i)
    inverse = 1 / shifted
    series = inverse * (1 / 12 - inverse**2 * (1 / 360 - inverse**2 * (1 / 1260 - inverse**2 / 1680)))
    return (shifted - 0.5) * np.log(shifted) - shifted + 0.5 * np.log(2 * np.pi) + series - np.log(below)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log probability that the estimator gives a run of a zeros and b ones."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - np.log(np.pi) - log_gamma(a + b + 1)


@dataclass
class Level:
    """Nodes of one depth, by id = context * 256 + decision: counts, and the log weighted probability."""

    ids: np.ndarray
    a: np.ndarray
    b: np.ndarray
    weighted: np.ndarray


def leaf_level(keys: np.ndarray, n: np.ndarray) -> Level:
    """Decisions of byte events."""
    byte = keys & 255
    ids, zeros, ones = [], [], []
    for k in range(8):
        bit = byte >> (7 - k) & 1
        ids.append((keys >> 8) * NODES + (1 << k | byte >> (8 - k)))
        zeros.append(np.where(bit == 0, n, 0))
        ones.append(np.where(bit == 1, n, 0))
    ids, a, b = summed(np.concatenate(ids), np.concatenate(zeros), np.concatenate(ones))
    return Level(ids, a, b, log_kt(a, b))


def parents(ids: np.ndarray) -> np.ndarray:
    return (ids >> 16) * NODES + (ids & 255)


def levels_up(level: Level, steps: int) -> list[Level]:
    """The level and the `steps` ones above it, the highest first."""
    out = [level]
    for _ in range(steps):
        below = out[0]
        ids, a, b, split = summed(parents(below.ids), below.a, below.b, below.weighted)
        out.insert(0, Level(ids, a, b, np.logaddexp(log_kt(a, b), split) - np.log(2)))
    return out


@dataclass
class Mix:
    """Prediction on the way down, node by node: weight not yet given away, probability of a one so far, and the
    estimate of the last node that has counts."""

    rest: np.ndarray
    one: np.ndarray
    last: np.ndarray

    def at(self, index: np.ndarray) -> Mix:
        return Mix(self.rest[index], self.one[index], self.last[index])


def enter(level: Level, mix: Mix, deepest: bool) -> Mix:
    """The mixture after the nodes of `level`; nodes without counts leave it as it is."""
    n = level.a + level.b
    estimate = (level.b + 0.5) / (n + 1.0)
    if deepest:
        share = np.ones(len(n))
    else:
        share = np.minimum(1.0, np.exp(log_kt(level.a, level.b) - np.log(2) - level.weighted))
    share = np.where(n > 0, share, 0.0)
    return Mix(mix.rest * (1 - share), mix.one + mix.rest * share * estimate, np.where(n > 0, estimate, mix.last))


def mix_down(levels: list[Level], mix: Mix, deepest: bool) -> Mix:
    """From the mixture after levels[0] to that after levels[-1], which are the tree's leaves if `deepest`."""
    for i, (above, below) in enumerate(zip(levels, levels[1:])):
        at = np.searchsorted(above.ids, parents(below.ids))
        mix = enter(below, mix.at(at), deepest and i == len(levels) - 2)
    return mix


def event_log10(keys: np.ndarray, leaves: Level, mix: Mix) -> np.ndarray:
    one = mix.one + mix.rest * mix.last
    total = np.zeros(len(keys))
    byte = keys & 255
    for k in range(8):
        at = np.searchsorted(leaves.ids, (keys >> 8) * NODES + (1 << k | byte >> (8 - k)))
        p = one[at]
        total += np.log10(np.where(byte >> (7 - k) & 1 == 1, p, 1 - p))
    return total


# --- the same, dealt by context -----------------------------------------------------------------------------------

# A node row: decision `id`, counts and weighted probability, or (kind 1) the mixture on arriving at it.
_NODE = "grp bigint, kind tinyint, id bigint, a bigint, b bigint, x double, y double, z double"
_FIELDS = ["grp", "kind", "id", "a", "b", "x", "y", "z"]


def _group(ids, bytes_below: int):
    """The context that is `bytes_below` bytes shorter than that of the node."""
    return ids >> (8 + 8 * bytes_below)


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[dict[str, np.ndarray]]:
    """Whole groups of rows that come sorted by `grp`, about `rows` at once."""
    held: list[pa.RecordBatch] = []
    size = 0

    def columns(table: pa.Table) -> dict[str, np.ndarray]:
        return {c: table.column(c).to_numpy() for c in table.column_names}

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            table = pa.Table.from_batches(held)
            group = table.column("grp").to_numpy()
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield columns(table.slice(0, cut))
                rest = table.slice(cut).combine_chunks()
                held, size = rest.to_batches(), rest.num_rows
    if size:
        yield columns(pa.Table.from_batches(held))


def _rows(fields: dict[str, np.ndarray], n: int, part: int = 100_000) -> Iterator[pa.RecordBatch]:
    for i in range(0, n, part):
        yield pa.RecordBatch.from_arrays([pa.array(v[i : i + part]) for v in fields.values()], names=list(fields))


def _node_rows(group: np.ndarray, kind: int, ids, a, b, x, y, z) -> Iterator[pa.RecordBatch]:
    values = [group, np.full(len(ids), kind, np.int8), ids, a, b, x, y, z]
    return _rows(dict(zip(_FIELDS, values)), len(ids))


def _dealt(df: DataFrame) -> DataFrame:
    return df.repartition(shared_partitions(df.sparkSession), "grp").sortWithinPartitions("grp")


def event_scores(events: DataFrame, settings: Settings) -> DataFrame:
    """key, log10 for a written table of events (key, n): how probable each is under the tree of those with n > 0."""
    cuts = list(range(settings.depth, 0, -settings.step))  # depth of the leaves of each round of groups
    if settings.depth > 6 or settings.depth % settings.step or len(cuts) < 2:
        raise ValueError("depth must be at most 6 and a multiple of step, two times step or more")
    step, rows = settings.step, settings.chunk_rows

    def parsed(chunk, leaf: bool) -> Level:
        nodes = chunk["kind"] == 0 if "kind" in chunk else slice(None)
        if leaf:
            return leaf_level(chunk["key"][nodes], chunk["n"][nodes])
        order = np.argsort(chunk["id"][nodes])
        return Level(*[chunk[c][nodes][order] for c in ("id", "a", "b", "x")])

    def climb(leaf: bool):
        def run(batches):
            for chunk in _chunks(batches, rows):
                top = levels_up(parsed(chunk, leaf), step)[0]
                zero = np.zeros(len(top.ids))
                yield from _node_rows(_group(top.ids, step), 0, top.ids, top.a, top.b, top.weighted, zero, zero)
        return run

    def descend(leaf: bool, root: bool):
        def run(batches):
            for chunk in _chunks(batches, rows):
                levels = levels_up(parsed(chunk, leaf), step)
                if root:
                    n = len(levels[0].ids)
                    mix = enter(levels[0], Mix(np.ones(n), np.zeros(n), np.full(n, 0.5)), False)
                else:
                    above = chunk["kind"] == 1
                    at = np.argsort(chunk["id"][above])
                    at = at[np.searchsorted(chunk["id"][above][at], levels[0].ids)]
                    mix = Mix(*[chunk[c][above][at] for c in ("x", "y", "z")])
                mix = mix_down(levels, mix, leaf)
                low = levels[-1]
                if leaf:
                    keys = chunk["key"][chunk["kind"] == 0]
                    yield from _rows({"key": keys, "log10": event_log10(keys, low, mix)}, len(keys))
                else:
                    zero = np.zeros(len(low.ids), np.int64)
                    yield from _node_rows(low.ids >> 8, 1, low.ids, zero, zero, mix.rest, mix.one, mix.last)
        return run

    # The context of a key without its `step` oldest bytes.
    own = events.select(F.shiftright("key", 8 + 8 * step).alias("grp"), "key", "n")
    levels = [settle(arrow_pass(_dealt(own), climb(True), _NODE), "tree")]
    for _ in cuts[2:]:
        levels.append(settle(arrow_pass(_dealt(levels[-1]), climb(False), _NODE), "tree"))
    # The last group is the whole tree over contexts of `step` bytes, 256^step contexts at most.
    mixes = None
    for nodes in reversed(levels):
        rows_in = nodes if mixes is None else nodes.unionByName(mixes)
        mixes = arrow_pass(_dealt(rows_in), descend(False, mixes is None), _NODE)
    kinds = {"kind": F.lit(0).cast("tinyint"), "id": F.lit(0).cast("bigint"),
             **{c: F.lit(0.0) for c in "xyz"}}
    leaf_rows = own.withColumns(kinds).unionByName(
        mixes.select("grp", "kind", "id", "x", "y", "z").withColumns(
            {"key": F.lit(0).cast("bigint"), "n": F.lit(0).cast("bigint")}))
    return arrow_pass(_dealt(leaf_rows), descend(True, False), "key bigint, log10 double")


# --- words and documents ------------------------------------------------------------------------------------------


def word_scores(words: DataFrame, settings: Settings) -> DataFrame:
    """hash, n, log10 for a written table of words (word, n); only occurrences n > 0 are learned from."""
    spark = words.sparkSession
    blocks = max(1, -(-words.count() // settings.words_per_block))
    depth = settings.depth
    dealt = words.withColumn("block", F.pmod(F.xxhash64("word"), F.lit(blocks)))

    def spell(table: pa.Table) -> pa.Table:
        keys, sizes = spelled(table.column("word").to_pylist(), depth)
        keys, n = summed(keys, np.repeat(table.column("n").to_numpy(), sizes))
        return pa.table({"block": np.full(len(keys), table.column("block")[0].as_py()), "key": keys, "n": n})

    spelt = settle(dealt.groupBy("block").applyInArrow(spell, "block bigint, key bigint, n bigint"), "spelled")
    events = settle(spelt.groupBy("key").agg(F.sum("n").alias("n")), "events")
    scored = spelt.select("block", "key").join(event_scores(events, settings), "key")

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        own = left.column("word").to_pylist()
        keys, sizes = spelled(own, depth)
        known = right.column("key").to_numpy()
        order = np.argsort(known)
        log10 = right.column("log10").to_numpy()[order][np.searchsorted(known[order], keys)]
        total = np.add.reduceat(log10, np.cumsum(sizes) - sizes)
        return pa.table({"hash": pa.array([word_hash(w) for w in own], pa.int64()), "n": left.column("n"),
                         "log10": total})

    ship_package(spark)
    return dealt.groupBy("block").cogroup(scored.groupBy("block")).applyInArrow(
        add, "hash bigint, n bigint, log10 double")


def score_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """RESULT per document, learning from those whose id's crc32 modulo FOLDS is not HELD_OUT.

    Null text counts as empty and has one token, the end; an empty table gives an empty result; repeated rows are
    learned from and scored each. `docs` is read twice and must come in the same order both times: pass a table.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
    )
    found = settle(block_words(texts, settings), "block-words")
    words = settle(found.groupBy("word").agg(F.sum("n").alias("n")), "words")
    total, distinct = words.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    scored = word_scores(words, settings)

    @F.pandas_udf("bigint")
    def hashed(word: pd.Series) -> pd.Series:
        return word.map(word_hash).astype("int64")

    met = found.select("block", hashed("word").alias("hash")).join(scored, "hash")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for block, part in in_blocks(batches, settings.block_bytes):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, block)), *part.columns],
                                             names=["block", *part.schema.names])

    numbered = arrow_pass(texts, blocks, "block bigint, doc_id bigint, text binary, held_out boolean")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        hashes = right.column("hash").to_numpy()
        order = np.argsort(hashes)
        hashes = hashes[order]
        n = right.column("n").to_numpy()[order]
        log10 = right.column("log10").to_numpy()[order]
        base = np.log10((n + 1) / (total + distinct + 1))
        at: dict[bytes, int] = {}

        def place(word: bytes) -> int:
            found = at.get(word)
            if found is None:
                found = at[word] = int(np.searchsorted(hashes, word_hash(word)))
            return found

        end = place(b"")
        out = []
        for text in left.column("text").to_pylist():
            own = text.lower().split()
            index = np.fromiter((at[w] if w in at else place(w) for w in own), np.int64, len(own))
            index = np.append(index, end)
            size = sum(map(len, own)) + len(own) + 1
            score = float(log10[index].sum())
            out.append((len(index), int(np.count_nonzero(n[index])), float(base[index].sum()), score,
                        -score * float(np.log2(10)) / size))
        tokens, known, base_score, own_score, bits = zip(*out)
        return pa.table({
            "doc_id": left.column("doc_id"), "held_out": left.column("held_out"),
            "n_tokens": pa.array(tokens, pa.int64()), "n_known": pa.array(known, pa.int64()),
            "train_tokens": pa.array([total] * len(out), pa.int64()), "base_score": pa.array(base_score),
            "score": pa.array(own_score), "bits_per_byte": pa.array(bits)})

    return numbered.groupBy("block").cogroup(met.groupBy("block")).applyInArrow(score, RESULT)


# --- running text -------------------------------------------------------------------------------------------------


def running(words: list[bytes]) -> bytes:
    """The text that is coded: each word and a blank, then END."""
    return b"".join([w + bytes([BLANK]) for w in words]) + bytes([END])


def running_keys(text: bytes, depth: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Keys of the byte events of text[start:stop], as `spelled` makes them, each with the `depth` bytes in front of it
    in the whole text; blanks stand before its start."""
    part = (bytes([BLANK]) * max(0, depth - start)) + text[max(0, start - depth) : stop]
    own = np.frombuffer(part, np.uint8)
    n = len(own) - depth
    keys = np.zeros(n, np.int64)
    for back in range(1, depth + 1):
        keys = keys << 8 | own[depth - back : depth - back + n]
    return keys << 8 | own[depth:]


def block_events(texts: DataFrame, settings: Settings) -> DataFrame:
    """block, key, n: the byte events of each block of (block, text, held_out), n of them in training documents, or 0.

    Events are counted slice by slice and summed per block, as far as one task reads it, before they leave the task.
    """
    depth, size = settings.depth, settings.slice_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        now = None
        held: list[tuple[np.ndarray, int]] = []
        waiting = 0
        done: list[tuple[np.ndarray, np.ndarray]] = []

        def count() -> None:
            nonlocal held, waiting
            if held:
                keys = np.concatenate([k for k, _ in held])
                n = np.concatenate([np.full(len(k), train, np.int64) for k, train in held])
                done.append(summed(keys, n))
            held, waiting = [], 0
            if len(done) >= 16:
                done[:] = [summed(*map(np.concatenate, zip(*done)))]

        def rows() -> Iterator[pa.RecordBatch]:
            count()
            if done:
                keys, n = summed(*map(np.concatenate, zip(*done)))
                done.clear()
                yield from _rows({"block": np.full(len(keys), now, np.int64), "key": keys, "n": n}, len(keys))

        for batch in batches:
            for block, text, out in zip(*[batch.column(c).to_pylist() for c in ("block", "text", "held_out")]):
                if block != now:
                    if now is not None:
                        yield from rows()
                    now = block
                whole = running(text.lower().split())
                for start in range(0, len(whole), size):
                    keys = running_keys(whole, depth, start, start + size)
                    held.append((keys, 0 if out else 1))
                    waiting += len(keys)
                    if waiting >= size:
                        count()
        if now is not None:
            yield from rows()

    return arrow_pass(texts, run, "block bigint, key bigint, n bigint")


def score_running(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """RESULT per document, as `score_documents` gives it, with contexts that run on over the ends of words.

    Documents are dealt into blocks once and written, so that counts and scores are of the same blocks however often a
    task runs.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for block, part in in_blocks(batches, settings.block_bytes):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, block)), *part.columns],
                                             names=["block", *part.schema.names])

    dealt = settle(arrow_pass(texts, deal, "block bigint, doc_id bigint, text binary, held_out boolean"), "blocks")
    texts = dealt.select("block", "text", "held_out")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        now, seen, train = None, set(), Counter()

        def rows() -> Iterator[pa.RecordBatch]:
            words = list(seen | set(train))
            for a in range(0, len(words), 100_000):
                part = words[a : a + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), now)), pa.array(part, pa.binary()),
                     pa.array([train[w] for w in part], pa.int64())], names=["block", "word", "n"])

        for batch in batches:
            for block, text, out in zip(*[batch.column(c).to_pylist() for c in ("block", "text", "held_out")]):
                if block != now:
                    if now is not None:
                        yield from rows()
                    now, seen, train = block, {b""}, Counter()
                words = text.lower().split()
                if out:
                    seen.update(words)
                else:
                    train.update(words)
                    train[b""] += 1
        if now is not None:
            yield from rows()

    found = settle(arrow_pass(texts, split, "block bigint, word binary, n bigint"), "block-words")
    words = settle(found.groupBy("word").agg(F.sum("n").alias("n")), "words")
    total, distinct = words.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    met = settle(block_events(texts, settings), "block-events")
    events = settle(met.groupBy("key").agg(F.sum("n").alias("n")), "events")

    @F.pandas_udf("bigint")
    def hashed(word: pd.Series) -> pd.Series:
        return word.map(word_hash).astype("int64")

    counts = settle(found.select("block", "word").join(words, "word").select(
        "block", F.lit(True).alias("is_word"), hashed("word").alias("key"), F.col("n").cast("double").alias("value")),
        "block-counts")
    drop(found, words)
    scored = settle_alone(lambda: event_scores(events, settings), "event-scores")
    drop(events)
    scores = met.select("block", "key").join(scored, "key").select(
        "block", F.lit(False).alias("is_word"), "key", F.col("log10").alias("value"))
    scores = settle(scores, "block-scores")
    drop(met, scored)
    known = counts.unionByName(scores)
    depth, size = settings.depth, settings.slice_bytes

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        word = right.column("is_word").to_numpy()
        keys, values = right.column("key").to_numpy(), right.column("value").to_numpy()
        hashes, n = keys[word], values[word]
        order = np.argsort(hashes)
        hashes, n = hashes[order], n[order].astype(np.int64)
        keys, values = keys[~word], values[~word]
        order = np.argsort(keys)
        keys, values = keys[order], values[order]
        base = np.log10((n + 1) / (total + distinct + 1))
        at: dict[bytes, int] = {}
        out = []
        for text in left.column("text").to_pylist():
            own = text.lower().split()
            whole = running(own)
            own.append(b"")
            for w in set(own):
                if w not in at:
                    at[w] = int(np.searchsorted(hashes, word_hash(w)))
            index = np.fromiter(map(at.__getitem__, own), np.int64, len(own))
            log10 = 0.0
            for start in range(0, len(whole), size):
                events = np.sort(running_keys(whole, depth, start, start + size))
                log10 += float(values[np.searchsorted(keys, events)].sum())
            out.append((len(index), int(np.count_nonzero(n[index])), float(base[index].sum()), log10,
                        -log10 * float(np.log2(10)) / len(whole)))
        tokens, seen, base_score, own_score, bits = zip(*out)
        return pa.table({
            "doc_id": left.column("doc_id"), "held_out": left.column("held_out"),
            "n_tokens": pa.array(tokens, pa.int64()), "n_known": pa.array(seen, pa.int64()),
            "train_tokens": pa.array([total] * len(out), pa.int64()), "base_score": pa.array(base_score),
            "score": pa.array(own_score), "bits_per_byte": pa.array(bits)})

    return dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(score, RESULT)


def op9_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_running(documents(spark, sf_dir))
