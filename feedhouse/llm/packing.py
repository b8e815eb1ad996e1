"""Token sequences of a fixed length, filled by a grouping genetic algorithm on islands.

Documents become token ids in one pass over the texts; only lengths and checksums go on. Pieces are dealt by hash
into groups of about `group_size`, each group lives on several islands, and an island is one task: it evolves its
own population of packings, a crossover carrying whole well-filled sequences from one parent into the other,
removing what is there twice and placing displaced documents by best fit. After each epoch an island hands its
best packing to the next one. Sequences that stay under-filled are opened again and packed once more across groups.

Nothing but lengths and row numbers leaves the texts; a group never holds more than about `group_size` pieces.
"""

from __future__ import annotations

import json
import os
import random
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.llm.common import arrow_pass, documents, settle, ship_package

END_ID = 1
LATIN_LETTERS, LATIN_NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
# Characters of the texts whose pieces are looked up together, and of the words of one call to the vocabulary.
SLICE_CHARS, CALL_CHARS = 2_000_000, 200_000
END_MARK = "\x01"
_CONTROLS, _BEYOND_LATIN = re.compile(r"[\x01\x1c-\x1f]"), re.compile(r"[^\x00-\xff]")

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@dataclass(frozen=True)
class Settings:
    capacity: int = 4096
    group_size: int = 6000
    islands: int = 3
    epochs: int = 2
    population: int = 4
    offspring: int = 6
    # Share of a parent's sequences that a crossover injects.
    inject: float = 0.12
    # Sequences below this fill are opened again for the last pass over all groups.
    settled_fill: float = 0.985


# --- tokens -------------------------------------------------------------------------------------------------------


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class TextIds:
    """Ids of whole texts, put together from those of their pieces; a piece is looked up once for many texts.

    The vocabulary cuts a lower-cased text by a pattern, marks the end of each piece and merges within pieces only. So
    the different pieces of Latin-1 texts go, each with a byte behind it that stands for its end, through a merge
    table without normalizer; its order is that of the vocabulary's merges, the marking of ends coming first. Words
    with other letters take the vocabulary's own way. A text with special token strings, or with a control character
    that is the end mark or that Python but not the vocabulary takes for white space, is encoded as one.

    Nothing is remembered from call to call.
    """

    def __init__(self, path: str):
        from tiktoken._tiktoken import CoreBPE
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        pattern = parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # Letters and numbers of Latin-1 in lower case, spelled out for Python's own, faster patterns.
        self.cut = re.compile(pattern.replace(r"\p{L}", LATIN_LETTERS).replace(r"\p{N}", LATIN_NUMBERS)).findall
        self.ranks, ids = merge_ranks(parts["model"])
        self.merges = CoreBPE(self.ranks, {}, f"[^{END_MARK}]+{END_MARK}")
        self.id_of = np.array(ids, "<u4")
        self.closes = np.array([len(k) > 1 and k.endswith(END_MARK.encode()) for k in self.ranks])

    def plain(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def latin(self, pieces: list[str]) -> list[bytes]:
        """Ids of lower-cased pieces of Latin-1."""
        if not pieces:
            return []
        joined = END_MARK.join(pieces) + END_MARK
        found = np.frombuffer(self.merges.encode_to_tiktoken_buffer(joined, set()), np.uint32)
        ids = self.id_of[found].tobytes()
        cuts = (4 * (np.flatnonzero(self.closes[found]) + 1)).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]

    def other(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words without white space, so many at a time, told apart by their places."""
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        share = np.cumsum(sizes) // CALL_CHARS
        for at, size in zip(*[x.tolist() for x in np.unique(share, return_index=True, return_counts=True)[1:]]):
            found = self.tokenizer.encode("\n".join(words[at : at + size]), add_special_tokens=False)
            ids = np.asarray(found.ids, "<u4").tobytes()
            starts = np.fromiter((start for start, _ in found.offsets), np.int64, len(found.offsets))
            ends = np.cumsum(sizes[at : at + size])
            cuts = (4 * np.searchsorted(starts, np.r_[0, ends])).tolist()
            yield from (ids[a:b] for a, b in zip(cuts, cuts[1:]))

    def pieces(self, text: str) -> list[str] | None:
        """What the ids of a text are put together from; None if it must be encoded as one."""
        if _CONTROLS.search(text) or ("<|" in text and any(s in text for s in self.special)):
            return None
        if text.isascii() or not _BEYOND_LATIN.search(text):
            return self.cut(text.lower())
        out = []
        for word in text.split():
            if _BEYOND_LATIN.search(word):
                out.append(word)
            else:
                out += self.cut(word.lower())
        return out

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [self.pieces(t) for t in texts]
        different = set(chain.from_iterable(x for x in split if x is not None))
        other = [x for x in different if not x.isascii() and _BEYOND_LATIN.search(x)]
        latin = list(different.difference(other))
        known = dict(zip(latin, self.latin(latin)))
        known.update(zip(other, self.other(other)))
        for text, pieces in zip(texts, split):
            yield self.plain(text) if pieces is None else b"".join(map(known.__getitem__, pieces))


def merge_ranks(model: dict) -> tuple[dict[bytes, int], list[int]]:
    """Bytes of every token, an end mark behind those that end a piece, with their merge order; and their ids."""
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b > 173]
    chars = {b: chr(b) for b in shown}
    chars |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in chars)}
    byte_of = {c: b for b, c in chars.items()}
    suffix, vocab = model["end_of_word_suffix"], model["vocab"]

    def spelled(token: str) -> bytes:
        ends = token.endswith(suffix)
        return bytes(byte_of[c] for c in token.removesuffix(suffix)) + END_MARK.encode() * ends

    tokens = [*chars.values(), *[c + suffix for c in chars.values()], *[x + y for x, y in model["merges"]]]
    ids: dict[bytes, int] = {}
    for token in tokens:
        ids.setdefault(spelled(token), vocab[token])
    return {t: rank for rank, t in enumerate(ids)}, list(ids.values())


_TOKENIZERS: dict[str, TextIds] = {}


def text_ids(path: str) -> TextIds:
    """One per Python worker; it holds the vocabulary only."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = TextIds(path)
    return _TOKENIZERS[path]


def by_size(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of about SLICE_CHARS characters."""
    start = held = 0
    for at, text in enumerate(texts):
        if held and held + len(text) > SLICE_CHARS:
            yield start, at
            start, held = at, 0
        held += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def token_pieces(docs: DataFrame, path: str, capacity: int) -> DataFrame:
    """One row per piece: ids of the document with the end id behind, cut where they exceed `capacity`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        encoder = text_ids(path)
        for batch in batches:
            every = [t or "" for t in batch.column(1).to_pylist()]
            for start, stop in by_size(every):
                rows: list[tuple] = []
                for doc_id, ids in zip(batch.column(0)[start:stop].to_pylist(), encoder.ids(every[start:stop])):
                    ids += END_ID.to_bytes(4, "little")
                    for piece, at in enumerate(range(0, len(ids) // 4, capacity)):
                        cut = ids[4 * at : 4 * (at + capacity)]
                        rows.append((doc_id, piece, at, len(cut) // 4, zlib.crc32(cut)))
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return arrow_pass(docs.select(F.col("doc_id").cast("bigint"), F.col("text")), run, PIECES)


# --- one population -----------------------------------------------------------------------------------------------


def best_fit(lengths: list[int], order: Iterable[int], capacity: int, bins: list[list[int]], free: list[int]) -> None:
    """Put items into the fullest sequence that still takes them, or a new one; `bins` and `free` grow."""
    by_free: dict[int, list[int]] = {}
    spaces = 0  # bit f is set where some sequence has f free
    for b, f in enumerate(free):
        if f > 0:
            by_free.setdefault(f, []).append(b)
            spaces |= 1 << f
    for item in order:
        size = lengths[item]
        fitting = spaces >> size
        if fitting:
            f = size + (fitting & -fitting).bit_length() - 1
            same = by_free[f]
            b = same.pop()
            if not same:
                spaces ^= 1 << f
                del by_free[f]
            bins[b].append(item)
        else:
            f, b = capacity, len(bins)
            bins.append([item])
            free.append(f)
        free[b] = left = f - size
        if left > 0:
            if left in by_free:
                by_free[left].append(b)
            else:
                by_free[left] = [b]
                spaces |= 1 << left


class Packing:
    """Sequences as lists of item numbers, with what is free in each."""

    def __init__(self, bins: list[list[int]], free: list[int], capacity: int):
        self.bins, self.free = bins, free
        # Fewer sequences first; among as many, those that leave their space in one place.
        self.fitness = (-len(bins), sum((capacity - f) ** 2 for f in free))

    def assignment(self, n: int) -> list[int]:
        out = [0] * n
        for b, items in enumerate(self.bins):
            for i in items:
                out[i] = b
        return out


def from_assignment(assigned: list[int], lengths: list[int], capacity: int) -> Packing:
    bins: list[list[int]] = [[] for _ in range(max(assigned, default=-1) + 1)]
    free = [capacity] * len(bins)
    for i, b in enumerate(assigned):
        bins[b].append(i)
        free[b] -= lengths[i]
    return Packing(bins, free, capacity)


def packed(lengths: list[int], order: Iterable[int], capacity: int) -> Packing:
    bins: list[list[int]] = []
    free: list[int] = []
    best_fit(lengths, order, capacity, bins, free)
    return Packing(bins, free, capacity)


def crossover(a: Packing, b: Packing, lengths: list[int], settings: Settings, draw: random.Random) -> Packing:
    """Well-filled sequences of `a` injected into `b`; sequences of `b` that share an item with them are dissolved."""
    count = max(1, round(len(a.bins) * settings.inject))
    fullest = sorted(range(len(a.bins)), key=a.free.__getitem__)
    chosen = draw.sample(fullest[: max(count, len(fullest) // 2)], min(count, len(fullest)))
    injected = {i for c in chosen for i in a.bins[c]}
    bins, free, displaced = [], [], []
    for items, f in zip(b.bins, b.free):
        if injected.isdisjoint(items):
            bins.append(list(items))
            free.append(f)
        else:
            displaced += [i for i in items if i not in injected]
    # The emptiest remaining sequences are dissolved too, so that their items can fill gaps elsewhere.
    emptiest = sorted(range(len(bins)), key=free.__getitem__)[-max(1, len(bins) // 50):] if bins else []
    for k in sorted(emptiest, reverse=True):
        displaced += bins.pop(k)
        free.pop(k)
    for c in chosen:
        bins.append(list(a.bins[c]))
        free.append(a.free[c])
    displaced.sort(key=lambda i: -lengths[i])
    best_fit(lengths, displaced, settings.capacity, bins, free)
    return Packing(bins, free, settings.capacity)


def evolve(lengths: list[int], seeds: list[list[int]], seed: int, settings: Settings) -> Packing:
    """The best packing of one island after one epoch. `lengths` come longest first."""
    draw = random.Random(seed)
    n = len(lengths)
    population = [from_assignment(s, lengths, settings.capacity) for s in seeds]
    if not population:
        population.append(packed(lengths, range(n), settings.capacity))
    while len(population) < settings.population:
        # Longest first, but with lengths blurred, so that parents differ.
        blurred = sorted(range(n), key=lambda i: -lengths[i] * (1 + 0.2 * draw.random()))
        population.append(packed(lengths, blurred, settings.capacity))
    ideal = -(-sum(lengths) // settings.capacity)
    for _ in range(settings.offspring):
        population.sort(key=lambda p: p.fitness, reverse=True)
        if len(population[0].bins) <= ideal:
            break
        a, b = draw.sample(range(len(population)), 2)
        child = crossover(population[a], population[b], lengths, settings, draw)
        if child.fitness > population[-1].fitness:
            population[-1] = child
    return max(population, key=lambda p: p.fitness)


# --- islands ------------------------------------------------------------------------------------------------------

_STATE = "group bigint, island int, rids array<bigint>, lengths array<int>, elite array<int>, bins int, filled bigint"


def _epoch(state: DataFrame, epoch: int, settings: Settings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                seeds = [s for s in (row["elite"], row["migrant"]) if s is not None]
                seed = hash((row["group"], row["island"], epoch))
                best = evolve(row["lengths"], seeds, seed, settings)
                yield pa.RecordBatch.from_pylist([{
                    "group": row["group"], "island": row["island"], "rids": row["rids"], "lengths": row["lengths"],
                    "elite": best.assignment(len(row["lengths"])), "bins": -best.fitness[0],
                    "filled": best.fitness[1],
                }], schema=pa.schema([
                    ("group", pa.int64()), ("island", pa.int32()), ("rids", pa.list_(pa.int64())),
                    ("lengths", pa.list_(pa.int32())), ("elite", pa.list_(pa.int32())), ("bins", pa.int32()),
                    ("filled", pa.int64())]))

    return arrow_pass(state, run, _STATE)


def pack_lengths(items: DataFrame, settings: Settings, label: str) -> DataFrame:
    """rid, group, bin, offset, fill for a written table (rid, length) of pieces shorter than a sequence."""
    total = items.count()
    groups = max(1, -(-total // settings.group_size))
    spread = max(1, min(groups * settings.islands, 4 * int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    grouped = items.groupBy(F.pmod(F.xxhash64("rid"), F.lit(groups)).alias("group")).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("length")).alias("l"), "rid"))).alias("x"))
    state = grouped.select(
        "group", F.explode(F.array(*[F.lit(i) for i in range(settings.islands)])).alias("island"),
        F.col("x.rid").alias("rids"), F.transform("x", lambda x: (-x["l"]).cast("int")).alias("lengths"),
        F.lit(None).cast("array<int>").alias("elite"), F.lit(None).cast("array<int>").alias("migrant"),
    )
    for epoch in range(settings.epochs):
        if epoch:
            moved = state.select("group", ((F.col("island") + 1) % settings.islands).alias("island"),
                                 F.col("elite").alias("migrant"))
            state = state.join(moved, ["group", "island"])
        state = settle(_epoch(state.repartition(spread, "group", "island"), epoch, settings), f"{label}-epoch")
    best = state.groupBy("group").agg(F.max_by(
        F.struct("rids", "lengths", "elite"), F.struct(-F.col("bins"), F.col("filled"), -F.col("island"))).alias("b"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rids, lengths, bins = (np.array(row["b"][k], np.int64) for k in ("rids", "lengths", "elite"))
                order = np.argsort(bins, kind="stable")
                rids, lengths, bins = rids[order], lengths[order], bins[order]
                ends = np.cumsum(lengths)
                first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
                sizes = np.diff(np.r_[first, len(bins)])
                base = np.repeat((ends - lengths)[first], sizes)
                fill = np.repeat(np.add.reduceat(lengths, first), sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (rids, np.full(len(rids), row["group"]), bins, ends - lengths - base, fill)],
                    names=["rid", "group", "bin", "offset", "fill"])

    return arrow_pass(best, place, "rid bigint, group bigint, bin bigint, offset bigint, fill bigint")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, settings: Settings = Settings()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document.

    Null text counts as empty: its only id is the end id. Repeated rows are packed each on their own; other columns
    are not read. An empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    pieces = settle(
        token_pieces(docs, tokenizer or default_tokenizer(), settings.capacity)
        .withColumn("rid", F.monotonically_increasing_id()), "pieces")
    short = pieces.where(F.col("length") < settings.capacity).select("rid", "length")
    first = settle(pack_lengths(short, settings, "pack"), "packed")
    done = F.col("fill") >= int(settings.settled_fill * settings.capacity)
    open_items = settle(first.where(~done).join(short, "rid").select("rid", "length"), "opened")
    second = pack_lengths(open_items, settings, "repack")

    def numbered(level: int) -> list:
        return ["rid", (F.lit(level << 62) + F.shiftleft(F.col("group"), 24) + F.col("bin")).alias("sequence_id"), "offset"]

    placed = first.where(done).select(*numbered(0)).unionByName(second.select(*numbered(1)))
    whole = pieces.where(F.col("length") >= settings.capacity).withColumns(
        {"sequence_id": -F.col("rid") - 1, "offset": F.lit(0).cast("bigint")})
    packed_rows = pieces.join(placed, "rid").select(*whole.columns).unionByName(whole)
    return packed_rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
