"""Fingerprints from spots: chains of content words that follow common-word anchors.

A text's fingerprint is the set of its spots, written out in full, so that likeness is the Jaccard similarity of the
sets. The start of a text counts as an anchor too; a text without content words has one spot, made of all its words.
Where fixed anchors are rare (lists, other languages), the word with the smallest hash in each few words is one too.

For a similarity join, sets are partitioned by their length: similar ones lie in the same or a neighbouring
partition, and share one of their first spots in a fixed order. Comparisons stop as soon as what is left cannot
reach the threshold.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.llm.common import arrow_pass, documents, settle, shared_partitions
from feedhouse.llm.order_minhash import components, crowd_links, linked, several
from feedhouse.llm.repeats import with_rid

CACHED_WORDS = 500_000
MAX_BLOCKS = 4096
EDGES = "!?.,;:#*$%&|<>\"'()[]{}"

# Frequent function words that serve as anchors.
ANCHORS = {
    "en": "a an and are as at be by for from in is it of on or that the this to was with".split(),
    "de": "das dem den der des die ein eine für im in ist mit nicht und von zu".split(),
    "fr": "au aux avec ce dans de des du en est et la le les par pour que qui sur un une".split(),
    "es": "con de del el en es la las lo los no para por que se su un una y".split(),
}


@dataclass(frozen=True)
class Settings:
    anchors: frozenset[str] = frozenset(w for words in ANCHORS.values() for w in words)
    chain: int = 2  # content words of a spot
    # A text with more different words than this for each anchor takes an anchor from every `window` of its words.
    sparse: int = 8
    window: int = 4
    similarity: float = 0.8
    # Sets of a bucket that one task compares with each other.
    crowd: int = 200


# --- spots --------------------------------------------------------------------------------------------------------


class WordCodes(dict):
    """word -> 64-bit hash whose last bit tells an anchor, remembered per worker."""

    def __init__(self, anchors: frozenset[str]):
        super().__init__()
        self.anchors = anchors

    def __missing__(self, word: str) -> int:
        core = word.lower().strip(EDGES) or word
        code = xxhash.xxh3_64_intdigest(core.encode("utf-8", "replace")) & ~1 | (core in self.anchors)
        if len(self) < CACHED_WORDS and len(word) <= 64:
            self[word] = code
        return code


_CODES: dict[frozenset, WordCodes] = {}


def codes_of(anchors: frozenset[str]) -> WordCodes:
    codes = _CODES.setdefault(anchors, WordCodes(anchors))
    if len(codes) >= CACHED_WORDS:
        codes.clear()
    return codes


def spots(text: str, settings: Settings) -> np.ndarray:
    """The distinct spots of a text as sorted 32-bit hashes; none for a text without words."""
    words = text.split()
    h = np.fromiter(map(codes_of(settings.anchors).__getitem__, words), np.uint64, len(words))
    if not len(h):
        return np.zeros(0, np.uint32)
    anchor = (h & np.uint64(1)).astype(bool)
    content = np.flatnonzero(~anchor)
    if not len(content):
        return np.array([xxhash.xxh32_intdigest(h.tobytes())], np.uint32)
    # The start of the text, as an anchor in front of all words, takes what words there are.
    at = np.r_[-1, np.flatnonzero(anchor)]
    if len(h) > settings.sparse * len(at) and len(np.unique(h)) > settings.sparse * len(at):
        # Chosen by the words around alone, so that a change elsewhere leaves it.
        runs = np.lib.stride_tricks.sliding_window_view(h, min(settings.window, len(h)))
        at = np.union1d(at, np.arange(len(runs)) + runs.argmin(axis=1))
    first = np.searchsorted(content, at, side="right")
    full = first + settings.chain <= len(content)
    full[0] = True
    at, first = at[full], first[full]
    value = np.where(at >= 0, h[at], np.uint64(0x9E3779B97F4A7C15))
    for k in range(settings.chain):
        # Past the end, possible only for the start of a short text, the last word stands again.
        word = h[content[np.minimum(first + k, len(content) - 1)]]
        value = (value ^ word) * np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(31)
    return np.unique((value >> np.uint64(32)).astype(np.uint32))


def written(found: np.ndarray) -> str:
    return base64.b64encode(found.astype("<u4").tobytes()).decode()


def pruned_jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets, or 0 as soon as it must be below `least`. Two empty sets are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    if len(a) < least * len(b):
        return 0.0
    total, same = len(a) + len(b), 0
    step = max(256, len(a) // 4) if least else len(a)
    for start in range(0, len(a), step):
        part = a[start : start + step]
        at = np.searchsorted(b, part)
        same += int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == part))
        best = same + len(a) - start - len(part)
        if best < least * (total - best):
            return 0.0
    return same / (total - same)


# --- every document beside the next -------------------------------------------------------------------------------

RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def in_order(doc_id: int | None, rid: int) -> tuple[bool, int, int]:
    """Descending ids, null last, then row numbers."""
    return doc_id is None, -(doc_id or 0), rid


def beside_next(docs: DataFrame) -> DataFrame:
    """Rows of (rid, doc_id, text) dealt into blocks of the descending order, sorted, with the first row of each
    block also at the end of the block before it (around the end). One shuffle of the texts.

    The first rows of the blocks are drawn by hash, about one in a thousand and MAX_BLOCKS in all, so that each is
    known exactly whatever the ids look like.
    """
    keys = docs.select("rid", "doc_id")
    total = keys.count()
    every = max(1000, -(-total // MAX_BLOCKS))
    drawn = keys.where(F.pmod(F.xxhash64("rid"), F.lit(every)) == 0).unionByName(
        keys.orderBy(F.col("doc_id").desc_nulls_last(), "rid").limit(1))
    bounds = sorted({in_order(r["doc_id"], r["rid"]) for r in drawn.collect()})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            places = [in_order(d, r) for r, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            blocks = [bisect.bisect_right(bounds, p) - 1 for p in places]
            firsts = [i for i, p in enumerate(places) if bounds[blocks[i]] == p]
            for rows, shift in ((list(range(len(places))), 0), (firsts, 1)):
                if rows:
                    part = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([(blocks[i] - shift) % len(bounds) for i in rows], pa.int32()),
                         pa.array([bool(shift)] * len(rows)), *part.columns],
                        names=["block", "border", *part.schema.names])

    dealt = arrow_pass(docs, deal, "block int, border boolean, rid bigint, doc_id bigint, text string")
    parts = shared_partitions(docs.sparkSession)
    return dealt.repartition(parts, "block").sortWithinPartitions(
        "block", "border", F.col("doc_id").desc_nulls_last(), "rid")


def fingerprints(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """RESULT per document. Null text counts as empty; a single document is its own next; rows with equal ids are
    ordered by their place in the table. `docs` is read twice: pass a written table."""
    texts = with_rid(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                 F.coalesce(F.col("text"), F.lit("")).alias("text"))).select("rid", "doc_id", "text")

    def row(one, following) -> tuple:
        _, doc_id, text, own = one
        _, _, later, others = following
        size = len(text) // 3
        edited = text[: len(text) - size] + later[:size]
        changed = spots(edited, settings)
        return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(own), written(changed),
                pruned_jaccard(own, changed), pruned_jaccard(own, others))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        last = None
        for batch in batches:
            out = []
            for block, border, doc_id, text in zip(*[batch.column(c).to_pylist()
                                                     for c in ("block", "border", "doc_id", "text")]):
                now = block, doc_id, text, spots(text, settings)
                if last is not None and last[0] == block:
                    out.append(row(last, now))
                last = None if border else now
            if out:
                kinds = (pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=[c.split()[0] for c in RESULT.split(", ")])

    return arrow_pass(beside_next(texts), run, RESULT)


# --- similarity join ----------------------------------------------------------------------------------------------


def spot_links(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Rows (rid, set_id), and links (a, b) between different sets, named by the smallest rid that has them."""
    texts = docs.select("rid", F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            sets = [spots(t, settings).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()),
                 pa.array(sets, pa.binary())], names=["rid", "hash", "spots"])

    found = settle(arrow_pass(texts, run, "rid bigint, hash binary, spots binary"), "spots")
    ids = found.groupBy("hash").agg(F.min("rid").alias("set_id"))
    distinct = found.select(F.col("rid").alias("id"), "spots").join(ids.select(F.col("set_id").alias("id")), "id")
    distinct = settle(distinct.where(F.length("spots") > 0), "spot-sets")
    least = settings.similarity

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(own, np.uint32)
                n = len(own)
                part = int(math.log(n) / -math.log(least) + 1e-9)
                for spot in own[: n - math.ceil(least * n - 1e-9) + 1].tolist():
                    rows += [(spot << 12 | part, i, n), (spot << 12 | part + 1, i, n)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["key", "id", "n"])

    def verify(pairs: DataFrame) -> DataFrame:
        left = distinct.select(F.col("id").alias("a"), F.col("spots").alias("sa"))
        right = distinct.select(F.col("id").alias("b"), F.col("spots").alias("sb"))

        def check(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
            for batch in batches:
                keep = [pruned_jaccard(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), least) >= least
                        for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return arrow_pass(pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb"), check, "a bigint, b bigint")

    def payload(ids: DataFrame) -> DataFrame:
        return distinct.withColumnRenamed("spots", "h").join(ids, "id")

    def compare(open_rows: DataFrame) -> DataFrame:
        return crowd_links(open_rows, payload, least, settings.crowd, lambda a, b: pruned_jaccard(a, b, least) >= least)

    members = several(arrow_pass(distinct, keys, "key bigint, id bigint, n bigint"))
    links = linked(members, verify, least, compare, settings.crowd)
    return found.select("rid", "hash").join(ids, "hash").select("rid", "set_id"), links


def spot_classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """rid, class_rid of every row of (rid, text): texts whose fingerprints are alike, directly or through others."""
    members, links = spot_links(docs, settings)
    parts = components(links).select(F.col("id").alias("set_id"), "part")
    return members.join(parts, "set_id", "left").select("rid", F.coalesce("part", "set_id").alias("class_rid"))


def op4_spot_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))
