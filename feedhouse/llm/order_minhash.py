"""Near duplicates by order MinHash, verified by banded alignment.

Texts are sequences of five-word shingles, a repeated shingle being told apart by its occurrence number. Each sketch
table hashes the labelled shingles, keeps the two smallest and joins them in the order of the text; texts that agree
in such a pair meet in a bucket. The chance of that falls with different shingles and with different order. It is
about the square of the share of shingles in common: with 24 tables, 94 % of pairs that differ in every tenth word
meet, and 99.9 % of those that differ in every fifteenth.

In a bucket all texts are compared with one center first, not with each other: in a sixth of the buckets, which settles
most copies, then in all of them. Links found so make components. Buckets of more than `crowd` texts are gone through
again with other centers while a tenth of a turn's pairs are links. Then all texts of different components that still
share a bucket are compared, in tasks of about `crowd` texts that give out links only: a larger bucket is dealt into
groups, and each two groups meet in a task, save those of its largest component.
A pair is linked if an alignment of their words, in a band as wide as the threshold allows, matches at least
`similarity` of all distinct places: m / (a + b - m), which is Jaccard similarity that minds the order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.llm.common import arrow_pass, documents, drop, marked, of_task, settle, settle_alone, shared_partitions
from feedhouse.llm.repeats import with_rid

SLICE_ROWS = 64
CACHED_WORDS = 250_000
# One of so many buckets is gone through first.
FIRST_BUCKETS = 6


@dataclass(frozen=True)
class Settings:
    words: int = 5
    similarity: float = 0.8
    tables: int = 24
    # Texts of a bucket that one task compares with each other.
    crowd: int = 200
    seed: int = 20


# --- shingles -----------------------------------------------------------------------------------------------------


class WordHashes(dict):
    """word bytes -> 64-bit hash, remembered within a task."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS and len(word) <= 64:
            self[word] = value
        return value


_WORDS = of_task(WordHashes())


def words_of(text: bytes) -> np.ndarray:
    """64-bit hashes of the words."""
    if len(_WORDS) >= CACHED_WORDS:
        _WORDS.clear()
    words = text.split()
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all runs of `size` words; a shorter text is one shingle, a text without words has none."""
    if not len(h):
        return h
    if len(h) < size:
        h = np.r_[h, np.zeros(size - len(h), np.uint64)]
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - size + 1 + k]
        out ^= out >> np.uint64(29)
    return out


def labelled(h: np.ndarray) -> np.ndarray:
    """Hashes that also tell the occurrences of equal shingles apart."""
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    first = np.r_[True, ranked[1:] != ranked[:-1]]
    if first.all():
        return h
    at = np.flatnonzero(first)
    number = np.arange(len(h)) - np.repeat(at, np.diff(np.r_[at, len(h)]))
    out = np.empty_like(h)
    out[order] = ranked + number.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sketch(h: np.ndarray, settings: Settings) -> np.ndarray:
    """One bucket key per table: the two smallest labelled shingles in text order."""
    seeds = np.random.default_rng(settings.seed).integers(0, 1 << 63, settings.tables, dtype=np.uint64)
    own = labelled(h)
    if len(own) == 1:
        own = np.r_[own, own]
    drawn = mixed(own[None, :] ^ seeds[:, None])
    rows = np.arange(settings.tables)
    one = drawn.argmin(axis=1)
    drawn[rows, one] = np.iinfo(np.uint64).max
    two = drawn.argmin(axis=1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    return mixed(mixed(own[low] + seeds) * np.uint64(3) + own[high]).view(np.int64)


# --- alignment ----------------------------------------------------------------------------------------------------


def most_common(a: np.ndarray, b: np.ndarray) -> int:
    """Words that both hold, with occurrences: no alignment matches more."""
    codes = np.unique(np.r_[a, b], return_inverse=True)[1]
    n = int(codes.max()) + 1
    return int(np.minimum(np.bincount(codes[: len(a)], minlength=n), np.bincount(codes[len(a) :], minlength=n)).sum())


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence among alignments that stray at most `band` places from the diagonal."""
    lead = 0
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    lead = int(differ[0]) if len(differ) else n
    a, b = a[lead:], b[lead:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1]) if n else []
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return lead + tail
    # Cell k of a row stands for column row + k - band; outside b nothing matches.
    codes = np.unique(np.r_[a, b], return_inverse=True)[1].astype(np.int64) + 1
    a, b = codes[: len(a)], codes[len(a) :]
    wide = np.zeros(len(a) + 2 * band + len(b) + 1, np.int64)
    wide[band : band + len(b)] = b
    row = np.zeros(2 * band + 2, np.int32)  # the last cell lies outside the band
    for i in range(len(a)):
        own = wide[i : i + 2 * band + 1] == a[i]
        best = np.maximum(row[:-1] + own, row[1:])
        row[:-1] = np.maximum.accumulate(best)
    # Any cell of the last row is a prefix of b: the rest of b adds nothing.
    return lead + tail + int(row[:-1].max())


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether an alignment matches m with m / (a + b - m) >= similarity."""
    total = len(a) + len(b)
    need = int(np.ceil(similarity * total / (1 + similarity) - 1e-9))
    if min(len(a), len(b)) < need or not need:
        return False
    possible = most_common(a, b)
    if possible < need:
        return False
    # A path that matches `need` leaves total - 2 * need places out, and strays no further than that.
    widest = total - 2 * need
    band = min(widest, abs(len(a) - len(b)) + (min(len(a), len(b)) - possible) // 4 + 8)
    while True:
        if aligned(a, b, band) >= need:
            return True
        if band >= widest:
            return False
        band = min(widest, 4 * band)


# --- buckets and links --------------------------------------------------------------------------------------------


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """rid, text_hash, n words and the bucket keys of each row of (rid, text binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in batch.column(1).to_pylist():
                h = words_of(text)
                sizes.append(len(h))
                digests.append(xxhash.xxh3_128_digest(text))
                keys.append(sketch(shingles(h, settings.words), settings).tolist() if len(h) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["rid", "text_hash", "n", "keys"])

    return arrow_pass(docs, run, "rid bigint, text_hash binary, n bigint, keys array<bigint>")


def star_pairs(members: DataFrame, turn: int, similarity: float) -> DataFrame:
    """(a, b) with a < b: every member of a bucket with its center, which changes from turn to turn.

    `members` is (key, id, n, part): texts of one part are linked already. The center is the member with the
    smallest hash; hot buckets are combined before the shuffle, and have as many pairs as members at most.
    """
    own = F.struct(F.xxhash64("id", F.lit(turn)).alias("draw"), "id", "n", "part")
    centers = members.groupBy("key").agg(
        F.min(own).alias("center"), F.min("part").alias("first"), F.max("part").alias("last")
    ).where(F.col("first") != F.col("last")).select("key", "center")
    # Written, so that the join has plain shuffles on both sides and a large bucket can be split.
    met = members.join(settle(centers, "centers"), "key").where(F.col("part") != F.col("center.part"))
    # Texts of very different length cannot be similar enough.
    close = F.least("n", "center.n") >= similarity * F.greatest(F.col("n"), F.col("center.n"))
    met = met.where(close).select("id", "center")
    if not turn:
        # One comparison per text settles most of them; the others go on while parts differ.
        met = met.groupBy("id").agg(F.min("center").alias("center"))
    return met.select(
        F.least("id", "center.id").alias("a"), F.greatest("id", "center.id").alias("b")).distinct()


def packed_words(texts: DataFrame, needed: DataFrame) -> DataFrame:
    """rid, h: 32-bit word hashes of the texts (rid, text binary) that are needed (rid)."""

    needed_rows = marked(texts, needed).where("_marked")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([words_of(t).astype(np.uint32).tobytes()
                                            for t in batch.column(1).to_pylist()], pa.binary())], names=["rid", "h"])

    return settle(arrow_pass(needed_rows.select("rid", "text"), pack, "rid bigint, h binary"), "word-hashes")


def part_sizes(members: DataFrame) -> DataFrame:
    """key, total texts, `top` (c texts, part) of the largest part, and how many parts, of each bucket (key, id, part)."""
    return members.groupBy("key", "part").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.sum("c").alias("total"), F.max(F.struct("c", "part")).alias("top"), F.count("*").alias("parts"))


def families(members: DataFrame, crowd: int) -> DataFrame:
    """`members` (key, id, part) with one bucket in place of all those of more than `crowd` texts where one part has
    the majority: a large class fills a bucket in every table, mostly of the same texts."""
    large = part_sizes(members).where((F.col("total") > crowd) & (F.col("parts") > 1) & (2 * F.col("top.c") > F.col("total")))
    large = settle(large.select("key", F.xxhash64(F.lit("family"), "top.part").alias("family")), "families")
    return settle(members.select("key", "id", "part").join(large, "key", "left").select(
        F.coalesce("family", "key").alias("key"), "id", "part").distinct(), "family-members")


def dealt_crowds(members: DataFrame, crowd: int) -> DataFrame:
    """Rows (key, low, high, own, id, part) of the buckets of `members` (key, id, part) that hold several parts.

    Each (key, low, high) is a task's share: the groups `low` and `high` of the bucket, of half a crowd each, or all of a
    bucket of up to `crowd` texts. Groups of the largest part meet the others only, so that one large class costs rows
    in proportion to its size.
    """
    half = max(1, crowd // 2)
    members = families(members, crowd)
    sizes = part_sizes(members)
    few = F.ceil((F.col("total") - F.col("top.c")) / half).cast("int")
    many = F.ceil(F.col("top.c") / half).cast("int")
    small = F.col("total") <= crowd
    sizes = settle(sizes.where("parts > 1").select(
        "key", F.col("top.part").alias("top"), F.when(small, 1).otherwise(few).alias("few"),
        F.when(small, 0).otherwise(many).alias("many")), "several-parts")
    rows = members.select("key", "id", "part").join(sizes, "key")
    draw = F.xxhash64("id", F.lit("group"))
    of_top = (F.col("part") == F.col("top")) & (F.col("many") > 0)
    rows = rows.withColumn("own", F.when(of_top, F.col("few") + F.pmod(draw, F.greatest("many", F.lit(1)))).otherwise(
        F.pmod(draw, "few")).cast("int"))
    last = F.when(of_top, F.col("few")).otherwise(F.col("few") + F.col("many")) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return rows.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own",
                       "id", "part")


def crowd_links(
    members: DataFrame, payload: Callable[[DataFrame], DataFrame], similarity: float, crowd: int,
    alike: Callable[[np.ndarray, np.ndarray], bool],
) -> DataFrame:
    """Links (a, b) between different parts in each bucket of the written table (key, id, part), of whatever size.

    `payload` gets a frame of ids and returns (id, h), h being 32-bit values; pairs that share enough of them go to
    `alike`. A pair is compared in the first bucket it shares only. In a task, parts that a link has joined are not
    compared again.
    """
    dealt = settle(dealt_crowds(members, crowd), "crowds")
    # A pair of different parts shares no other buckets than those dealt out.
    keys = dealt.groupBy("id").agg(F.collect_set("key").alias("keys"))
    values = settle(payload(keys.select("id")).join(keys, "id"), "crowd-texts")
    parts = shared_partitions(members.sparkSession)
    rows = dealt.join(values, "id").select("key", "low", "high", "own", "id", "part", "keys", "h").repartition(
        parts, "key", "low", "high").sortWithinPartitions("key", "low", "high", "id")

    def links_of(held: list[dict]) -> Iterator[tuple[int, int]]:
        if len({r["part"] for r in held}) < 2:
            return
        joined = {r["part"]: r["part"] for r in held}

        def root(part: int) -> int:
            while joined[part] != part:
                part = joined[part]
            return part

        hashes = [np.frombuffer(r["h"], np.uint32) for r in held]
        sizes = np.array([len(h) for h in hashes])
        starts = np.cumsum(sizes) - sizes
        codes = np.unique(np.concatenate([labelled(h.astype(np.uint64)) for h in hashes]), return_inverse=True)[1]
        keys = [frozenset(r["keys"]) for r in held]
        own = np.array([r["own"] for r in held])
        across = held[0]["low"] != held[0]["high"]
        mark = np.zeros(int(codes.max()) + 1, bool)
        for i in range(1, len(held)):
            mine = codes[starts[i] : starts[i] + sizes[i]]
            mark[mine] = True
            # Values in common, with occurrences: nothing matches more.
            possible = np.add.reduceat(mark[codes[: starts[i]]].astype(np.int64), starts[:i])
            mark[mine] = False
            enough = possible >= similarity * (sizes[:i] + sizes[i]) / (1 + similarity) - 1e-6
            if across:
                enough &= own[:i] != own[i]
            for j in np.flatnonzero(enough).tolist():
                a, b = root(held[i]["part"]), root(held[j]["part"])
                if a == b or min(keys[i] & keys[j]) != held[i]["key"]:
                    continue
                if alike(hashes[i], hashes[j]):
                    joined[max(a, b)] = min(a, b)
                    yield min(held[i]["id"], held[j]["id"]), max(held[i]["id"], held[j]["id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held: list[dict] = []
        found: list[tuple[int, int]] = []
        place = None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                for row in batch.slice(at, SLICE_ROWS).to_pylist():
                    now = row["key"], row["low"], row["high"]
                    if held and place != now:
                        found += links_of(held)
                        held = []
                    place = now
                    held.append(row)
        if held:
            found += links_of(held)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return arrow_pass(rows, run, "a bigint, b bigint").distinct()


def verified(pairs: DataFrame, words: DataFrame, settings: Settings) -> DataFrame:
    """Those of the written pairs whose texts are similar; `words` is (rid, h) as `packed_words` gives it."""
    left = words.select(F.col("rid").alias("a"), F.col("h").alias("ha"))
    right = words.select(F.col("rid").alias("b"), F.col("h").alias("hb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                keep = [similar(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), settings.similarity)
                        for x, y in zip(part.column("ha").to_pylist(), part.column("hb").to_pylist())]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ha", "hb")
    return arrow_pass(both, check, "a bigint, b bigint")


def contracted(edges: DataFrame, chunk: int) -> tuple[DataFrame, int]:
    """Edges (u, v) with v the smallest id that u reaches inside its chunk of about `chunk` edges, and the chunks."""
    parts = max(1, -(-edges.count() // chunk))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                up[max(a, b)] = min(a, b)
        found = [(x, root(x)) for x in list(up) if up[x] != x]
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

    dealt = edges.repartition(parts) if parts > 1 else edges.coalesce(1)
    return settle(arrow_pass(dealt, run, "u bigint, v bigint"), "contracted"), parts


def components(links: DataFrame, chunk: int = 200_000) -> DataFrame:
    """id, part: the smallest id reachable over the links (a, b), for every id in them.

    Chunks of edges are contracted, one task each; if there are several, large-star and small-star steps follow,
    each written to the shared folder, until nothing moves.
    """
    edges = settle(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                   "edges")
    before = None
    while True:
        edges, chunks = contracted(edges, chunk)
        if chunks == 1:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.where("u <> v").distinct(), "large-star")
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small_low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = settle(small, "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("part"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("part")).unionByName(roots).distinct()


def added(settled: DataFrame | None, more: DataFrame, label: str) -> DataFrame:
    """Two settled tables as one, which takes their place."""
    return more if settled is None else in_place_of(settled, in_place_of(more, settle(settled.unionByName(more), label)))


def in_place_of(old: DataFrame, new: DataFrame) -> DataFrame:
    """`new`, once the settled table `old` that it was made from is deleted."""
    drop(old)
    return new


def untried(members: DataFrame, turn: int, tried: DataFrame | None, similarity: float) -> DataFrame:
    pairs = star_pairs(members, turn, similarity)
    return pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")


def with_parts(members: DataFrame, links: DataFrame) -> DataFrame:
    """`members` with the parts that the links make."""
    return members.drop("part").join(components(links), "id", "left").withColumn("part", F.coalesce("part", "id"))


def several(members: DataFrame) -> DataFrame:
    """The rows of `members` (key, id, n) in buckets that hold more than one text, each a part of its own."""
    crowded = settle(members.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "crowded")
    shared = settle(members.join(crowded, "key", "left_semi").withColumn("part", F.col("id")), "members")
    return in_place_of(crowded, shared)


def linked(
    members: DataFrame, verify: Callable[[DataFrame], DataFrame], similarity: float,
    compare: Callable[[DataFrame], DataFrame], crowd: int,
) -> DataFrame:
    """Verified links (a, b) between the ids that share a bucket of the written table `members`, as `several` makes it.

    `verify` gets a written table of pairs and returns those that hold. The first turn takes a sixth of the buckets, the
    second all. Further ones take those of more than `crowd` texts that still hold several parts, while a tenth of the
    pairs of a turn are links: what goes on with fewer is settled by `compare` at less cost. It gets the members of all
    buckets, whatever their size, that still hold several parts, and returns the links between those parts.
    """
    found = tried = None

    def take(some: DataFrame, turn: int) -> tuple[int, int]:
        """Pairs tried in a turn, and links among them."""
        nonlocal found, tried
        pairs = settle_alone(lambda: untried(some, turn, tried, similarity), "pairs")
        many = pairs.count()
        new = settle_alone(lambda: verify(pairs), "links") if many else None
        links = new.count() if many else 0
        if many:
            found, tried = added(found, new, "links"), added(tried, pairs, "tried")
        return many, links

    if take(members.where(F.pmod(F.xxhash64("key"), F.lit(FIRST_BUCKETS)) == 0), 0)[1]:
        members = in_place_of(members, settle_alone(lambda: with_parts(members, found), "members"))
    turn = 1
    take(members, turn)

    def still_open(rows: DataFrame, least: int) -> DataFrame:
        """Rows of buckets of more than `least` texts that hold several parts, with the parts of now."""
        if found is not None:
            rows = settle(with_parts(rows, found), "parted")
        keys = rows.groupBy("key").agg(F.count("*").alias("c"), F.min("part").alias("low"), F.max("part").alias("high"))
        keys = settle(keys.where((F.col("low") != F.col("high")) & (F.col("c") > least)).select("key"), "open-buckets")
        return rows.join(keys, "key", "left_semi")

    members = in_place_of(members, settle_alone(lambda: still_open(members, 1), "members"))
    large = settle_alone(lambda: still_open(members, crowd), "large")
    more = not large.isEmpty()
    while more:
        turn += 1
        pairs, links = take(large, turn)
        more = 0 < pairs <= 10 * links
        if links:
            large = in_place_of(large, settle_alone(lambda: still_open(large, crowd), "large"))
    if turn > 1:
        drop(large)
        members = in_place_of(members, settle_alone(lambda: still_open(members, 1), "members"))
    # Stars see one center of a bucket a turn; what they left apart is compared in full.
    rest = settle_alone(lambda: compare(members), "links")
    return rest if found is None else settle(found.unionByName(rest).distinct(), "links")


# --- operator -----------------------------------------------------------------------------------------------------


def near_classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """rid, doc_id, class_rid, n_links per row of `docs` (rid, doc_id, text).

    class_rid is the smallest row number of the class. Equal texts share a class, null counting as empty text; texts
    without words are linked to nothing else. n_links counts the different texts that this text was found similar to.
    """
    texts = docs.select("rid", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    sketched = settle(sketches(texts, settings), "sketches")
    first = sketched.groupBy("text_hash").agg(F.min(F.struct("rid", "n", "keys")).alias("x"))
    distinct = settle(first.select("text_hash", F.col("x.rid").alias("id"), "x.n", "x.keys"), "distinct")
    members = several(distinct.where("n > 0").select("id", "n", F.explode(F.array_distinct("keys")).alias("key")))
    # Every comparison is of these.
    words = packed_words(texts, members.select("id").distinct())

    def payload(ids: DataFrame) -> DataFrame:
        return words.withColumnRenamed("rid", "id").join(ids, "id")

    def compare(open_rows: DataFrame) -> DataFrame:
        return crowd_links(open_rows, payload, settings.similarity, settings.crowd,
                           lambda a, b: similar(a, b, settings.similarity))

    links = linked(members, lambda pairs: verified(pairs, words, settings), settings.similarity, compare, settings.crowd)
    drop(words)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy(F.col("a").alias("id")).agg(F.count("*").alias("n_links"))
    parts = components(links)
    known = distinct.select("text_hash", "id").join(parts, "id", "left").join(degree, "id", "left").select(
        "text_hash", F.coalesce("part", "id").alias("class_rid"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return sketched.select("rid", "text_hash").join(known, "text_hash").select("rid", "class_rid", "n_links")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, class_id, n_links, kept per document; class_id is the doc_id of the class's first row, which is kept.

    Repeated rows are equal texts. `docs` is read several times: pass a written table.
    """
    held = with_rid(docs.select("doc_id", "text"))
    classes = settle_alone(lambda: near_classes(held, settings), "classes")
    ids = settle(held.select("rid", "doc_id"), "ids")
    heads = ids.select(F.col("rid").alias("class_rid"), F.col("doc_id").alias("class_id"))
    return classes.join(ids, "rid").join(heads, "class_rid").select(
        "doc_id", "class_id", "n_links", (F.col("rid") == F.col("class_rid")).alias("kept"))


def keep_first(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One document of each class, with the columns it came with, whatever their names."""
    names = docs.columns
    own = [f"_c{i}" for i in range(len(names))]
    renamed = docs.toDF(*own)
    if "_metadata" in {n.lower() for n in names}:
        # It hides the places of rows in their files; both reads below must see the same ones.
        renamed = settle(renamed, "documents")
    texts = renamed.select(F.col(own[names.index("doc_id")]).alias("doc_id"), F.col(own[names.index("text")]).alias("text"))
    placed = with_rid(texts)
    gone = settle_alone(
        lambda: near_classes(placed, settings).where("rid <> class_rid").select("rid"), "copies")
    return with_rid(renamed).join(gone, "rid", "left_anti").select(*[F.col(c).alias(n) for c, n in zip(own, names)])


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
