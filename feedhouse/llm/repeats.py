"""Long repeats across and within documents, found with common-prefix interval trees over enhanced suffix arrays.

Every 400-byte window elects one of its 32-byte grams, the one with the smallest hash, as its anchor. Equal windows
elect the same gram at the same offset, so their anchors meet under the gram's hash. An anchor carries its context:
the bytes of all windows that elected it. Contexts that occur twice are repeats as they are. The others that share
a gram form a bucket: a suffix array of their texts from the anchor on, with common prefix lengths between
neighbours, is scanned with a stack into the tree of common-prefix intervals. In each interval the left contexts,
read backwards, are sorted and scanned the same way: a node whose members extend differently to the left and come
from different children to the right is a maximal repeat, with all its occurrences.

A bucket with too many contexts is split by where the window lies around the anchor: each band of offsets fixes most
of the bytes on both sides, so its buckets are small, down to single offsets where all contexts of a bucket are
equal. Nothing is dropped and no bucket is ever larger than `bucket_limit` in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedhouse.llm.common import arrow_pass, documents, marked, settle, settle_alone, shared_partitions, sliced

GRAM = 32
SLICE_BYTES = 1 << 19
INDEX_BITS = 20


@dataclass(frozen=True)
class Settings:
    length: int = 400
    bucket_limit: int = 512
    # Each split of a bucket cuts its band of offsets into so many.
    bands: int = 8


# --- anchors ------------------------------------------------------------------------------------------------------


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """64-bit hashes of all GRAM-byte strings, by doubling."""
    table = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    h, width = table[text], 1
    while width < GRAM:
        h = h[:-width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + h[width:]
        width *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values, from running minima of blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of documents laid end to end in `text`, `ends` being where each stops: position, hash, first and last
    window start. At most 2^INDEX_BITS bytes."""
    none = np.zeros(0, np.int64)
    if len(text) < length:
        return none, none, none, none
    h = gram_hashes(text)
    order = (h >> np.uint64(INDEX_BITS)) << np.uint64(INDEX_BITS) | np.arange(len(h), dtype=np.uint64)
    low = sliding_min(order, length - GRAM + 1)
    elected = (low & np.uint64((1 << INDEX_BITS) - 1)).astype(np.int64)
    starts = np.arange(len(elected))
    doc = np.searchsorted(ends, starts, side="right")
    inside = starts + length <= ends[np.minimum(doc, len(ends) - 1)]
    starts, elected, doc = starts[inside], elected[inside], doc[inside]
    if not len(starts):
        return none, none, none, none
    change = np.flatnonzero((np.diff(elected) != 0) | (np.diff(doc) != 0)) + 1
    first, last = np.r_[0, change], np.r_[change - 1, len(starts) - 1]
    at = elected[first]
    return at, h[at].view(np.int64), starts[first], starts[last]


ANCHOR = "rid bigint, pos bigint, gram bigint, context bigint, before int, after int"


def anchor_table(docs: DataFrame, settings: Settings) -> DataFrame:
    """Anchors of (rid, text binary): position, gram hash, context hash, context bytes before and from the anchor on."""
    length = settings.length

    def pieces(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int, bytes]]]:
        """Lists of (rid, offset, bytes) with up to SLICE_BYTES; long texts are cut with an overlap of a window."""
        held, size = [], 0
        for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for start in range(0, max(1, len(text) - length + 1), SLICE_BYTES):
                part = text[start : start + SLICE_BYTES + length - 1]
                if held and size + len(part) > SLICE_BYTES:
                    yield held
                    held, size = [], 0
                held.append((rid, start, part))
                size += len(part)
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in sliced(batches):
            for held in pieces(batch):
                joined = b"".join([p for _, _, p in held])
                ends = np.cumsum([len(p) for _, _, p in held])
                at, grams, low, high = anchors(np.frombuffer(joined, np.uint8), ends, length)
                if not len(at):
                    continue
                doc = np.searchsorted(ends, low, side="right")
                begin = ends - [len(p) for _, _, p in held]
                rids = np.array([r for r, _, _ in held])
                offsets = np.array([o for _, o, _ in held])
                before, after = at - low, high + length - at
                context = [xxhash.xxh3_64_intdigest(joined[a:b], s) - (1 << 63)
                           for a, b, s in zip(low.tolist(), (high + length).tolist(), before.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(rids[doc]), pa.array(at - begin[doc] + offsets[doc]), pa.array(grams),
                    pa.array(context, pa.int64()), pa.array(before.astype(np.int32)), pa.array(after.astype(np.int32)),
                ], names=["rid", "pos", "gram", "context", "before", "after"])

    return arrow_pass(docs, run, ANCHOR)


# --- interval trees -----------------------------------------------------------------------------------------------


def common(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    differ = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (first, last, length) of a sorted list, inner ones first, by a scan with a stack.

    lcp[i] is the common prefix of entries i and i + 1. Intervals shorter than `least` are left out.
    """
    stack: list[tuple[int, int]] = []  # (length, first entry)
    for i, value in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > value:
            length, first = stack.pop()
            if length >= least:
                yield first, i, length
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def maximal_repeats(
    before: list[bytes], after: list[bytes], length: int
) -> Iterator[tuple[list[int], int, int]]:
    """(members, bytes to the left, bytes from the anchor on) of each maximal repeat of at least `length` bytes.

    `before` holds the left contexts backwards. Members are all occurrences in the bucket.
    """
    n = len(after)
    order = sorted(range(n), key=after.__getitem__)
    lcp = [common(after[a], after[b]) for a, b in zip(order, order[1:])]
    widest = max(map(len, before))
    left_rank = [0] * n
    for rank, i in enumerate(sorted(range(n), key=before.__getitem__)):
        left_rank[i] = rank
    for first, last, right in intervals(lcp, max(1, length - widest)):
        # Children of the interval are cut where neighbours share no more than the interval does.
        child, of = 0, {}
        for k in range(first, last + 1):
            child += k > first and lcp[k - 1] == right
            of[order[k]] = child
        members = sorted(of, key=left_rank.__getitem__)
        left_lcp = [common(before[a], before[b]) for a, b in zip(members, members[1:])]
        for low, high, left in intervals(left_lcp, max(0, length - right)):
            group = members[low : high + 1]
            # Left extensions differ in every interval; the right ones must too, or a longer repeat covers it.
            if len({of[i] for i in group}) > 1:
                yield group, left, right


# --- buckets ------------------------------------------------------------------------------------------------------

_BUCKET = "key bigint, gram bigint, context bigint, before binary, after binary"


def solve(buckets: DataFrame, settings: Settings) -> DataFrame:
    """gram, context, before, after: how far each context's repeats reach, for buckets within the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held: list[dict] = []

        def flush(rows: list[dict]) -> Iterator[pa.RecordBatch]:
            if len(rows) < 2:
                return
            reach: dict[int, tuple[int, int]] = {}
            for group, left, right in maximal_repeats(
                    [r["before"] for r in rows], [r["after"] for r in rows], settings.length):
                for i in group:
                    a, b = reach.get(i, (0, 0))
                    reach[i] = max(a, left), max(b, right)
            if reach:
                yield pa.RecordBatch.from_pylist([
                    {"gram": rows[i]["gram"], "context": rows[i]["context"], "before": a, "after": b}
                    for i, (a, b) in reach.items()
                ], schema=pa.schema([("gram", pa.int64()), ("context", pa.int64()), ("before", pa.int32()),
                                     ("after", pa.int32())]))

        for batch in batches:
            for row in batch.to_pylist():
                if held and held[-1]["key"] != row["key"]:
                    yield from flush(held)
                    held = []
                held.append(row)
        yield from flush(held)

    sorted_rows = buckets.select("key", "gram", "context", "before", "after").repartition(
        shared_partitions(buckets.sparkSession), "key").sortWithinPartitions("key")
    return arrow_pass(sorted_rows, run, "gram bigint, context bigint, before int, after int")


def split_bands(rows: DataFrame, low: str, high: str, settings: Settings) -> DataFrame:
    """Rows of large buckets, once per narrower band of window offsets [low, high], cut to the bytes it can use."""
    width = F.col(high) - F.col(low) + 1
    step = F.ceil(width / settings.bands).cast("int")
    banded = rows.withColumn("_from", F.explode(F.sequence(F.col(low), F.col(high), step))).withColumn(
        "_to", F.least(F.col("_from") + step - 1, F.col(high)))
    # A window that starts o bytes before the anchor takes o bytes of one side and length - o of the other.
    need_after = F.lit(settings.length) - F.col("_to")
    fits = (F.length("before") >= F.col("_from")) & (F.length("after") >= need_after)
    return banded.where(fits).select(
        F.xxhash64("gram", "_from", "_to", F.expr("substring(before, 1, _from)"),
                   F.expr(f"substring(after, 1, {settings.length} - _to)")).alias("key"),
        "gram", "context",
        F.expr("substring(before, 1, _to)").alias("before"),
        F.expr(f"substring(after, 1, {settings.length} - _from)").alias("after"),
        F.col("_from").cast("int").alias("low"), F.col("_to").cast("int").alias("high"),
    )


def repeat_reach(contexts: DataFrame, settings: Settings) -> DataFrame:
    """gram, context, before, after for a written table of distinct contexts (key, gram, context, before, after).

    Bucket after bucket is solved or split; splitting ends at single offsets, whose buckets hold one text.
    """
    level = contexts.withColumns({"low": F.lit(0), "high": F.lit(settings.length - GRAM)})
    found = []
    while True:
        counts = level.groupBy("key").agg(F.count("*").alias("n"))
        large = counts.where(F.col("n") > settings.bucket_limit)
        found.append(solve(level.join(large, "key", "left_anti"), settings))
        if large.isEmpty():
            break
        bands = settle(split_bands(level.join(large.select("key"), "key"), "low", "high", settings), "bands")
        own = F.xxhash64("before", "after", F.length("before")).alias("own")
        keyed = bands.select("*", own)
        same = keyed.groupBy("key", "own").agg(F.count("*").alias("n"), F.min("context").alias("first"))
        twice = keyed.join(same.where("n > 1").select("key", "own"), ["key", "own"])
        whole = F.length("before") + F.length("after") >= settings.length
        found.append(twice.where(whole).select(
            "gram", "context", F.length("before").alias("before"), F.length("after").alias("after")))
        first = same.select("key", "own", F.col("first").alias("context"))
        level = settle(keyed.join(first, ["key", "own", "context"]).drop("own"), "buckets")
    reach = found[0]
    for more in found[1:]:
        reach = reach.unionByName(more)
    return reach


# --- operator -----------------------------------------------------------------------------------------------------


def _of_files(docs: DataFrame) -> bool:
    """Whether each row of `docs` is a row of a file, once."""
    node = docs._jdf.queryExecution().analyzed()
    while (kind := node.getClass().getSimpleName()) in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return kind == "LogicalRelation"


def with_rid(docs: DataFrame, name: str = "rid") -> DataFrame:
    """A number per row: that of its file and its place in it, which no split of a later read can change.

    A frame that is more than rows of Parquet files is written first.
    """
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    held = None
    if _of_files(docs):
        try:
            held = docs.select("*", *place)
        except AnalysisException:  # files of another format
            pass
    if held is None:
        held = settle(docs, "rows").select("*", *place)
    files = sorted(r[0] for r in held.select("_file").distinct().collect())
    numbers = docs.sparkSession.createDataFrame(list(enumerate(files)), "_number bigint, _file string")
    rid = F.shiftleft("_number", 40).bitwiseOR(F.col("_row"))
    return held.join(F.broadcast(numbers), "_file").withColumn("_rid", rid).select(
        *[F.col(f"`{c}`") for c in docs.columns if c != name], F.col("_rid").alias(name))


def all_reach(contexts: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """gram, context, to_left, to_right: how far repeats reach around the anchors of each of the written contexts."""
    mixed = contexts.groupBy("gram").agg(
        F.count("*").alias("m"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("single"))
    mixed = settle(mixed.where("m > 1 and single > 0").select("gram"), "mixed")
    active = contexts.join(mixed, "gram", "left_semi")
    wanted = settle(active.groupBy(F.col("at.rid").alias("rid")).agg(F.collect_list(
        F.struct("gram", "context", "at.pos", "at.before", "at.after")).alias("cuts")), "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist()):
                for x in found:
                    at = x["pos"]
                    out.append((x["gram"], x["gram"], x["context"], text[at - x["before"] : at][::-1],
                                text[at : at + x["after"]]))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=["key", "gram", "context", "before", "after"])

    met = marked(texts, wanted.select("rid")).where("_marked").join(wanted, "rid").select("text", "cuts")
    buckets = settle(arrow_pass(met, cut, _BUCKET), "buckets")
    partly = repeat_reach(buckets, settings)
    wholly = contexts.where("n > 1").select("gram", "context", "at.before", "at.after")
    return wholly.unionByName(partly).groupBy("gram", "context").agg(
        F.max("before").alias("to_left"), F.max("after").alias("to_right"))


def repeated_spans(texts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """rid, spans: byte ranges [start, stop) covered by strings of `length` bytes that also start elsewhere.

    `texts` is (rid, text binary), read twice: pass a written table.
    """
    def shared_anchors() -> DataFrame:
        every = settle(anchor_table(texts, settings), "anchors")
        # Written, so that the join below has plain shuffles on both sides and a frequent gram can be split.
        several = settle(every.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "several")
        return every.join(several, "gram", "left_semi")

    shared = settle_alone(shared_anchors, "shared-anchors")
    place = F.struct("rid", "pos", "before", "after")
    contexts = settle(shared.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(place).alias("at")), "contexts")
    reach = settle_alone(lambda: all_reach(contexts, texts, settings), "reach")
    spans = shared.join(reach, ["gram", "context"]).select(
        "rid", F.struct((F.col("pos") - F.col("to_left")).alias("start"),
                        (F.col("pos") + F.col("to_right")).alias("stop")).alias("span"))
    return spans.groupBy("rid").agg(F.collect_list("span").alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted ranges without overlap; touching ones become one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], stop)
        else:
            out.append((start, stop))
    return out


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, stop in spans:
        parts.append(text[at:start])
        at = stop
    return b"".join([*parts, text[at:]])


def _spans(docs: DataFrame, settings: Settings) -> DataFrame:
    return settle_alone(lambda: repeated_spans(docs.select("rid", "text"), settings), "spans")


def _beside(docs: DataFrame, found: DataFrame) -> DataFrame:
    """`docs` with the columns that the written table `found` (rid, ...) has for some of them; the others stay where they
    lie."""
    own = marked(docs, found.select("rid"))
    met = own.where("_marked").drop("_marked").join(found, "rid")
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in found.schema.fields if f.name != "rid"}
    return met.unionByName(own.where("not _marked").drop("_marked").withColumns(nothing))


REPORT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def repeat_report(docs: DataFrame, settings: Settings = Settings(), with_text: bool = False) -> DataFrame:
    """REPORT per document, and on demand `kept_text`, without characters of which only some bytes remain. Null text
    counts as empty; other columns are not read; repeated rows each have a row.

    Texts shorter than `length` bytes lose nothing. `docs` is read three times: pass a written table.
    """
    texts = with_rid(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                 F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                spans = merged(found)
                kept = kept_bytes(text, spans)
                rows.append((len(text), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest(),
                             kept.decode("utf-8", "ignore") if with_text else None))
            if rows:
                size, gone, n, sha, kept = zip(*rows)
                columns = [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (size, gone, n)], pa.array(sha)]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                more = [pa.array(kept, pa.string())] if with_text else []
                yield pa.RecordBatch.from_arrays(columns + more, names=names + ["kept_text"] * with_text)

    schema = f"{REPORT}, kept_text string" if with_text else REPORT
    found = _spans(texts, settings)
    return arrow_pass(_beside(texts, found).select("doc_id", "text", "spans"), run, schema)


# --- runs of words ------------------------------------------------------------------------------------------------

_WORD = re.compile(r"\S+")
CODE = 8  # bytes that stand for a word


def coded_words(texts: DataFrame) -> DataFrame:
    """(rid, text binary) with CODE bytes for each word: repeated words are repeated bytes, whatever their length and
    the white space between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in sliced(batches):
            coded = [b"".join([xxhash.xxh3_64_digest(w) for w in _WORD.findall(t.decode("utf-8", "replace"))])
                     for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(coded, pa.binary())], names=["rid", "text"])

    return arrow_pass(texts, run, "rid bigint, text binary")


def byte_ranges(text: bytes, spans: list[dict] | None) -> list[dict]:
    """Byte ranges of the text from the first to the last whole word of ranges of its coded words."""
    if not spans:
        return []
    shown = text.decode("utf-8", "replace")
    words = [m.span() for m in _WORD.finditer(shown)]
    out = []
    for start, stop in merged(spans):
        first, last = -(-start // CODE), stop // CODE - 1
        a, b = words[first][0], words[last][1]
        at = len(shown[:a].encode())
        out.append({"start": at, "stop": at + len(shown[a:b].encode())})
    return out


def remove_repeats(docs: DataFrame, settings: Settings = Settings(), words: int = 0) -> DataFrame:
    """`docs` with the repeated bytes taken out of `text`, and `n_chars`, where it is there, counted anew.

    With `words`, runs of that many words that occur more than once go too, however short. Characters of which only
    some bytes remain go too. Documents without repeats keep their rows as they are.
    """
    names = docs.columns
    own = [f"_c{i}" for i in range(len(names))]
    text = own[names.index("text")]
    renamed = docs.toDF(*own)
    held = with_rid(renamed.withColumn("text", F.coalesce(F.col(text), F.lit("")).cast("binary")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = []
            for t, found, runs in zip(*[batch.column(c).to_pylist() for c in ("text", "spans", "runs")]):
                found = (found or []) + byte_ranges(t, runs)
                rows.append(kept_bytes(t, merged(found)).decode("utf-8", "ignore") if found else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(rows, pa.string())],
                                             names=[*batch.schema.names[:-3], "cut"])

    if words:
        def runs() -> DataFrame:
            coded = settle(coded_words(held.select("rid", "text")), "coded-words")
            found = repeated_spans(coded, replace(settings, length=words * CODE))
            return found.withColumnRenamed("spans", "runs")

        found = settle_alone(
            lambda: _spans(held, settings).join(settle_alone(runs, "runs"), "rid", "full"), "spans")
    else:
        found = _spans(held, settings)
        found = found.withColumn("runs", F.lit(None).cast(found.schema["spans"].dataType))
    joined = _beside(held, found).select(*own, "text", "spans", "runs")
    schema = T.StructType([*renamed.schema.fields, T.StructField("cut", T.StringType())])
    done = arrow_pass(joined, run, schema)
    columns = []
    for name, c in zip(names, own):
        value = F.col(c)
        if c == text:
            value = F.coalesce(F.col("cut"), value)
        elif name == "n_chars":
            value = F.when(F.col("cut").isNotNull(), F.char_length("cut").cast(docs.schema[name].dataType)).otherwise(value)
        columns.append(value.alias(name))
    return done.select(*columns)


def op3_interval_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(documents(spark, sf_dir), with_text=True)
