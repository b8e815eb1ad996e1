"""SentencePiece ids by a streaming Viterbi search, and back to text.

The search keeps scores and backpointers of a window as long as the longest piece. Whenever the paths of all live
positions meet in one boundary, the ids before it are final and are given out. No piece holds a space behind
another character, so paths always meet in front of a space; texts are therefore searched word by word with the
same result, and recent words are remembered.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from feedhouse.llm.common import arrow_pass, documents

MARK = "▁"
CACHED_WORDS = 400_000
CACHED_CHARS = 64
SLICE_ROWS = 256
WINDOWS = 4  # longest pieces that the search takes in before it settles what it can
RESULT = "doc_id bigint, n_ids bigint, ids_crc32 bigint, score double, decoded_sha256 string, round_trip boolean"

# A character without a piece costs this per byte on top of the worst piece.
BYTE_PENALTY = 10.0


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """Pieces, scores and byte ids of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.byte_ids: dict[int, int] = {}
        self.raw: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                # The space mark stands for a space; so a literal mark in a text has no piece and is spelled in bytes.
                self.pieces[piece.replace(MARK, " ")] = (i, model.get_score(i))
                self.raw.append(piece.replace(MARK, " ").encode())
        if len(self.byte_ids) != 256:
            raise ValueError("the model needs all 256 byte pieces")
        self.longest = max(map(len, self.pieces))
        # All ends of pieces: a backward walk from a position stops where no piece can end so.
        self.ends = {p[i:] for p in self.pieces for i in range(len(p))}
        # Pieces that the model rules out by an absurd score do not count as the worst.
        self.by_byte = min(s for _, s in self.pieces.values() if s > -1e8) - BYTE_PENALTY
        # The same for one lookup a part: what an end of a piece scores, which is nothing if it is no piece itself.
        self.gains = dict.fromkeys(self.ends, -math.inf) | {p: s for p, (_, s) in self.pieces.items()}
        self.packed = {p: struct.pack("<I", i) for p, (i, _) in self.pieces.items()}
        # Split points that every path passes.
        if any(" " in p.lstrip(" ") or "\n" in p for p in self.pieces):
            raise ValueError("pieces must hold spaces in front only, and no line ends")
        self.words = re.compile(r" +[^ \n]*|\n|[^ \n]+")
        self.known: dict[str, tuple[bytes, float]] = {}

    def char_ids(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()]

    def stream(self, chars: Iterable[str]) -> Iterator[tuple[list[int], float]]:
        """Final ids, and what they score, as soon as they are settled."""
        pieces, longest, ends = self.pieces, self.longest, self.ends
        text = ""  # from the last settled boundary on
        best: list[float] = [0.0]
        back: list[int] = [0]
        for char in chars:
            text += char
            end = len(text)
            own = pieces.get(char)
            top = best[end - 1] + (own[1] if own else self.by_byte * len(self.char_ids(char)))
            source = end - 1
            for start in range(end - 2, max(-1, end - longest - 1), -1):
                part = text[start:end]
                if part not in ends:
                    break
                found = pieces.get(part)
                if found and best[start] + found[1] > top:
                    top, source = best[start] + found[1], start
            best.append(top)
            back.append(source)
            if end >= WINDOWS * longest:
                # Follow all live positions back until they meet.
                live = set(range(max(0, end - longest + 1), end + 1))
                while len(live) > 1:
                    last = max(live)
                    live.discard(last)
                    live.add(back[last])
                meet = live.pop()
                if meet > 0:
                    yield self.read(text, back, meet), best[meet]
                    text = text[meet:]
                    best = [b - best[meet] for b in best[meet:]]
                    back = [max(0, b - meet) for b in back[meet:]]
        if text:
            yield self.read(text, back, len(text)), best[len(text)]

    def read(self, text: str, back: list[int], end: int) -> list[int]:
        cuts = [end]
        while end > 0:
            end = back[end]
            cuts.append(end)
        cuts.reverse()
        ids: list[int] = []
        for a, b in zip(cuts, cuts[1:]):
            found = self.pieces.get(text[a:b])
            ids += [found[0]] if found else self.char_ids(text[a:b])
        return ids

    def short(self, word: str) -> tuple[bytes, float]:
        """What `stream` finds in a word that ends before its window does."""
        gains, packed = self.gains, self.packed
        best, back = [0.0], [0]
        start = 0
        for end, char in enumerate(word, 1):
            gain = gains[char] if char in packed else self.by_byte * len(char.encode())
            top, source = best[start] + gain, start
            while start:
                start -= 1
                part = word[start:end]
                if part not in gains:
                    break
                gain = best[start] + gains[part]
                if gain > top:
                    top, source = gain, start
            best.append(top)
            back.append(source)
            start = end
        out = []
        while start:
            part = word[back[start] : start]
            out.append(packed[part] if part in packed else struct.pack(f"<{len(part.encode())}I", *self.char_ids(part)))
            start = back[start]
        out.reverse()
        return b"".join(out), best[-1]

    def word(self, word: str) -> tuple[bytes, float]:
        if len(word) < WINDOWS * self.longest:
            return self.short(word)
        ids: list[int] = []
        score = 0.0
        for part, gain in self.stream(word):
            ids += part
            score += gain
        return np.asarray(ids, "<u4").tobytes(), score

    def encode(self, text: str) -> tuple[bytes, float]:
        """Little-endian unsigned 32-bit ids, and their score. Empty text has no ids."""
        if not text:
            return b"", 0.0
        words = self.words.findall(" " + text)
        known = self.known
        new = set(words).difference(known)
        if len(known) + len(new) > CACHED_WORDS:
            known.clear()
            new = set(words)
        for word in new:
            known[word] = self.word(word)
        found = [known[w] for w in words]
        for word in new:
            if len(word) > CACHED_CHARS:
                del known[word]
        return b"".join([f[0] for f in found]), float(sum([f[1] for f in found]))

    def decode(self, ids: bytes) -> str:
        joined = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return joined[1:].decode() if joined[:1] == b" " else joined.decode()


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One per Python worker, so that its words are remembered from task to task."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: number and checksum of its ids, their score, the hash of the decoded text, and whether that is
    the text again.

    Null text counts as empty, which has no ids. Repeated rows are encoded each; other columns are not read.
    """
    model_path = path or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                rows = []
                for text in part.column(1).to_pylist():
                    text = text or ""
                    ids, score = model.encode(text)
                    decoded = model.decode(ids)
                    rows.append((len(ids) // 4, zlib.crc32(ids), score,
                                 hashlib.sha256(decoded.encode()).hexdigest(), decoded == text))
                n, crc, score, sha, same = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(score, pa.float64()),
                     pa.array(sha), pa.array(same)],
                    names=["doc_id", "n_ids", "ids_crc32", "score", "decoded_sha256", "round_trip"])

    return arrow_pass(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), run, RESULT)


def op8_streaming_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir))
