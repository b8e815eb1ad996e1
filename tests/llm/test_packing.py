"""Packing: the ids of whole texts, complete and disjoint places, few sequences."""

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest_helpers import multiset, texts_of
from feedhouse.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.default_tokenizer())


def whole(tokenizer, text):
    return np.array([*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID], "<u4").tobytes()


def test_words_apart_give_the_ids_of_the_whole(tokenizer):
    words = packing.TextIds(packing.default_tokenizer())
    draw = random.Random(1)
    odd = "ab Éé ẍ̈ 'S 'll 12 ... <| <|endoftext|> \u0085 \x1c   ΑΣ İ 日本語 ́ \n \t ﬁ".split(" ")
    for _ in range(300):
        text = draw.choice([" ", "\n", "", " "]).join(draw.choices(odd, k=draw.randint(0, 12)))
        assert next(words.ids([text])) + packing.END_ID.to_bytes(4, "little") == whole(tokenizer, text)


def test_latin_words_are_cut_as_the_vocabulary_does(tokenizer):
    words = packing.TextIds(packing.default_tokenizer())
    signs = [chr(c) for c in range(0x21, 0x100) if c not in (0x85, 0xA0)]
    texts = [a + "x" + b + "'" + a for a in signs for b in signs[::7]] + ["".join(signs)]
    assert list(words.ids(texts)) == [words.plain(x) for x in texts]


def test_merges_by_bytes_are_those_of_the_vocabulary(tokenizer):
    """Byte strings tell merges by what they give, the vocabulary by their two parts: every token must come from its own
    two parts when all earlier merges are done, so that both agree on any text."""
    words = packing.TextIds(packing.default_tokenizer())
    ranks, never = words.ranks, 1 << 30
    by_id = {int(words.id_of[rank]): token for token, rank in ranks.items()}
    assert len(by_id) == len(ranks) == tokenizer.get_vocab_size() - len(words.special)
    with open(packing.default_tokenizer(), encoding="utf-8") as f:
        model = json.load(f)["model"]
    for x, y in model["merges"]:
        x, y = by_id[model["vocab"][x]], by_id[model["vocab"][y]]
        token = x + y
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            rank, at = min((ranks.get(a + b, never), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= ranks[token]:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        assert parts == [x, y]


def test_slices_and_calls_change_nothing(tokenizer, monkeypatch):
    words = packing.TextIds(packing.default_tokenizer())
    draw = random.Random(9)
    texts = [" ".join(draw.choices(["日本", "δύο", "one", "Zwölf", "x" * 50, "3.5", "’s"], k=draw.randint(0, 40)))
             for _ in range(60)]
    monkeypatch.setattr(packing, "CALL_CHARS", 7)
    monkeypatch.setattr(packing, "SLICE_CHARS", 300)
    ranges = list(packing.by_size(texts))
    assert [i for a, b in ranges for i in range(a, b)] == list(range(60)) and len(ranges) > 5
    assert [x for a, b in ranges for x in words.ids(texts[a:b])] == [words.plain(t) for t in texts]


def test_pieces_and_places(awkward, tokenizer):
    settings = packing.Settings(capacity=256, group_size=20)
    rows = packing.pack_documents(awkward, settings=settings).collect()
    expected = []
    for doc_id, text in texts_of(awkward):
        ids = whole(tokenizer, text)
        expected += [(doc_id, k, k * 256, len(ids[a : a + 1024]) // 4, zlib.crc32(ids[a : a + 1024]))
                     for k, a in enumerate(range(0, len(ids), 1024))]
    assert multiset((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == multiset(expected)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(places) <= 1.06 * sum(r.length for r in rows) / 256 + 2


def test_evolution_finds_perfect_fits():
    draw = random.Random(2)
    lengths = []
    for _ in range(60):
        cuts = sorted(draw.sample(range(1, 1000), 3))
        lengths += [b - a for a, b in zip([0, *cuts], [*cuts, 1000])]
    lengths.sort(reverse=True)
    settings = packing.Settings(capacity=1000, population=8, offspring=200)
    start = packing.packed(lengths, range(len(lengths)), 1000)
    best = packing.evolve(lengths, [], 1, settings)
    assert len(best.bins) <= len(start.bins) <= 63
    assert sorted(i for b in best.bins for i in b) == list(range(len(lengths)))
    assert best.free == [1000 - sum(lengths[i] for i in b) for b in best.bins] and min(best.free) >= 0
    assert len(best.bins) <= 61


def test_crossover_keeps_every_document_once():
    draw = random.Random(3)
    settings = packing.Settings(capacity=100)
    lengths = sorted((draw.randint(1, 99) for _ in range(200)), reverse=True)
    a = packing.packed(lengths, range(200), 100)
    b = packing.packed(lengths, draw.sample(range(200), 200), 100)
    for _ in range(20):
        child = packing.crossover(a, b, lengths, settings, draw)
        assert sorted(i for x in child.bins for i in x) == list(range(200))
        assert child.free == [100 - sum(lengths[i] for i in x) for x in child.bins] and min(child.free) >= 0
        a, b = b, child


def test_empty_table(nothing):
    assert packing.pack_documents(nothing).collect() == []
