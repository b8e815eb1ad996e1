"""Streaming search against a search over the whole text, and exact round trips."""

import random

import numpy as np
import pytest

from conftest_helpers import multiset, texts_of
from feedhouse.llm import pieces


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(pieces.default_model())


def whole(model, text):
    """Best path over all of " " + text at once."""
    text = " " + text
    best, back = [0.0], [0]
    for end in range(1, len(text) + 1):
        own = model.pieces.get(text[end - 1])
        top = best[-1] + (own[1] if own else model.by_byte * len(model.char_ids(text[end - 1])))
        source = end - 1
        for start in range(end - 2, max(-1, end - model.longest - 1), -1):
            found = model.pieces.get(text[start:end])
            if found and best[start] + found[1] > top:
                top, source = best[start] + found[1], start
        best.append(top)
        back.append(source)
    return model.read(text, back, len(text)), best[-1]


def test_equal_to_the_whole_search(model):
    draw = random.Random(1)
    for _ in range(200):
        text = "".join(draw.choices("aabethiongr  \n▁é日\t.", k=draw.randint(1, 200)))
        ids, score = model.encode(text)
        expected, top = whole(model, text)
        assert np.frombuffer(ids, "<u4").tolist() == expected and score == pytest.approx(top)
        assert model.decode(ids) == text


def test_long_words_are_settled_on_the_way(model):
    draw = random.Random(2)
    word = "".join(draw.choices("etaoinshr", k=2000))
    parts = list(model.stream(" " + word))
    assert len(parts) > 5
    assert [i for ids, _ in parts for i in ids] == whole(model, word)[0]


def test_short_words_are_searched_as_the_stream_does(model):
    draw = random.Random(3)
    for n in range(1, pieces.WINDOWS * model.longest + 2):
        word = " " * (n % 3) + "".join(draw.choices("aabethiongréì日▁\t.#", k=n))
        parts = list(model.stream(word))
        ids = np.asarray([i for found, _ in parts for i in found], "<u4").tobytes()
        for found in [model.word(word), *[model.short(word)] * (len(word) < pieces.WINDOWS * model.longest)]:
            assert found == (ids, sum(gain for _, gain in parts))


def test_documents(awkward, model):
    rows = pieces.encode_documents(awkward).collect()
    assert all(r.round_trip for r in rows)
    expected = [(i, len(model.encode(t)[0]) // 4) for i, t in texts_of(awkward)]
    assert multiset((r.doc_id, r.n_ids) for r in rows) == multiset(expected)


def test_empty_table(nothing):
    assert pieces.encode_documents(nothing).collect() == []
