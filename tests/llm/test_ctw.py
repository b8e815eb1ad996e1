"""Context-tree weighting against a tree kept in a dictionary, and the baseline against plain counting."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest_helpers import multiset, texts_of
from feedhouse.llm import ctw
from feedhouse.session import folder_names, scratch_root


def log_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)


class Tree:
    """One weighted tree per decision of a byte, contexts as byte strings, latest byte first."""

    def __init__(self, words: Counter, depth: int):
        self.depth = depth
        self.counts = defaultdict(lambda: [0, 0])
        for word, n in words.items():
            for context, node, bit in self.decisions(word):
                for d in range(depth + 1):
                    self.counts[context[:d], node][bit] += n
        self.children = defaultdict(set)
        for context, node in list(self.counts):
            if context:
                self.children[context[:-1], node].add(context)
        self.weighted = {}
        for context, node in sorted(self.counts, key=lambda x: -len(x[0])):
            own = log_kt(*self.counts[context, node])
            if len(context) < depth:
                split = sum(self.weighted[c, node] for c in self.children[context, node])
                own = np.logaddexp(own, split) - math.log(2)
            self.weighted[context, node] = own

    def decisions(self, word):
        text = b" " * self.depth + (word + b" " if word else b"\n")
        for i in range(self.depth, len(text)):
            context = text[i - self.depth : i][::-1]
            for k in range(8):
                yield context, 1 << k | text[i] >> (8 - k), text[i] >> (7 - k) & 1

    def log10(self, word):
        total = 0.0
        for context, node, bit in self.decisions(word):
            rest, one, last = 1.0, 0.0, 0.5
            for d in range(self.depth + 1):
                key = context[:d], node
                if key not in self.counts or not sum(self.counts[key]):
                    break
                a, b = self.counts[key]
                last = (b + 0.5) / (a + b + 1)
                share = 1.0 if d == self.depth else math.exp(log_kt(a, b) - math.log(2) - self.weighted[key])
                one, rest = one + rest * share * last, rest * (1 - share)
            one += rest * last
            total += math.log10(one if bit else 1 - one)
        return total


def fold(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7


@pytest.mark.parametrize("settings", [
    ctw.Settings(block_bytes=4000, words_per_block=150, chunk_rows=500), ctw.Settings(depth=6, step=3)])
def test_scores_equal_the_plain_tree(awkward, settings):
    docs = [(i, t.encode().lower().split()) for i, t in texts_of(awkward)]
    train = Counter()
    for i, words in docs:
        if fold(i) != 2:
            train.update([*words, b""])
    total, distinct = sum(train.values()), len(train)
    tree = Tree(train, settings.depth)
    known = {w: tree.log10(w) for w in {b"", *(w for _, words in docs for w in words)}}
    expected = []
    for i, words in docs:
        tokens = [*words, b""]
        expected.append((i, fold(i) == 2, len(tokens), sum(w in train for w in tokens), total,
                         round(sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in tokens), 4),
                         round(sum(known[w] for w in tokens), 4)))
    rows = ctw.score_documents(awkward, settings).collect()
    found = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4))
             for r in rows]
    assert multiset(found) == multiset(expected)


def test_predictions_are_probabilities():
    """Over all words of up to two letters and a rest, the closed tokens' probabilities cannot exceed one."""
    words = Counter({b"ab": 5, b"a": 3, b"ba": 2, b"": 4})
    tree = Tree(words, 2)
    alphabet = [bytes([c]) for c in range(256) if c != 0x20]
    single = sum(10 ** tree.log10(w) for w in alphabet if w != b"\n") + 10 ** tree.log10(b"")
    assert 0.2 < single < 1


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 10, 1e6, 3e9])
    assert ctw.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-12)


def test_empty_table(nothing):
    assert ctw.score_documents(nothing).collect() == []


class RunningTree(Tree):
    """The same over whole texts, each word with a blank behind it."""

    def decisions(self, words):
        text = b" " * self.depth + b"".join(w + b" " for w in words) + b"\n"
        for i in range(self.depth, len(text)):
            context = text[i - self.depth : i][::-1]
            for k in range(8):
                yield context, 1 << k | text[i] >> (8 - k), text[i] >> (7 - k) & 1


@pytest.mark.parametrize("size", [50, 1 << 20])
def test_running_scores_equal_the_plain_tree(awkward, size):
    settings = ctw.Settings(block_bytes=4000, chunk_rows=500, slice_bytes=size)
    docs = [(i, t.encode().lower().split()) for i, t in texts_of(awkward)]
    train, words = Counter(), Counter()
    for i, own in docs:
        if fold(i) != 2:
            train[tuple(own)] += 1
            words.update([*own, b""])
    tree = RunningTree(train, settings.depth)
    total, distinct = sum(words.values()), len(words)
    known = {own: tree.log10(own) for own in {tuple(own) for _, own in docs}}
    expected = []
    for i, own in docs:
        tokens = [*own, b""]
        expected.append((i, fold(i) == 2, len(tokens), sum(w in words for w in tokens), total,
                         round(sum(math.log10((words[w] + 1) / (total + distinct + 1)) for w in tokens), 4),
                         round(known[tuple(own)], 4)))
    found = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4))
             for r in ctw.score_running(awkward, settings).collect()]
    assert multiset(found) == multiset(expected)


def test_shuffled_words_score_lower(spark, tmp_path):
    draw = random.Random(8)
    follows = {f"w{i}": [f"w{draw.randrange(60)}" for _ in range(2)] for i in range(60)}

    def chain(n):
        out = ["w0"]
        while len(out) < n:
            out.append(draw.choice(follows[out[-1]]))
        return out

    held = [i for i in range(400) if fold(i) == 2]
    texts = {i: chain(80) for i in range(400)}
    for a, b in zip(held[::2], held[1::2]):
        texts[b] = draw.sample(texts[a], 80)
    folder = tmp_path / "sf" / "documents.parquet"
    spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string").write.parquet(str(folder))
    rows = ctw.op9_context_tree_weighting(spark, str(tmp_path / "sf")).collect()
    score = {r.doc_id: r.score for r in rows}
    assert all(score[a] > score[b] + 20 for a, b in zip(held[::2], held[1::2]))
    clean = set(held[::2])
    assert sum(r.score for r in rows if r.doc_id in clean) > sum(r.base_score for r in rows if r.doc_id in clean)


def test_empty_table_has_no_running_text(nothing):
    assert ctw.score_running(nothing).collect() == []


def test_only_what_the_result_reads_stays_on_disk(spark, awkward):
    """Words, events, trees and unjoined scores go as soon as nothing reads them."""
    folder = f"{scratch_root(spark)}/feedhouse-{spark.sparkContext.applicationId}"
    before = set(folder_names(spark, folder))
    scored = ctw.score_running(awkward)
    left = {n.rsplit("-", 1)[0] for n in set(folder_names(spark, folder)) - before}
    assert left <= {"blocks", "block-counts", "block-scores", "code"}
    assert scored.count() == awkward.count()
