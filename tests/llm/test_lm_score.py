from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lakestrata.llm import lm_score
from lakestrata.llm.lm_score import score_adaptively, score_documents, train_language_model
from lakestrata.llm.ppm import END, START, AdaptiveModel, Trie, grams, mask


def some_rows():
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(["the", "The", "cat", "été", "x"], k=rng.randint(0, 12)))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "the cat"), (102, " lead\ttab "), (103, "dog zebra " * 3)]
    return rows + [(104, "same row")] * 3 + [(105, "long text " * 5000)]


def plain_base(train, rows):
    tokens = lambda t: [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), None]
    counts = Counter(w for _, t in train for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        found = tokens(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in found)
        out.append((d, len(found), sum(counts[w] > 0 for w in found), base))
    return out, n


@pytest.mark.parametrize("pairs", [1 << 23, 40])
@pytest.mark.parametrize("frequent", [1 << 17, 2])
def test_equals_plain_models(documents, monkeypatch, pairs, frequent):
    monkeypatch.setattr(lm_score, "TRIE_PAIRS", pairs)
    monkeypatch.setattr(lm_score, "FREQUENT_WORDS", frequent)
    rows = some_rows()
    train = [r for r in rows if r[0] is None or r[0] % 3]
    model = train_language_model(documents(train), order=3)
    base, n = plain_base(train, rows)
    assert model.tokens == n
    assert (model.trie_parts() > 1) == (pairs == 40)
    plain = AdaptiveModel(3)
    for _, t in train:
        plain.score((t or "").encode().lower(), learn=True, score=False)
    wanted = sorted(
        (str(d), tokens, known, round(b, 6), round(plain.score((t or "").encode().lower(), False), 4))
        for (d, t), (_, tokens, known, b) in zip(rows, base)
        if len(t or "") < 1000
    )
    found = sorted(
        (str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 4))
        for r in score_documents(documents(rows), model).collect()
        if r.n_tokens < 1000
    )
    assert found == wanted


def test_probabilities_add_up_to_one():
    plain = AdaptiveModel(2)
    for text in (b"abracadabra", b"banana", b""):
        plain.score(text, learn=True)
    for history in ([START, START], [START, 97], [97, 98], [98, 114], [122, 122]):
        assert sum(10 ** plain.cost(history, s) for s in range(END + 1)) == pytest.approx(1)


def test_adaptive_code_length_falls_for_repeats():
    once = AdaptiveModel(4).score(b"some words", learn=True)
    model = AdaptiveModel(4)
    model.score(b"some words", learn=True)
    assert model.score(b"some words", learn=True) > once


def test_adaptive_scores_of_documents(documents):
    rows = [(1, "ab " * 30), (2, "The dog saw a cat"), (3, None), (None, "The dog saw a cat")]
    found = {r.doc_id: r.score for r in score_adaptively(documents(rows)).collect()}
    assert found[3] == pytest.approx(-math.log10(257))
    assert found[2] == found[None] == pytest.approx(
        AdaptiveModel(3).score(b"the dog saw a cat", learn=True)
    )
    assert found[1] / 91 > found[2] / 18
    assert score_adaptively(documents([])).count() == 0


def test_block_of_rows_is_packed_row_by_row():
    data = np.frombuffer(b"abc" + b"" + b"zz", np.uint8)
    packed, begins = grams(data, np.array([0, 3, 3, 5]), 2)
    assert begins.tolist() == [0, 4, 5, 8]
    assert (packed & mask(0)).tolist() == [97, 98, 99, END, END, 122, 122, END]
    first = [START << 18 | START << 9 | 97, START << 18 | 97 << 9 | 98]
    assert packed[:2].tolist() == first


def test_empty_tables(documents):
    model = train_language_model(documents([]))
    assert score_documents(documents([]), model).count() == 0
    (r,) = score_documents(documents([(1, "ab")]), model).collect()
    assert r.score == pytest.approx(-3 * math.log10(257))
    assert (r.n_tokens, r.n_known, r.base_score) == (2, 0, 0.0)
    assert isinstance(model.trie(0, 1), Trie)


def test_crowded_contexts_are_split(documents, monkeypatch):
    monkeypatch.setattr(lm_score, "TRIE_PAIRS", 3)
    monkeypatch.setattr(lm_score, "TEXT_BLOCK", 200)
    monkeypatch.setattr(lm_score, "TRIE_PARTS", 3)
    monkeypatch.setattr(lm_score, "BLOCKS_AT_ONCE", 2)
    rng = random.Random(7)
    rows = [(i, "".join(rng.choices("abc d", k=rng.randint(0, 60)))) for i in range(80)]
    train = [r for r in rows if r[0] % 4]
    for order in (1, 2, 4):
        plain = AdaptiveModel(order)
        for _, t in train:
            plain.score(t.encode(), learn=True, score=False)
        model = train_language_model(documents(train), order=order)
        found = {r.doc_id: r.score for r in score_documents(documents(rows), model).collect()}
        assert found == pytest.approx({d: plain.score(t.encode(), learn=False) for d, t in rows})


def test_different_keys_in_order():
    rng = np.random.default_rng(4)
    for n in (0, 1, 5, 3000):
        keys = rng.integers(0, 2**54, max(1, n // 3), np.uint64)[rng.integers(0, max(1, n // 3), n)]
        assert lm_score._distinct(keys).tolist() == sorted(set(keys.tolist()))
