from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from lakestrata.llm.mixing import mix_sources, mixed_documents, source_targets, taken_words


def plain_targets(sizes, weights=(1, 2, 3), repeats=3):
    """Share by weight, cap, share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > repeats * sizes[s]}
        if not over:
            for s in open_:
                target[s] = left * weight[s] / total
            break
        for s in over:
            target[s] = float(repeats * sizes[s])
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 1000, None: 5, "é": 70, "Z": 3},
        {"a": 0, "b": 0},
        {"only": 7},
        {"a": 1, "b": 1, "c": 10**9},
    ],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in source_targets(rows).collect()}
    assert found == pytest.approx(plain_targets(sizes))


def some_rows():
    rng = random.Random(4)
    rows = [
        (i, " ".join(["w%d" % rng.randrange(99)] * 1 + rng.choices("abc", k=rng.randint(0, 60))), "en",
         rng.choice(["a", "a", "a", "b", "c", None, "é"]))
        for i in range(400)
    ]
    rows += [(9, None, "en", "a"), (8, "", "en", "b"), (None, "x y z", "en", "c")]
    rows += [(7, "same row again", "en", "b")] * 5 + [(6, "long " * 60_000, "en", "a")]
    return rows


def test_mix_comes_near_targets_and_is_repeatable(documents):
    rows = some_rows()
    docs = documents(rows)
    found = Counter(tuple(r) for r in taken_words(mix_sources(docs)).collect())
    again = taken_words(mix_sources(docs.repartition(3, "text"))).collect()
    assert found == Counter(tuple(r) for r in again)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += size(text)
    targets = plain_targets(sizes)
    assert sum(found.values()) == len(rows)
    assert Counter({(d, n): 0 for d, n, *_ in found}) == Counter({(d, size(t)): 0 for d, t, *_ in rows})
    by_target = defaultdict(int)
    for (_, n, _, target, taken), times in found.items():
        assert 0 <= taken <= 3 * n
        by_target[round(target, 6)] += taken * times
    wanted = defaultdict(float)
    for target in targets.values():
        wanted[round(target, 6)] += target
    assert by_target == pytest.approx(wanted, abs=2)


def test_mixed_documents_hold_what_is_taken(documents):
    docs = documents(some_rows())
    mix = mix_sources(docs)
    mixed = mixed_documents(docs, mix)
    assert mixed.columns == docs.columns
    words = defaultdict(int)
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    taken = defaultdict(int)
    for r in taken_words(mix).collect():
        taken[r.doc_id] += r.taken
    assert words == {d: n for d, n in taken.items() if n}


def test_rows_taken_in_part_keep_their_white_space(documents):
    text = "\n  one\n\ntwo\tthree  é ist\u00a0da\r\n end \n"
    docs = documents([(i, text * 20, "en", "ab"[i % 2]) for i in range(13)])
    mixed = [r.text for r in mixed_documents(docs, mix_sources(docs, block=7)).collect()]
    parts = [t for t in mixed if t != text * 20]
    assert parts and all(t in text * 20 and t == t.strip(" \t\n\r") for t in parts)
    words = sum(r.taken for r in taken_words(mix_sources(docs, block=7)).collect())
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in mixed) == words


def test_slots_follow_the_weights_all_along(documents):
    rows = [(i, "w " * 50, "en", "abc"[i % 3]) for i in range(600)]
    pieces = mix_sources(documents(rows), block=20).pieces
    slots = pieces.select("slot", "number").distinct().orderBy("slot").collect()
    half = Counter(r.number for r in slots[: len(slots) // 2])
    for number, share in ((0, 1 / 6), (1, 2 / 6), (2, 3 / 6)):
        assert abs(half[number] / sum(half.values()) - share) < 0.02


def test_empty_table(documents):
    docs = documents([])
    assert taken_words(mix_sources(docs)).count() == 0
    assert mixed_documents(docs, mix_sources(docs)).count() == 0
