from __future__ import annotations

import re
from collections import defaultdict
from itertools import permutations

import pytest

from lakestrata.llm.divergence import source_divergence, term_counts

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=10, top=10):
    """rows: (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    n, held = defaultdict(int), defaultdict(int)
    for lang, source, text in rows:
        terms = TERM.findall(text.translate(LOWER))
        for t in terms:
            n[lang, source, t] += 1
        for t in set(terms):
            held[lang, t] += 1
    groups, found = sorted({r[:2] for r in rows}), set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), k in held.items() if x == lang and k >= min_docs)
        sources = [s for x, s in groups if x == lang]
        v = len(kept)

        def shares(counts):
            total = sum(counts)
            return [1 + 10**9 * (c + 2) // (total + 2 * v) for c in counts]

        counts = {s: [n[lang, s, t] for t in kept] for s in sources}
        p = {s: shares(c) for s, c in counts.items()}
        q = shares([sum(c) for c in zip(*counts.values())])
        f = lambda a, b: (a - b) ** 2 // (a + b)
        parts = defaultdict(list)
        for a, b in permutations(sources, 2):
            parts[a, "pair"].append((b, sum(map(f, p[a], p[b]))))
        for s in sources:
            for t, c, x, y in zip(kept, counts[s], p[s], q):
                if c and x > y:
                    parts[s, "term"].append((t, f(x, y)))
        for (s, part), items in parts.items():
            items.sort(key=lambda i: (-i[1], i[0].encode()))
            for rank, (item, value) in enumerate(items if part == "pair" else items[:top], 1):
                found.add((lang, s, part, item, value, rank))
    return found


@pytest.fixture
def rows():
    words = ["alpha", "Beta", "gamma", "Été", "漢字", "delta's", "x1y", "É"]
    made = []
    for i in range(160):
        text = " ".join(words[(i * j + j) % (3 + i % 5)] for j in range(1, 12 + i % 7))
        made.append((["en", "fr"][i % 2], f"s{i % 9}", text))
    made += [("en", "s1", "alpha " * 400)] * 3  # a group with most of the words, copies
    made += [(None, None, None), ("en", None, "alpha"), (None, "s1", "one"), ("en", "no words", "1 2 3")]
    made += [("xx", "a", "rare"), ("xx", "b", None), ("yy", "only", "word")]
    return made


def as_rows(documents, rows):
    return documents([(i, text, lang, source) for i, (lang, source, text) in enumerate(rows)])


def test_equals_brute_force(documents, rows):
    found = source_divergence(as_rows(documents, rows))
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {tuple(r) for r in found.collect()} == brute(rows)


@pytest.mark.parametrize("groups, terms", [(1, 1), (2, 3), (4, 1000)])
def test_blocks_do_not_change_the_result(documents, rows, groups, terms):
    found = source_divergence(as_rows(documents, rows), 3, 2, groups, terms)
    assert {tuple(r) for r in found.collect()} == brute(rows, 3, 2)


def test_counts_beyond_63_bits_of_product(spark, documents, monkeypatch):
    """10^9 times a count of 10^12 does not fit a long."""
    from lakestrata.llm import divergence

    counted = spark.createDataFrame(
        [("en", "a", "t", 10**12, 50), ("en", "b", "t", 7, 50), ("en", "b", "u", 10**12, 50)],
        "lang string, source string, term string, n long, docs long",
    )
    monkeypatch.setattr(divergence, "term_counts", lambda docs: counted)
    found = source_divergence(documents([(1, "t", "en", "a"), (2, "t", "en", "b")])).collect()
    share = lambda n, total: 1 + 10**9 * (n + 2) // (total + 4)
    a = share(10**12, 10**12), share(0, 10**12)
    b = share(7, 10**12 + 7), share(10**12, 10**12 + 7)
    value = sum((x - y) ** 2 // (x + y) for x, y in zip(a, b))
    assert {r.value for r in found if r.part == "pair"} == {value}


def test_frequent_terms_are_counted_in_parts(documents, monkeypatch):
    from lakestrata.llm import divergence

    monkeypatch.setattr(divergence, "COUNTED_AT_ONCE", 3)
    counts = term_counts(documents([(i, "a B b c d e f", "en", "s") for i in range(20)]))
    assert {(r.term, r.n, r.docs) for r in counts.collect()} == {
        (t, 40 if t == "b" else 20, 20) for t in "abcdef"
    }


def test_empty_table(documents):
    assert source_divergence(documents([])).count() == 0
