from __future__ import annotations

import hashlib
import os
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakestrata.llm.alignment import (
    Csr,
    PieceLinks,
    _linked,
    align_tokens,
    overlap_links,
    shared_group_links,
)
from lakestrata.llm.queries import LLM_QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TEXTS = [
    None, "", " ", "  two", "a  b", "tab\t x", " lead", "trail ", "nb sp x  y", "line \n next",
    "plain words here", "it's 12,5 % <|endoftext|> <s> </s> <0x41> é ü 漢字 🙂", "a\x00b",
    "\x1c x \x85 y", "▁", "under ▁ line", "x" * 3000, "a b " * 2000, "words\nover lines",
]


def matrix(ids, n):
    m = np.zeros((n, 6), np.int64)
    for i, j in ids:
        m[i, j] += 1
    return m


def to_csr(m):
    rows, columns = np.nonzero(m)
    return Csr(np.searchsorted(rows, np.arange(len(m) + 1)), columns, m[rows, columns], m.shape[1])


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), max_size=20),
       st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5)), max_size=20))
def test_product_equals_dense_product(a, b):
    a, b = matrix(a, 4), matrix(b, 5)
    found = to_csr(a).times(to_csr(b).transposed())
    dense = np.zeros((4, 5), np.int64)
    dense[found.pairs()] = found.values
    assert np.array_equal(dense, a @ b.T)


@given(st.sets(st.integers(1, 29)), st.sets(st.integers(1, 29)))
def test_links_of_two_cuts(a, b):
    a, b = np.array(sorted(a | {30})), np.array(sorted(b | {30}))
    cuts = np.intersect1d(a, b)
    spans = lambda ends: list(zip([0, *ends[:-1].tolist()], ends.tolist()))
    over = {
        (i, j): min(x[1], y[1]) - max(x[0], y[0])
        for i, x in enumerate(spans(a))
        for j, y in enumerate(spans(b))
        if min(x[1], y[1]) > max(x[0], y[0])
    }
    found = overlap_links(a, b)
    assert dict(zip(zip(*(x.tolist() for x in found.pairs())), found.values.tolist())) == over
    group = lambda ends: [int((cuts < e).sum()) for e in ends]
    shared = {(i, j) for i, g in enumerate(group(a)) for j, h in enumerate(group(b)) if g == h}
    assert set(zip(*(x.tolist() for x in shared_group_links(a, b, cuts).pairs()))) == shared


@pytest.fixture(scope="module")
def plain():
    """Tokens of a whole text, as (id, bytes), by both tokenizers; none if bytes differ."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [x for x in range(256) if x not in kept]
    of = {chr(x): x for x in kept} | {chr(256 + i): x for i, x in enumerate(others)}
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def tokens(text):
        if not text:
            return [], []
        x = a.encode(" " + text, add_special_tokens=False)
        first = [(i, bytes(of[c] for c in t)) for i, t in zip(x.ids, x.tokens)]
        second = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            second.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(t for _, t in first) != whole or b"".join(t for _, t in second) != whole:
            return [], []
        return first, second

    return tokens


def brute(docs, plain):
    """Rows of the query for (doc_id, text)."""
    linked, pair_count, rows = [], defaultdict(int), []
    for doc, text in docs:
        a, b = plain(text)
        ends = lambda t: np.cumsum([len(x) for _, x in t]).tolist() if t else []
        a_ends, b_ends = ends(a), ends(b)
        cuts = sorted(set(a_ends) & set(b_ends))
        where = {e: j for j, e in enumerate(b_ends)}
        links = [(a[i][0], b[where[e]][0]) for i, e in enumerate(a_ends) if e in where]
        for pair in links:
            pair_count[pair] += 1
        groups, x, y = [], 0, 0
        n_shared = 0
        for cut in cuts:
            i, j = a_ends.index(cut, x) + 1, b_ends.index(cut, y) + 1
            groups.append("|".join(",".join(str(t[0]) for t in p) for p in (a[x:i], b[y:j])))
            n_shared += (i - x) * (j - y)
            x, y = i, j
        n_overlaps = len(a) + len(b) - len(cuts)
        linked.append((doc, len(a), len(b), len(groups), links, ";".join(groups), n_overlaps, n_shared))
    best = defaultdict(int)
    for (_, y), n in pair_count.items():
        best[y] = max(best[y], n)
    for doc, n_a, n_b, n_groups, links, text, n_overlaps, n_shared in linked:
        n_best = sum(pair_count[p] == best[p[1]] for p in links)
        sha = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        total = sum(pair_count[p] for p in links)
        rows.append((doc, n_a, n_b, n_groups, len(links), n_best, total, sha, n_overlaps, n_shared))
    return rows


def key(row):
    return (row[0] is not None, row[0] or 0, *row[1:])


def test_table(spark, documents, plain):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[10]), (3, TEXTS[10]), (None, "no id")]
    rows += [(100 + i, "copy of plain words") for i in range(50)]
    found = align_tokens(documents(rows).repartition(3), A, B).collect()
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups n_overlaps n_shared".split()
    sha = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    got = [tuple(sha(r[n]) if n == "groups" else r[n] for n in names) for r in found]
    assert sorted(got, key=key) == sorted(brute(rows, plain), key=key)


_LINKS = PieceLinks(A, B)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(st.sampled_from("ab \n\t'.1é ▁<"), max_size=30), min_size=1, max_size=5))
def test_pieces_of_any_text(plain, texts):
    batch = pa.record_batch(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["d", "t"]
    )
    found = _linked(_LINKS, batch, 1).slice(0, len(texts)).to_pylist()
    wanted = brute(list(enumerate(texts)), plain)
    for r, w in zip(found, wanted):
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_overlaps"], r["n_shared"]) == (
            *w[1:5], *w[8:]
        )
        assert (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") == w[7]


def test_empty_table(documents):
    assert align_tokens(documents([]), A, B).count() == 0
    only = align_tokens(documents([(1, None), (2, "▁")]), A, B).collect()
    assert [(r.n_a, r.n_links, r.groups, r.count_sum) for r in only] == [(0, 0, "", 0)] * 2


def test_query_equals_brute_force(spark, plain):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = [tuple(r) for r in LLM_QUERIES["op12_alignment"](spark, SF_DIR).collect()]
    assert sorted(found, key=key) == sorted(brute([tuple(r) for r in docs], plain), key=key)
