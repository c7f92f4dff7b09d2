from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakestrata.llm import dac
from lakestrata.llm.queries import tokenizer_path
from lakestrata.llm.token_store import PieceEncoder, read_documents, read_ids, write_token_store
from lakestrata.sources import run_folder


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 70_000), max_size=1500), st.data())
def test_codes_give_every_id_and_slice_back(ids, data):
    reader = dac.Reader(dac.encode(np.array(ids, np.uint32)))
    assert len(reader) == len(ids)
    assert reader.slice(0, len(ids)).tolist() == ids
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert reader.slice(a, b).tolist() == ids[a:b]
    for i in {a, b, len(ids) // 2}:
        if i < len(ids):
            assert reader[i] == ids[i]


def test_random_access_over_several_directory_steps():
    ids = np.random.default_rng(1).integers(0, 1 << 20, 10_000, np.uint32)
    reader = dac.Reader(dac.encode(ids))
    assert [reader[i] for i in range(0, 10_000, 37)] == ids[::37].tolist()


TEXTS = [
    "", " ", "  two", "a  b", "tab\t x", " lead", "trail ", "nb sp x  y", "line \n next",
    "it's 12,5 % <|endoftext|> é ü 漢字 🙂", "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>", "plain words here", "\x1c x \x85 y", "x" * 5000, "a b " * 3000,
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_the_whole_text(plain):
    encoder = PieceEncoder(tokenizer_path())
    found = encoder(pa.array(TEXTS))
    assert [x.tolist() for x in found] == [plain(t) for t in TEXTS]


@settings(deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n\t'.1é "), max_size=40), max_size=5))
def test_pieces_of_any_text(plain, texts):
    encoder = PieceEncoder(tokenizer_path())
    found = encoder(pa.array(texts, pa.string()))
    assert [x.tolist() for x in found] == [plain(t) for t in texts]


def test_store_round_trip(spark, documents, plain):
    rows = [(i * 7 % 23, t) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id"), (None, None), (3, None), (5, "same"), (5, "same"), (6, "y z " * 200_000)]
    path = run_folder(spark, "tokens")
    write_token_store(documents(rows), path, tokenizer_path())
    found = read_documents(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted(
        (i for i, _ in rows), key=lambda i: (i is not None, i)
    )
    wanted = sorted(
        (i is not None, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for i, ids in ((i, [*plain(t), 0]) for i, t in rows)
    )
    got = sorted((r.doc_id is not None, r.doc_id, r.n_tokens, r.ids_crc32) for r in found)
    assert got == wanted
    start = 0
    for r in found:
        assert r.start == start
        start += r.n_tokens
    some = found[len(found) // 2]
    ids = read_ids(spark, path, some.start, some.start + some.n_tokens)
    assert zlib.crc32(np.array(ids, "<u4").tobytes()) == some.ids_crc32


def test_empty_store(spark, documents):
    path = run_folder(spark, f"tokens-{uuid.uuid4().hex}")
    write_token_store(documents([]), path, tokenizer_path())
    assert read_documents(spark, path).count() == 0
    assert read_ids(spark, path, 0, 10) == []
