"""The registered queries, and the pipeline stage by stage against brute force."""

from __future__ import annotations

import os
import re
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
import corpus_pipeline  # noqa: E402
from comparison import connect, differences  # noqa: E402
from lakestrata.llm.oracles import LLM_ORACLES  # noqa: E402
from lakestrata.llm.queries import LLM_QUERIES, tokenizer_path  # noqa: E402
from lakestrata.llm.toxicity import train_toxicity  # noqa: E402
from lakestrata.sources import run_folder  # noqa: E402
from llm.test_mixing import plain_targets  # noqa: E402
from llm.test_repeats import brute as plain_repeats  # noqa: E402
from llm.test_simhash import brute as plain_components  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = {
    "op1_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op2_token_ids": "doc_id start n_tokens ids_crc32",
    "op3_repeats": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op4_decontamination": "doc_id item_id n_windows coverage exact",
    "op5_lm_score": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op6_langid": "doc_id held_out lang_pred score",
    "op7_mixing": "doc_id size source_size target taken",
    "op8_simhash": "doc_id fingerprint component_id",
    "op9_toxicity": "doc_id held_out score predicted",
    "op10_topk": "query_id rank vec_id score",
    "op11_divergence": "lang source part item value rank",
    "op12_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256 n_overlaps n_shared",
    "op13_packing": "doc_id piece start length ids_crc32 sequence_id offset",
}


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def texts(database):
    return database.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def test_all_are_registered():
    assert set(COLUMNS) == set(LLM_QUERIES)
    assert set(COLUMNS) | {"pipeline"} <= set(contract.queries())
    assert set(LLM_ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, texts, name):
    result = LLM_QUERIES[name](spark, SF_DIR)
    assert result.columns == COLUMNS[name].split()
    n = result.count()
    if "doc_id" in result.columns and name not in ("op4_decontamination", "op13_packing"):
        assert n == len(texts)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_equals_sql(spark, database, name):
    assert differences(LLM_QUERIES[name](spark, SF_DIR), database, LLM_ORACLES[name]) is None


def test_repeats_and_components_of_the_whole_table(spark, texts):
    import hashlib

    found = {tuple(r) for r in LLM_QUERIES["op3_repeats"](spark, SF_DIR).collect()}
    assert found == {
        (d, n, gone, spans, hashlib.sha256(kept).hexdigest())
        for d, n, gone, spans, kept in plain_repeats(texts)
    }
    found = {tuple(r) for r in LLM_QUERIES["op8_simhash"](spark, SF_DIR).collect()}
    assert found == set(plain_components(texts))


@pytest.fixture(scope="module")
def stages(spark):
    """Rows that went into each stage, and those that the last one returned."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    root, seen = run_folder(spark, "stages"), [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{root}/{name.replace(' ', '-')}")
        docs = spark.read.parquet(f"{root}/{name.replace(' ', '-')}")
        seen.append(docs)
    return seen


def rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_stages_hand_on_documents(stages):
    assert [s.columns for s in stages[:-1]] == [stages[0].columns] * 5


def test_toxic_documents_go(spark, stages):
    import math

    import xxhash

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = train_toxicity(stages[0], labels)
    weights = dict(zip(model.keys.tolist(), model.weights.tolist()))
    a, b, c = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9

    def score(text):
        h = [xxhash.xxh64_intdigest(w) for w in re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower())]
        found = {x * a for x in h} | {x * b + y * a for x, y in zip(h, h[1:])}
        found |= {x * c + y * b for x, y in zip(h, h[2:])}
        total = model.bias + sum(weights.get(x % 2**64 >> 32, 0.0) for x in found)
        return 1 / (1 + math.exp(-total))

    kept = {d for d, _, _ in rows(stages[1])}
    assert kept == {d for d, t, _ in rows(stages[0]) if score(t or "") < 0.5}


def test_one_of_each_group_stays(stages):
    components = plain_components([(d, t) for d, t, _ in rows(stages[1])])
    assert sorted(d for d, _, _ in rows(stages[2])) == sorted({c for _, _, c in components})


def test_documents_with_items_go(stages, database):
    items = database.execute("SELECT text FROM benchmark").fetchall()
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    wanted = [grams(words(t)) for (t,) in items]
    kept = []
    for doc, text, _ in rows(stages[2]):
        own = grams(words(text))
        if not any(w and len(w & own) / len(w) >= 0.8 for w in wanted):
            kept.append(doc)
    assert sorted(kept) == sorted(d for d, _, _ in rows(stages[3]))


def test_mix_has_the_target_words(stages):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in rows(stages[3]):
        sizes[source] += count(text)
    for _, text, source in rows(stages[4]):
        taken[source] += count(text)
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= 1


def test_token_store_holds_the_mix(stages):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    wanted = []
    for doc, text, _ in rows(stages[4]):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        wanted.append((doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    found = sorted(stages[5].collect(), key=lambda r: r.start)
    assert sorted(wanted) == sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in found)
    assert [r.doc_id for r in found] == sorted(r.doc_id for r in found)


def test_whole_run(spark, stages):
    result = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, stages[5].collect()))
