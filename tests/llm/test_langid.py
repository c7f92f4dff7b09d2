from __future__ import annotations

import random

import numpy as np

from lakestrata.llm.langid import (
    BINS,
    LanguageSettings,
    family_of,
    first_places,
    identify_language,
    train_language_id,
)

SYLLABLES = {
    "en": "the ing tion er an and th wh".split(),
    "de": "ung sch keit der ein ich ß ö".split(),
    "fr": "eau tion ère que les oi é ç".split(),
    "es": "ción que los ado ñ ez las rr".split(),
    "xx": "qzx vkw jjq pfz wvx zzk xqx kvj".split(),
}


def some_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(20)]
        rows.append((i, " ".join(words), lang))
    return rows


def test_held_out_rows(documents):
    model = train_language_id(documents(some_rows(300, 1)), LanguageSettings(epochs=3))
    assert set(model.families) == {"germanic", "romance", "other"}
    found = identify_language(documents(some_rows(200, 2)), model).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 196
    assert all(0 <= r.lang_score <= 1 for r in found)


def test_nulls_no_letters_long_and_repeated(documents):
    rows = some_rows(120, 3) + [(500, "no lang", None), (501, None, "en"), (502, "", "en")]
    model = train_language_id(documents(rows), LanguageSettings(epochs=2))
    odd = [(1, None), (2, ""), (3, "12 + 34!"), (4, "²½"), (None, "the and"), (5, "the ing " * 90_000)]
    docs = documents(odd + [(5, "x")] * 2).withColumnRenamed("score", "lang_pred")
    found = identify_language(docs, model).collect()
    assert len(found) == 8
    assert {r.doc_id for r in found if r.lang_pred == "und"} == {1, 2, 3, 4}
    assert all(r.lang_score == 0 for r in found if r.lang_pred == "und")
    assert identify_language(documents([]), model).count() == 0


def test_one_language_or_none(documents):
    one = train_language_id(documents([(1, "the and", "en")]))
    assert [r.lang_pred for r in identify_language(documents([(1, "was")]), one).collect()] == ["en"]
    none = train_language_id(documents([(1, "the", None)]))
    assert [r.lang_pred for r in identify_language(documents([(1, "was")]), none).collect()] == ["und"]


def test_families():
    assert family_of("en-GB") == family_of("DE") == "germanic"
    assert family_of("tlh") == "other"


def test_copies_do_not_fill_or_empty_the_sample(documents):
    """Most rows of a language are copies of one text, whatever its hash."""
    rng = random.Random(4)
    for trial in range(3):
        text = " ".join("".join(rng.choices(SYLLABLES["de"], k=3)) for _ in range(30))
        rows = [r for r in some_rows(60, trial) if r[2] != "de"]
        rows += [(1000 + i, text, "de") for i in range(3000)]
        model = train_language_id(documents(rows), LanguageSettings(per_language=20, epochs=2))
        assert set(model.languages["germanic"]) == {"de", "en"}
        found = identify_language(documents([(1, text)]), model).collect()
        assert [r.lang_pred for r in found] == ["de"]


def test_smallest_places_of_each_language(spark):
    rows = [("a", i % 50) for i in range(400)] + [("b", -i) for i in range(7)]
    found = first_places(spark.createDataFrame(rows, "lang string, place long").repartition(4), 10)
    assert {tuple(r) for r in found.collect()} == {("a", i, i + 1) for i in range(10)} | {
        ("b", i - 6, i + 1) for i in range(7)
    }


def test_many_languages_are_all_learned(documents):
    """A large family is cut into parts; no language is left out."""
    codes = [f"q{i:02}" for i in range(20)]
    rows = [(i, f"w{c} {c}x z{c} " * 4, c) for i, c in enumerate(codes * 3)]
    settings = LanguageSettings(members=8, epochs=3)
    model = train_language_id(documents(rows), settings)
    assert sorted(x for langs in model.languages.values() for x in langs) == codes
    assert {f: len(langs) for f, langs in model.languages.items()} == {
        "other": 8, "other 2": 8, "other 3": 4
    }
    assert len(model.pair_weights) == 28 + 28 + 6
    found = identify_language(documents(rows), model).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 54


def plain_margin(text, w):
    """Mean weight of the 2-, 3- and 4-grams of the bytes, one after the other."""
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
    total = 0.0
    for at in range(len(data)):
        for n in (2, 3, 4):
            gram = int.from_bytes(data[at : at + n], "little")
            mixed = gram * 2654435761 % 2**32 ^ ((n - 1) * 0x85EBCA6B & 0xFFFFFFFF)
            total += w[(mixed * 2654435761 % 2**32) >> (32 - BINS)]
    return total * 16.0 / max(len(data), 1) + w[-1]


def test_predictions_equal_a_plain_loop(documents):
    model = train_language_id(documents(some_rows(150, 5)), LanguageSettings(epochs=2))
    rows = some_rows(40, 6) + [(900, "The A", "en"), (901, "a", "en"), (902, "é ç 12", "fr")]
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    found = identify_language(documents(rows), model).collect()
    assert len(found) == len(rows)
    for r in found:
        margins = [plain_margin(r.text, w) for w in model.family_weights]
        ordered = sorted(margins)
        members = model.languages[model.families[int(np.argmax(margins))]]
        votes = dict.fromkeys(members, 0.0)
        for (a, b), w in model.pair_weights.items():
            if a in votes and b in votes:
                p = sigmoid(2 * plain_margin(r.text, w))
                votes[a] += p
                votes[b] += 1 - p
        best = max(members, key=lambda m: votes[m])
        score = sigmoid(2 * (ordered[-1] - ordered[-2]))
        if len(members) > 1:
            score *= votes[best] / (len(members) - 1)
        assert r.lang_pred == best
        assert abs(r.lang_score - score) < 1e-9
