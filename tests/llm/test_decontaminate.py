from __future__ import annotations

import os
import re
from collections import Counter, defaultdict

from lakestrata.llm.decontaminate import UNITS, benchmark_leaks, drop_leaks

ITEM = (
    "A train leaves Paris at 60 km per hour and Maria walks 5 km to the station. "
    "How long does Maria wait if the train needs 3 hours for the whole way?"
)
OTHER = "Which of the following metals melts at the lowest temperature under normal pressure?"
FILLER = "some plain words that say nothing at all about any question in the list "


def leaks(spark, documents, rows, items=((1, ITEM), (2, OTHER), (3, None), (4, ""), (None, "x y"))):
    table = spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, pos string")
    return documents(rows), table


def found(spark, documents, rows, **more):
    docs, table = leaks(spark, documents, rows, **more)
    return {(r.doc_id, r.item_id, r.exact) for r in benchmark_leaks(docs, table).collect()}


def test_copies_and_other_parameters(spark, documents):
    other_values = ITEM.replace("60", "85").replace("Maria", "Ahmed").replace("3 hours", "4 days")
    rows = [
        (1, FILLER + ITEM + " " + FILLER),
        (2, FILLER + ITEM.lower() + FILLER),
        (3, FILLER + other_values + " " + FILLER),
        (4, FILLER * 3),
        (5, FILLER + OTHER.upper()),
        (6, OTHER[:40]),
    ]
    assert found(spark, documents, rows) == {
        (1, 1, True), (2, 1, True), (3, 1, False), (5, 2, True),
    }


def test_slots_must_map_one_to_one(spark, documents):
    item = ((1, "Tom has 3 red and 4 blue balls and gives 3 of them to Ann and 4 of them to Eva"),)
    same = "Max has 8 red and 9 blue balls and gives 8 of them to Lea and 9 of them to Ida"
    mixed = "Max has 8 red and 9 blue balls and gives 7 of them to Lea and 8 of them to Max"
    rows = [(1, f"so {same} now"), (2, f"so {mixed} now")]
    assert {d for d, _, _ in found(spark, documents, rows, items=item)} == {1}


def test_names_that_begin_sentences(spark, documents):
    item = "Tom has 5 apples. Tom buys 3 more. How many apples does Tom have?"
    rows = [(1, item.replace("Tom", "Anna")), (2, f"so {item.replace('Tom', 'Anna')} now")]
    assert found(spark, documents, rows, items=((1, item),)) == {(1, 1, False), (2, 1, False)}


def test_one_changed_value(spark, documents):
    before = "the old road that runs from Paris along the quiet river and over the hills"
    after = "was closed for 3 days so that all carts to Paris had to wait 4 days at the gate"
    item = f"{before} {after}"
    rows = [
        (1, f"so {before} {after.replace('Paris', 'Rome')} now"),
        (2, f"so {item.replace('4', '3')} now"),
    ]
    assert found(spark, documents, rows, items=((1, item),)) == {(1, 1, False), (2, 1, False)}


def test_placeholders_alone_are_no_evidence(spark, documents):
    numbers = "Find the median of " + ", ".join(str(n) for n in range(12, 25))
    items = ((1, numbers), (2, "2, 4, 8, 16, 32"))
    table = ", ".join(str(n) for n in range(300, 340))
    rows = [
        (1, f"the table says {table} in all"),
        (2, f"so {numbers} now"),
        (3, "first 2, 4, 8, 16, 32 and more"),
        (4, "Nine Ten Paris Rome Oslo Bern Lima Cairo Quito Delhi Tunis Accra Dakar Seoul Hanoi"),
    ]
    items += ((3, "Bonn Kiel Trier Mainz Worms Essen Halle Jena Gera Suhl Ulm Hof Celle"),)
    assert found(spark, documents, rows, items=items) == {(2, 1, True), (3, 2, True)}


def test_nulls_repeats_long_texts_and_short_items(spark, documents):
    items = ((1, ITEM), (9, "Yes or no"), (10, ITEM))
    rows = [
        (1, None), (2, ""), (None, ITEM), (3, ITEM), (3, ITEM), (3, FILLER), (4, "yes or no"),
        (5, "yes or no or maybe so"), (6, FILLER * 20_000 + ITEM), (7, (ITEM + " ") * 300),
    ]
    got = {(d, i) for d, i, _ in found(spark, documents, rows, items=items)}
    assert got == {(d, i) for d in (None, 3, 6, 7) for i in (1, 10)} | {(4, 9)}
    docs, table = leaks(spark, documents, rows, items=items)
    kept = drop_leaks(docs, table)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted(
        (d, t or "") for d, t in rows if t is None or ITEM not in t and t != "yes or no"
    )


def test_empty_tables(spark, documents):
    assert found(spark, documents, []) == set()
    assert found(spark, documents, [(1, ITEM)], items=()) == set()


TOKEN = re.compile(rb"[0-9]+(?:[.,][0-9]+)*|[A-Za-z\x80-\xff]+|[.!?:;\n]|%")


def plain_forms(text):
    """Per form a list of (token, placeholder or None)."""
    out, before = ([], [], []), "break"
    for token in TOKEN.findall((text or "").encode()):
        word = token.decode()
        if word in ".!?:;\n":
            before = "break"
            continue
        titled = word[0].isupper() and not word.isupper()
        kind = "number" if word[0] in "0123456789" else "name" if titled else "word"
        unit = word == "%" or word.lower() in UNITS and (titled or before == "number")
        kind = "unit" if unit else kind
        holder = kind if kind == "number" or unit and before == "number" else None
        inside = "name" if kind == "name" and before != "break" else holder
        for form, typed in zip(out, (holder, inside, "name" if kind == "name" else holder)):
            form.append((word.lower(), typed))
        before = "%" if word == "%" else kind if not unit else "name" if titled else "word"
    return out


def plain_windows(text, n=5):
    """(key, place, holes, slots) of all windows in all forms; and their places."""
    forms = plain_forms(text)
    total = len(forms[0])
    found = set()
    for form in forms:
        for at in range(max(total - n, 0) + 1 if total else 0):
            window = form[at : at + n]
            holes = tuple(i for i, (_, typed) in enumerate(window) if typed)
            bare = len(holes) == len(window)
            key = tuple((w, None) if bare or not t else ("", t) for w, t in window)
            if all((key, at) != f[:2] for f in found if f[1] == at):
                found.add((key, at, holes, tuple(window[i][0] for i in holes)))
    return found, max(total - n, 0) + 1


def plain_line(windows, total, literals=5):
    """Places that count of the windows of one alignment, and whether all is equal."""
    pairs = {at + i: (a, g) for at, _, holes, asked, given in windows
             for i, a, g in zip(holes, asked, given)}
    often = Counter(pairs.values())
    kept = {
        p for p in often
        if all(often[q] < often[p] for q in often if q != p and (q[0] == p[0] or q[1] == p[1]))
    }
    equal = {w[0] for w in windows if w[3] == w[4]}
    mapped, around = set(equal), set()
    for at, size, _, asked, given in windows:
        if at in equal or set(zip(asked, given)) <= kept:
            mapped.add(at)
            around |= set(range(at, at + size))
    around = {p for p in around if p not in pairs or pairs[p][0] == pairs[p][1]}
    size = next(iter(windows))[1]
    enough = len(around) >= min(literals, (total - 1 + size) // 2)
    return mapped if enough else equal, all(a == g for a, g in pairs.values())


def plain_leaks(docs, items):
    by_key, totals = defaultdict(list), {}
    for item, text in items:
        windows, totals[item] = plain_windows(text)
        for key, at, holes, slots in windows:
            by_key[key].append((item, at, holes, slots))
    out = set()
    for doc, text in docs:
        lines = defaultdict(set)
        for key, at, _, given in plain_windows(text)[0]:
            for item, pos, holes, asked in by_key.get(key, ()):
                if len(asked) == len(given):
                    lines[item, at - pos].add((pos, len(key), holes, asked, given))
        judged = defaultdict(list)
        for (item, _), windows in lines.items():
            places, same = plain_line(windows, totals[item])
            if places:
                judged[item].append((places, same))
        for item, found_ in judged.items():
            covered = set().union(*(places for places, _ in found_))
            if len(covered) / totals[item] >= 0.8 or max(len(p) for p, _ in found_) >= 9:
                out.add((doc, item, len(covered), all(same for _, same in found_)))
    return out


def test_equals_a_plain_search_with_templates_and_slots(spark):
    folder = f"{os.environ.get('TEST_SF_DIR', '/root/testdata/sf0.001')}"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    asked = [(r.item_id, r.text) for r in items.collect()]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # The items again with other values, names and units, and with one value changed.
    edits = [("0", "7"), (" 3", " 41"), ("Maria", "Ahmed"), (" m", " km"), (" The ", " Otto ")]
    for i, (old, new) in enumerate(edits):
        rows += [(-1000 * (i + 1) - k, f"{FILLER}{(t or '').replace(old, new)} {FILLER}")
                 for k, (_, t) in enumerate(asked)]
        rows += [(-9000 * (i + 1) - k, (t or "").replace(old, new, 1)) for k, (_, t) in enumerate(asked)]
    rows += [(-1, ITEM.replace("60", "85").replace("Maria", "Ahmed")), (-2, ITEM.replace("60", "5"))]
    asked.append((-1, ITEM))
    table = spark.createDataFrame(asked, "item_id long, text string")
    leaks_ = benchmark_leaks(spark.createDataFrame(rows, "doc_id long, text string"), table)
    found_ = {(r.doc_id, r.item_id, r.n_windows, r.exact) for r in leaks_.collect()}
    assert found_ == plain_leaks(rows, asked)
    assert {exact for *_, exact in found_} == {True, False}
