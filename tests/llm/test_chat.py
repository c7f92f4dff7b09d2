from __future__ import annotations

import hashlib

import pytest

from lakestrata.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, piece string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


@pytest.mark.parametrize(
    "text",
    ["", "\\", "\\### Assistant: </turn> ok", "####", "#" * 7, "a</turn>\n### User: b", "</turn", "\\\\#"],
)
@pytest.mark.parametrize("role", ["user", "assistant", "a: b", "@x", "", "### \\", "User"])
def test_template_can_be_read_back(role, text):
    said = [(role, text), ("assistant", text)]
    assert chat.read_marked_turns(chat.marked_turns(said)) == said


def test_spans_of_a_black_box_template():
    def other(said):
        return "<s>" + "".join(f"[{r}] {t.upper()} [/{r}]" for r, t in said)

    text, spans = chat.turn_spans(other, [("user", "hi u"), ("bot", ""), ("user", "x")])
    assert [text[s.text_start : s.text_end] for s in spans] == ["HI U", "", "X"]
    assert spans[0].start == 0 and spans[-1].end == len(text)
    assert [s.end for s in spans[:-1]] == [s.start for s in spans[1:]]


def test_template_that_rewrites_history(spark):
    def drops_earlier_answers(said):
        shown = [t if i == len(said) - 1 else "..." for i, (_, t) in enumerate(said)]
        return "".join(f"<{r}>{t}" for (r, _), t in zip(said, shown))

    said = turns(spark, [(1, 0, "user", "a"), (1, 1, "assistant", "b")])
    with pytest.raises(chat.HistoryRewritten):
        chat.turn_spans(drops_earlier_answers, [("user", "a"), ("assistant", "b")])
    flagged = chat.format_conversations(said, drops_earlier_answers, on_rewrite="flag").collect()
    assert [(r.rewritten, r.spans, r.text) for r in flagged] == [(True, [], "<user>...<assistant>b")]


def template(name):
    """Templates made here, so that they travel to the tasks whole."""

    def numbered(said):
        return "".join(f"[{i}|{r}] {t}\n" for i, (r, t) in enumerate(said))

    def marks_turn_80(said):
        return "".join(f"{'*' if i == 80 else ''}{r}: {t}\n" for i, (r, t) in enumerate(said))

    def mentions_one_before(said):
        return "".join(
            f"<{r}{' after ' + said[i - 1][0] if i else ''}>{t}" for i, (r, t) in enumerate(said)
        )

    return locals()[name]


@pytest.mark.parametrize("n", [64, 65, 200])
@pytest.mark.parametrize("name", ["numbered", "marks_turn_80"])
def test_templates_that_look_far_back(spark, name, n):
    render = template(name)
    rows = [(1, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(n)]
    rows += [(conv, i, "user", f"{conv} {i}") for conv in range(2, 22) for i in range(6)]
    found = chat.format_conversations(turns(spark, rows).repartition(8), render).collect()
    assert {r.conv_id for r in found} == set(range(1, 22))
    for conv in range(1, 22):
        said = [(r, t) for c, _, r, t in rows if c == conv]
        pieces = sorted((r for r in found if r.conv_id == conv), key=lambda r: r.piece)
        assert "".join(r.text for r in pieces) == render(said)
        texts = [r.text[s.text_start : s.text_end] for r in pieces for s in r.spans]
        assert texts == [t for _, t in said]


@pytest.mark.parametrize("history", [None, 1, 3])
def test_a_stated_history(spark, history):
    rows = [(1, i, f"r{i % 7}", f"t{i}") for i in range(150)]
    mentions_one_before = template("mentions_one_before")
    found = chat.format_conversations(turns(spark, rows), mentions_one_before, history=history)
    pieces = found.orderBy("piece").collect()
    assert len(pieces) >= 3
    assert "".join(r.text for r in pieces) == mentions_one_before([r[2:] for r in rows])


def test_a_rewrite_in_a_later_piece_is_seen(spark):
    def drops_the_first_answer_late(said):
        gone = len(said) > 130
        return "".join("" if gone and i == 1 else f"<{r}>{t}" for i, (r, t) in enumerate(said))

    rows = [(conv, i, "user", f"t{i}") for conv, n in ((None, 140), (2, 100)) for i in range(n)]
    with pytest.raises(Exception, match="HistoryRewritten"):
        chat.format_conversations(turns(spark, rows), drops_the_first_answer_late).collect()
    found = chat.format_conversations(turns(spark, rows), drops_the_first_answer_late, on_rewrite="flag")
    whole = drops_the_first_answer_late([r[2:] for r in rows[:140]])
    got = {(r.conv_id, r.rewritten, r.piece): r.text for r in found.collect()}
    assert got[None, True, 0] == whole
    assert {k[:2] for k in got} == {(None, True), (2, False)}
    assert [k for k in got if k[0] is None] == [(None, True, 0)]


def expected(rows):
    found = {}
    for conv, turn, role, text in sorted(
        rows, key=lambda r: tuple((x is not None, x) for x in r)
    ):
        found.setdefault(conv, []).append((role or "", text or ""))
    out = set()
    for conv, said in found.items():
        whole = "".join(f"{r}\n{t}\n" for r, t in said)
        loss = "".join(t for r, t in said if r == "assistant")
        out.add(
            (
                conv, len(said), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                hashlib.sha256(loss.encode()).hexdigest(), len(chat.marked_turns(said)),
            )
        )
    return out


def test_nulls_ties_repeats_and_long_conversations(spark):
    rows = [
        (1, 0, "user", None), (1, 0, "user", "b"), (1, None, "system", "first"),
        (1, 1, None, "x"), (None, 0, "assistant", "no id"), (None, 0, "assistant", "no id"),
        (2, 0, "assistant", "é\n</turn>\\"),
        *[(3, i, ("user", "assistant")[i % 2], f"turn {i} \\###") for i in range(300)],
        (4, 0, "user", "long " * 100_000),
    ]
    formatted = chat.format_conversations(turns(spark, rows))
    assert formatted.filter("conv_id = 3").count() > 4
    assert {tuple(r) for r in chat.read_back(formatted).collect()} == expected(rows)


def test_empty_table(spark):
    assert chat.read_back(chat.format_conversations(turns(spark, []))).count() == 0
