"""Personal data: plain spans against the stated patterns, disguises, masks."""

import random
import re

import pytest

from keyedload.llm import pii

KINDS = ("email", "ip", "card", "phone")


def stated(text):
    """Base spans straight from the patterns of the contract."""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


@pytest.mark.parametrize("seed", range(40))
def test_plain_spans_are_the_stated_ones(seed):
    rng = random.Random(seed)
    parts = ["a", "b.", "@", "@", ".", "-", "_", "%", "1", "25", "255", "256", ".", ".", " ", "  ", "+", "+1", "(", ")", "é", "x@y.z", "1.2.3.4"]
    parts += ["4111111111111111", "4111 1111 1111 1111", "+1 (743) 555-3824", "00.0.0.001", "\n"]
    text = "".join(rng.choice(parts) for _ in range(400))
    assert pii.plain_spans(text) == stated(text)


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("write jane.doe (at) mail [dot] example dot com now", "email", "jane.doe (at) mail [dot] example dot com"),
        ("bob at site dot org", "email", "bob at site dot org"),
        ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("call plus four nine one five one two three four five six seven now", "phone", "plus four nine one five one two three four five six seven"),
        ("host one nine two dot one six eight dot zero dot one ok", "ip", "one nine two dot one six eight dot zero dot one"),
        ("４１１１ 1111 1111 1111", "card", "４１１１ 1111 1111 1111"),
        ("eins zwei sieben . null . null . eins", "ip", "eins zwei sieben . null . null . eins"),
        ("zero​width@mail.com", "email", "zero​width@mail.com"),
    ],
)
def test_disguises_are_found_where_they_stand(text, kind, found):
    assert (kind, text.index(found), text.index(found) + len(found), False) in pii.spans_of(text)


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("ask eight dot eight dot eight dot eight now", "ip", "eight dot eight dot eight dot eight"),
        ("at one dot two dot three dot four.", "ip", "one dot two dot three dot four"),
        ("host 1 dot two dot 3 dot four ok", "ip", "1 dot two dot 3 dot four"),
        ("call plus four 9 one 5 one 2 three 4 five 6 seven now", "phone", "plus four 9 one 5 one 2 three 4 five 6 seven"),
        ("card four 1 1 1 1 1 1 1 1 1 1 1 1 1 1 one.", "card", "four 1 1 1 1 1 1 1 1 1 1 1 1 1 1 one"),
        ("« FÜNF dot 2 dot fünf dot 4 »", "ip", "FÜNF dot 2 dot fünf dot 4"),
        ("“eight dot eight dot eight dot eight”", "ip", "eight dot eight dot eight dot eight"),
    ],
)
def test_spelled_digits_need_not_stand_in_a_row(text, kind, found):
    at = text.index(found)
    assert (kind, at, at + len(found), False) in pii.spans_of(text)
    assert pii.redact(text) == f"{text[:at]}[{kind.upper()}]{text[at + len(found):]}"


@pytest.mark.parametrize("text", ["meet me at noon", "one two three go", "un deux trois", "point (at) 5", "Привет мир", ""])
def test_clean_texts_have_no_spans(text):
    assert pii.spans_of(text) == [] and pii.redact(text) == text


def test_long_runs_take_no_square_time():
    text = "a" * 200_000 + "1" * 200_000 + "+ " * 20_000 + "one " * 20_000 + "@" * 20_000 + "( " * 20_000
    assert pii.spans_of(text) == []


def test_columns(spark):
    rows = [(1, "a@b.cd and 1.2.3.4", "x"), (None, None, "x"), (1, "", "x"), (2, "x (at) y (dot) z", "x"), (1, "a@b.cd and 1.2.3.4", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    found = pii.find(docs).select("doc_id", pii.listed("spans").alias("s")).collect()
    assert sorted(map(repr, ((r.doc_id, r.s) for r in found))) == sorted(
        map(repr, [(1, "email:0:6,ip:11:18"), (None, ""), (1, ""), (2, "email:0:16"), (1, "email:0:6,ip:11:18")])
    )
    masked = pii.redacted(docs)
    assert masked.columns == docs.columns
    assert sorted(str(r.text) for r in masked.collect()) == ["", "None", "[EMAIL]", "[EMAIL] and [IP]", "[EMAIL] and [IP]"]
    assert pii.find(docs.limit(0)).count() == 0
