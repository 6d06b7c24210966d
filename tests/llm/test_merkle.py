"""Merkle fingerprints: equality, likeness, located edits, neighbours in order."""

import hashlib
import random
import zlib

import pytest
import xxhash

from keyedload.llm import merkle
from keyedload.llm.merkle import edited_paragraphs, fingerprint, likeness

LINES = [" ".join(f"word{i * j % 97}" for j in range(1, 40)) for i in range(1, 31)]


def test_equal_texts_and_only_they_have_equal_roots():
    texts = ["", "a", "a ", " a", "a\n", "\na", "a\n\n", "\n".join(LINES), "\n".join(LINES) + " ", "é", "é"]
    assert len({fingerprint(t)[:32] for t in texts}) == len(texts)
    assert all(fingerprint(t) == fingerprint("".join(list(t))) for t in texts)


def plain_pieces(line):
    """Pieces of a line, word by word."""
    out, now = [], []
    for w in line.split(" "):
        now.append(w)
        if zlib.crc32(w.encode()) % 4 == 0:
            out.append(now)
            now = []
    out += [now] if now else []
    return [" ".join(x[i : i + 12]) for x in out for i in range(0, len(x), 12)]


def plain_tree(text):
    """Sections of paragraphs of pieces, as text; digests serve only to end sections."""
    sections, now = [], []
    for line in text.split("\n"):
        pieces = plain_pieces(line)
        now.append(pieces)
        digest = xxhash.xxh3_128_digest(b"".join(xxhash.xxh3_128_digest(p.encode()) for p in pieces))
        if not line or digest[15] % 4 == 0:
            sections.append(now)
            now = []
    return sections + ([now] if now else [])


def plain_likeness(a, b):
    """Share of common pieces: those of common sections, of common paragraphs in other sections, and then single ones."""

    def less(x, y):
        x, y = x.copy(), y.copy()
        for item in x.copy():
            if item in y:
                x.remove(item)
                y.remove(item)
        return x, y

    if a == b:
        return 1.0
    a, b = plain_tree(a), plain_tree(b)
    n = [sum(len(p) for s in t for p in s) for t in (a, b)]
    a, b = less(a, b)
    a, b = less([p for s in a for p in s], [p for s in b for p in s])
    a, b = [x for p in a for x in p], [x for p in b for x in p]
    return 2 * (n[0] - len(less(a, b)[0])) / sum(n)


def plain_text(rng):
    lines = [" ".join(rng.choices("a bc def same words again é".split(" "), k=rng.randint(0, 30))) for _ in range(rng.randint(1, 12))]
    return "\n".join(lines + rng.choices(lines, k=3))


def test_likeness_against_a_plain_tree():
    rng = random.Random(8)
    for _ in range(150):
        a = plain_text(rng)
        b = rng.choice([plain_text(rng), merkle.edited(a, plain_text(rng)), a])
        assert likeness(fingerprint(a), fingerprint(b)) == pytest.approx(plain_likeness(a, b))
        assert likeness(fingerprint(b), fingerprint(a)) == pytest.approx(plain_likeness(a, b))


def test_a_fingerprint_is_read_back():
    rng = random.Random(9)
    for text in ["", "a", "\n\n", *(plain_text(rng) for _ in range(20))]:
        assert merkle.read(fingerprint(text)) == merkle.tree(text)
        sections = plain_tree(text)
        assert [[len(below) // merkle.LEAF for _, below in ps] for _, ps in merkle.tree(text).sections] == [
            [len(p) for p in s] for s in sections
        ]


def test_only_differing_branches_are_entered():
    """Equal branches are told by their names: what stands below them in a fingerprint is not looked at."""
    a = "\n".join(LINES)
    b = a.replace(LINES[20], "another line")
    one, other = merkle.tree(a), merkle.tree(b)
    spoilt = [(s, [(p, below if p != one.sections[0][1][0][0] else "????" * (len(below) // 4)) for p, below in ps]) for s, ps in other.sections]
    assert merkle.compare(one, merkle.Tree(other.root, spoilt)) == merkle.compare(one, other)


def test_ranges():
    assert merkle.ranges_of([]) == "" and merkle.ranges_of([4]) == "4:5"
    assert merkle.ranges_of([0, 1, 2, 5, 7, 8]) == "0:3,5:6,7:9"


def test_repeated_lines_are_located():
    lines = ["same line"] * 9
    changed = [*lines[:4], "other", *lines[5:]]
    assert edited_paragraphs(fingerprint("\n".join(lines)), fingerprint("\n".join(changed))) == ([4], [4])


def test_edits_are_located():
    for at in (0, 7, 29):
        changed = LINES.copy()
        changed[at] = "entirely new words in here"
        a, b = fingerprint("\n".join(LINES)), fingerprint("\n".join(changed))
        assert edited_paragraphs(a, b) == ([at], [at])
        assert 0.9 < likeness(a, b) < 1
    assert edited_paragraphs(a, a) == ([], []) and likeness(a, a) == 1
    assert likeness(a, fingerprint("something else altogether")) == 0


def test_leaves_are_the_paragraph():
    rng = random.Random(1)
    for _ in range(200):
        p = "".join(rng.choice(["a", "bc", " ", "  ", "\t", "é", "same "]) for _ in range(rng.randint(0, 80))).encode()
        assert b" ".join(merkle.leaves(p)) == p
        assert max(len(x.split(b" ")) for x in merkle.leaves(p)) <= merkle.MOST_WORDS


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_neighbours(spark, partitions):
    rng = random.Random(4)
    rows = [(i, "\n".join(rng.sample(LINES, rng.randint(1, 6)))[: rng.randint(0, 900)], "c") for i in rng.sample(range(1000), 60)]
    rows += [(None, "no id", "c"), (5000, None, "c"), (5001, "", "c"), (5002, "x" * 50_000, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, h string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.doc_id: r for r in merkle.compared_with_next(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(order)
    for k, (i, text, _) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 4
        new = text[: len(text) - n] + following[:n]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.fingerprint == fingerprint(text) and r.edited_fingerprint == fingerprint(new)
        assert r.near_edited == pytest.approx(plain_likeness(text, new))
        assert r.near_next == pytest.approx(plain_likeness(text, following))
        lost = edited_paragraphs(r.fingerprint, r.edited_fingerprint)[0]
        assert r.edited_paragraphs == merkle.ranges_of(lost) and set(new.split("\n")) >= {
            p for n, p in enumerate(text.split("\n")) if n not in lost
        }


def test_repeated_rows_and_few_rows(spark):
    docs = spark.createDataFrame([(1, "same")] * 7, "doc_id bigint, text string")
    assert [r.near_next for r in merkle.compared_with_next(docs).collect()] == [1.0] * 7
    assert merkle.compared_with_next(docs.limit(1)).first().near_next == 1.0
    assert merkle.compared_with_next(docs.limit(0)).count() == 0
    assert [r.fingerprint for r in merkle.fingerprints(docs.limit(1)).collect()] == [fingerprint("same")]
