"""Repeated byte strings against a table of all windows, and maximal groups against all strings."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from keyedload.llm import queries, repeats


def plain(texts, least):
    """Spans and kept bytes of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + least] for d in data for i in range(len(d) - least + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 2, bool)
        for i in range(len(d) - least + 1):
            if seen[d[i : i + least]] > 1:
                gone[i + 1 : i + least + 1] = True
        edges = np.flatnonzero(np.diff(gone.astype(int))).reshape(-1, 2)
        out.append(([tuple(e) for e in edges.tolist()], bytes(b for b, g in zip(d, gone[1:]) if not g)))
    return out


def example(seed, length):
    rng = random.Random(seed)
    words = [f"{rng.randrange(1000):x}" for _ in range(300)] + ["é", "漢字", "the"]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passages = [text(length // 2), text(length), text(length * 2), "x" * (length * 4), "ab" * length]
    texts = [text(rng.randrange(length * 4)) for _ in range(60)]
    texts += [f"{text(20)} {rng.choice(passages)} {text(20)}" for _ in range(60)]
    for _ in range(40):  # near copies
        near = passages[2].split(" ")
        near[rng.randrange(len(near))] = rng.choice(words)
        texts.append(" ".join(near))
    texts += [texts[3]] * 5 + [passages[1] + passages[1], None, "", "short", "short"]
    return texts


def frame(spark, texts):
    rows = [(i if i % 7 else None, t, "c") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, spans string").repartition(6)


def results(rows):
    return sorted(([(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in rows)


@pytest.mark.parametrize("least, gram", [(200, 48), (20, 6)])
def test_removed_bytes_are_those_of_repeated_windows(spark, least, gram):
    texts = example(least, least // 2)
    got = repeats.without_repeats(frame(spark, texts), least=least, gram=gram).collect()
    assert results(got) == sorted(plain(texts, least))
    assert sorted(r.n_bytes for r in got) == sorted(len((t or "").encode()) for t in texts)
    assert sum(r.doc_id is None for r in got) == sum(i % 7 == 0 for i in range(len(texts)))


def test_anchors_with_many_contents_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(repeats, "MOST_CONTENTS", 3)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 2000)
    texts = example(5, 40)
    got = repeats.without_repeats(frame(spark, texts), least=60, gram=12).collect()
    assert results(got) == sorted(plain(texts, 60))


def test_long_texts_are_cut_by_their_own_bytes():
    rng = random.Random(1)
    long = bytes(rng.choice(b"abcdef ") for _ in range(3 * repeats.BYTES_AT_ONCE + 77))
    alone = repeats.Bytes.of(pa.array([long], pa.binary()))
    among = repeats.Bytes.of(pa.array([b"x" * 500, long, b"", b"y" * 300], pa.binary()))
    mine = [tuple(x) for b, n, m in alone.pieces(200, 48) for x in zip(b.tolist(), n.tolist(), m.tolist())]
    theirs = [tuple(x) for b, n, m in among.pieces(200, 48) for x in zip((b - 500).tolist(), n.tolist(), m.tolist())]
    assert [x for x in theirs if 0 <= x[0] < len(long)] == mine
    covered = [s + k for s, n, _ in mine for k in range(n)]
    assert covered == list(range(len(long) - 199))


@pytest.mark.parametrize("seed", range(6))
def test_groups_are_the_maximal_repeats(seed):
    rng = random.Random(seed)
    least = 3
    contents = [bytes(rng.choice(b"ab" if seed % 2 else b"abc") for _ in range(rng.randrange(least, 14))) for _ in range(8)]
    array = repeats.SuffixArray.of(contents, least)
    found, places = repeats.maximal_groups(array, least)
    everything = b"".join(contents)
    occurrences = defaultdict(set)
    for number, suffix in places:
        while number >= 0:
            occurrences[number].add(suffix)
            number = found[number][1]
    got = {everything[s : s + length]: occurrences[number] for number, (_, _, length, s) in enumerate(found)}

    at = defaultdict(set)
    for start, c in zip(array.starts.tolist(), contents):
        for i in range(len(c)):
            for j in range(i + least, len(c) + 1):
                at[c[i:j]].add(start + i)
    ends = {start + i: start + len(c) for start, c in zip(array.starts.tolist(), contents) for i in range(len(c))}
    expected = {}
    for w, where in at.items():
        after = {everything[p + len(w) : p + len(w) + 1] if p + len(w) < ends[p] else p for p in where}
        before = {p if p in array.starts else everything[p - 1] for p in where}
        if len(where) > 1 and len(after) > 1 and (len(before) > 1 or before <= set(array.starts.tolist())):
            expected[w] = where
    assert got == expected


def test_groups_hold_all_occurrences(spark):
    rng = random.Random(8)

    def text(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))

    shared = text(230)
    texts = [text(50) + shared + text(50) for _ in range(4)] + [text(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    nodes, places = repeats.groups(repeats.find(docs))
    length = {r.group: r.length for r in nodes.collect()}
    covered = defaultdict(set)
    for r in places.collect():
        found = texts[r.doc_id][r.start : r.start + length[r.group]]
        assert found in shared
        covered[r.doc_id] |= set(range(r.start, r.start + length[r.group]))
    assert {i: set(range(50, 280)) for i in range(4)} == covered


def test_empty_tables_and_query(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a" * 200), (2, None)], "doc_id bigint, text string")
    assert repeats.without_repeats(docs.limit(0)).count() == 0
    assert [r.spans for r in repeats.without_repeats(docs).collect()] == [[], []]
    texts = ["é" * 150 + "x", "é" * 150, None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.QUERIES["op11_repeats"](spark, str(tmp_path)).collect()}
    for i, (spans, kept) in enumerate(plain(texts, 200)):
        n = len((texts[i] or "").encode())
        assert tuple(got[i]) == (i, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("seed", range(4))
def test_suffixes_that_begin_as_no_other_are_left_out(monkeypatch, seed):
    monkeypatch.setattr(repeats, "SORTED_AT_ONCE", 3)
    rng = random.Random(seed)
    least = 9
    contents = [rng.randbytes(40) for _ in range(30)]
    contents += [bytes(rng.choice(b"\0\xff") for _ in range(rng.randrange(least, 40))) for _ in range(30)]
    contents += [contents[3][5:30] + bytes([k]) * rng.randrange(12) for k in range(5)]
    array = repeats.SuffixArray.of(contents, least)
    end = {int(start) + i: int(start) + len(c) for start, c in zip(array.starts, contents) for i in range(len(c))}
    whole = b"".join(contents)
    windows = Counter(whole[s : s + least] for s in end if end[s] - s >= least)
    assert sorted(array.suffixes.tolist()) == [s for s in end if end[s] - s >= least and windows[whole[s : s + least]] > 1]
    texts = [whole[s : end[s]] for s in array.suffixes.tolist()]
    for x, y, common in zip(texts, texts[1:], array.common.tolist()):
        assert common == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert common < least or x <= y
    assert sum(common < least for common in array.common) + 1 == sum(n > 1 for n in windows.values())


def test_pieces_do_not_depend_on_blocks(monkeypatch):
    texts = pa.array([(t or "").encode() for t in example(3, 40)], pa.binary())
    whole = [x for b, n, m in repeats.Bytes.of(texts).pieces(30, 8) for x in zip(b.tolist(), n.tolist(), m.tolist())]
    monkeypatch.setattr(repeats, "_BLOCK", 77)
    assert whole == [x for b, n, m in repeats.Bytes.of(texts).pieces(30, 8) for x in zip(b.tolist(), n.tolist(), m.tolist())]


def test_stretches_end_with_their_text():
    texts = repeats.Bytes.of(pa.array([b"", b"abcdef", b"", b"ghij", b"kl", b""], pa.binary()))
    spans = [(6, 10), (3, 6), (0, 2), (1, 2), (2, 3), (11, 12)]
    starts, ends = repeats._joined(*np.array(spans).T, texts.starts)
    got = repeats._without(texts, starts, ends)
    pairs = [[(s["start"], s["end"]) for s in x] for x in got["spans"].to_pylist()]
    assert pairs == [[], [(0, 6)], [], [(0, 4)], [(1, 2)], []]
    assert got["kept"].to_pylist() == [b"", b"", b"", b"", b"k", b""]
    none = np.zeros(0, np.int64)
    got = repeats._without(texts, *repeats._joined(none, none, texts.starts))
    assert got["spans"].to_pylist() == [[]] * 6 and got["kept"].to_pylist() == [b"", b"abcdef", b"", b"ghij", b"kl", b""]
