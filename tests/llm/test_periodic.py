"""Runs of words against the definition, on random, nested and junk texts."""

import hashlib
import random
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keyedload.llm import periodic, queries


def plain(words, least=24, periods=3):
    out, n = [], len(words)
    for q in range(1, n // periods + 1):
        s = q
        while s < n:
            if words[s] != words[s - q]:
                s += 1
                continue
            e = s
            while e < n and words[e] == words[e - q]:
                e += 1
            start, length = s - q, e - s + q
            if length >= max(least, periods * q):
                smaller = any(all(words[i] == words[i - d] for i in range(start + d, e)) for d in range(1, q))
                if not smaller:
                    out.append((start, length, q))
            s = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(text, **options):
    return periodic.runs_of([[str(w).encode() for w in text]], **options)[0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=14), st.integers(1, 12)), max_size=6))
def test_runs_of_repeated_pieces(parts):
    words = [w for piece, n in parts for w in piece * n]
    assert found(words) == plain(words)
    assert found(words, words=6) == plain(words, 6)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 3), st.integers(3, 4))
def test_runs_of_random_words(seed, letters, periods):
    rng = random.Random(seed)
    words = [rng.randrange(letters) for _ in range(rng.randrange(200))]
    for least in (2, 8, 24):
        assert found(words, words=least, periods=periods) == plain(words, least, periods)


def nested():
    a, b = ["a"] * 30, ["b"] * 30
    yield (a + b) * 4
    yield (a + ["x"]) * 5 + a
    yield (["a", "b"] * 20 + ["x"]) * 4 + ["a", "b"] * 7
    yield a * 10 + ["x"] + a * 10 + ["y"] + a
    yield [w for k in range(60) for w in ["a"] * (k + 1) + ["x"]]
    yield ([*"abcdefghijklmnopqrst"] * 3 + ["z"]) * 3 + [*"abcdefghij"] * 6
    yield [f"w{i % 7}" for i in range(100)] + [f"w{i % 14}" for i in range(100)]
    yield [*"aab"] * 30 + [*"ab"] * 30 + [*"aabab"] * 20


@pytest.mark.parametrize("words", list(nested()))
@pytest.mark.parametrize("many", [0, 16])
def test_runs_within_runs(words, many, monkeypatch):
    monkeypatch.setattr(periodic, "MANY", many)
    assert found(words) == plain(words)


def test_all_short_texts_of_two_words(monkeypatch):
    monkeypatch.setattr(periodic, "MANY", 0)
    texts = [list(t) for n in range(13) for t in product((b"a", b"b"), repeat=n)]
    assert periodic.runs_of(texts, 4) == [plain(t, 4) for t in texts]


def test_long_junk_in_bounded_time():
    words = ["a"] * 200_000
    assert found(words) == [(0, 200_000, 1)]
    zones = [w for k in range(300) for w in [*["a"] * 100, f"x{k}"]]
    assert found(zones) == [(101 * k, 100, 1) for k in range(300)]


def rows(spark, docs):
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id bigint, text string, runs int")
    return [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.runs(d.repartition(3)).collect()]


def test_rows_of_all_kinds(spark):
    junk = "é  b\tc\n" * 20
    docs = [(1, junk), (1, junk), (None, "x y " * 30 + "z"), (2, None), (3, ""), (4, " \n "), (5, "a " * 23), (6, "one word " * 24)]
    expected = []
    for i, t in docs:
        words = [w for w in (t or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        runs = plain(words)
        dropped = {p for s, n, q in runs for p in range(s + q, s + n)}
        expected.append((i, len(words), runs, " ".join(w for p, w in enumerate(words) if p not in dropped)))
    assert sorted(rows(spark, docs), key=repr) == sorted(expected, key=repr)
    assert periodic.runs(spark.createDataFrame([], "doc_id string, text string")).count() == 0


def test_query_columns(spark, tmp_path):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(200)))) for i in range(80)] + [(80, None), (81, "a b " * 50)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.asDict() for r in queries.QUERIES["op13_periodic"](spark, str(tmp_path)).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        words = (text or "").split()
        n, h = len(words), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        runs = plain(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        dropped = {k for s, m, q in runs for k in range(s + q, s + m)}
        assert got[i] == {
            "doc_id": i,
            "n_runs": len(runs),
            "start": best and best[0],
            "length": best and best[1],
            "period": best and best[2],
            "exponent_milli": best and 1000 * best[1] // best[2],
            "runs_sha256": hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in dropped).encode()).hexdigest(),
        }
    assert any(r["n_runs"] for i, r in got.items() if i < 80)
