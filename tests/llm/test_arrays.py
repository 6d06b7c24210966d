"""Counts of one byte with their list, and searches in stretches."""

import numpy as np
import pytest

from keyedload.llm import kneser_ney
from keyedload.llm.arrays import RUN, ascending, by_pair, count_triples, counts_at, save, save_counts, within


def test_counts_of_any_size_come_back(tmp_path):
    counts = np.array([1, 254, 255, 256, 3, 2**33, 2**62, 0, 255])
    save_counts(f"{tmp_path}/c", counts)
    places = np.array([8, 0, 5, 2, 6, 1, 7, 3, 3, 4])
    assert (counts_at(f"{tmp_path}/c", places) == counts[places]).all()
    save_counts(f"{tmp_path}/none", counts[:0])
    assert len(counts_at(f"{tmp_path}/none", places[:0])) == 0


def test_search_in_stretches():
    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 30, 200)
    ends = np.cumsum(sizes)
    values = np.concatenate([np.unique(rng.integers(0, 60, 500))[:n] if n else np.zeros(0, int) for n in sizes]).astype(np.uint32)
    which = rng.integers(0, 200, 3000)
    asked = rng.integers(0, 61, 3000).astype(np.uint32)
    low, high = (ends - sizes)[which], ends[which]
    got = within(values, low, high, asked)
    for g, a, b, x in zip(got, low, high, asked):
        expected = [i for i in range(a, b) if values[i] == x]
        assert ([g] if g >= 0 else []) == expected


class Counted(np.ndarray):
    """Counts the numbers that are read by their places."""

    read = 0

    def __getitem__(self, key):
        if isinstance(key, np.ndarray):
            Counted.read += len(key)
        return np.asarray(self)[key]


def test_many_numbers_of_one_stretch_are_not_each_searched_in_rounds():
    values = np.arange(0, 200_000, 2, dtype=np.uint32)
    asked = np.arange(50_000, 60_000, dtype=np.uint32)
    low, high = np.zeros(len(asked), np.int64), np.full(len(asked), len(values))
    Counted.read = 0
    got = within(values.view(Counted), low, high, asked)
    assert (got == np.where(asked % 2 == 0, asked.astype(np.int64) // 2, -1)).all()
    assert Counted.read <= 2 * len(asked)


def test_search_of_runs_and_single_numbers():
    """Stretches that many, some and no numbers are asked of, empty ones among them; numbers in any order."""
    rng = np.random.default_rng(3)
    sizes = np.array([0, 500, 1, 40, 0, 300, 7])
    ends = np.cumsum(sizes)
    values = np.concatenate([np.sort(rng.choice(1000, n, replace=False)) for n in sizes]).astype(np.uint32)
    which = np.repeat([0, 1, 2, 1, 3, 4, 5, 6], [RUN, 3 * RUN, RUN - 1, 2, RUN, 1, 5 * RUN, 3])
    asked = rng.integers(0, 1000, len(which)).astype(np.uint32)
    low, high = (ends - sizes)[which], ends[which]
    for g, a, b, x in zip(within(values, low, high, asked), low, high, asked):
        expected = [i for i in range(a, b) if values[i] == x]
        assert ([g] if g >= 0 else []) == expected


@pytest.mark.parametrize("most", [2, 2**20, 2**64 - 1])
def test_hashes_ascend_also_where_their_top_bits_are_equal(most):
    values = np.random.default_rng(4).integers(0, most, 3000, np.uint64, endpoint=True)
    values = np.concatenate([values, values[:500], values[:100] ^ np.uint64(1)])
    out, by = ascending(values)
    assert (out == np.sort(values)).all() and (values[by] == out).all() and (np.sort(by) == np.arange(len(values))).all()
    out, by = ascending(values[:0])
    assert len(out) == len(by) == 0


@pytest.mark.parametrize("size", [1, 50, 2**20, 2**29, 2**31, 2**40])
def test_pairs_and_triples_of_numbers_of_any_size(size):
    """With room for all bits in one number, and without."""
    rng = np.random.default_rng(5)
    some = rng.integers(0, size, 40)
    a, b, c = (rng.choice(some, 2000) for _ in range(3))
    by = by_pair(a, b, size, size)
    assert [*zip(a[by], b[by])] == sorted(zip(a, b)) and (np.sort(by) == np.arange(len(a))).all()
    distinct, n = np.unique(np.stack([a, b, c]), axis=1, return_counts=True)
    *found, counts = count_triples(a, b, c, size)
    assert (np.stack(found) == distinct).all() and (counts == n).all()
    assert all(len(x) == 0 for x in count_triples(a[:0], b[:0], c[:0], size))


@pytest.mark.parametrize("n", [1, 63, 64, 65, 500])
def test_stretches_of_contexts(tmp_path, n):
    """Contexts with few and with very many words, in blocks."""
    rng = np.random.default_rng(n)
    sizes = np.where(rng.random(n) < 0.1, rng.integers(250, 700, n), rng.integers(1, 9, n))
    starts = np.cumsum(sizes) - sizes
    block = kneser_ney.BLOCK_CONTEXTS
    padded = np.zeros(-(-n // block) * block, np.uint8)
    padded[:n] = np.minimum(sizes, 255)
    long = np.flatnonzero(sizes >= 255)
    save(f"{tmp_path}/0.sizes", padded)
    save(f"{tmp_path}/0.blocks", starts[::block].astype(np.uint32))
    save(f"{tmp_path}/0.long", long.astype(np.int64))
    save(f"{tmp_path}/0.long_sums", np.concatenate([np.zeros((4, len(long))), sizes[None, long]]).astype(np.int64))
    places = np.unique(rng.integers(0, n, 300))
    low, high = kneser_ney._stretches(f"{tmp_path}/0", places)
    assert (low == starts[places]).all() and (high == (starts + sizes)[places]).all()


def test_contexts_are_found_by_shifting():
    texts = ["a b c a", "", "b", "a b"]
    for at_once in (2_000_000, 2):
        for grams in kneser_ney.grams(texts, 3, at_once):
            values, places = kneser_ney._indexed(grams[:3])
            for x, at in zip(grams, places):
                assert (values[at] == x).all()
