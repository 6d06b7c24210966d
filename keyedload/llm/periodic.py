"""Runs: stretches of consecutive words that repeat with a period, found by an online sparse diagonal table.

A run of period q is a stretch in which words q apart are identical: a diagonal of lag q on which words match. Going over
the words, each word's earlier occurrences continue or begin the diagonals of their lags; only those are held, each with
the place where its matches began. A diagonal that ends long enough is a run and is emitted at once.

Two things keep the table sparse, and neither loses a run. Occurrences are those of a word with the few words that follow
it, of which any diagonal that counts has many in a row; so words whose neighbourhood never came before are passed over.
And while a diagonal of lag q is long enough already, only shorter lags begin: a run of a longer lag shares fewer than both
periods' words with it, so it shows again once that diagonal has ended, and its begin is then looked for backwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from keyedload.functions.names import col
from keyedload.llm.common import batch, map_batches, text_of

# Words that are sorted at once; a text with more is sorted by itself.
WORDS_AT_ONCE = 1 << 19
# From so many earlier occurrences on, the lags that cannot become a run are left out by comparing hashes.
MANY = 16

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def least_matches(words: int, periods: int) -> int:
    """Fewest matches on a diagonal whose run has so many words and periods."""
    return min(max(words - q, (periods - 1) * q) for q in range(1, words + 1))


def grams_of(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of each word with those that follow it, ``size`` in all."""
    out, have = None, 0
    power, width = ids.astype(np.uint64) * _BASE + np.uint64(1), 1
    while size:
        if size & 1:
            out = power[:] if out is None else out[: len(power) - have] * _pow(width) + power[have:]
            have += width
        size >>= 1
        if size:
            power = power[:-width] * _pow(width) + power[width:]
            width *= 2
    return out[: max(0, len(ids) - have + 1)]


def _pow(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


class _Hashes:
    """Hashes of stretches of words; equal stretches have equal ones."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.powers = np.ones(n + 1, np.uint64)
        self.powers[1:] = np.multiply.accumulate(np.full(n, _BASE))
        # The sum of words times descending powers, from ascending ones.
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        downs = np.ones(n + 1, np.uint64)
        downs[1:] = np.multiply.accumulate(np.full(n, inverse))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((ids.astype(np.uint64) + np.uint64(1)) * downs[1:], dtype=np.uint64)])

    def of(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.powers[start]


def _back(ids: np.ndarray, at: int, lag: int) -> int:
    """Where the matches on a diagonal begin that hold up to ``at``."""
    step = 16
    while at > lag:
        low = max(lag, at - step)
        differ = np.flatnonzero(ids[low:at] != ids[low - lag : at - lag])
        if len(differ):
            return low + int(differ[-1]) + 1
        at, step = low, step * 2
    return at


def _primes(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return [*out, n] if n > 1 else out


def runs_in(
    ids: np.ndarray, stretches: list[tuple[int, int]], order: np.ndarray, place: list[int], first: list[int], size: int, words: int, periods: int
) -> list[tuple[int, int, int]]:
    """``start, length, period`` of the runs of one text. Its words are ``ids``; ``stretches`` are of places whose gram came before;
    the occurrences before place ``i`` are ``order[first[i] : place[i]]``, ascending."""
    n, out, hashes = len(ids), [], None
    most = n // periods
    word = ids.tolist()

    def ended(lag: int, start: int, end: int) -> None:
        length = end - start + lag
        if length >= words and length >= periods * lag:
            text = ids[start - lag : end]
            if not any(np.array_equal(text[lag // p :], text[: -(lag // p)]) for p in _primes(lag)):
                out.append((start - lag, length, lag))

    for begin, end in stretches:
        active: dict[int, int] = {}
        for i in range(begin, end):
            last = i + size - 1
            held = most + 1
            for lag in [g for g in active if word[last] != word[last - g]]:
                ended(lag, active.pop(lag), last)
            for lag, start in active.items():
                if lag < held and i + size - start >= max(words - lag, (periods - 1) * lag):
                    held = lag
            low, high = first[i], place[i]
            if high - low > MANY:
                low += int(np.searchsorted(order[low:high], i - held, "right"))
            earlier = order[low:high]
            if high - low > MANY:
                hashes = hashes or _Hashes(ids)
                lags = i - earlier
                behind, ahead = i >= 2 * lags, i + lags <= n
                mine = hashes.of(earlier, lags)
                behind[behind] = hashes.of((i - 2 * lags)[behind], lags[behind]) == mine[behind]
                ahead[ahead] = hashes.of(np.full(ahead.sum(), i), lags[ahead]) == mine[ahead]
                earlier = earlier[behind | ahead]
            for j in earlier.tolist():
                lag = i - j
                if lag < held and lag not in active and word[i : i + size] == word[j : j + size]:
                    active[lag] = _back(ids, i, lag)
        for lag, start in active.items():
            ended(lag, start, end + size - 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of(texts: list[list[bytes]], words: int = 24, periods: int = 3) -> list[list[tuple[int, int, int]]]:
    """The runs of each text of a batch, by start and then period."""
    matches = least_matches(words, periods)
    size = max(1, matches // 2)
    known: dict[bytes, int] = {}
    number = known.setdefault
    ids = [np.array([number(w, len(known)) for w in text], np.int64) for text in texts]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    long = [k for k, x in enumerate(ids) if len(x) >= words]
    while long:
        some, n = [], 0
        while long and (not some or n + len(ids[long[-1]]) <= WORDS_AT_ONCE):
            some.append(long.pop())
            n += len(ids[some[-1]])
        grams = [grams_of(ids[k], size) for k in some]
        starts = np.cumsum([0, *map(len, grams)])
        text = np.repeat(np.arange(len(some)), np.diff(starts))
        grams = np.concatenate(grams)
        order = np.argsort(grams, kind="stable")
        # By text, and within it by gram; places of a gram stay in order.
        order = order[np.argsort(text[order], kind="stable")]
        changes = np.flatnonzero((np.diff(grams[order]) != 0) | (np.diff(text[order]) != 0)) + 1
        firsts = np.concatenate([[0], changes])
        first = np.empty(len(order), np.int64)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        first[order] = np.repeat(firsts, np.diff(firsts, append=len(order)))
        again = (place > first).astype(np.int8)
        # Stretches do not go over the end of a text, whose first gram never came before.
        edges = np.flatnonzero(np.diff(again, prepend=0, append=0)).reshape(-1, 2)
        edges = edges[edges[:, 1] - edges[:, 0] >= matches - size + 1]
        for t in np.unique(text[edges[:, 0]]).tolist():
            low, high = int(starts[t]), int(starts[t + 1])
            mine = edges[(edges[:, 0] >= low) & (edges[:, 0] < high)] - low
            own = order[low:high] - low
            out[some[t]] = runs_in(
                ids[some[t]], [tuple(x) for x in mine.tolist()], own, (place[low:high] - low).tolist(), (first[low:high] - low).tolist(), size, words, periods
            )
    return out


def without_repeats(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not found:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 24, periods: int = 3) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row.

    Words stand between ASCII white space and are numbered from 0. ``runs`` are ``start, length, period``, by start and then
    period: the stretches of at least ``words`` words and ``periods`` times their smallest period that no neighbouring word
    extends. ``collapsed`` are the words that no run holds behind its first period, joined by one space.

    A null or empty text has no words. Texts of any length are read whole; a text is one task's. Repeated rows and null ids
    are kept, no rows give no rows, and other columns are not read.
    """
    if periods < 3 or words < 2:
        raise ValueError("a run has at least two words and three periods")
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.encode("utf-8", "surrogatepass").split() for t in b.column(1).to_pylist()]
            found = runs_of(texts, words, periods)
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in x] for x in found]
            collapsed = [b" ".join(without_repeats(t, x)) for t, x in zip(texts, found)]
            yield batch(
                {
                    "id": b.column(0),
                    "n_words": pa.array([len(t) for t in texts], pa.int64()),
                    "runs": pa.array(rows, _RUNS),
                    "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string()),
                }
            )

    schema = f"id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    rows = docs.select(col(doc_id).alias("id"), text_of(text).alias("t"))
    return map_batches(rows, work, schema).withColumnRenamed("id", doc_id)
