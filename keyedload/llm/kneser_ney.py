"""An interpolated modified Kneser-Ney model of order two or three: counted in Spark, kept in sorted arrays, mapped by the workers.

Words become numbers by their place among the sorted hashes of all training words; a bigram is one 64-bit number, context
above word. Tasks count the bigrams of their texts and send them, sorted and compressed, to shards by context; contexts
frequent enough to fill a shard are spread over all shards. A shard's task writes its bigrams and counts as sorted arrays
and sends on what the lower order needs: how many words follow each context once, twice or more often, and after how many
contexts each word comes. Scoring reads texts where they are: a worker maps the arrays and looks up each batch's
distinct bigrams in their order. No array is held by the driver, none is cut off, and all grow with the corpus:
about 5 bytes for each distinct bigram and 22 for each word. Counts have one byte, and a list of those that need more.

Order three counts trigrams first, in shards by their two context words; contexts of two frequent words are spread over all
shards, and their sums kept apart. The words after a context stand together, so its sums follow from their counts; those of
contexts with many are kept. A shard sends on, in place of the bigrams of the texts, after how many words each bigram comes
(how often, for one that begins a text). That takes about 5 bytes more for each distinct trigram and 9 for each distinct pair
of context words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedload.functions.names import col
from keyedload.llm.arrays import (
    SMALL,
    ascending,
    by_pair,
    count_triples,
    counts_at,
    firsts_of,
    mapped,
    save,
    save_counts,
    squeeze,
    unsqueeze,
    within,
)
from keyedload.llm.common import batch, map_batches, shared_dir, staged, text_of

# Tokens that a task counts at once, and the bytes of a text that are split into words at once.
TOKENS_AT_ONCE = 2_000_000
BYTES_AT_ONCE = 1 << 20
# Bigram tokens in a shard, bytes of text for a file of word hashes, numbers in a file of statistics: these bound a task's memory.
SHARD_TOKENS = 4_000_000
FILE_BYTES = 1 << 24
BLOCK_WORDS = 1 << 20
# Texts that are scored together, and their bytes from which on there are fewer.
SCORED_ROWS = 2048
SCORED_BYTES = 1 << 24
# Contexts whose places are found from one of their begins. A context's words are counted in one byte; where these are too many,
# their number and the context's sums are kept.
BLOCK_CONTEXTS = 64

#: No word has white space, so these stand for the ends of a text, and for what is before its begin.
BEGIN, END, BEFORE = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b"\t", b"\n", b"\r"))


def word_lists(text: str) -> Iterator[list[bytes]]:
    """Words of a text, A-Z lower-cased, between ASCII white space; some at a time, of which none is cut."""
    data, at = text.encode("utf-8", "surrogatepass").lower(), 0
    while at < len(data):
        end = at + BYTES_AT_ONCE
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[at:end].split()
        at = end


def hashes(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)


def grams(texts: Iterable[str], order: int, at_once: int = TOKENS_AT_ONCE) -> Iterator[tuple[np.ndarray, ...]]:
    """Context words, the farthest first, tokens and numbers of the texts they are in, a bounded number at a time. The end of a
    text is a token."""
    held, n = [], 0
    end = np.array([END])
    for number, text in enumerate(texts):
        before = np.array([BEFORE] * (order - 2) + [BEGIN])
        for found in chain(map(hashes, word_lists(text)), [end]):
            if not len(found):
                continue
            line = np.concatenate([before, found])
            held.append((*(line[i : i + len(found)] for i in range(order)), np.full(len(found), number)))
            before, n = line[len(found) :], n + len(found)
            if n >= at_once:
                yield tuple(map(np.concatenate, zip(*held)))
                held, n = [], 0
    if n:
        yield tuple(map(np.concatenate, zip(*held)))


def pairs(texts: Iterable[str], at_once: int = TOKENS_AT_ONCE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Contexts, tokens and numbers of the texts they are in."""
    return grams(texts, 2, at_once)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[str]:
    """The texts of all batches of a task, one after another."""
    return chain.from_iterable(b.column(0).to_pylist() for b in batches)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together up to a number of rows or bytes."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if held and (sum(x.num_rows for x in held) + b.num_rows > SCORED_ROWS or sum(x.nbytes for x in held) + b.nbytes > SCORED_BYTES):
            yield pa.concat_batches(held)
            held = []
        held.append(b)
    if held:
        yield pa.concat_batches(held)


def _indexed(grams: tuple[np.ndarray, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct hashes of some tokens and their contexts, ascending, and where each is among them, the farthest context first.

    A context is the token before, but at the begin of a text and of what is looked at together.
    """
    *before, tokens = grams
    found, by = ascending(tokens)
    firsts = firsts_of(found)
    values = found[firsts]
    every = np.sort(np.concatenate([values, np.array([BEGIN, BEFORE]), *(x[:1] for x in before)]))
    every = every[firsts_of(every)]
    place = np.empty(len(tokens), np.int64)
    place[by] = np.repeat(np.searchsorted(every, values), np.diff(firsts, append=len(tokens)))
    out = [place]
    begins = before[-1] == BEGIN
    for i, x in enumerate(reversed(before)):
        shifted = np.empty_like(out[0])
        shifted[1:] = out[0][:-1]
        shifted[:1] = np.searchsorted(every, x[:1])
        shifted[begins] = np.searchsorted(every, BEFORE if i else BEGIN)
        out.insert(0, shifted)
    return every, out


def _mix(values: np.ndarray, among: int) -> np.ndarray:
    return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(among)


@dataclass(frozen=True)
class Words:
    """Where the sorted word hashes and their counts are; file ``i`` has the hashes whose top bits are ``i``."""

    root: str
    bits: int
    first: np.ndarray  # number of the first word of each file
    total: int  # training tokens
    distinct: int
    texts: int  # training texts

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: none) and counts of ascending distinct hashes."""
        numbers, counts = np.full(len(values), -1, np.int64), np.zeros(len(values), np.int64)
        files = (values >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(values), np.int64)
        for i, start, end in _runs(files):
            known = mapped(f"{self.root}/words/{i}.hashes", np.uint64)
            at = np.searchsorted(known, values[start:end])
            inside = at < len(known)
            same = np.zeros(len(at), bool)
            same[inside] = known[at[inside]] == values[start:end][inside]
            numbers[start:end][same] = self.first[i] + at[same]
            counts[start:end][same] = counts_at(f"{self.root}/words/{i}.counts", at[same])
        return numbers, counts

    def numbered(self, values: np.ndarray) -> np.ndarray:
        """Numbers of hashes in any order; the begin of a text and what is before it come behind all words."""
        distinct, back = np.unique(values, return_inverse=True)
        numbers, _ = self.find(distinct)
        numbers[distinct == BEGIN], numbers[distinct == BEFORE] = self.distinct, self.distinct + 1
        return numbers[back]


def _runs(ascending: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each value of an ascending array, with where it begins and ends."""
    if len(ascending):
        cuts = np.flatnonzero(np.diff(ascending)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(ascending)]):
            yield int(ascending[start]), int(start), int(end)


def count_words(texts: DataFrame, root: str) -> Words:
    """Counts the tokens of ``texts`` (column ``t``) and writes them as sorted arrays.

    Tasks send their words' hashes, sorted and compressed, to the file they belong to.
    """
    size = texts.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    bits = max(0, -(-size // FILE_BYTES) - 1).bit_length()

    def added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        values, n = (np.concatenate(x) for x in zip(*held))
        values, by = ascending(values)
        firsts = firsts_of(values)
        return values[firsts], np.add.reduceat(n[by], firsts)

    def files_of(values: np.ndarray) -> np.ndarray:
        return (values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)

    def sent(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        values, n = added(held)
        out = [(f, squeeze(values[i:j], True), squeeze(n[i:j].astype(np.uint64))) for f, i, j in _runs(files_of(values))]
        return batch(dict(zip(("file", "k", "c"), map(list, zip(*out)))), {"file": pa.int32(), "k": pa.binary(), "c": pa.binary()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for _, tokens, _ in pairs(_texts(batches)):
            held.append(np.unique(tokens, return_counts=True))
            if sum(len(v) for v, _ in held) > TOKENS_AT_ONCE:
                yield sent(held)
                held = []
        if held:
            yield sent(held)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, held = None, []
        for b in batches:
            for file, k, c in zip(*(b.column(i).to_pylist() for i in range(3))):
                held.append((unsqueeze(k, np.uint64, True), unsqueeze(c, np.uint64).astype(np.int64)))
        if held:
            h, n = added(held)
            save(f"{root}/words/{file}.hashes", h)
            save_counts(f"{root}/words/{file}.counts", n)
            # Every text has one end, and nothing else is an end.
            found = {"file": file, "v": len(h), "n": n.sum(), "t": n[h == END].sum()}
            yield batch({k: [int(v)] for k, v in found.items()}, {"file": pa.int32(), "v": pa.int64(), "n": pa.int64(), "t": pa.int64()})

    counts = map_batches(texts, work, "file int, k binary, c binary", 1 << 16).repartitionById(1 << bits, F.col("file"))
    sizes, total, ends = np.zeros(1 << bits, np.int64), 0, 0
    for r in counts.mapInArrow(write, "file int, v bigint, n bigint, t bigint").collect():  # one row per file
        sizes[r.file], total, ends = r.v, total + r.n, ends + r.t
    for empty in np.flatnonzero(sizes == 0):
        save(f"{root}/words/{empty}.hashes", np.zeros(0, np.uint64))
        save_counts(f"{root}/words/{empty}.counts", np.zeros(0, np.int64))
    words = Words(root, bits, np.cumsum(sizes) - sizes, total, int(sizes.sum()), ends)
    if words.distinct >= 2**32 - 1:
        raise ValueError("bigrams are numbered for fewer than 2**32 words")
    return words


def frequent(spark: SparkSession, words: Words, most: int) -> np.ndarray:
    """Hashes of the words with more tokens than ``most``; each file is looked through by a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column(0).to_pylist():
                few = mapped(f"{words.root}/words/{i}.counts", np.uint8)
                at = np.flatnonzero(few >= min(most + 1, SMALL))
                at = at[counts_at(f"{words.root}/words/{i}.counts", at) > most]
                yield batch({"h": pa.array(mapped(f"{words.root}/words/{i}.hashes", np.uint64)[at].view(np.int64))})

    files = spark.range(1 << words.bits)
    # Fewer than there are shards, since together they have no more tokens than there are.
    return np.array([r.h for r in map_batches(files, work, "h bigint").collect()], np.int64).view(np.uint64)


@dataclass(frozen=True)
class Discounts:
    """What is taken off counts of one, two, and three or more."""

    off: tuple[float, float, float]

    @staticmethod
    def of(n1: int, n2: int, n3: int, n4: int) -> Discounts:
        """The modified Kneser-Ney estimates; halves of the counts where a class of counts is empty."""
        if not (n1 and n2 and n3 and n4):
            return Discounts((0.5, 1.0, 1.5))
        y = n1 / (n1 + 2 * n2)
        raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        return Discounts(tuple(float(np.clip(d, 0.05 * k, 0.95 * k)) for k, d in enumerate(raw, 1)))

    def from_(self, counts: np.ndarray) -> np.ndarray:
        return np.array([0.0, *self.off])[np.minimum(counts, 3)]


@dataclass(frozen=True)
class Model:
    words: Words
    shards: int
    hot: np.ndarray  # hashes of contexts that are spread over all shards
    upper: Discounts
    lower: Discounts
    types: int  # distinct bigrams
    lower_left: float  # what the lower discounts leave to all words alike
    order: int = 2
    top: Discounts | None = None  # of trigrams
    hot_numbers: np.ndarray | None = None  # of the words in ``hot``

    def lookup(self, *grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each token after its context words, the farthest first, and the token's training count."""
        w = self.words
        values, (*far, c, t) = _indexed(grams)
        numbers, counts = w.find(values)
        numbers[values == BEFORE] = w.distinct + 1
        begin = values == BEGIN
        numbers[begin], counts[begin] = w.distinct, w.texts
        stats = _stats(w, np.where(numbers > w.distinct, -1, numbers), self.order)  # follow once, twice, more; of order three, together; comes after
        uniform = 1.0 / (w.distinct + 1)
        after = stats[-1]
        lower = np.full(len(values), uniform)
        if self.types:
            lower = np.maximum(after - self.lower.from_(after), 0) / self.types + self.lower_left * uniform
        of = counts if self.order == 2 else stats[3]
        seen = np.maximum(of, 1)
        left = np.where(of > 0, (self.upper.off @ stats[:3].astype(np.float64)) / seen, 1.0)
        # Each distinct bigram once, and where its tokens are.
        by = by_pair(c, t, len(values), len(values))
        heads, words = c[by], t[by]
        firsts = firsts_of(heads, words)
        heads, words = heads[firsts], words[firsts]
        found = np.zeros(len(firsts), np.int64)
        both = np.flatnonzero((numbers[heads] >= 0) & (numbers[words] >= 0))
        if len(both):
            contexts = numbers[heads[both]]
            keys = _keys(contexts, numbers[words[both]])
            found[both] = self._counts(keys, _shard(contexts, keys, contexts, self.hot_numbers, self.shards))
        distinct = np.maximum(found - self.upper.from_(found), 0) / seen[heads] + left[heads] * lower[words]
        p = np.empty(len(c))
        p[by] = np.repeat(distinct, np.diff(firsts, append=len(c)))
        if self.order == 3:
            p = self._third(far[0], c, t, numbers, p)
        return np.log10(p), counts[t]

    def _third(self, u: np.ndarray, v: np.ndarray, t: np.ndarray, numbers: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probabilities of words after two others, all by their places in ``numbers``; ``lower`` where the two were never seen or a
        text begins."""
        known = numbers >= 0
        asked = np.flatnonzero((known & (numbers <= self.words.distinct))[u] & known[v])
        asked = asked[by_pair(u[asked], v[asked], len(numbers), len(numbers))]
        u, v, words = u[asked], v[asked], numbers[t[asked]]
        keys = _keys(numbers[u], numbers[v])
        frequent = np.isin(numbers, self.hot_numbers)
        hot = frequent[u] & frequent[v]
        found, total, left = np.zeros(len(asked), np.int64), np.ones(len(asked)), np.ones(len(asked))
        root = f"{self.words.root}/trigrams"
        for s, at, back, place in _found(f"{root}/%d.contexts", keys, _shard3(keys, words, hot, self.shards)):
            low, high = _stretches(f"{root}/{s}", place)
            sums = _sums_of(f"{root}/{s}", place, low, high)
            total[at], left[at] = sums[3][back], ((self.top.off @ sums[:3].astype(np.float64)) / sums[3])[back]
            word = words[at] >= 0
            at, low, high = at[word], low[back[word]], high[back[word]]
            i = within(mapped(f"{root}/{s}.words", np.uint32), low, high, words[at].astype(np.uint32))
            found[at[i >= 0]] = counts_at(f"{root}/{s}.counts", i[i >= 0])
        spread = np.flatnonzero(hot)
        total[spread], left[spread] = 1, 1
        for s, at, back, place in _found(f"{root}/%d.spread", keys[spread], _mix(keys[spread], self.shards).astype(np.int64)):
            sums = mapped(f"{root}/{s}.spread_sums", np.uint64).reshape(4, -1)[:, place].astype(np.int64)
            at = spread[at]
            total[at], left[at] = sums[3][back], ((self.top.off @ sums[:3].astype(np.float64)) / sums[3])[back]
        out = lower.copy()
        out[asked] = np.maximum(found - self.top.from_(found), 0) / total + left * lower[asked]
        return out

    def _counts(self, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Counts of distinct bigrams; those of a context stand together."""
        out = np.zeros(len(keys), np.int64)
        order = _by_shard(shard)
        for s, start, end in _runs(shard[order]):
            at = order[start:end]
            asked = keys[at]
            files = f"{self.words.root}/bigrams/{s}"
            heads, starts = mapped(f"{files}.heads", np.uint32), mapped(f"{files}.starts", np.uint32)
            if len(heads):
                contexts = (asked >> np.uint64(32)).astype(np.uint32)
                firsts = firsts_of(contexts)
                each = np.diff(firsts, append=len(contexts))
                place = np.minimum(np.searchsorted(heads, contexts[firsts]), len(heads) - 1)
                known = heads[place] == contexts[firsts]
                low, high = (np.repeat(starts[x[known]].astype(np.int64), each[known]) for x in (place, place + 1))
                known = np.repeat(known, each)
                at, words = at[known], (asked[known] & np.uint64(2**32 - 1)).astype(np.uint32)
                i = within(mapped(f"{files}.words", np.uint32), low, high, words)
                out[at[i >= 0]] = counts_at(f"{files}.counts", i[i >= 0])
        return out


def _keys(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (contexts.astype(np.uint64) << np.uint64(32)) | words.astype(np.uint64)


def _shard(hashed: np.ndarray, keys: np.ndarray, contexts: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """By context; a hot context's bigrams by themselves."""
    out, spread = _mix(contexts.astype(np.uint64), shards), np.flatnonzero(np.isin(hashed, hot))
    out[spread] = _mix(keys[spread], shards)
    return out.astype(np.int64)


def _shard3(keys: np.ndarray, words: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """By both context words; a hot context's trigrams by themselves."""
    out, spread = _mix(keys, shards), np.flatnonzero(hot)
    out[spread] = _mix(keys[spread] ^ (words[spread].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), shards)
    return out.astype(np.int64)


def _by_shard(shard: np.ndarray) -> np.ndarray:
    """The order by shard, and within it as they come."""
    few = shard.astype(np.uint16) if len(shard) and shard.max() < 1 << 16 else shard
    return np.argsort(few, kind="stable")


def _found(files: str, keys: np.ndarray, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """By shard: which keys the file of the shard has, to which of the distinct ones each belongs, and where in it those are.

    Equal keys stand together.
    """
    order = _by_shard(shard)
    for s, start, end in _runs(shard[order]):
        known, at = mapped(files % s, np.uint64), order[start:end]
        if len(known):
            asked = keys[at]
            firsts = firsts_of(asked)
            place = np.minimum(np.searchsorted(known, asked[firsts]), len(known) - 1)
            same = known[place] == asked[firsts]
            each = np.diff(firsts, append=len(asked))
            yield s, at[np.repeat(same, each)], np.repeat(np.arange(same.sum()), each[same]), place[same]


def _stretches(files: str, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words after the contexts at ``places`` of a shard, ascending, begin and end."""
    sizes = mapped(f"{files}.sizes", np.uint8).reshape(-1, BLOCK_CONTEXTS)
    blocks, long = mapped(f"{files}.blocks", np.uint32), mapped(f"{files}.long", np.int64)
    more = np.concatenate([[0], np.cumsum(mapped(f"{files}.long_sums", np.int64).reshape(5, -1)[4] - SMALL)])
    block, inside = np.divmod(places, BLOCK_CONTEXTS)
    low = blocks[block].astype(np.int64) + more[np.searchsorted(long, places)] - more[np.searchsorted(long, block * BLOCK_CONTEXTS)]
    # Eight sizes at once: those before each context in its block, added by pairs in 16 bits.
    eights, halves = sizes.view(np.uint64), np.uint64(0x00FF00FF00FF00FF)
    before = (np.tri(BLOCK_CONTEXTS, k=-1, dtype=np.uint8) * np.uint8(255)).view(np.uint64)
    for i in range(0, len(places), 1 << 12):
        part = slice(i, i + (1 << 12))
        some = eights[block[part]] & before[inside[part]]
        both = ((some & halves) + ((some >> np.uint64(8)) & halves)).sum(axis=1)
        low[part] += ((both * np.uint64(0x0001000100010001)) >> np.uint64(48)).astype(np.int64)
    size = sizes[block, inside].astype(np.int64)
    full = np.flatnonzero(size == SMALL)
    at = np.searchsorted(long, places[full])
    size[full] += more[at + 1] - more[at]
    return low, low + size


def _sums_of(files: str, places: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Of the contexts at ``places`` of a shard, how many words follow once, twice, more often; and the sum of their counts."""
    out = np.zeros((4, len(places)), np.int64)
    long = high - low >= SMALL
    if long.any():
        at = np.searchsorted(mapped(f"{files}.long", np.int64), places[long])
        out[:, long] = mapped(f"{files}.long_sums", np.int64).reshape(5, -1)[:4, at]
    sizes = (high - low)[~long]
    if len(sizes):
        begins = np.cumsum(sizes) - sizes
        counts = counts_at(f"{files}.counts", np.arange(sizes.sum()) + np.repeat(low[~long] - begins, sizes))
        out[:, ~long] = _sums(counts, begins)
    return out


def _save_stats(root: str, block: int, sums: np.ndarray) -> None:
    for i, row in enumerate(sums):
        save_counts(f"{root}/stats/{block}.{i}", row.astype(np.int64))


def _stats(w: Words, numbers: np.ndarray, order_: int) -> np.ndarray:
    """For numbers in any order (-1: zeros): how many words follow once, twice, more often; of order three, the sum of their
    counts; how many contexts it comes after."""
    out = np.zeros((order_ + 2, len(numbers)), np.int64)
    order = np.argsort(numbers, kind="stable")
    order = order[np.searchsorted(numbers[order], 0) :]
    for block, start, end in _runs(numbers[order] // BLOCK_WORDS):
        here = order[start:end]
        places = numbers[here] - block * BLOCK_WORDS
        for i in range(order_ + 2):
            out[i, here] = counts_at(f"{w.root}/stats/{block}.{i}", places)
    return out


def train(texts: DataFrame, text: str = "text", shard_tokens: int = SHARD_TOKENS, order: int = 2) -> Model:
    """A model of all rows of ``texts``; null texts are empty. Without rows every text has probability one.

    A text's begin is a context only, its end a token. ``order`` is two or three words.
    """
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    root = shared_dir(texts.sparkSession, "model")
    rows = texts.select(text_of(text).alias("t"))
    words = count_words(rows, root)
    shards = max(1, -(-words.total // shard_tokens))
    most = max(1, words.total // shards)
    hot = frequent(texts.sparkSession, words, most)
    if words.texts > most:
        hot = np.append(hot, BEGIN)

    hot_numbers = words.numbered(hot)
    if BEGIN in hot:
        hot_numbers = np.append(hot_numbers, words.distinct + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for contexts, tokens, _ in pairs(_texts(batches)):
            values, (c, t) = _indexed((contexts, tokens))
            numbers, _ = words.find(values)
            numbers[values == BEGIN] = words.distinct
            c = numbers[c]
            keys, first, n = np.unique(_keys(c, numbers[t]), return_index=True, return_counts=True)
            yield _sent(0, _shard(contexts[first], keys, c[first], hot, shards), keys, n.astype(np.uint64))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, keys, n, spread = None, [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], []
        for b in batches:
            for kind, shard, k, c in zip(*(b.column(i).to_pylist() for i in range(4))):
                k, c = unsqueeze(k, np.uint64, True), unsqueeze(c, np.uint64)
                if kind == 0:
                    keys.append(k)
                    n.append(c)
                elif kind == 1:
                    yield _stat_rows([-2], [np.array([shard])], [c.astype(np.uint32)])
                else:
                    spread.append((k, c.reshape(4, -1)))
        if spread:
            own, back = np.unique(np.concatenate([k for k, _ in spread]), return_inverse=True)
            sums = np.zeros((4, len(own)), np.uint64)
            np.add.at(sums, (slice(None), back), np.concatenate([c for _, c in spread], axis=1))
            save(f"{root}/trigrams/{shard}.spread", own)
            save(f"{root}/trigrams/{shard}.spread_sums", sums)
            yield _stat_rows([-3], [np.array([shard])], [np.zeros(0, np.uint32)])
        if len(keys) == 1:
            return
        keys, n = np.concatenate(keys), np.concatenate(n).astype(np.int64)
        by = np.argsort(keys, kind="stable")
        keys, n = keys[by], n[by]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, n = keys[starts], np.add.reduceat(n, starts)
        save_counts(f"{root}/bigrams/{shard}.counts", n)
        of = np.bincount(np.minimum(n, 5), minlength=6)
        yield _stat_rows([-1], [np.array([shard])], [np.append(of[1:5], len(keys)).astype(np.uint32)])
        contexts, starts = np.unique((keys >> np.uint64(32)).astype(np.int64), return_index=True)
        save(f"{root}/bigrams/{shard}.heads", contexts.astype(np.uint32))
        save(f"{root}/bigrams/{shard}.starts", np.append(starts, len(keys)).astype(np.uint32))
        save(f"{root}/bigrams/{shard}.words", (keys & np.uint64(2**32 - 1)).astype(np.uint32))
        follow = _sums(n, starts)[: order + 1]
        comes, after = np.unique((keys & np.uint64(2**32 - 1)).astype(np.int64), return_counts=True)
        for block, i, j in _runs(contexts // BLOCK_WORDS):
            # Sums of counts may pass 32 bits, so all go as halves.
            both = np.ascontiguousarray(follow[:, i:j].astype(np.uint64).reshape(-1)).view(np.uint32)
            yield _stat_rows([block], [contexts[i:j]], [both])
        for block, i, j in _runs(comes // BLOCK_WORDS):
            yield _stat_rows([block], [comes[i:j]], [after[i:j].astype(np.uint32)])

    if order == 3:
        counted = _third(rows, words, hot_numbers, shards)
    else:
        counted = map_batches(rows, count, _SENT, 1 << 16)
    counted = counted.repartitionById(shards, F.col("shard"))
    stats = staged(counted.mapInArrow(gather, "block int, i binary, v binary"), "statistics")
    # A few rows per shard.
    of, of_top, made = np.zeros(5, np.int64), np.zeros(4, np.int64), {-1: set(), -2: set(), -3: set()}
    for r in stats.where("block < 0").collect():
        made[r.block].add(int(unsqueeze(bytes(r.i), np.int64, True)[0]))
        if r.block == -1:
            of += unsqueeze(bytes(r.v), np.uint32)
        elif r.block == -2:
            of_top += unsqueeze(bytes(r.v), np.uint32)
    for shard in range(shards):
        empty = [] if shard in made[-1] else ["bigrams/{}.heads", "bigrams/{}.starts"]
        if order == 3:
            empty += [] if shard in made[-2] else ["trigrams/{}.contexts"]
            empty += [] if shard in made[-3] else ["trigrams/{}.spread"]
        for name in empty:
            save(f"{root}/{name.format(shard)}", np.zeros(0, np.uint64))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sums = None, None
        for b in batches:
            for block, i, v in zip(*(b.column(k).to_pylist() for k in range(3))):
                if sums is None:
                    size = min(BLOCK_WORDS, words.distinct + 1 - block * BLOCK_WORDS)
                    sums = np.zeros((order + 2, size), np.int64)
                at = unsqueeze(i, np.int64, True) - block * BLOCK_WORDS
                values = unsqueeze(v, np.uint32)
                if len(values) == len(at):
                    sums[-1, at] += values
                else:
                    sums[:-1, at] += values.view(np.uint64).reshape(-1, len(at)).astype(sums.dtype)
        if sums is not None:
            _save_stats(root, block, sums)
            after = sums[-1]
            m = np.bincount(np.minimum(after, 5), minlength=6)
            yield batch({"m": [[*m[1:5].tolist(), int((after >= 3).sum())]]}, {"m": pa.list_(pa.int64())})

    blocks = (words.distinct + BLOCK_WORDS) // BLOCK_WORDS
    placed = stats.where("block >= 0").repartitionById(blocks, F.col("block"))
    m = np.zeros(5, np.int64)
    for r in placed.mapInArrow(add, "m array<bigint>").collect():  # one row per block
        m += np.array(r.m)
    if not words.total:
        for block in range(blocks):
            _save_stats(root, block, np.zeros((order + 2, min(BLOCK_WORDS, words.distinct + 1 - block * BLOCK_WORDS))))
    lower = Discounts.of(*map(int, m[:4]))
    left = float(np.dot(lower.off, [m[0], m[1], m[4]]) / of[4]) if of[4] else 1.0
    top = Discounts.of(*map(int, of_top)) if order == 3 else None
    return Model(words, shards, hot, Discounts.of(*map(int, of[:4])), lower, int(of[4]), left, order, top, hot_numbers)


def _sums(n: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each context, how many counts are one, two, more; and their sum."""
    both = np.add.reduceat(np.array([0, 1, 1 << 32, 0])[np.minimum(n, 3)], starts)
    once, twice = both & (2**32 - 1), both >> 32
    return np.stack([once, twice, np.diff(starts, append=len(n)) - once - twice, np.add.reduceat(n, starts)])


_SENT = "kind int, shard int, k binary, c binary"


def _sent(kind: int, shard: np.ndarray, keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """Ascending keys and their values, a row for each shard they go to."""
    by = _by_shard(shard)
    out = [(kind, s, squeeze(keys[by[i:j]], True), squeeze(values[..., by[i:j]].reshape(-1))) for s, i, j in _runs(shard[by])]
    names = {"kind": pa.int32(), "shard": pa.int32(), "k": pa.binary(), "c": pa.binary()}
    return batch(dict(zip(names, map(list, zip(*out)))) if out else {n: [] for n in names}, names)


def _third(rows: DataFrame, words: Words, hot: np.ndarray, shards: int) -> DataFrame:
    """``kind, shard, k, c`` of what the shards of trigrams send on, whose tasks also write their arrays: the bigrams below (0),
    how many trigrams have each low count (1), the sums of spread contexts (2).

    A context of both words in ``hot`` may have more tokens than a shard; no other has, as it is no more frequent than each.
    """
    root = f"{words.root}/trigrams"

    def is_hot(numbers: np.ndarray) -> np.ndarray:
        return np.isin(numbers, hot)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *triple, _ in grams(_texts(batches), 3):
            values, places = _indexed(tuple(triple))
            del triple
            numbers, _ = words.find(values)
            numbers[values == BEGIN], numbers[values == BEFORE] = words.distinct, words.distinct + 1
            by = np.argsort(numbers)
            place = np.empty_like(by)
            place[by] = np.arange(len(by))
            numbers = numbers[by]
            u, v, w, n = count_triples(*(place[x] for x in places), len(numbers))
            del places
            frequent = is_hot(numbers)
            keys, both = _keys(numbers[u], numbers[v]), frequent[u] & frequent[v]
            w, n = numbers[w].astype(np.uint32), n.astype(np.uint32)
            shard = _shard3(keys, w, both, shards)
            by = _by_shard(shard)
            out = [(s, squeeze(keys[by[i:j]], True), squeeze(w[by[i:j]]), squeeze(n[by[i:j]])) for s, i, j in _runs(shard[by])]
            yield batch(
                dict(zip(("shard", "k", "w", "c"), map(list, zip(*out)))),
                {"shard": pa.int32(), "k": pa.binary(), "w": pa.binary(), "c": pa.binary()},
            )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for b in batches:
            for shard, k, w, c in zip(*(b.column(i).to_pylist() for i in range(4))):
                held.append((unsqueeze(k, np.uint64, True), unsqueeze(w, np.uint32), unsqueeze(c, np.uint32)))
        if shard is None:
            return
        keys, w, n = (np.concatenate(x) for x in zip(*held))
        held.clear()
        keys, by = ascending(keys)
        w, n = w[by], n[by]
        # Within a context by word.
        starts = firsts_of(keys)
        by = by_pair(np.repeat(np.arange(len(starts)), np.diff(starts, append=len(keys))), w, len(starts), words.distinct)
        w, n = w[by], n[by].astype(np.int64)
        firsts = firsts_of(keys, w)
        keys, w, n = keys[firsts], w[firsts], np.add.reduceat(n, firsts)
        begins = (keys >> np.uint64(32)) > np.uint64(words.distinct)
        # A bigram counts once for each word before it; at the begin of a text there is none, and it counts as often as it comes.
        below, by = ascending(_keys(keys & np.uint64(2**32 - 1), w))
        starts = firsts_of(below)
        below, comes = below[starts], np.add.reduceat(np.where(begins, n, 1)[by], starts)
        context = (below >> np.uint64(32)).astype(np.int64)
        yield _sent(0, _shard(context, below, context, hot, shards), below, comes.astype(np.uint64))
        keys, w, n = keys[~begins], w[~begins], n[~begins]
        of = np.bincount(np.minimum(n, 5), minlength=6)[1:5].astype(np.uint64)
        yield _sent(1, np.full(4, shard), np.arange(4, dtype=np.uint64), of)
        contexts, starts = np.unique(keys, return_index=True)
        ends = np.append(starts, len(keys))
        save(f"{root}/{shard}.contexts", contexts)
        sizes = np.diff(ends)
        padded = np.zeros(-(-len(sizes) // BLOCK_CONTEXTS) * BLOCK_CONTEXTS, np.uint8)
        padded[: len(sizes)] = np.minimum(sizes, SMALL)
        save(f"{root}/{shard}.sizes", padded)
        save(f"{root}/{shard}.blocks", starts[::BLOCK_CONTEXTS].astype(np.uint32))
        save(f"{root}/{shard}.words", w)
        save_counts(f"{root}/{shard}.counts", n)
        sums = _sums(n, starts) if len(n) else np.zeros((4, 0), np.int64)
        long = np.flatnonzero(sizes >= SMALL)
        save(f"{root}/{shard}.long", long.astype(np.int64))
        save(f"{root}/{shard}.long_sums", np.concatenate([sums[:, long], sizes[None, long]]).astype(np.int64))
        spread = np.flatnonzero(is_hot((contexts >> np.uint64(32)).astype(np.int64)) & is_hot((contexts & np.uint64(2**32 - 1)).astype(np.int64)))
        if len(spread):
            own = contexts[spread]
            yield _sent(2, _mix(own, shards).astype(np.int64), own, sums[:, spread].astype(np.uint64))

    counted = map_batches(rows, count, "shard int, k binary, w binary, c binary", 1 << 16).repartitionById(shards, F.col("shard"))
    return counted.mapInArrow(gather, _SENT)


def _stat_rows(blocks: list[int], numbers: list[np.ndarray], values: list[np.ndarray]) -> pa.RecordBatch:
    return batch(
        {"block": blocks, "i": [squeeze(x, True) for x in numbers], "v": [squeeze(x) for x in values]},
        {"block": pa.int32(), "i": pa.binary(), "v": pa.binary()},
    )


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity`` of every row.

    Scores are log10 probabilities of the whole text with its end: ``base_score`` by counts plus one, ``score`` by the model.
    A null text is an empty one, which is its end. Repeated rows and null ids are kept; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        w = known.words
        for b in _joined(batches):
            n = b.num_rows
            sums = {"n_tokens": np.zeros(n), "n_known": np.zeros(n), "base_score": np.zeros(n), "score": np.zeros(n)}
            for *words, numbers in grams(b.column(1).to_pylist(), known.order):
                logs, counts = known.lookup(*words)
                base = np.log10((counts + 1.0) / (w.total + (w.distinct + 1.0)))
                for name, values in (("n_tokens", None), ("n_known", counts > 0), ("base_score", base), ("score", logs)):
                    sums[name] += np.bincount(numbers, values, n)
            out = {c: pa.array(v.astype(np.int64) if c.startswith("n_") else v) for c, v in sums.items()}
            trained = pa.array(np.full(n, w.total, np.int64))
            perplexity = pa.array(10.0 ** (-sums["score"] / np.maximum(sums["n_tokens"], 1)))
            yield batch({"id": b.column(0), **out, "train_tokens": trained, "perplexity": perplexity})

    rows = docs.select(col(doc_id).alias("id"), text_of(text).alias("t"))
    schema = f"id {kind}, n_tokens bigint, n_known bigint, base_score double, score double, train_tokens bigint, perplexity double"
    return map_batches(rows, work, schema, SCORED_ROWS).withColumnRenamed("id", doc_id)
