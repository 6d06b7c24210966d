"""Exact repeats: which byte strings of a given length start more than once, and the maximal groups they belong to.

Every window of ``least`` bytes is put to an anchor in it, the leftmost of the smallest hashes of its grams; consecutive windows
with one anchor make a piece. Equal windows have equal anchors at equal places, so all that can repeat meets by the hash of
its anchor's gram, and only there. Tasks count the pieces of their texts and send a hash and a count of each different one.

Anchors that occur once are done with. Where all pieces of an anchor are equal they repeat whole. Else the different contents of
the anchor, each once, come to a shard of bounded size as text. There an enhanced suffix array is built over those of their
windows that come more than once (told by a rolling hash first, then by bytes), and its common-prefix intervals are found by
one scan with a stack. An interval whose suffixes have different bytes before them cannot be extended to the left, so it is a
maximal repeat within its pieces: it is given out with all its occurrences. Every repeated window lies in such a group, since
extending to the left ends at one. An anchor with very many different contents (the edge of a passage that many texts share)
does not come to one task: its windows are counted by hash.

Texts are read where they are. What is found goes back to the part of the table it was found in, as a file of the shared
folder, and is looked up by content; no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyedload.functions.names import col
from keyedload.llm.arrays import ascending, firsts_of, mapped, save, within
from keyedload.llm.common import batch, map_batches, shared_dir, staged, text_of

LEAST = 200
GRAM = 48
# Bytes whose windows are looked at together; longer texts are cut so, and their windows overlap.
BYTES_AT_ONCE = 1 << 20
# Windows hashed at once.
_BLOCK = 1 << 15
# Bytes of contents in a shard of suffixes.
SHARD_BYTES = 1 << 21
# Contents of an anchor that one task sorts; windows of anchors with more are counted by hash.
MOST_CONTENTS = 1024
# Suffixes sorted at once, about.
SORTED_AT_ONCE = 1 << 13

_BASE = 0x9E3779B97F4A7C15
_LOW = np.uint64((1 << 24) - 1)


def _pow(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def _mixed(h: np.ndarray, factor: int) -> np.ndarray:
    out = h >> np.uint64(31)
    out ^= h
    out *= np.uint64(factor)
    out ^= out >> np.uint64(29)
    return out


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while width * 2 <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return values if width == size else np.minimum(values[: -(size - width)], values[size - width :])


# What a byte counts as in a gram's hash.
_BYTES = _mixed(np.arange(256, dtype=np.uint64) + np.uint64(1), 0xBF58476D1CE4E5B9)


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    power, width = _BYTES[data], 1
    out, have = None, 0
    while True:
        if size & 1:
            if out is None:
                out = power
            else:
                out = out[: len(power) - have] * _pow(width)
                out += power[have:]
            have += width
        size >>= 1
        if not size:
            return out
        longer = power[:-width] * _pow(width)
        longer += power[width:]
        power = longer
        width *= 2


def pieces_of(data: np.ndarray, ends: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins, numbers of windows and anchor hashes of the pieces of texts that lie one after another and end at ``ends``."""
    none = np.zeros(0, np.int64)
    if len(data) < least:
        return none, none, none.view(np.uint64)
    hashes, lowest = np.empty(len(data) - gram + 1, np.uint64), np.empty(len(data) - least + 1, np.uint64)
    # Blocks that stay in a core's cache; a window's grams lie in its block.
    for at in range(0, len(lowest), _BLOCK):
        grams = _gram_hashes(data[at : at + _BLOCK + least - 1], gram)
        ranks = _mixed(grams, 0x94D049BB133111EB)
        ranks &= ~_LOW
        ranks |= np.arange(at, at + len(grams), dtype=np.uint64)
        hashes[at : at + len(grams)] = grams
        lowest[at : at + _BLOCK] = _sliding_min(ranks, least - gram + 1) & _LOW
    # A window that reaches over the end of a text is none.
    for end in ends:
        lowest[max(0, end - least + 1) : end] = _LOW
    firsts = np.append(0, np.flatnonzero(lowest[1:] != lowest[:-1]) + 1)
    sizes = np.diff(firsts, append=len(lowest))
    anchors = lowest[firsts]
    real = anchors != _LOW
    return firsts[real], sizes[real], _mixed(hashes[anchors[real].astype(np.int64)], 0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Bytes:
    """The texts of a batch, one after another."""

    data: np.ndarray
    starts: np.ndarray

    @staticmethod
    def of(column: pa.BinaryArray) -> Bytes:
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        buffer = column.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        return Bytes(data[offsets[0] : offsets[-1]] if len(column) else data[:0], offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64))

    @cached_property
    def raw(self) -> bytes:
        return self.data.tobytes()

    def pieces(self, least: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pieces, a bounded number of bytes at a time. How a text is cut depends on nothing but the text."""
        i, n = 0, len(self.starts) - 1
        while i < n:
            j = i + 1
            while j < n and self.starts[j + 1] - self.starts[i] <= BYTES_AT_ONCE:
                j += 1
            low, high = int(self.starts[i]), int(self.starts[j])
            step = BYTES_AT_ONCE if j == i + 1 else high - low
            for at in range(low, max(low + 1, high), max(1, step)):
                end = min(high, at + step + least - 1)
                ends = self.starts[i + 1 : j] - at
                begins, sizes, anchors = pieces_of(self.data[at:end], np.append(ends, end - at), least, gram)
                yield begins + at, sizes, anchors
            i = j

    def content(self, begin: int, size: int, least: int) -> bytes:
        return self.raw[begin : begin + size + least - 1]


def _hash(content: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(content)
    return h - (1 << 64) if h >> 63 else h


def _by_part(parts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of rows of one part."""
    cuts = np.flatnonzero(np.diff(parts)) + 1
    for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(parts)]):
        if j > i:
            yield int(parts[i]), i, j


def _pieces(texts: DataFrame, least: int, gram: int) -> DataFrame:
    """``part, m, c, n, row, start, size``: each different piece of a batch: hashes of its anchor and content, how often it is
    there, and where first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part, i, j in _by_part(whole.column(0).to_numpy()):
                b = whole.slice(i, j - i)
                texts, rows = Bytes.of(b.column(2)), b.column(1).to_numpy()
                for begins, sizes, m in texts.pieces(least, gram):
                    if not len(begins):
                        continue
                    c = np.array([_hash(texts.content(s, k, least)) for s, k in zip(begins.tolist(), sizes.tolist())], np.int64)
                    m = m.view(np.int64)
                    order = np.lexsort((begins, c, m))
                    firsts = np.flatnonzero(np.concatenate([[True], (np.diff(m[order]) != 0) | (np.diff(c[order]) != 0)]))
                    n, at = np.diff(firsts, append=len(order)), order[firsts]
                    text = np.searchsorted(texts.starts, begins[at], "right") - 1
                    yield batch(
                        {
                            "part": pa.array(np.full(len(at), part, np.int32)),
                            "m": pa.array(m[at]),
                            "c": pa.array(c[at]),
                            "n": pa.array(n),
                            "row": pa.array(rows[text]),
                            "start": pa.array(begins[at] - texts.starts[text]),
                            "size": pa.array(sizes[at].astype(np.int32)),
                        }
                    )

    schema = "part int, m bigint, c bigint, n bigint, row bigint, start bigint, size int"
    return map_batches(texts.select("part", "row", "t"), work, schema)


def _deal(rows: DataFrame, texts: DataFrame, root: str, kinds: dict[str, type], order: list[str]) -> None:
    """Writes the rows of each part of the table as arrays ``<root>/<part>.<column>``, also for parts without rows."""
    names = list(kinds)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, written = None, [], 0

        def flush() -> None:
            for k, name in enumerate(names):
                save(f"{root}/{current}.{name}", np.concatenate([h[k] for h in held]).astype(kinds[name]))

        for b in batches:
            real = b.column(1).to_numpy(zero_copy_only=False)
            values = [b.column(2 + k).to_numpy() for k in range(len(names))]
            for part, i, j in _by_part(b.column(0).to_numpy()):
                if part != current:
                    if held:
                        flush()
                    current, held, written = part, [], written + 1
                held.append([v[i:j][real[i:j]] for v in values])
        if held:
            flush()
        yield batch({"n": pa.array([written], pa.int64())})

    every = texts.select("part").distinct().select("part", F.lit(False).alias("real"), *[F.lit(0).cast(rows.schema[n].dataType).alias(n) for n in names])
    both = rows.select("part", F.lit(True).alias("real"), *names).unionAll(every)
    placed = both.repartition("part").sortWithinPartitions("part", *order)
    map_batches(placed, write, "n bigint", 1 << 16).agg(F.sum("n")).collect()


def _contents(texts: DataFrame, root: str, least: int) -> DataFrame:
    """``m, c, n, hot, content`` of the pieces dealt to ``root``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @cache
        def wanted(part: int, name: str, kind: type) -> np.ndarray:
            return mapped(f"{root}/{part}.{name}", kind)

        for whole in batches:
            for part, i, j in _by_part(whole.column(0).to_numpy()):
                b = whole.slice(i, j - i)
                texts, rows = Bytes.of(b.column(2)), b.column(1).to_numpy()
                asked = wanted(part, "row", np.int64)
                lows, highs = np.searchsorted(asked, rows), np.searchsorted(asked, rows, "right")
                which = np.concatenate([np.arange(x, y) for x, y in zip(lows, highs)] or [np.zeros(0, np.int64)]).astype(np.int64)
                if not len(which):
                    continue
                begins = np.repeat(texts.starts[:-1], highs - lows) + wanted(part, "start", np.int64)[which]
                sizes = wanted(part, "size", np.int64)[which]
                found = [texts.content(s, k, least) for s, k in zip(begins.tolist(), sizes.tolist())]
                yield batch(
                    {
                        "m": pa.array(wanted(part, "m", np.int64)[which]),
                        "c": pa.array(wanted(part, "c", np.int64)[which]),
                        "n": pa.array(wanted(part, "n", np.int64)[which]),
                        "hot": pa.array(wanted(part, "hot", np.int64)[which] > 0),
                        "content": pa.array(found, pa.binary()),
                    }
                )

    return map_batches(texts.select("part", "row", "t"), work, "m bigint, c bigint, n bigint, hot boolean, content binary")


def _common(data: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many bytes from ``a`` on are as those from ``b`` on, ``most`` at most."""
    padded = np.append(data, np.zeros(8, np.uint8))
    words = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    common = np.zeros(len(a), np.int64)
    open_ = np.flatnonzero(most > 0)
    while len(open_):
        have = common[open_]
        differ = words[a[open_] + have] ^ words[b[open_] + have]
        # The bits below the lowest one set, all 64 if none is: eight for each equal byte.
        have += np.bitwise_count(~differ & (differ - np.uint64(1))) >> 3
        common[open_] = have
        open_ = open_[(differ == 0) & (have < most[open_])]
    return np.minimum(common, most)


@dataclass(frozen=True)
class SuffixArray:
    """Suffixes of some contents whose first ``least`` bytes come more than once among them, and how many bytes each has in common
    with the one before. Those with the same first ``least`` bytes stand together, in order. A suffix that begins as no other
    does is in no group, and seldom is here."""

    data: np.ndarray
    starts: np.ndarray
    suffixes: np.ndarray
    common: np.ndarray

    @staticmethod
    def of(contents: list[bytes], least: int) -> SuffixArray:
        raw = b"".join(contents)
        data = np.frombuffer(raw, np.uint8)
        starts = np.cumsum([0, *map(len, contents)])
        ends = np.repeat(starts[1:], np.diff(starts))
        # Equal windows have equal hashes, so none that repeats is left out; bytes are compared below.
        places = np.flatnonzero(ends - np.arange(len(data)) >= least)
        hashes, by = ascending(_gram_hashes(data, least)[places])
        firsts = firsts_of(hashes)
        sizes = np.diff(firsts, append=len(hashes))
        again = np.repeat(sizes > 1, sizes)
        hashes, suffixes = hashes[again], places[by[again]]
        # Some at a time, whose bytes stay in a core's cache; equal hashes are not parted.
        cuts = firsts_of(hashes)
        cuts = cuts[firsts_of(cuts // SORTED_AT_ONCE)]
        for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(suffixes)]):
            some = suffixes[i:j]
            texts = [raw[s:e] for s, e in zip(some.tolist(), ends[some].tolist())]
            suffixes[i:j] = some[sorted(range(j - i), key=texts.__getitem__)]
        a, b = suffixes[:-1], suffixes[1:]
        return SuffixArray(data, starts, suffixes, _common(data, a, b, np.minimum(ends[a] - a, ends[b] - b)))


def maximal_groups(array: SuffixArray, least: int) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """The common-prefix intervals of at least ``least`` bytes whose suffixes have different bytes before them.

    ``number, parent, length, a suffix`` of each (parent -1: none), and ``number, suffix`` for each suffix in the smallest
    such interval it is in. An interval's occurrences are its own suffixes and those of the intervals below it.
    """
    begins = np.zeros(len(array.data) + 1, bool)
    begins[array.starts[:-1]] = True
    # What is before a suffix; none equals the begin of a content.
    before = np.where(begins[array.suffixes], -1, array.data[array.suffixes - 1].astype(np.int64)).tolist()
    suffixes, common = array.suffixes.tolist(), array.common.tolist()
    groups: list[list[int]] = []
    places: list[tuple[int, int]] = []

    def closed(entry: list, above: list | None) -> None:
        length, left, own, below = entry
        if left == -1:
            number = len(groups)
            groups.append([number, -1, length, own[0] if own else groups[below[0]][3]])
            places.extend((number, s) for s in own)
            for g in below:
                groups[g][1] = number
            own, below = [], [number]
        if above is not None:
            above[1] = left if above[1] == left or above[1] is None else -1
            # The longer list stays, so each suffix moves few times.
            above[2], own = (above[2], own) if len(above[2]) >= len(own) else (own, above[2])
            above[2].extend(own)
            above[3].extend(below)

    stack: list[list] = []  # length, byte before (None: nothing yet, -1: different), suffixes and groups not in a group
    for i in range(len(suffixes)):
        here = common[i] if i < len(common) else 0
        now = here if here >= least else 0
        behind = common[i - 1] if i else 0
        if not now and behind < least:
            continue
        # The suffix belongs to the deeper of the intervals with its neighbours.
        if now and (not stack or now > stack[-1][0]):
            stack.append([now, None, [], []])
        top = stack[-1]
        top[1] = before[i] if top[1] == before[i] or top[1] is None else -1
        top[2].append(suffixes[i])
        while stack and stack[-1][0] > now:
            entry = stack.pop()
            if stack and stack[-1][0] >= now:
                closed(entry, stack[-1])
            elif now:
                stack.append([now, None, [], []])
                closed(entry, stack[-1])
            else:
                closed(entry, None)
    return [tuple(g) for g in groups], places


def _grouped(contents: DataFrame, least: int, shards: int) -> DataFrame:
    """``m, c, at, length, node, parent``: the maximal groups of each shard, a row for each of their own suffixes and, without
    ``m``, one for each group."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, c, n, held = [], [], [], []
        for b in batches:
            m.append(b.column(1).to_numpy())
            c.append(b.column(2).to_numpy())
            n.append(b.column(3).to_numpy())
            held += b.column(4).to_pylist()
        if not held:
            return
        m, c, n = (np.concatenate(x) for x in (m, c, n))
        array = SuffixArray.of(held, least)
        groups, places = maximal_groups(array, least)
        raw = array.data.tobytes()
        ids = [_hash(raw[s : s + length]) for _, _, length, s in groups]
        lengths = [g[2] for g in groups]
        which = np.searchsorted(array.starts, [s for _, s in places], "right") - 1 if places else np.zeros(0, np.int64)
        rows = {
            "m": [*m[which].tolist(), *[None] * len(groups)],
            "c": [*c[which].tolist(), *[None] * len(groups)],
            "at": [*(int(s - array.starts[k]) for (_, s), k in zip(places, which)), *[None] * len(groups)],
            "length": [*(lengths[g] for g, _ in places), *lengths],
            "node": [*(ids[g] for g, _ in places), *ids],
            "parent": [*[None] * len(places), *(ids[g[1]] if g[1] >= 0 else None for g in groups)],
        }
        # A content that occurs more than once repeats whole.
        for k in np.flatnonzero(n > 1).tolist():
            size = len(held[k])
            for name, value in (("m", int(m[k])), ("c", int(c[k])), ("at", 0), ("length", size), ("node", _hash(held[k])), ("parent", None)):
                rows[name].append(value)
        yield batch(rows, {x: pa.int64() for x in rows})

    shard = F.pmod(F.xxhash64("m"), F.lit(shards)).cast("int")
    placed = contents.select(shard.alias("shard"), "m", "c", "n", "content").repartitionById(shards, F.col("shard"))
    schema = "m bigint, c bigint, at bigint, length bigint, node bigint, parent bigint"
    return map_batches(placed, work, schema, 1 << 16)


def _windows(contents: DataFrame, least: int) -> DataFrame:
    """``m, h, c, at, n``: every window of the contents by hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for m, c, n, content in zip(*(b.column(k).to_pylist() for k in range(4))):
                size = len(content) - least + 1
                h = [_hash(content[i : i + least]) for i in range(size)]
                yield batch(
                    {
                        "m": pa.array(np.full(size, m)),
                        "h": pa.array(h, pa.int64()),
                        "c": pa.array(np.full(size, c)),
                        "at": pa.array(np.arange(size)),
                        "n": pa.array(np.full(size, n)),
                    }
                )

    return map_batches(contents.select("m", "c", "n", "content"), work, "m bigint, h bigint, c bigint, at bigint, n bigint")


@dataclass(frozen=True)
class Repeats:
    """What repeats in a table of texts."""

    texts: DataFrame  # id, t, part, row
    pieces: DataFrame  # part, m, c, n, row, start, size, mixed: pieces whose anchor repeats; mixed: it has different contents
    suffixes: DataFrame  # m, c, at, length, node, parent
    least: int
    gram: int


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, gram: int = GRAM) -> Repeats:
    """All repeats of at least ``least`` bytes within and among the rows of ``docs``."""
    if not 1 <= gram <= least:
        raise ValueError("a gram has at least one byte and fits into a window")
    spark = docs.sparkSession
    rid = F.monotonically_increasing_id()
    rows = docs.select(col(doc_id).alias("id"), text_of(text).cast("binary").alias("t"), rid.alias("rid"))
    part, row = F.shiftright("rid", 33).cast("int"), F.col("rid").bitwiseAND(F.lit(2**33 - 1))
    texts = staged(rows.select("id", "t", part.alias("part"), row.alias("row")), "texts")
    every = staged(_pieces(texts, least, gram), "pieces")
    anchors = every.groupBy("m").agg(F.sum("n").alias("k"), F.min("c").alias("low"), F.max("c").alias("high")).where("k > 1")
    pieces = staged(every.join(anchors.select("m", (F.col("low") != F.col("high")).alias("mixed")), "m"), "repeated-anchors")

    place = F.min(F.struct("part", "row", "start", "size"))
    different = staged(pieces.where("mixed").groupBy("m", "c").agg(F.sum("n").alias("n"), place.alias("p")), "contents-wanted")
    many = different.groupBy("m").agg(F.count("*").alias("k"))
    size = (F.col("p.size") + F.lit(least - 1)).cast("bigint")
    cold = F.col("k") <= MOST_CONTENTS
    known = different.join(many, "m")
    sums = known.agg(F.coalesce(F.sum(F.when(cold, size)), F.lit(0)).alias("cold"), F.count(F.when(~cold, 1)).alias("hot")).first()
    root = shared_dir(spark, "wanted")
    hot = F.when(cold, 0).otherwise(1).cast("bigint")
    wanted = known.select("p.part", "p.row", "p.start", F.col("p.size").cast("bigint").alias("size"), "m", "c", "n", hot.alias("hot"))
    _deal(wanted, texts, root, {x: np.int64 for x in ("row", "start", "size", "m", "c", "n", "hot")}, ["row", "start"])
    contents = staged(_contents(texts, root, least), "contents")
    suffixes = _grouped(contents.where("NOT hot"), least, max(1, -(-sums.cold // SHARD_BYTES)))
    if sums.hot:
        windows = staged(_windows(contents.where("hot"), least), "windows")
        again = windows.groupBy("m", "h").agg(F.sum("n").alias("k")).where("k > 1").select("m", "h")
        found = windows.join(again, ["m", "h"])
        none = F.lit(None).cast("bigint")
        suffixes = suffixes.unionAll(
            found.select("m", "c", "at", F.lit(least).cast("bigint").alias("length"), F.col("h").alias("node"), none.alias("parent"))
        )
    return Repeats(texts, pieces, staged(suffixes, "suffixes"), least, gram)


def groups(found: Repeats, doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The groups ``group, parent, length``, and their places ``group, doc_id, row, start``, in bytes.

    A group's occurrences are its places and those of all groups below it. Groups are maximal within the pieces of text around
    their anchors: no longer string there has the same occurrences. Longer repeats are chains of groups. ``row`` tells rows of
    equal id apart. Needs the places of all pieces, so the texts are read once more.
    """
    whole = found.pieces.where("NOT mixed").select(
        "m", "c", F.lit(0).cast("bigint").alias("at"), (F.col("size") + found.least - 1).cast("bigint").alias("length"), F.col("c").alias("node")
    )
    own = found.suffixes.where("m IS NOT NULL").select("m", "c", "at", "length", "node").unionAll(whole).distinct()
    nodes = found.suffixes.groupBy("node", "length").agg(F.max("parent").alias("parent"))
    nodes = nodes.unionByName(whole.groupBy("node", "length").agg(F.max(F.lit(None).cast("bigint")).alias("parent")))
    least, gram = found.least, found.gram

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, part, row = Bytes.of(b.column(2)), b.column(0).to_numpy(), b.column(1).to_numpy()
            for begins, sizes, m in texts.pieces(least, gram):
                text = np.searchsorted(texts.starts, begins, "right") - 1
                c = [_hash(texts.content(s, k, least)) for s, k in zip(begins.tolist(), sizes.tolist())]
                yield batch(
                    {
                        "part": pa.array(part[text]),
                        "row": pa.array(row[text]),
                        "m": pa.array(m.view(np.int64)),
                        "c": pa.array(c, pa.int64()),
                        "start": pa.array(begins - texts.starts[text]),
                    }
                )

    every = map_batches(found.texts.select("part", "row", "t"), work, "part int, row bigint, m bigint, c bigint, start bigint")
    placed = every.join(own, ["m", "c"]).select("part", "row", "node", (F.col("start") + F.col("at")).alias("start"))
    named = placed.join(found.texts.select("part", "row", "id"), ["part", "row"])
    row = F.shiftleft(F.col("part").cast("bigint"), 33).bitwiseOR(F.col("row"))
    places = named.select(F.col("node").alias("group"), F.col("id").alias(doc_id), row.alias("row"), "start").distinct()
    return nodes.select(F.col("node").alias("group"), "parent", "length").distinct(), places


def _stretches(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers from each ``low`` on that are below its ``high``."""
    sizes = high - low
    return np.arange(sizes.sum()) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)


def _joined(starts: np.ndarray, ends: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal stretches that spans cover. Spans lie within the texts that begin at ``texts``, and so do stretches."""
    by = np.argsort(starts)
    starts, ends = starts[by], np.maximum.accumulate(ends[by])
    text = np.searchsorted(texts, starts, "right")
    apart = (starts[1:] > ends[:-1]) | (text[1:] != text[:-1])
    edge = np.ones(len(starts) + 1, bool)
    edge[1:-1] = apart
    return starts[edge[:-1]], ends[edge[1:]]


def _without(texts: Bytes, starts: np.ndarray, ends: np.ndarray) -> dict[str, pa.Array]:
    """``spans, kept`` of each text, given the stretches to remove."""
    edges = np.stack([starts, ends], 1).reshape(-1)
    stays = np.repeat(np.arange(len(edges) + 1) % 2 == 0, np.diff(edges, prepend=0, append=len(texts.data)))
    behind = np.searchsorted(starts, texts.starts)
    gone = np.append(0, np.cumsum(ends - starts))[behind]
    own = np.repeat(texts.starts[:-1], np.diff(behind))
    spans = pa.StructArray.from_arrays([pa.array(starts - own), pa.array(ends - own)], ["start", "end"])
    offsets = pa.py_buffer((texts.starts - gone).astype(np.int32))
    kept = pa.py_buffer(texts.data[stays])
    return {
        "spans": pa.ListArray.from_arrays(pa.array(behind.astype(np.int32)), spans),
        "kept": pa.Array.from_buffers(pa.binary(), len(texts.starts) - 1, [None, offsets, kept]),
    }


def removed(found: Repeats, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row: the maximal stretches of repeated bytes, and the bytes that are left."""
    least, gram = found.least, found.gram
    texts = found.texts
    windows = F.struct(F.col("at").alias("low"), (F.col("at") + F.col("length") - (least - 1)).alias("high"))
    mixed = found.suffixes.where("m IS NOT NULL").groupBy("m", "c").agg(F.collect_set(windows).alias("w"))
    parts = found.pieces.where("mixed").select("part", "m", "c").distinct().join(mixed, ["m", "c"])
    parts = parts.select("part", "m", "c", F.explode("w").alias("w")).select("part", "m", "c", "w.low", "w.high")
    whole = found.pieces.where("NOT mixed").select(
        "part", "m", "c", F.lit(0).cast("bigint").alias("low"), F.col("size").cast("bigint").alias("high")
    )
    root = shared_dir(texts.sparkSession, "repeats")
    kinds = {x: np.int64 for x in ("m", "c", "low", "high")}
    _deal(parts.unionAll(whole.distinct()), texts, root, kinds, ["m", "c", "low"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for whole in batches:
            for part, i, j in _by_part(whole.column(0).to_numpy()):
                if part != current:
                    anchors, contents, lows, highs = (mapped(f"{root}/{part}.{x}", np.int64) for x in kinds)
                    firsts = firsts_of(anchors, contents)
                    current, bounds = part, np.append(firsts, len(anchors))
                    anchors, contents = anchors[firsts], contents[firsts]
                b = whole.slice(i, j - i)
                texts = Bytes.of(b.column(2))
                starts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for begins, sizes, m in texts.pieces(least, gram):
                    m = m.view(np.int64)
                    low, high = np.searchsorted(anchors, m), np.searchsorted(anchors, m, "right")
                    asked = np.flatnonzero(low < high)
                    c = [_hash(texts.content(s, k, least)) for s, k in zip(begins[asked].tolist(), sizes[asked].tolist())]
                    at = within(contents, low[asked], high[asked], np.array(c, np.int64))
                    begins, at = begins[asked[at >= 0]], at[at >= 0]
                    which, begins = _stretches(bounds[at], bounds[at + 1]), np.repeat(begins, bounds[at + 1] - bounds[at])
                    starts.append(begins + lows[which])
                    ends.append(begins + highs[which] + (least - 1))
                starts, ends = _joined(np.concatenate(starts), np.concatenate(ends), texts.starts)
                yield batch({"id": b.column(1), "n_bytes": pa.array(np.diff(texts.starts)), **_without(texts, starts, ends)})

    kind = texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    return map_batches(texts.select("part", "id", "t"), work, schema).withColumnRenamed("id", doc_id)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row: each byte that a string of ``least`` bytes covers goes if that string starts
    anywhere else too, in the same text or another, its first occurrence included.

    Texts are their UTF-8 bytes; strings do not go over the end of a text, and are judged on what came in. A null text is an
    empty one, repeated rows repeat each other, null ids are kept. Texts of any length are read whole, a text is one task's.
    No rows give no rows, and other columns are not read. ``spans`` are in bytes, end exclusive, apart from one another.
    """
    return removed(find(docs, doc_id, text, least, gram), doc_id)
