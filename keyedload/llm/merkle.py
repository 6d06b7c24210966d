"""Document fingerprints: a Merkle tree over the sections and paragraphs of a text.

Leaves are pieces of a few words. A paragraph is a line; a section ends at a blank line, or behind a paragraph whose digest
says so. Where a piece or a section ends depends on its last word or paragraph only, so an edit moves no border but its own. A
node's digest is the digest of its children's. The fingerprint writes the tree out: the root, which tells whether texts are
equal, and below it short names of sections, paragraphs and leaves, by which two fingerprints are walked down only where
their branches differ: that gives both their likeness and the paragraphs that were edited.
"""

from __future__ import annotations

import hashlib
import zlib
from base64 import urlsafe_b64encode
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from keyedload.functions.names import col
from keyedload.llm.common import batch, map_batches, prepare, text_of

# A piece has about so many words and at most so many, a section about so many paragraphs.
WORDS_IN_PIECE = 4
MOST_WORDS = 12
PARAGRAPHS_IN_SECTION = 4


def leaves(paragraph: bytes) -> list[bytes]:
    """Pieces that are the paragraph when joined by spaces."""
    words, crc = paragraph.split(b" "), zlib.crc32
    out, start = [], 0
    for end in [i for i, w in enumerate(words, 1) if crc(w) % WORDS_IN_PIECE == 0 or i == len(words)]:
        while end - start > MOST_WORDS:
            out.append(b" ".join(words[start : start + MOST_WORDS]))
            start += MOST_WORDS
        out.append(b" ".join(words[start:end]))
        start = end
    return out


# A section and a paragraph are written as 8 signs (48 bits), a leaf as 4 (24 bits): leaves are compared only where the
# paragraphs above them differ.
NAME_BYTES, LEAF_BYTES = 6, 3
NAME, LEAF = NAME_BYTES * 4 // 3, LEAF_BYTES * 4 // 3

#: Name of a paragraph, and the names of its leaves one after another.
Paragraph = tuple[str, str]


@dataclass(frozen=True)
class Tree:
    """The root's digest, and below it sections and their paragraphs by name."""

    root: str
    sections: list[tuple[str, list[Paragraph]]]

    @property
    def written(self) -> str:
        return "|".join([self.root, *(f"{name}:{','.join(p + below for p, below in ps)}" for name, ps in self.sections)])


def tree(text: str, known: dict[bytes, tuple[bytes, Paragraph]] | None = None) -> Tree:
    """The tree of a text. ``known`` keeps what paragraphs have come to, for texts that share some."""
    known = {} if known is None else known
    digest = xxhash.xxh3_128_digest
    sections, digests, own_sections, own_paragraphs = [], [], [], []
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    for i, line in enumerate(lines, 1):
        if line not in known:
            below = [digest(x) for x in leaves(line)]
            own = digest(b"".join(below))
            names = urlsafe_b64encode(own[:NAME_BYTES] + b"".join([x[:LEAF_BYTES] for x in below])).decode()
            known[line] = own, (names[:NAME], names[NAME:])
        own, paragraph = known[line]
        digests.append(own)
        own_paragraphs.append(paragraph)
        if own[15] % PARAGRAPHS_IN_SECTION == 0 or not line or i == len(lines):
            own_sections.append(digest(b"".join(digests)))
            sections.append((urlsafe_b64encode(own_sections[-1][:NAME_BYTES]).decode(), own_paragraphs))
            digests, own_paragraphs = [], []
    return Tree(digest(b"".join(own_sections)).hex(), sections)


def fingerprint(text: str) -> str:
    """``root|section:paragraph,paragraph|section:...``: the root has 32 hexadecimal digits, a section 8 signs of the URL-safe
    base64 alphabet, a paragraph 8 and then 4 for each of its leaves. An empty text has one section, paragraph and leaf.
    """
    return tree(text).written


def read(fp: str) -> Tree:
    """The tree that a fingerprint writes out."""
    root, *sections = fp.split("|")
    return Tree(root, [(s[:NAME], [(p[:NAME], p[NAME:]) for p in s[NAME + 1 :].split(",")]) for s in sections])


def _left(a: list, b: list, name: Callable) -> tuple[list, list]:
    """What each of two lists has that the other has not, or has less often. Equal beginnings and ends are passed over."""
    start, end, most = 0, 0, min(len(a), len(b))
    while start < most and name(a[start]) == name(b[start]):
        start += 1
    while end < most - start and name(a[-1 - end]) == name(b[-1 - end]):
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]

    def beyond(items: list, others: Counter) -> list:
        out = []
        for x in items:
            n = name(x)
            if others[n] > 0:
                others[n] -= 1
            else:
                out.append(x)
        return out

    in_a, in_b = Counter(map(name, a)), Counter(map(name, b))
    return beyond(a, in_b), beyond(b, in_a)


@dataclass(frozen=True)
class Difference:
    """How like two trees are, and the numbers of the paragraphs of each that the other does not have."""

    likeness: float
    here: list[int]
    there: list[int]


def compare(a: Tree, b: Tree) -> Difference:
    """Walks two trees down from their roots, only into branches that differ.

    Equal roots are equal texts. Sections of one name are alike as a whole, and so are paragraphs of one name below the
    sections that are left; leaves are looked at only in paragraphs that the other text does not have. Likeness is the share
    of leaves, as often as they occur, that both have: in equal branches all, else those that are met at the bottom. A branch
    that has only moved is no difference but for the root.
    """
    if a.root == b.root:
        return Difference(1.0, [], [])

    def numbered(t: Tree) -> list:
        n, out = 0, []
        for name, ps in t.sections:
            out.append((name, [(p, below, n + i) for i, (p, below) in enumerate(ps)]))
            n += len(ps)
        return out

    def size(paragraphs: list) -> int:
        return sum(len(p[1]) for p in paragraphs) // LEAF

    def bottom(paragraphs: list) -> Counter:
        return Counter([below[i : i + LEAF] for _, below, _ in paragraphs for i in range(0, len(below), LEAF)])

    first = lambda branch: branch[0]
    sections = _left(numbered(a), numbered(b), first)
    here, there = _left(*([p for _, ps in left for p in ps] for left in sections), first)
    all_here, all_there = (size([p for _, ps in t.sections for p in ps]) for t in (a, b))
    shared = all_here - size(here) + (bottom(here) & bottom(there)).total()
    return Difference(2.0 * shared / (all_here + all_there), [n for *_, n in here], [n for *_, n in there])


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints: 1 for equal roots, 0 for no branch or leaf in common."""
    return compare(read(a), read(b)).likeness


def edited_paragraphs(a: str, b: str) -> tuple[list[int], list[int]]:
    """Numbers of the paragraphs of each text that the other does not have: where they were edited."""
    found = compare(read(a), read(b))
    return found.here, found.there


def ranges_of(numbers: list[int]) -> str:
    """Ascending numbers as ``start:end`` (end exclusive), comma-joined."""
    starts = [n for i, n in enumerate(numbers) if i == 0 or numbers[i - 1] != n - 1]
    ends = [n + 1 for i, n in enumerate(numbers) if i + 1 == len(numbers) or numbers[i + 1] != n + 1]
    return ",".join(f"{s}:{e}" for s, e in zip(starts, ends))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row, repeated rows and null ids included; other columns are not read.

    A null text has the fingerprint of an empty one. A text of any length is fingerprinted whole. No rows give no rows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch({"id": b.column(0), "fingerprint": [fingerprint(t) for t in b.column(1).to_pylist()]}, {"fingerprint": pa.string()})

    rows = docs.select(col(doc_id).alias("id"), text_of(text).alias("t"))
    return map_batches(rows, work, f"id {kind}, fingerprint string").withColumnRenamed("id", doc_id)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as many first characters of the following one, or all it has."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


class _Comparison:
    """Compares each text with its edited form and with the text that follows it."""

    def __init__(self) -> None:
        self.known: dict[bytes, tuple[bytes, Paragraph]] = {}

    def tree(self, text: str) -> Tree:
        # Paragraphs of this text come again in its edited form and in the one before; older ones are let go.
        if len(self.known) > 1000:
            self.known = {}
        return tree(text, self.known)

    def row(self, text: str, own: Tree, following: str, after: Tree) -> tuple:
        new = edited(text, following)
        new_tree = self.tree(new)
        sha = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
        edit = compare(own, new_tree)
        near_next = compare(own, after).likeness
        return len(text), sha, own.written, new_tree.written, edit.likeness, near_next, ranges_of(edit.here)


def _rows(ids: list, rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = {
        "n_chars": pa.int64(),
        "edited_sha256": pa.string(),
        "fingerprint": pa.string(),
        "edited_fingerprint": pa.string(),
        "near_edited": pa.float64(),
        "near_next": pa.float64(),
        "edited_paragraphs": pa.string(),
    }
    columns = zip(*rows) if rows else [()] * len(kinds)
    return batch({"id": pa.array(ids, kind), **{c: list(v) for c, v in zip(kinds, columns)}}, kinds)


def compared_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its fingerprint, that of its edited text, and how like they and the next row's are.

    ``edited_paragraphs`` are the paragraphs (lines, from 0) of the text that its edited form does not have, as ``start:end``.

    The next row is the one that follows by ascending id, null ids first, rows of one id by the hash of their text and then
    in the order read; the first follows the last. A null text is an empty one. One row is its own next; no rows give none.
    Other columns are not read.

    Sorting ids and hashes alone gives ranges and the first row of each; only these keys, one per shuffle partition, come
    to the driver. Rows equal in id and text are told apart by their place in the input, which must come in one order when
    read twice, as files do; otherwise the query fails. The texts are then dealt to their ranges in one shuffle, the first of
    a range also to the one before it.
    """
    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema[doc_id].dataType.simpleString()
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        col(doc_id).alias("id"), text_of(text).alias("t"), F.xxhash64(text_of(text)).alias("h"), F.monotonically_increasing_id().alias("n")
    )
    order = [F.col(c).asc_nulls_first() for c in ("id", "h", "n")]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from islice((b.slice(0, 1) for b in batches if b.num_rows), 1)

    keys = rows.select("id", "h", "n").repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    starts = keys.mapInArrow(first, f"id {kind}, h bigint, n bigint").orderBy(*order).collect()
    schema = f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string"
    schema += ", near_edited double, near_next double, edited_paragraphs string"
    if not starts:
        return spark.createDataFrame([], schema).withColumnRenamed("id", doc_id)

    def literal(values: Row) -> Column:
        return F.struct(F.lit(values.id).cast(kind).alias("id"), F.lit(values.h).alias("h"), F.lit(values.n).alias("n"))

    # Binary search among the first keys: how many are not above the row's.
    known, own = F.array(*map(literal, starts)), F.struct("id", "h", "n")
    steps = [1 << k for k in reversed(range(len(starts).bit_length()))]

    def search(at: Column, step: Column) -> Column:
        reached = at + step
        return F.when((reached <= len(starts)) & (F.get(known, reached - 1) <= own), reached).otherwise(at)

    at = (F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), search) - 1).alias("range")
    placed = rows.select("*", at)
    here = F.struct("range", F.lit(False).alias("ahead"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(len(starts))).alias("range"), F.lit(True).alias("ahead"))
    opens = F.get(known, F.col("range")) == own
    placed = placed.select("id", "t", "h", "n", F.explode(F.when(opens, F.array(here, before)).otherwise(F.array(here))).alias("to"))
    dealt = placed.select("id", "t", "to.ahead", "h", "n", "to.range").repartitionById(len(starts), F.col("range"))
    dealt = dealt.sortWithinPartitions("ahead", *order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compare, last, ahead = _Comparison(), None, True
        for b in batches:
            ids, done = [], []
            for i, t, ahead in zip(*(b.column(c).to_pylist() for c in ("id", "t", "ahead"))):
                own = compare.tree(t)
                if last is not None:
                    ids.append(last[0])
                    done.append(compare.row(last[1], last[2], t, own))
                last = (i, t, own)
            yield _rows(ids, done, b.schema.field(0).type)
        if not ahead:
            raise RuntimeError("the rows were read in another order the second time")

    return map_batches(dealt, work, schema).withColumnRenamed("id", doc_id)
