r"""Secrets in texts: an inverted index of trigrams proposes documents, the rules' patterns verify them. Columns only.

A text that matches a pattern holds, for one of the pattern's alternatives, all trigrams of its literal parts. Each rule's
pattern is read into such alternatives (a disjunction of sets of trigrams). The index has a posting for each document
and each trigram that some rule asks for; a rule's postings are intersected per alternative by counting, and the documents
that remain are verified with the pattern over the whole text. A rule without a mandatory trigram scans all texts.

Places are code points, ends exclusive. Texts are searched from left to right without overlap, per kind.
"""

from __future__ import annotations

import re
import re._constants as c
import re._parser
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyedload.functions.names import col
from keyedload.llm.common import staged, text_of

# More literal strings than this for one part of a pattern are not followed up; the part then asks for nothing.
MOST_STRINGS = 64

# Matches, and pieces of text between them, that are folded at a time: an even number.
PIECES_IN_BLOCK = 256

#: Marks the ends of matches; the sign itself is replaced in texts by a neighbour that no pattern mentions either.
_MARK, _OTHER = "\u0001", "\u0002"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a Java pattern, and the least length of a match, or of one of its groups."""

    kind: str
    pattern: str
    least: int
    group: int = 0


# The three base rules. Keywords are in either case, so trigrams are of lower-case texts.
BASE_RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
)
# Further well-known forms of credentials.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 20),
    Rule("code_host_token", r"gh[pousr]_[A-Za-z0-9]{36,}+", 40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}+", 15),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", 30),
)
RULES = BASE_RULES + MORE_RULES


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of a pattern, each the trigrams (lower case) that a match of it must hold.

    None if some alternative holds no trigram for certain: then every text is a candidate.
    """
    Alternatives = list[tuple[frozenset[str], str | None]]  # trigrams so far, and the literal string at the end

    def close(parts: Alternatives) -> Alternatives:
        return list(dict.fromkeys((grams | _trigrams(tail or ""), "") for grams, tail in parts))

    def strings(op, arg) -> list[str] | None:
        if op is c.LITERAL:
            return [chr(arg).lower()]
        if op is c.IN and all(o is c.LITERAL for o, _ in arg):
            return sorted({chr(a).lower() for _, a in arg})
        return None

    def follow(tree, parts: Alternatives) -> Alternatives:
        for op, arg in tree:
            known = strings(op, arg)
            if op is c.MAX_REPEAT and arg[1] == 1 and arg[0] == 0:
                parts = list(dict.fromkeys(parts + follow(arg[2], parts)))
            elif op is c.MAX_REPEAT and arg[0] >= 1:
                once = close(follow(arg[2], close(parts)))
                parts = once
            elif op is c.SUBPATTERN:
                parts = follow(arg[3], parts)
            elif op is c.BRANCH:
                parts = list(dict.fromkeys(p for tree in arg[1] for p in follow(tree, parts)))
            elif known is not None:
                parts = [(grams, (tail or "") + s) for grams, tail in parts for s in known]
            else:
                parts = close(parts)
            if len(parts) > MOST_STRINGS:
                parts = [(frozenset.intersection(*(g for g, _ in close(parts))), "")]
        return parts

    found = {grams for grams, _ in close(follow(re._parser.parse(pattern), [(frozenset(), "")]))}
    least = [g for g in found if not any(other < g for other in found)]
    return None if any(not g for g in least) else sorted(least, key=sorted)


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """``trigram, key`` for each text (``key, t``) and each of the trigrams in its lower-case form."""
    held = F.filter(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in trigrams]), lambda g: g.isNotNull())
    lowered = texts.select("key", F.lower("t").alias("low"))
    return lowered.select("key", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``key, kinds``: for each text, the rules with an alternative all of whose trigrams it has postings for."""
    alternatives = [(rule.kind, i, grams) for rule in rules for i, grams in enumerate(trigram_query(rule.pattern) or [])]
    asked = [(kind, i, g, len(grams)) for kind, i, grams in alternatives for g in sorted(grams)]
    spark = index.sparkSession
    # As many rows as the rules have trigrams: a fixed, small table.
    query = spark.createDataFrame(asked, "kind string, alternative int, trigram string, size int")
    met = index.join(F.broadcast(query), "trigram").groupBy("key", "kind", "alternative", "size").agg(F.count("*").alias("n"))
    return met.where("n = size").groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def spans_of(rule: Rule, text: Column) -> Column:
    """Spans ``struct<start, end>`` of a rule's matches in a text, those too short left out."""
    # Matches come to stand between marks; the pieces between marks are then outside and inside by turns.
    clean = F.translate(text, _MARK, _OTHER)
    pieces = F.split(F.regexp_replace(clean, F.lit(rule.pattern), F.lit(f"{_MARK}$0{_MARK}")), _MARK)
    measured = f"^(?:{rule.pattern})$"

    def long_enough(piece: Column) -> Column:
        part = piece if rule.group == 0 else F.regexp_extract(piece, measured, rule.group)
        return F.length(part) >= rule.least

    # Odd pieces are matches. Each step of a fold copies what it has found so far, so a block of pieces is folded at a time,
    # with places from its own beginning; blocks are then moved to where they stand. A block begins outside a match.
    none = F.array().cast("array<struct<start:int,end:int>>")
    empty = F.struct(F.lit(0).alias("at"), F.lit(False).alias("is_match"), none.alias("found"))

    def step(state: Column, piece: Column) -> Column:
        end = state["at"] + F.length(piece)
        span = F.array(F.struct(state["at"].alias("start"), end.alias("end")))
        found = F.when(state["is_match"] & long_enough(piece), F.concat(state["found"], span)).otherwise(state["found"])
        return F.struct(end.alias("at"), (~state["is_match"]).alias("is_match"), found.alias("found"))

    def folded(pieces: Column) -> Column:
        begins = F.sequence(F.lit(1), F.size(pieces), F.lit(PIECES_IN_BLOCK))
        return F.transform(begins, lambda i: F.aggregate(F.slice(pieces, i, PIECES_IN_BLOCK), empty, step))

    def moved(blocks: Column) -> Column:
        ends = F.aggregate(blocks, F.array(F.lit(0)), lambda at, b: F.concat(at, F.array(F.element_at(at, -1) + b["at"])))
        places = F.slice(ends, F.lit(1), F.size(blocks))

        def place(block: Column, at: Column) -> Column:
            return F.transform(block["found"], lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end")))

        return F.flatten(F.zip_with(blocks, places, place))

    return _let(_let(pieces, folded), moved)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def find(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES
) -> tuple[DataFrame, DataFrame]:
    """``doc_id, spans`` (kind, start, end; by start, then rule, then end) of every row, and the index it was found with.

    The index (``trigram, key``) is written to the shared folder. A text is known in it by the hash of its id and itself, so
    repeated rows share their postings and each have their spans. A null or empty text has no spans, null ids are ids like
    others, and other columns are not read.
    """
    key = F.xxhash64(col(doc_id), F.length(text_of(text)), text_of(text))
    texts = docs.select(col(doc_id).alias("id"), key.alias("key"), text_of(text).alias("t"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    trigrams = sorted({g for q in queries.values() for grams in q or [] for g in grams})
    index = staged(postings(texts.select("key", "t"), trigrams).distinct().sortWithinPartitions("trigram"), "postings") if trigrams else None
    if index is not None:
        found = candidates(index, rules)
        texts = texts.join(found, "key", "left")
    else:
        texts = texts.withColumn("kinds", F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def named(i: int, rule: Rule) -> Column:
        # A rule without trigrams looks at all texts, first whether there is a long enough match at all.
        asked = F.array_contains("kinds", rule.kind) if queries[rule.kind] else F.col("t").rlike(_quick(rule))
        number, kind = F.lit(i).alias("rule"), F.lit(rule.kind).alias("kind")
        spans = F.when(asked, spans_of(rule, F.col("t"))).otherwise(none)
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), number, s["end"].alias("end"), kind))

    spans = [named(i, rule) for i, rule in enumerate(rules)]
    listed = F.array_sort(F.concat(*spans))
    shown = F.transform(listed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return texts.select(F.col("id").alias(doc_id), shown.alias("spans")), index


def _quick(rule: Rule) -> str:
    """A pattern that each kept match of the rule holds a match of."""
    one_class = re.fullmatch(r"(\[[^\]]*\])\+", rule.pattern)
    return f"{one_class[1]}{{{rule.least}}}" if one_class and rule.group == 0 else rule.pattern
