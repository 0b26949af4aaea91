"""Benchmark decontamination by pigeonhole edit matching.

An item may occur in a document with up to k edits. Cut into k + 1 pieces, at
least one piece of such an occurrence is unedited. One Aho-Corasick automaton
over all pieces finds these exact hits in a single pass over a text; each hit
says where the item would lie. As pieces are short, a hit is first checked by the
pieces beside it: n neighbouring pieces that begin with an unedited one hold at
most n - 1 edits on some way from one piece to all of them, doubling each time.
Neighbouring guesses that pass are merged into one window, and Myers'
bit-parallel algorithm finds the best end of the item in it with the fewest
edits. A second run over reversed texts, bound to their beginning, gives the start.

Items are a query set: they are read in blocks of at most ``BLOCK_CHARS``
characters, and every block is matched against every whole text. The documents
are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.shared import table
from landledger.session import materialize

# One edit is allowed for this many characters of an item, so pieces are about as long.
CHARS_PER_EDIT = 10
# Items below this length are one exact piece, and count only between word borders.
SHORT = 20
BLOCK_CHARS = 4_000_000

MATCHES = "array<struct<item_id: bigint, distance: int, start: int, end: int>>"


def normalise(text: str | None) -> str:
    """Lower case, each run of white space one space, trimmed."""
    return " ".join(text.lower().split()) if text else ""


def edit_budget(length: int) -> int:
    return length // CHARS_PER_EDIT if length >= SHORT else 0


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece) of the budget-plus-one pieces of nearly equal length."""
    n = edit_budget(len(item)) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_end(pattern: str, text: str, budget: int, bound: bool = False) -> tuple[int, int] | None:
    """(distance, end) of the occurrence of ``pattern`` in ``text`` with the fewest
    edits, the first of them; None if it takes more than ``budget``.

    Myers' algorithm: one bit per pattern character holds the vertical
    differences of a column of the edit table, whose top row is zero so that an
    occurrence may start anywhere; ``bound`` to the beginning it counts upwards.
    """
    m = len(pattern)
    full, last = (1 << m) - 1, 1 << (m - 1)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    up, down, score = full, 0, m
    best = (m, 0) if m <= budget else None
    limit = budget + 1 if best is None else m
    for end, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right_up = down | (full & ~(diagonal | up))
        right_down = up & diagonal
        if right_up & last:
            score += 1
        elif right_down & last:
            score -= 1
        right_up = ((right_up << 1) & full) | bound
        right_down = (right_down << 1) & full
        up = right_down | (full & ~((eq | down) | right_up))
        down = right_up & (eq | down)
        if score < limit:
            limit, best = score, (score, end)
    return best


def ladder(parts: list[tuple[int, str]]) -> list[list[tuple[int, int, int]]]:
    """For each piece the spans (begin, end, budget) that hold it, from the smallest to all of the item.

    A span of n pieces is cut into two of about n / 2. If it has at most n - 1
    edits, one of its halves has fewer edits than pieces as well, down to one
    piece without any; so every occurrence has a piece whose whole ladder holds.
    """
    ends = [*(offset for offset, _ in parts), parts[-1][0] + len(parts[-1][1])]
    steps: list[list[tuple[int, int, int]]] = [[] for _ in parts]

    def cut(first: int, last: int) -> None:
        if last - first > 1:
            middle = (first + last + 1) // 2
            cut(first, middle)
            cut(middle, last)
            for k in range(first, last):
                steps[k].append((ends[first], ends[last], last - first - 1))

    cut(0, len(parts))
    return steps


class Matcher:
    """All pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = items
        owners: dict[str, list[tuple[int, int, int]]] = {}
        self.parts = [pieces(text) if text else [] for _, text in items]
        self.ladders = [ladder(parts) if parts else [] for parts in self.parts]
        for number, parts in enumerate(self.parts):
            for k, (offset, piece) in enumerate(parts):
                owners.setdefault(piece, []).append((number, offset, k))
        self.automaton = ahocorasick.Automaton()
        for piece, places in owners.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.searchable = bool(owners)
        if owners:
            self.automaton.make_automaton()

    def _holds(self, number: int, piece: int, start: int, text: str) -> bool:
        """Whether the spans around a piece occur near where its hit puts them; all but the whole item."""
        item = self.items[number][1]
        for begin, end, budget in self.ladders[number][piece][:-1]:
            window = text[max(0, start + begin - budget) : start + end + budget]
            if budget == 1:
                # one edit leaves a half of the piece beside the hit as it is
                offset, own = self.parts[number][piece]
                other = item[offset + len(own) : end] if offset == begin else item[begin:offset]
                half = len(other) // 2
                if other[:half] not in window and other[half:] not in window:
                    return False
            if item[begin:end] not in window and best_end(item[begin:end], window, budget) is None:
                return False
        return True

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of each item found, at its best place."""
        text = normalise(text)
        found: list[tuple[int, int, int, int]] = []
        guesses: dict[int, set[int]] = {}
        if self.searchable:
            for end, (length, places) in self.automaton.iter(text):
                for number, offset, piece in places:
                    start = end + 1 - length - offset
                    mine = guesses.get(number, ())
                    if start not in mine and self._holds(number, piece, start, text):
                        guesses.setdefault(number, set()).add(start)
        for number, starts in guesses.items():
            item_id, item = self.items[number]
            if len(item) < SHORT:
                found += self._between_words(number, sorted(starts), text)
                continue
            budget = edit_budget(len(item))
            best = None
            for low, high in _merged(sorted(starts), len(item) + 2 * budget):
                begin = max(0, low - budget)
                window = text[begin : high + len(item) + budget]
                at = window.find(item)
                hit = (0, at + len(item)) if at >= 0 else best_end(item, window, budget)
                if hit and (best is None or hit[0] < best[0]):
                    best = (hit[0], begin + hit[1])
            if best:
                distance, end = best
                start = end - len(item)
                if distance:
                    back = text[max(0, end - len(item) - budget) : end][::-1]
                    start = end - best_end(item[::-1], back, distance, bound=True)[1]
                found.append((item_id, distance, start, end))
        return sorted(found, key=lambda m: (m[0] is None, m))

    def _between_words(self, number: int, starts: list[int], text: str) -> list[tuple[int, int, int, int]]:
        """A short item: unedited, and no part of a longer word."""
        item_id, item = self.items[number]
        for start in starts:
            end = start + len(item)
            if not (start and text[start - 1].isalnum() and item[0].isalnum()):
                if not (end < len(text) and text[end].isalnum() and item[-1].isalnum()):
                    return [(item_id, 0, start, end)]
        return []


def _merged(starts: list[int], reach: int) -> list[tuple[int, int]]:
    """Runs of guesses whose windows overlap."""
    runs = [(starts[0], starts[0])]
    for s in starts[1:]:
        low, high = runs[-1]
        if s - high <= reach:
            runs[-1] = (low, s)
        else:
            runs.append((s, s))
    return runs


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items (item_id, text) in lists of about ``block_chars`` characters each."""
    known = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL")
    total = known.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-total // block_chars) or 1
    for block in range(blocks):
        mine = known.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield [(r.item_id, normalise(r.text)) for r in mine.distinct().collect()]


def _search(items: list[tuple[int, str]]):
    """A function of a text column: what ``Matcher.matches`` finds."""

    @F.pandas_udf(MATCHES)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(items)
        for texts in batches:
            found = [
                [{"item_id": i, "distance": d, "start": a, "end": b} for i, d, a, b in matcher.matches(t)]
                for t in texts
            ]
            yield pd.Series(found, dtype=object)

    return search


def with_leaks(docs: DataFrame, items: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents with ``leaks``: the items found in each text, fewest edits first place.

    Positions count code points of the normalised text. NULL and empty texts
    and items match nothing; repeated items are one item; rows are neither
    dropped nor repeated. A column ``leaks`` of the input is replaced. With
    several blocks of items the documents are written between the passes.
    """
    docs = docs.drop("leaks").withColumn("leaks", F.expr(f"cast(array() AS {MATCHES})"))
    first = True
    for block in item_blocks(items, block_chars):
        if not first:
            docs = materialize(docs, "leaks")
        first = False
        docs = docs.withColumn("leaks", F.concat("leaks", _search(block)("text")))
    return docs


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents in which no item is found."""
    return with_leaks(docs, items).filter(F.size("leaks") == 0).drop("leaks")


def op7_edit_matching(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return with_leaks(docs, table(spark, folder, "benchmark")).select("doc_id", F.inline("leaks"))
