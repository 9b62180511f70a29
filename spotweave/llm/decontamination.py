"""Benchmark decontamination by pigeonhole edit matching.

A test item of m bytes has an error budget of ``budget_percent`` of m.  It is split into one piece more
than errors are allowed, and the pieces are taken in pairs, with a last one alone if their number is odd:
if each pair had two errors and the single piece one, they would be more than allowed.  So any passage
within the budget holds the single piece unchanged, or some piece unchanged beside its partner with at
most one error.  An Aho-Corasick automaton finds all exact piece hits in a document in one scan; a look at
the partner drops the chance hits; each hit that is left places the item in the text, and Myers'
bit-parallel algorithm gives the least edit distance of the item to any passage there.  Case and white
space are folded before, and items of equal text are one.

A piece of many items, as of a common question stem, would place them all in each text that has the stem.
Such items are counted first: an edit changes GRAM grams of an item at most, so that a passage within the
budget has all of its grams but GRAM for each error.  The grams that most of the piece's items have are counted
at once for all, and only the others are looked up item by item; what falls short is dropped.

Documents are only mapped, never shuffled.  The test items go out in blocks of at most BLOCK_ITEMS, so
that what is broadcast is bounded however many there are; each block is a pass of its own over all
documents.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ITEMS, BLOCK_BYTES = 5_000, 2 << 20
HOT_ITEMS, GRAM = 32, 3
#: Errors allowed in the query and in the pipeline, as a share of an item's bytes.
BUDGET_PERCENT = 10


def folded(text: str | None) -> str:
    """Case folded over Unicode, composed (NFC), white space as single blanks; as UTF-8 bytes that stand for characters."""
    text = text or ""
    if not text.isascii():  # decomposed before, so that marks in any order fold alike (Unicode, D145)
        text = unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).casefold())
    return b" ".join(text.encode().lower().split()).decode("latin-1")


@dataclass(frozen=True)
class Item:
    """Test items of one text: their ids, folded text, error budget, and piece bounds."""

    item_ids: tuple[int, ...]
    text: str
    budget: int

    def pieces(self) -> list[tuple[int, str]]:
        n, k = len(self.text), self.budget + 1
        cuts = [n * i // k for i in range(k + 1)]
        return [(low, self.text[low:high]) for low, high in zip(cuts, cuts[1:])]


def make_items(rows: list[tuple[int, str]], budget_percent: int) -> tuple[Item, ...]:
    """Items with text; a null or blank item matches nothing."""
    by_text: dict[str, set[int]] = defaultdict(set)
    for i, text in rows:
        if whole := folded(text):
            by_text[whole].add(i)
    return tuple(Item(tuple(sorted(ids)), text, len(text) * budget_percent // 100) for text, ids in by_text.items())


def grams(text: str) -> set[str]:
    return {text[i : i + GRAM] for i in range(len(text) - GRAM + 1)}


class HotPiece:
    """Items that share a piece at one place in them, with the same partner: their grams, the common ones apart.

    Of its common grams an item counts as having as many as the passage has of all.
    """

    def __init__(self, numbers: list[int], low: int, items: tuple[Item, ...]) -> None:
        self.numbers, self.low = numbers, low
        own = {n: grams(items[n].text) for n in numbers}
        counts = Counter(g for s in own.values() for g in s)
        self.common = {g for g, c in counts.items() if 2 * c > len(numbers)}
        self.rare: dict[str, list[int]] = defaultdict(list)
        for n, s in own.items():
            for g in s - self.common:
                self.rare[g].append(n)
        self.needed = {n: len(s) - GRAM * items[n].budget for n, s in own.items()}
        self.has_common = {n: len(s & self.common) for n, s in own.items()}
        self.reach = max(len(items[n].text) + items[n].budget for n in numbers)
        self.slack = max(items[n].budget for n in numbers)

    def candidates(self, whole: str, first: int) -> list[int]:
        """Items that may be in the text with this piece at ``first``."""
        seen = grams(whole[max(0, first - self.low - self.slack) : first - self.low + self.reach])
        had, common = Counter(n for g in seen for n in self.rare.get(g, ())), len(self.common & seen)
        return [n for n in self.numbers if had[n] + min(common, self.has_common[n]) >= self.needed[n]]


def least_distance(pattern: str, passage: str, most: int) -> int:
    """Least edit distance of the pattern to any part of the passage, or most + 1 if it is above ``most``.

    Myers (1999): a column of the distance table is two bit vectors of vertical differences, of any length
    in Python's integers, and a character costs a dozen operations on them.
    """
    m = len(pattern)
    places: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        places[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    for c in passage:
        same = places.get(c, 0)
        diagonal = (((same & plus) + plus) ^ plus) | same | minus
        right_plus = minus | (full & ~(diagonal | plus))
        right_minus = plus & diagonal
        if right_plus & top:
            score += 1
        elif right_minus & top:
            score -= 1
            best = min(best, score)
        right_plus = (right_plus << 1) & full
        right_minus = (right_minus << 1) & full
        zero = same | minus
        plus = right_minus | (full & ~(zero | right_plus))
        minus = right_plus & zero
    return min(best, most + 1)


def begins(text: str, piece: str) -> bool:
    """Whether the text begins with the piece, but for one edit at most."""
    n, same = len(piece), 0
    for a, b in zip(text, piece):
        if a != b:
            break
        same += 1
    rest = piece[same + 1 :]
    return same == n or text[same + 1 : n] == rest or text[same : n - 1] == rest or text[same + 1 : n + 1] == piece[same:]


@lru_cache(maxsize=2)
def automaton(items: tuple[Item, ...]):
    """Pieces of all items, each with its items by partner: one list for few, a HotPiece for many at the same place."""
    places: dict[str, dict[tuple[str, str], dict[int, list[int]]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(list)))
    for n, item in enumerate(items):
        pieces = item.pieces()
        for i, (low, piece) in enumerate(pieces):
            behind = pieces[i + 1][1] if i % 2 == 0 and i + 1 < len(pieces) else ""
            places[piece][behind, pieces[i - 1][1][::-1] if i % 2 else ""][low].append(n)
    built = ahocorasick.Automaton()
    for piece, partners in places.items():
        few = [(n, low, *partner) for partner, by_place in partners.items() for low, of in by_place.items() if len(of) <= HOT_ITEMS for n in of]
        hot = [(*partner, HotPiece(of, low, items)) for partner, by_place in partners.items() for low, of in by_place.items() if len(of) > HOT_ITEMS]
        built.add_word(piece, (len(piece), few, hot))
    built.make_automaton()
    return built


def partner_is_there(whole: str, first: int, end: int, behind: str, before: str) -> bool:
    """Whether the partner stands beside the piece from ``first`` to ``end``, with one error at most; an empty one always does."""
    if behind:
        return begins(whole[end + 1 : end + 2 + len(behind)], behind)
    return begins(whole[max(0, first - len(before) - 1) : first][::-1], before)


def leaks(text: str | None, items: tuple[Item, ...]) -> dict[int, int]:
    """Items found in a text within their budgets: item_id and least distance."""
    whole = folded(text)
    if not whole or not items:
        return {}
    starts: dict[int, set[int]] = defaultdict(set)
    for end, (size, few, hot) in automaton(items).iter(whole):
        first = end + 1 - size
        for n, low, behind, before in few:
            if partner_is_there(whole, first, end, behind, before):
                starts[n].add(first - low)
        for behind, before, piece in hot:
            if partner_is_there(whole, first, end, behind, before):
                for n in piece.candidates(whole, first):
                    starts[n].add(first - piece.low)
    found: dict[int, int] = {}
    for n, places in starts.items():
        item = items[n]
        m, k = len(item.text), item.budget
        best, low, high = k + 1, None, 0
        for at in [*sorted(places), None]:
            if low is not None and (at is None or at > high + 2 * k + 1):
                best = min(best, least_distance(item.text, whole[max(0, low - k) : high + m + k], k))
                low = None
                if not best:
                    break
            if low is None:
                low = at
            high = at  # placements so near share a window
        if best <= k:
            for item_id in item.item_ids:
                found[item_id] = min(best, found.get(item_id, best))
    return found


def item_blocks(benchmark: DataFrame, budget_percent: int, item_id: str, text: str) -> Iterator[tuple[Item, ...]]:
    """The benchmark, a block of bounded rows and bytes at a time; a longer text is a block of its own.  One block at least."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    block, size = [], 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        if block and (len(block) == BLOCK_ITEMS or size + len(r["text"]) > BLOCK_BYTES):
            yield make_items(block, budget_percent)
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += len(r["text"])
    yield make_items(block, budget_percent)


def find_leaks(docs: DataFrame, benchmark: DataFrame, budget_percent: int = 6, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, distance) for each test item that a document holds within the item's budget.

    The distance is in bytes of the folded texts, the least of an item's texts and places.  Texts are searched
    whole, however long.  Null and blank texts and items match nothing; a row with
    a null item_id is no item; repeated document rows give repeated results; an empty table gives none.
    """
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out: DataFrame | None = None
    for items in item_blocks(benchmark, budget_percent, item_id, item_text):

        def run(batches: Iterator[pa.RecordBatch], items: tuple[Item, ...] = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(d.as_py(), i, k) for d, t in zip(batch.column(0), batch.column(1)) for i, k in sorted(leaks(t.as_py(), items).items())]
                columns = list(zip(*rows)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "distance"])

        found = chosen.mapInArrow(run, "doc_id long, item_id long, distance long")
        out = found if out is None else out.unionByName(found)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, budget_percent: int = 6, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that hold no test item within its budget."""
    at = docs.columns.index(text)
    for items in item_blocks(benchmark, budget_percent, item_id, item_text):

        def run(batches: Iterator[pa.RecordBatch], items: tuple[Item, ...] = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not leaks(t.as_py(), items) for t in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
