"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, maps look-alike letters of other scripts and digits or signs used for letters to
one Latin form, and drops marks set inside words.  The lexicon has fixed terms and terms learned from
labelled rows: whole words and word beginnings that are much commoner in toxic texts.  A hit inside an
exception phrase doesn't count.  The weights of the hits, over a root of the text's length, go through
a logistic curve fitted on the same labelled rows.

Learning reads at most ``max_rows`` labelled rows, the first by a hash of their id; what comes to the
driver is bounded by that.  Scoring is a map over Arrow batches without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The starting lexicon (term: weight) and phrases in which a term means no harm.
SEED_TERMS = {
    "idiot": 2.0, "moron": 2.0, "stupid": 1.5, "scum": 2.0, "trash": 1.0, "loser": 1.5, "clown": 1.0, "pathetic": 1.5,
    "worthless": 1.5, "disgusting": 1.5, "imbecile": 2.0, "dumbass": 2.5, "asshole": 2.5, "bastard": 2.0, "retard": 2.5, "vermin": 2.0,
    "dummkopf": 2.0, "arschloch": 2.5, "connard": 2.5, "imbécile": 2.0, "idiota": 2.0, "estúpido": 1.5, "gilipollas": 2.5, "cretin": 2.0,
}
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "clown car", "circus clown", "scum line", "pond scum", "sore loser board", "not stupid", "not an idiot", "worthless stock option")
# Look-alike letters (Cyrillic, Greek, full-width) and signs, each with its Latin form.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ѕ": "s", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o",
    "р": "p", "т": "t", "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "ν": "v", "χ": "x", "ı": "i", "ſ": "s",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i", "l": "i"}
INVISIBLE = "­​‌‍⁠﻿*_'`"


def fold_table() -> dict[int, str | int | None]:
    """i, l, 1, ! and | become one letter, so that any of them may stand for any other."""
    table: dict[int, str | int | None] = {ord(k): DIGITS.get(v, v) if v in "li" else v for k, v in LOOKALIKES.items()}
    table |= {ord(k.upper()): v for k, v in LOOKALIKES.items() if len(k.upper()) == 1 and k not in "ıſ"}
    table |= {ord(k): v for k, v in DIGITS.items()}
    table |= {ord(c): ("i" if c in "IL" else c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    table |= {0xFF21 + i: ("i" if c in "il" else c) for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")}
    table |= {0xFF41 + i: ("i" if c in "il" else c) for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")}
    table |= {ord(c): None for c in INVISIBLE}
    table |= {ord(c): " " for c in '\t\n\r\x0b\x0c.,;:?"()[]{}<>/\\-'}
    return table


FOLD = fold_table()
#: Signs that stand for letters do so inside words alone.
AFTER_WORD = re.compile(r"[!|]+(?!\w)")


def fold(text: str) -> str:
    """Folded text with a blank at either end."""
    if "!" in text or "|" in text:
        text = AFTER_WORD.sub(" ", text)
    folded = text.translate(FOLD)
    return f" {folded if folded.isascii() else folded.lower()} "


@dataclass
class Lexicon:
    """Folded terms with weights; a term ends in a blank if it is a whole word, else it is a beginning."""

    weights: dict[str, float]
    curve: tuple[float, float] = (-4.0, 3.0)
    exceptions: tuple[str, ...] = EXCEPTIONS
    built: object = field(default=None, repr=False, compare=False)

    def automaton(self):
        if self.built is None:
            self.built = ahocorasick.Automaton()
            for phrase in self.exceptions:
                term = f" {fold(phrase).strip()} "
                self.built.add_word(term, (len(term), 0.0))
            for term, weight in self.weights.items():
                self.built.add_word(f" {term}", (len(term) + 1, weight))
            self.built.make_automaton()
        return self.built

    def strength(self, text: str) -> float:
        """Summed weights of the hits over the root of the length in words, and a share that length can't dilute."""
        folded = fold(text)
        hits, covered = [], []
        for end, (size, weight) in self.automaton().iter(folded):
            (hits if weight else covered).append((end - size + 1, end, weight))
        if covered:
            hits = [h for h in hits if not any(s <= h[0] and h[1] <= e for s, e, _ in covered)]
        # of a word's beginnings and the word itself the heaviest counts
        best: dict[int, float] = {}
        for start, _, weight in hits:
            best[start] = max(best.get(start, 0.0), weight)
        total = sum(best.values())
        if not total:
            return 0.0
        return math.log1p(total) * (0.5 + 0.5 / math.sqrt(1 + folded.count(" ") / 200))

    def score(self, text: str) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-(a + b * self.strength(text))))


def terms_of(text: str) -> set[str]:
    """Folded words (with a blank behind) and their beginnings of four to seven letters."""
    found = set()
    for word in fold(text).split():
        found.add(word + " ")
        found.update(word[:n] for n in (4, 5, 6, 7) if n < len(word))
    return found


def learn_terms(rows: list[tuple[str, int]], least_share: float = 0.02, most_terms: int = 400) -> dict[str, float]:
    """Terms at least 30 times as common in toxic texts as in others.

    The commonest come first, and of equally common ones the longest, so that a beginning is taken only
    if it stands for clearly more texts than any word that it begins.
    """
    n = Counter(y for _, y in rows)
    least = max(4, math.ceil(least_share * n[1]))
    seen = (Counter(), Counter())
    for text, y in rows:
        seen[y].update(terms_of(text))
    scored = []
    for term, toxic in seen[1].items():
        if toxic >= least:
            ratio = ((toxic + 0.5) / (n[1] + 1)) / ((seen[0][term] + 0.5) / (n[0] + 1))
            if ratio >= 30 and toxic >= 20 * seen[0][term]:
                scored.append((term, toxic, ratio))
    chosen: dict[str, float] = {}
    longest = {t: max((k for q, k, _ in scored if q != t and q.startswith(t)), default=0) for t, _, _ in scored}
    for term, toxic, ratio in sorted(scored, key=lambda x: (-x[1], -len(x[0]), x[0])):
        covered = any(term.startswith(c) for c in chosen if not c.endswith(" "))
        if len(chosen) < most_terms and not covered and toxic >= 1.3 * longest[term]:
            chosen[term] = round(min(3.0, math.log(ratio) / 2), 4)
    return chosen


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """Logistic regression on one feature by Newton steps."""
    w = np.array([-2.0, 2.0])
    design = np.stack([np.ones_like(x), x], 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (y - p) - ridge * (w - [-2.0, 2.0])
        w = w + np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2), gradient)
    return float(w[0]), float(w[1])


def learn(rows: list[tuple[str, int]]) -> Lexicon:
    """Lexicon and curve from labelled texts; with too few of either label, the fixed ones."""
    weights = {fold(t).strip() + " ": w for t, w in SEED_TERMS.items()}
    n = Counter(y for _, y in rows)
    if min(n[0], n[1]) < 5:
        return Lexicon(weights)
    lexicon = Lexicon(weights | learn_terms(rows))
    x = np.array([lexicon.strength(t) for t, _ in rows])
    lexicon.curve = fit_curve(x, np.array([y for _, y in rows], float))
    if lexicon.curve[1] <= 0:
        lexicon.curve = Lexicon.curve
    return lexicon


def held_out(doc_id: str | Column) -> Column:
    """Rows that learning never sees, by their id; false for a row without one, which has no label either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, max_rows: int = 3000) -> list[tuple[str, int]]:
    """Texts and labels of up to ``max_rows`` training rows, the first by a hash of the id.

    The bound on rows makes the id list small enough to broadcast.  Rows with a null id, label or text
    are left out; of several labels of an id the largest counts, of several texts the least, so that an id
    that is repeated however often is one row.
    """
    chosen = labels.select("doc_id", "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id"))
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    return [(r["text"], int(r["toxic"] > 0)) for r in sorted(rows, key=lambda r: r["doc_id"])]


def score_toxicity(docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1) and predicted (1 from 0.5 on).

    A null or empty text has no hits and gets the curve's lowest score.  Repeated rows score alike;
    labels, languages and other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([lexicon.score(t.as_py() or "") for t in batch.column(1)], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")
