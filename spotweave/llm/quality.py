"""Quality rules: distribution divergence of a document from language references.

A document gets two histograms: character classes and common words.  The references are the summed
histograms of all documents of a language, so they cover the whole table and are a few hundred
numbers.  A document is kept if some language reference is near to it in Jensen-Shannon distance on
both histograms.  Short documents have noisy histograms: below ``min_chars`` / ``min_words`` a
histogram is not judged, and above them the limit shrinks with the length towards its asymptote.

Both passes are maps over Arrow batches; the only shuffle holds one row per task, language and
histogram cell.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.llm.batches import steps

# The commonest function words of the reference languages.
COMMON_WORDS = {
    "en": "the of and to in a is that it for was with be by on an are this from or which at as have not",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero",
    "it": "di e il la che in a per un è del le si con non una da i dei al come nel più ha",
    "nl": "de van een en het in is dat op te zijn met voor niet aan er om ook als bij maar door naar",
    "pt": "de a o que e do da em um para com não uma os no se na por mais as dos como mas",
}
STRIP = b".,;:!?\"'()[]{}-"
SYMBOLS = b"#*$%&|<>"
#: lower, upper, digit, blank, newline, sentence punctuation, symbols, other ASCII, beyond ASCII
N_CLASSES = 9
VOCABULARY = sorted({w.encode() for words in COMMON_WORDS.values() for w in words.split()})
N_CELLS = N_CLASSES + len(VOCABULARY) + 1


def _class_table() -> np.ndarray:
    table = np.full(256, 7, np.uint8)
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    for codes, value in ((b" \t\x0b\x0c\r", 3), (b"\n", 4), (b".,;:!?'\"()-", 5), (SYMBOLS, 6)):
        table[list(codes)] = value
    table[0xC0:] = 8
    table[0x80:0xC0] = N_CLASSES  # continuation bytes: no code point of their own
    return table


CLASS_OF_BYTE = _class_table()


@dataclass(frozen=True)
class QualityLimits:
    """Parameters of the rules; the limits are Jensen-Shannon distances (base 2)."""

    min_words: int = 20
    max_repeat_percent: int = 30
    min_chars: int = 200
    min_judged_words: int = 40
    char_limit: float = 0.14
    char_slack: float = 1.7  # added to the limit as slack / sqrt(length)
    word_limit: float = 0.30
    word_slack: float = 0.6


def class_counts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Code points by class, one row per document."""
    n = len(offsets) - 1
    rows = np.repeat(np.arange(n, dtype=np.int64) * (N_CLASSES + 1), np.diff(offsets))
    rows += CLASS_OF_BYTE[data]
    return np.bincount(rows, minlength=n * (N_CLASSES + 1)).reshape(n, N_CLASSES + 1)[:, :N_CLASSES]


_CELL_OF_WORD = {w: i for i, w in enumerate(VOCABULARY)}
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def word_counts(text: bytes) -> np.ndarray:
    """Histogram of common words, punctuation and case aside; the last cell has all other words."""
    other = len(VOCABULARY)
    found = list(map(_CELL_OF_WORD.get, text.translate(_LOWER, STRIP).split(), repeat(other)))
    return np.bincount(np.array(found, np.int64), minlength=other + 1)


def word_ids(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    return np.array([numbers[w] for w in words], np.int64)


def repeated_words(ids: np.ndarray, width: int = 8) -> int:
    """Words that lie in a window of ``width`` words found at least twice in the text.

    Window names double in width by ranking pairs of names, so that equal names mean equal windows.
    """
    n, names, span = len(ids), ids, 1
    if n <= width:
        return 0
    while span < width:
        pairs = names[: len(names) - span] * (names.max() + 1) + names[span:]
        _, names, times = np.unique(pairs, return_inverse=True, return_counts=True)
        span *= 2
        if len(times) == len(pairs):
            return 0
    edges = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(times[names] > 1)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges)[:n] > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if not line.isspace() and line]
    return len(lines) - len(set(lines))


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (root of the divergence, base 2) of each row of p from q."""
    p, q = p.astype(float), q.astype(float)
    p = p / np.maximum(p.sum(-1, keepdims=True), 1)
    q = q / max(q.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(-1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(-1)
    return np.sqrt(np.maximum(left + right, 0) / 2)


def near_some_reference(classes: np.ndarray, words: np.ndarray, references: dict[str, np.ndarray], limits: QualityLimits) -> np.ndarray:
    """Whether some language is near on both histograms; without references all are."""
    n_chars, n_words = classes.sum(1), words.sum(1)
    if not references:
        return np.ones(len(classes), bool)
    near = np.zeros(len(classes), bool)
    for cells in references.values():
        by_char = js_distance(classes, cells[:N_CLASSES]) <= limits.char_limit + limits.char_slack / np.sqrt(np.maximum(n_chars, 1))
        by_word = js_distance(words, cells[N_CLASSES:]) <= limits.word_limit + limits.word_slack / np.sqrt(np.maximum(n_words, 1))
        near |= (by_char | (n_chars < limits.min_chars)) & (by_word | (n_words < limits.min_judged_words))
    return near


def language_references(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Summed histograms of all documents of each language of COMMON_WORDS found in the table.

    At most one row of N_CELLS numbers per language of that fixed list comes to the driver.  Every language that
    any document is labelled with gives a reference, so that a single document of its language is its own and
    is never rejected by it; no least number of documents is asked for.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for low, high, offsets, data in steps(batch.column(1)):
                classes, raw = class_counts(offsets, data), data.tobytes()
                for i in range(high - low):
                    cells = word_counts(raw[offsets[i] : offsets[i + 1]])
                    total = sums.setdefault(langs[low + i], np.zeros(N_CELLS, np.int64))
                    total[:N_CLASSES] += classes[i]
                    total[N_CLASSES:] += cells
        for key, cells in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([key] * N_CELLS), pa.array(np.arange(N_CELLS)), pa.array(cells)], ["lang", "cell", "n"])

    of_known = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(F.col("lang").isin(*COMMON_WORDS))
    rows = of_known.mapInArrow(partial, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).collect()
    found: dict[str, np.ndarray] = {}
    for row in rows:
        found.setdefault(row["lang"], np.zeros(N_CELLS, np.int64))[row["cell"]] = row["n"]
    return {k: found[k] for k in sorted(found)}


def judge(column: pa.Array, references: dict[str, np.ndarray], limits: QualityLimits) -> dict[str, np.ndarray]:
    """Counts and verdicts of a column of texts."""
    n = len(column)
    out = {k: np.zeros(n, np.int64) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    near = np.ones(n, bool)
    for low, high, offsets, data in steps(column):
        classes, raw = class_counts(offsets, data), data.tobytes()
        words = np.zeros((high - low, len(VOCABULARY) + 1), np.int64)
        for i in range(high - low):
            text = raw[offsets[i] : offsets[i + 1]]
            words[i], ids = word_counts(text), word_ids(text.split())
            out["n_words"][low + i] = len(ids)
            out["n_dup_lines"][low + i] = repeated_lines(text)
            out["n_repeat_words"][low + i] = repeated_words(ids)
        out["word_chars"][low:high] = classes.sum(1) - classes[:, 3] - classes[:, 4]
        out["n_symbols"][low:high] = classes[:, 6]
        near[low:high] = near_some_reference(classes, words, references, limits)
    failed = (out["n_words"] < limits.min_words) | (100 * out["n_repeat_words"] > limits.max_repeat_percent * out["n_words"])
    return out | {"base_failed": failed, "kept": near & ~failed}


def score_quality(docs: DataFrame, limits: QualityLimits = QualityLimits(), doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per input row: counts, ``base_failed`` and ``kept``.

    Words are runs of bytes other than space and \\t..\\r.  A null or empty text has no words and so
    fails the base rules.  Null languages and languages outside COMMON_WORDS give no reference, but
    their documents are judged like all others; without any reference the method rejects nothing.
    Repeated rows are judged alike, each by itself.  Other columns of ``docs`` are not read.
    """
    references = language_references(docs, text, lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = judge(batch.column(1), references, limits)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in found.values())], ["doc_id", *found])

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def keep_quality(docs: DataFrame, limits: QualityLimits = QualityLimits(), text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs``, with all their columns, that the rules keep; a map without a shuffle."""
    references, at = language_references(docs, text, lang), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(judge(batch.column(at), references, limits)["kept"]))

    return docs.mapInArrow(run, docs.schema)
