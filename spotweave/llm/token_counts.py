"""Token counts of a byte-level BPE with word ends, by rank-synchronous array merging.

A batch's unseen words are pre-tokenised and laid end to end as one ragged array of symbols.  In each
round every sequence finds its lowest-rank neighbouring pair and all its occurrences merge at once,
left to right; a sequence without a known pair is done, and its surviving symbols are its tokens.
Counts of words are kept in a dictionary of bounded size, so a repeated word costs one look-up.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.llm.batches import steps

CACHED_WORDS = 500_000
SHIFT = 1 << 20
ENDS = {".", ",", ";", ":", "!", "?"}


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable Latin-1, else 256 + i."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class WordBpe:
    """Tables of a vocabulary file: symbols of bytes, and pairs sorted by key with rank and result."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        names = byte_symbols()
        self.inner = np.array([vocab[c] for c in names])
        self.final = np.array([vocab[c + suffix] for c in names])
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * SHIFT + vocab[b] for a, b in merges])
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.made = np.array([vocab[a + b] for a, b in merges])
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.split_special = regex.compile("|".join(map(regex.escape, self.special)))
        self.split_words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.counts: dict[bytes, int] = {}

    def pre_tokens(self, word: bytes) -> tuple[int, list[bytes]]:
        """Number of special tokens in a piece of text, and its pre-tokens."""
        text = word.decode("utf-8", "replace")
        special = 0
        if "<|" in text:
            special = len(self.split_special.findall(text))
            text = self.split_special.sub("\n", text)  # a text is normalised between special tokens
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # str.lower() minds the place of a capital sigma in its word; the library doesn't
        text = text.lower() if "\u03a3" not in text else "".join(c.lower() for c in text)
        if text.isalpha():
            return special, [text.encode()]
        if text[-1:] in ENDS and text[:-1].isalpha():
            return special, [text[:-1].encode(), text[-1:].encode()]
        return special, [t.encode() for t in self.split_words.findall(text)]

    def merge(self, tokens: list[bytes]) -> np.ndarray:
        """Surviving symbols of each pre-token."""
        sizes = np.array([len(t) for t in tokens])
        raw = np.frombuffer(b"".join(tokens), np.uint8)
        ends = np.cumsum(sizes)
        symbols = self.inner[raw]
        symbols[ends - 1] = self.final[raw[ends - 1]]
        owner = np.repeat(np.arange(len(tokens)), sizes)
        counts = sizes.copy()
        none = len(self.keys)
        rank = self.pair_ranks(symbols, owner, np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.minimum.reduceat(rank, starts)
            alive = lowest < none
            spans = np.diff(np.append(starts, len(symbols)))
            if not alive.all():  # finished sequences leave the arrays
                stay = np.repeat(alive, spans)
                symbols, owner, rank, spans, lowest = symbols[stay], owner[stay], rank[stay], spans[alive], lowest[alive]
                if not len(symbols):
                    break
            hit = rank == np.repeat(lowest, spans)
            # a run of overlapping hits merges its first, third, fifth, ...
            begin = hit & ~np.concatenate([[False], hit[:-1]])
            position = np.arange(len(hit))
            hit &= (position - np.maximum.accumulate(np.where(begin, position, 0))) % 2 == 0
            symbols[hit] = self.made[rank[hit]]
            counts -= np.bincount(owner[hit], minlength=len(counts))
            stay = ~np.concatenate([[False], hit[:-1]])
            symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
            change = hit[stay]  # ranks change at merged symbols and just before them
            change[:-1] |= change[1:].copy()
            at = np.flatnonzero(change)
            rank[at] = self.pair_ranks(symbols, owner, at)
        return counts

    def pair_ranks(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pairs that begin at the given places; pairs across sequences have none."""
        none, last = len(self.keys), len(symbols) - 1
        follow = np.minimum(at + 1, last)
        key = np.where((owner[follow] == owner[at]) & (at < last), symbols[at] * SHIFT + symbols[follow], -1)
        found = np.searchsorted(self.keys, key)
        found[found == none] = 0
        return np.where(self.keys[found] == key, self.ranks[found], none)

    def learn(self, words: list[bytes]) -> None:
        """Counts the tokens of words not counted before."""
        for low in range(0, len(words), 20_000):
            part = words[low : low + 20_000]
            found = [self.pre_tokens(w) for w in part]
            tokens = [t for _, pieces in found for t in pieces]
            total = np.array([special for special, _ in found], np.int64)
            if tokens:
                owner = np.repeat(np.arange(len(part)), [len(pieces) for _, pieces in found])
                np.add.at(total, owner, self.merge(tokens))
            self.counts.update(zip(part, total.tolist()))

    def count(self, texts: list[bytes]) -> list[int]:
        """Tokens of each text.  White space parts pre-tokens always, so texts are counted by word."""
        parted = [t.split() for t in texts]
        new = list({w for words in parted for w in words if w not in self.counts})
        if len(self.counts) + len(new) > CACHED_WORDS:
            self.counts.clear()
            new = list({w for words in parted for w in words})
        self.learn(new)
        find = self.counts.__getitem__
        return [sum(map(find, words)) for words in parted]


@lru_cache(maxsize=1)
def load(path: str) -> WordBpe:
    """The tables and counted words of a vocabulary, kept by each Python worker from task to task."""
    return WordBpe(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    ``vocabulary`` is the path of the file on every machine; it is read once per task.  A null or
    empty text has no bytes and no tokens; repeated rows count alike; other columns are not read.  Texts are
    counted whole; the time is in proportion to their bytes, but for single words of tens of thousands of bytes,
    whose rounds of merges grow with their distinct pairs (some 4 seconds for a word of 128 KB).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            n_bytes, n_tokens = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for low, high, offsets, data in steps(batch.column(1), 1 << 20):
                raw = data.tobytes()
                n_bytes[low:high] = np.diff(offsets)
                n_tokens[low:high] = bpe.count([raw[offsets[i] : offsets[i + 1]] for i in range(high - low)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
