"""Exact removal of repeated byte strings by merging Burrows-Wheeler transforms.

A byte is removed if a string of LENGTH bytes over it also starts earlier in the corpus.

1. Candidates.  Every window of LENGTH bytes has a minimizer: its K-byte gram of least hash.  Equal windows
   have equal minimizers, so a window can repeat only among spans (a run of windows with one minimizer) of
   one fingerprint.  Spans equal as a whole are one text: of these all but the earliest are removed at once.
2. Where a fingerprint has unlike spans, its distinct spans are compared window by window.  A task cuts its
   spans into shards, sorts each shard's suffixes into a Burrows-Wheeler transform, and merges the transforms
   of all shards by interleave refinement: each round moves the interleave STRIDE symbols to the left by the
   shards' own LF mappings and gives the common prefixes of neighbours that it parts, so that in the end
   suffixes with a common prefix of LENGTH bytes form one interval.  No suffix is sorted again.  In each
   interval all windows but the earliest repeat.
3. The removed intervals meet their texts by document.

A fingerprint of more than HOT spans would be too much for one task; its windows go one by one through a
hash aggregation instead, which is as exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spotweave.llm.batches import steps

LENGTH, K = 100, 32
STRIDE = 4  # symbols by which a round of the merge goes to the left
SHARD_BYTES, MERGE_BYTES, HOT = 16_384, 32_768, 20_000
PLACE_BITS = 40  # of a window's least hash, the low bits hold the gram's place; no text is as long

_random = np.random.default_rng(97)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all strings of ``size`` bytes (a sum of powers of two), by doubling."""
    have, width, out, done = _BYTE[data], 1, None, 0
    while width <= size:
        if size & width:
            if out is None:
                out, done = have, width
            else:
                n = len(data) - done - width + 1
                out = out[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + have[done : done + n]
                done += width
        have = have[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + have[width:] if len(have) > width else have[:0]
        width *= 2
    return _mixed(out[: max(0, len(data) - size + 1)])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    n, size = len(x) - width + 1, 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:n], x[width - size : width - size + n])


def spans_of(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each span: fingerprint, row, first window (from the text's start), windows, hash of its bytes."""
    none = np.zeros(0, np.int64)
    sizes = np.diff(offsets) - LENGTH + 1
    rows = np.flatnonzero(sizes > 0)
    if not len(rows):
        return (none,) * 5
    prints = gram_hashes(data, K)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    least = sliding_least((prints & ~mask) | np.arange(len(prints), dtype=np.uint64), LENGTH - K + 1) & mask
    count = sizes[rows]
    row = np.repeat(rows, count)
    start = np.arange(count.sum()) + np.repeat(offsets[rows] - (np.cumsum(count) - count), count)
    place = least[start].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])]))
    windows = np.diff(np.append(first, len(start)))
    low = start[first]
    high = low + windows + LENGTH - 1
    terms = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * _powers(_INVERSE, len(data)))])
    whole = _mixed((terms[high] - terms[low]) * _powers(_BASE, len(data) + 1)[high] + windows.astype(np.uint64))
    return prints[place[first]].view(np.int64), row[first], low - offsets[row[first]], windows, whole.view(np.int64)


# ---- merging transforms -------------------------------------------------------------------------


def shard_transform(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and transform of texts that each end in a zero symbol; equal suffixes sort by text number.

    Symbols are bytes + 1, so that the ends are least.  Suffixes are ranked by their first five symbols, and
    then by doubling prefixes; a key's low bits are the suffix's place, so that any sort of keys is stable.
    """
    data = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8).astype(np.int64) + 1
    lengths = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(lengths) - 1
    data[ends] = 0
    n, bits = len(data), len(data).bit_length()
    left, place = np.repeat(ends, lengths) - np.arange(n), np.arange(n)
    key, width = data, 5
    padded = np.append(data, np.zeros(width, np.int64))
    for k in range(1, width):
        key = key << 8 | np.where(left >= k, padded[k : k + n], 0)
    while True:
        ranked = np.sort(key << bits | place)
        order, ranked = ranked & ((1 << bits) - 1), ranked >> bits
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]))
        if rank[order[-1]] == n - 1 or width >= lengths.max():
            break
        follow = np.where(left >= width, np.append(rank[width:], np.zeros(min(n, width), np.int64)) + 1, 0)
        key = rank << bits | follow
        width *= 2
    before = data[order - 1]
    before[np.isin(order, np.concatenate([[0], ends[:-1] + 1]))] = 0
    return order, before


def merged_prefixes(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(shared, text, place, room) of all suffixes in the order of their first LENGTH symbols.

    ``shared`` is the prefix that a suffix has in common with the one before, in whole strides; ``room`` is
    its length.  Equal prefixes stand in no fixed order, and neither do suffixes shorter than LENGTH.

    The transforms of the shards are merged by refining their interleave.  A round takes the interleave, sorted
    by so many symbols, STRIDE symbols to the left by the shards' LF mapping, applied STRIDE times, and deals it
    out, in order, by these symbols; then it is sorted by STRIDE symbols more.  Where a round first parts two
    neighbours, their common prefix is known.
    """
    shards, size = [[]], 0
    for i, text in enumerate(texts):
        if size > SHARD_BYTES:
            shards.append([])
            size = 0
        shards[-1].append(i)
        size += len(text) + 1
    places, owners, rooms, symbols, moves, base = [], [], [], [], [], 0
    for numbers in shards:
        order, before = shard_transform([texts[i] for i in numbers])
        lengths = np.array([len(texts[i]) + 1 for i in numbers])
        owner = np.repeat(np.arange(len(numbers)), lengths)
        start = np.cumsum(lengths) - lengths
        places.append(order - start[owner[order]])
        owners.append(np.array(numbers)[owner[order]])
        rooms.append(lengths[owner[order]] - 1 - places[-1])
        symbols.append(before)
        # LF mapping: the symbols' stable order gives the places of the suffixes one symbol longer; texts' ends map
        # to ends, so that it is a permutation; what lies beyond an end is never looked at
        lf = np.empty(len(order), np.int64)
        lf[np.argsort(before.astype(np.uint8), kind="stable")] = np.arange(len(order))
        moves.append(lf + base)
        base += len(order)
    # bytes of UTF-8 are below 248, so that a symbol fits a byte
    lf, symbol = np.concatenate(moves), np.concatenate(symbols)
    key, move = symbol, lf
    for k in range(1, STRIDE):
        key, move = key | symbol[move] << 8 * k, lf[move]
    # few of the possible strides occur, so that their ranks mostly fit two bytes, whose stable sort is two counting passes
    seen, key = np.unique(key, return_inverse=True)
    key, move = key.astype(np.min_scalar_type(len(seen))), move.astype(np.int32)
    interleave, interval = np.arange(base, dtype=np.int32), np.zeros(base, np.int32)
    depth, cut, old = np.full(base, LENGTH, np.int16), np.zeros(base, bool), np.zeros(base, bool)
    for done in range(0, LENGTH, STRIDE):
        step = key[interleave]
        order = step.argsort(kind="stable")
        step, before, interleave = step[order], interval[order], move[interleave[order]]
        np.not_equal(step[1:], step[:-1], out=cut[1:])
        cut[1:] |= before[1:] != before[:-1]
        depth[cut & ~old] = done
        cut, old = old, cut
        np.cumsum(old, out=interval)
    depth[0] = 0
    return depth, np.concatenate(owners)[interleave], np.concatenate(places)[interleave], np.concatenate(rooms)[interleave]


def merged_intervals(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(interval, text, place) of all windows of LENGTH bytes; windows of one interval are equal.

    An interval is a run of suffixes with common prefixes of LENGTH.
    """
    shared, text, place, room = merged_prefixes(texts)
    interval, full = np.cumsum(shared < LENGTH), room >= LENGTH
    return interval[full], text[full], place[full]


def repeated_windows(texts: list[bytes], docs: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """(doc, first byte, end) of runs of windows that have an equal window earlier by (doc, place)."""
    interval, text, place = merged_intervals(texts)
    if not len(interval):
        return []
    doc, at = docs[text], starts[text] + place
    order = np.lexsort((at, doc, interval))
    interval, doc, at = interval[order], doc[order], at[order]
    again = np.concatenate([[False], interval[1:] == interval[:-1]])
    first = np.maximum.accumulate(np.where(again, 0, np.arange(len(again))))
    again &= (doc != doc[first]) | (at != at[first])
    doc, at = doc[again], at[again]
    if not len(doc):
        return []
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order]
    head = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + 1)]))
    tail = np.append(head[1:], len(doc)) - 1
    return list(zip(doc[head].tolist(), at[head].tolist(), (at[tail] + LENGTH).tolist()))


# ---- the distributed operator -------------------------------------------------------------------


def _spans(texts: DataFrame) -> DataFrame:
    """(print, doc_id, at, windows, whole, copy) of all spans.

    Of equal spans of one batch all but the earliest are copies already; each gets a fingerprint of its own,
    so that a string repeated very often doesn't meet in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = batch.column(0).to_numpy(zero_copy_only=False), []
            for low, _, offsets, data in steps(batch.column(1), 1 << 19):
                prints, row, at, windows, whole = spans_of(offsets, data)
                parts.append((prints, ids[row + low], at, windows, whole))
            if not parts:
                continue
            prints, doc, at, windows, whole = (np.concatenate(x).astype(np.int64) for x in zip(*parts))
            order = np.lexsort((at, doc, windows, whole, prints))
            prints, doc, at, windows, whole = (x[order] for x in (prints, doc, at, windows, whole))
            same = np.zeros(len(order), bool)
            same[1:] = (prints[1:] == prints[:-1]) & (whole[1:] == whole[:-1]) & (windows[1:] == windows[:-1])
            first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
            copy = (doc != doc[first]) | (at != at[first])
            own = _mixed(doc.view(np.uint64) * np.uint64(_BASE) + at.view(np.uint64)).view(np.int64)
            prints[copy] = own[copy]
            whole[copy] = own[copy]
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (prints, doc, at, windows, whole)), pa.array(copy)], ["print", "doc_id", "at", "windows", "whole", "copy"])

    return texts.mapInArrow(run, "print long, doc_id long, at long, windows long, whole long, copy boolean")


def _span_bytes(chosen: DataFrame) -> DataFrame:
    """(print, hot, doc_id, at, bytes) of the spans listed by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part, rows = batch.slice(low, 256), []
                for doc, text, spans in zip(*(part.column(i).to_pylist() for i in range(3))):
                    raw = text.encode()
                    rows += [(s["print"], s["hot"], doc, s["at"], raw[s["at"] : s["at"] + s["windows"] + LENGTH - 1]) for s in spans]
                columns = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()))], ["print", "hot", "doc_id", "at", "bytes"])

    return chosen.mapInArrow(run, "print long, hot boolean, doc_id long, at long, bytes binary")


def _merge(spans: DataFrame) -> DataFrame:
    """(doc_id, low, high) of the windows that repeat, fingerprint by fingerprint in each task."""

    def found(rows: list[tuple]) -> pa.RecordBatch:
        runs = repeated_windows([r[3] for r in rows], np.array([r[1] for r in rows]), np.array([r[2] for r in rows])) if rows else []
        columns = list(zip(*runs)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if size > MERGE_BYTES and row[0] != last:
                    yield found(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
                last = row[0]
        yield found(held)

    parted = spans.select("print", "doc_id", "at", "bytes").repartition("print").sortWithinPartitions("print")
    return parted.mapInArrow(run, "doc_id long, low long, high long")


def _windows(spans: DataFrame) -> DataFrame:
    """(doc_id, low, high) of repeated windows of very common fingerprints, by hash aggregation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, at, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                names = [hashlib.blake2b(raw[i : i + LENGTH], digest_size=16).digest() for i in range(len(raw) - LENGTH + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([doc] * len(names), pa.int64()), pa.array(range(at, at + len(names)), pa.int64())], ["name", "doc_id", "low"])

    each = spans.select("doc_id", "at", "bytes").mapInArrow(run, "name binary, doc_id long, low long")
    earliest = each.groupBy("name").agg(F.min(F.struct("doc_id", "low")).alias("first"), F.count("*").alias("n")).where("n > 1")
    return each.join(earliest, "name").where(F.struct("doc_id", "low") != F.col("first")).select("doc_id", "low", (F.col("low") + LENGTH).alias("high"))


def _digest(rows: DataFrame) -> DataFrame:
    """The result for each text and its packed intervals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part, out = batch.slice(low, 256), []
                for text, packed in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    raw = (text or "").encode()
                    if not packed:
                        out.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest()))
                        continue
                    bounds = np.array(packed, np.int64)
                    edges = np.zeros(len(raw) + 1, np.int64)
                    np.add.at(edges, np.minimum(bounds >> 32, len(raw)), 1)
                    np.add.at(edges, np.minimum(bounds & 0xFFFFFFFF, len(raw)), -1)
                    gone = np.cumsum(edges)[:-1] > 0
                    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                    left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    out.append((len(raw), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
                columns = list(zip(*out)) or [()] * 4
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.string() if i == 3 else pa.int64()) for i, c in enumerate(columns))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def removed_intervals(texts: DataFrame) -> DataFrame:
    """(doc_id, low, high): byte intervals to remove; they overlap and together are what repeats."""
    by_print, by_span = Window.partitionBy("print"), Window.partitionBy("print", "whole", "windows")
    place = F.struct("doc_id", "at")
    spans = _spans(texts).withColumn("place", place).repartition("print")
    seen = spans.withColumn("first", F.min("place").over(by_span))
    seen = seen.withColumns({"n": F.count("*").over(by_print), "least": F.min("whole").over(by_print), "most": F.max("whole").over(by_print)}).where("copy OR n > 1")
    copies = seen.where("copy OR place != first").select("doc_id", F.col("at").alias("low"), (F.col("at") + F.col("windows") + (LENGTH - 1)).alias("high"))
    unlike = seen.where("NOT copy AND place = first AND least != most")
    listed = unlike.groupBy("doc_id").agg(F.collect_list(F.struct("print", (F.col("n") > HOT).alias("hot"), "at", "windows")).alias("spans"))
    parts = _span_bytes(texts.join(listed, "doc_id"))
    merged = _merge(parts.where("NOT hot")).unionByName(_windows(parts.where("hot")))
    return copies.unionByName(merged)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes, a null text is empty, and matches never cross texts.  Earlier is a smaller
    doc_id, or in one document an earlier byte.  A row without an id takes no part: nothing is removed from
    it or because of it.  Repeated rows of an id are one document and get equal results; ids are taken to name
    one text, and intervals that lie beyond a row's text do nothing.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    takes_part = F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    usable = texts.where(takes_part)
    packed = F.shiftleft("low", 32) + F.col("high")
    intervals = removed_intervals(usable).groupBy("doc_id").agg(F.collect_list(packed).alias("packed"))
    # the texts meet their spans and their intervals by one and the same shuffle
    joined = usable.join(intervals, "doc_id", "left").select("doc_id", "text", "packed")
    return _digest(joined).unionByName(_digest(texts.where(~takes_part).withColumn("packed", F.lit(None).cast("array<bigint>"))))
