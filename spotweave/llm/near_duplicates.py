"""MinHash near-duplicates by a chosen-path similarity join.

A document's set is its distinct five-word shingles as 64-bit hashes, and its minwise tokens are the
least values of SIZE or more hash functions over the set.  Equal sets are one class and are represented by
one member, so thousands of exact copies cost one row.

1. Paths.  Each of some independent trees branches the representatives by one minwise token a level: those
   with equal tokens so far share a node.  A node of weight LEAF or less is a leaf; a heavier one branches on,
   down to DEPTH levels.  A frontier row is a node and a number, never a text or a signature.
2. Leaves.  All members of a leaf are compared by sketches, one byte of each minwise token.  From each leaf
   come the edges of a spanning forest of those that look near, so fewer rows than members.  Their components
   are loose: they hold every link that some leaf saw, and more.
3. Links.  Members of a loose component meet once with their whole texts, in one task, and are compared
   exactly on their full sets.  A loose component heavier than LEAF is compared leaf by leaf instead.  Either
   gives the edges of a spanning forest of true links, and these become the components.
4. Nodes still too heavy at the last level hold masses of near copies.  They are cut into blocks, each with the
   node's pivot; a block is a leaf like any other.  Then only members outside the node's largest component
   are compared with the others, block by block, so that no link is lost to the cuts.

Nothing that is emitted grows faster than the members, but for the rows of the last step, which are strays and
members by block.  A leaf's weight bounds what one task holds: LEAF documents, or LEAF * UNIT shingles.

A pair of similarity s shares a node of depth d in a tree with probability s**d.  There are as many trees as
let a pair at the limit that needs all DEPTH levels be missed once in 1 / MISS at most: fifteen at a limit of
0.85, 21 at 0.80.  Each level of each tree has a token of its own.  Most leaves lie at depth one, where such a
pair is missed once in a thousand billion.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.llm.batches import steps, whole_groups
from spotweave.llm.components import connected_components
from spotweave.storage import release, small_side, stored

WIDTH = 5  # words of a shingle
SIZE = 64  # minwise tokens, at least
DEPTH, LEAF, UNIT = 4, 4096, 1024
MISS = 1 / 60_000  # share of the pairs at the limit that all trees may miss at the last level
LOOKS_NEAR = 0.23  # how far below the limit an estimate may be: five standard deviations

_random = np.random.default_rng(20240501)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PRIME, _BASE_P = np.uint64((1 << 31) - 1), 16_807
_INVERSE_P = pow(_BASE_P, -1, (1 << 31) - 1)
_PLACE = _random.integers(1, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = _random.integers(1, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _random.integers(0, 1 << 63, SIZE, dtype=np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tree_count(limit: float) -> int:
    """The least number of independent trees that miss a pair at the limit, at the last level, with probability MISS at most."""
    miss = 1 - limit**DEPTH
    return 1 if miss <= MISS else math.ceil(math.log(MISS) / math.log(miss))


def token_count(limit: float) -> int:
    """Minwise tokens of a set: one for each level of each tree, so that no two trees are alike."""
    return max(SIZE, tree_count(limit) * DEPTH)


def hash_functions(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and shifts; the first SIZE are the same for any size."""
    more = np.random.default_rng(20240502).integers(0, 1 << 63, (max(0, size - SIZE), 2), dtype=np.uint64)
    return np.concatenate([_FACTOR, more[:, 0] * np.uint64(2) + np.uint64(1)])[:size], np.concatenate([_SHIFT, more[:, 1]])[:size]


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def prime_powers(base: int, n: int) -> np.ndarray:
    """Powers of a base modulo the prime, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, int(_PRIME))) % _PRIME
        have += more
    return out[:n]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a buffer; A-Z count as a-z.

    A hash mixes two polynomials of the bytes, modulo 2**64 and modulo a prime: words made to collide in
    one don't in the other.
    """
    solid = np.concatenate([[False], ~_BLANK[data], [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    lower = _LOWER[data]
    terms = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[lower] * powers(_INVERSE, len(data)))])
    first = mixed((terms[ends] - terms[starts]) * powers(_BASE, len(data) + 1)[ends])
    terms = np.concatenate([[np.uint64(0)], np.cumsum((lower + np.uint64(1)) * prime_powers(_INVERSE_P, len(data)) % _PRIME)])
    second = (terms[ends] - terms[starts]) % _PRIME * prime_powers(_BASE_P, len(data) + 1)[ends] % _PRIME
    return starts, mixed(first + (second << np.uint64(32)) + (ends - starts).astype(np.uint64))


def shingle_sets(offsets: np.ndarray, data: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; with fewer words than WIDTH, one for all of them."""
    n = len(offsets) - 1
    padded = np.full(len(data) + n, 32, np.uint8)
    padded[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
    starts, words = word_hashes(padded)
    first = np.searchsorted(starts, offsets + np.arange(n + 1))
    full = np.zeros(max(0, len(words) - WIDTH + 1), np.uint64)
    for k in range(WIDTH):
        full += mixed(words[k : k + len(full)] * _PLACE[k])
    full = mixed(full)
    out = []
    for i in range(n):
        low, high = int(first[i]), int(first[i + 1])
        if high - low >= WIDTH:
            out.append(np.unique(full[low : high - WIDTH + 1]))
        elif high > low:
            few = words[low:high] * _PLACE[: high - low]
            out.append(mixed(np.array([mixed(few).sum() + np.uint64(high - low)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minwise(sets: list[np.ndarray], size: int = SIZE) -> np.ndarray:
    """The minwise tokens of each set, a row of ``size`` 32-bit numbers; an empty set gets zeros."""
    out = np.zeros((len(sets), size), np.uint32)
    factor, shift = hash_functions(size)
    some = np.flatnonzero([len(s) > 0 for s in sets])
    if len(some):
        flat = np.concatenate([sets[i] for i in some])
        starts = np.cumsum([0, *(len(sets[i]) for i in some[:-1])])
        for k in range(size):
            out[some, k] = np.minimum.reduceat(((flat * factor[k] + shift[k]) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def set_names(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit numbers that name each set."""
    return tuple(np.array([mixed(s * factor).sum() for s in sets], np.uint64).view(np.int64) for factor in _FACTOR[:2])


def signatures(docs: DataFrame, size: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, tokens, sketch): k1 and k2 name the set, tokens are ``size`` little-endian 32-bit numbers.

    A sketch has the low byte of each token.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for low, high, offsets, data in steps(batch.column(1), 1 << 18):
                sets = shingle_sets(offsets, data)
                tokens = minwise(sets, size)
                low_bytes = tokens.astype(np.uint8)
                k1, k2 = set_names(sets)
                columns = [ids.slice(low, high - low), pa.array([len(s) for s in sets], pa.int64()), pa.array(k1), pa.array(k2), *(pa.array([t.tobytes() for t in x], pa.binary()) for x in (tokens, low_bytes))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "k1", "k2", "tokens", "sketch"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long, tokens binary, sketch binary")


# ---- paths ----------------------------------------------------------------------------------------


def token_at(tree: Column, level: int) -> Column:
    """The token by which a tree branches at a level."""
    return F.substring("tokens", ((tree * DEPTH + level) * 4 + 1).cast("int"), F.lit(4))


def paths(reps: DataFrame, limit: float) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Leaves (grp, rep) of all trees; heavy nodes of the last level (node, rep, weight, all); what was stored for them."""
    light = (F.col("members") <= 2) | (F.col("all") <= LEAF)
    tree = F.explode(F.sequence(F.lit(0), F.lit(tree_count(limit) - 1)))
    frontier = reps.select("rep", "weight", "tokens", tree.alias("tree")).select("rep", "weight", "tree", F.xxhash64("tree", token_at(F.col("tree"), 0)).alias("node"))
    leaves, kept = None, []
    for level in range(DEPTH):
        sizes = frontier.groupBy("node").agg(F.count("*").alias("members"), F.sum("weight").alias("all")).where("members > 1")
        shared = stored(frontier.join(sizes, "node"))
        kept.append(shared)
        found = shared.where(light).select(F.col("node").alias("grp"), "rep")
        leaves = found if leaves is None else leaves.unionByName(found)
        heavy = shared.where(~light)
        if level + 1 == DEPTH or heavy.isEmpty():
            break
        frontier = heavy.drop("members", "all").join(reps.select("rep", "tokens"), "rep").select("rep", "weight", "tree", F.xxhash64("node", token_at(F.col("tree"), level + 1)).alias("node"))
    return leaves, heavy.select("node", "rep", "weight", "all"), kept


def block_of(all_weight: Column, share: int = 1) -> Column:
    """A member's block, of so many that each weighs about LEAF / share."""
    return F.pmod(F.xxhash64("rep", F.lit(7)), F.ceil(all_weight * share / LEAF))


def heavy_blocks(heavy: DataFrame) -> DataFrame:
    """Leaves (grp, rep) that cut heavy nodes into blocks, each with the node's pivot, drawn by hash."""
    draw = F.struct(F.xxhash64("node", "rep").alias("draw"), F.col("rep").alias("pivot"))
    pivots = heavy.groupBy("node").agg(F.min(draw).alias("drawn"), F.max("all").alias("all"))
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("all") / LEAF) - 1)).alias("block")
    pivots = pivots.select("node", F.col("drawn.pivot").alias("rep"), numbers)
    blocks = heavy.select("node", "rep", block_of(F.col("all")).alias("block")).unionByName(pivots).distinct()
    return blocks.select(F.xxhash64("node", "block").alias("grp"), "rep")


def stray_blocks(heavy: DataFrame, components: DataFrame) -> DataFrame:
    """Leaves (grp, rep) in which each member outside its heavy node's largest component meets all other members.

    A node's strays and its members are cut into blocks of LEAF / 2; each block of strays meets each of members.
    """
    named = heavy.join(components.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    sizes = named.groupBy("node", "component").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    main = sizes.groupBy("node").agg(F.max(F.struct("n", F.col("component").alias("main"), "w")).alias("m"), F.sum("w").alias("total"))
    main = main.select("node", "m.main", (F.col("total") - F.col("m.w")).alias("stray_weight")).where("stray_weight > 0")
    placed = named.join(main, "node")

    def numbered(weight: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(weight) * 2 / LEAF) - 1))

    few = placed.where("component <> main").select("node", "rep", block_of(F.col("stray_weight"), 2).alias("few"), numbered("all").alias("many"))
    many = placed.select("node", "rep", block_of(F.col("all"), 2).alias("many"), numbered("stray_weight").alias("few"))
    return few.unionByName(many).select(F.xxhash64("node", "few", "many").alias("grp"), "rep").distinct()


# ---- comparisons within one group -----------------------------------------------------------------


def joined(label: np.ndarray, near: np.ndarray) -> None:
    """Gives all members that ``near`` lists, and those labelled like one of them, one label."""
    old = np.unique(label[near])
    if len(old) > 1:
        label[np.isin(label, old)] = old[0]


def looks_near(sketches: np.ndarray, least: float) -> np.ndarray:
    """Labels of members by components of the pairs that agree on a share ``least`` of the bytes."""
    label = np.arange(len(sketches))
    for i in range(len(sketches) - 1):
        agree = (sketches[i + 1 :] == sketches[i]).sum(1)
        near = np.flatnonzero(agree >= least * sketches.shape[1]) + i + 1
        if len(near):
            joined(label, np.append(near, i))
    return label


def truly_near(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Labels of members by components of the pairs with 100 * intersection >= percent * union.

    The members of each shingle are listed; a member's overlaps with all others are counted from its lists.
    """
    n, sizes = len(sets), np.array([len(s) for s in sets])
    label = np.arange(n)
    if n == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        if 100 * common >= percent * (sizes.sum() - common):
            label[1] = 0
        return label
    first = np.concatenate([[0], np.cumsum(sizes)])
    order = np.argsort(flat := np.concatenate(sets), kind="stable")
    ranked = flat[order]
    start = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    count = np.diff(np.append(start, len(ranked)))
    run_of = np.empty(len(flat), np.int64)
    run_of[order] = np.repeat(np.arange(len(start)), count)
    owner = np.repeat(np.arange(n), sizes)[order]
    for i in range(n):
        runs = run_of[first[i] : first[i + 1]]
        runs = runs[count[runs] > 1]
        each = count[runs]
        places = np.repeat(start[runs] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        common = np.bincount(owner[places], minlength=n)
        joined(label, np.append(np.flatnonzero((common > 0) & (100 * common >= percent * (sizes[i] + sizes - common))), i))
        if (label == label[0]).all():
            break
    return label


def forest(reps: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) from each member to one of its label, fewer than members."""
    other = np.flatnonzero(label != np.arange(len(label)))
    return reps[other], reps[label[other]]


EDGES = "a long, b long"


def edge_batch(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = [np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found)] or [np.zeros(0, np.int64)] * 2
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["a", "b"])


def loose_edges(leaves: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    """Edges (a, b) of a spanning forest of each leaf's members that look near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bounds, table in whole_groups(batches):
            rep = table.column("rep").to_numpy()
            sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(rep), -1)
            found = []
            two = bounds[:-1][np.diff(bounds) == 2]
            two = two[(sketches[two] == sketches[two + 1]).sum(1) >= least * sketches.shape[1]]
            found.append((rep[two], rep[two + 1]))
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if high - low > 2:
                    found.append(forest(rep[low:high], looks_near(sketches[low:high], least)))
            yield edge_batch(found)

    members = leaves.join(reps.select("rep", "sketch"), "rep").select("grp", "rep", "sketch")
    return members.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, EDGES).where("a <> b").distinct()


def true_edges(groups: DataFrame, docs: DataFrame, percent: int, doc_id: str, text: str) -> DataFrame:
    """Edges (a, b) of a spanning forest of the true links within each group (grp, rep).

    Rows that repeat an id are one document: of unlike sets under one id the least by size and name is taken.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bounds, table in whole_groups(batches):
            rep = table.column("rep").to_numpy()
            sets = [s for _, _, offsets, data in steps(table.column("text"), 1 << 18) for s in shingle_sets(offsets, data)]
            found = []
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                own = {}
                for i in range(low, high):
                    if len(sets[i]) and (rep[i] not in own or set_order(sets[i]) < set_order(sets[own[rep[i]]])):
                        own[rep[i]] = i
                if len(own) > 1:
                    found.append(forest(np.array(list(own)), truly_near([sets[i] for i in own.values()], percent)))
            yield edge_batch(found)

    wanted = groups.select(F.col("rep").alias("wanted")).distinct()
    texts = docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).alias("text")).join(small_side(wanted), F.col("rep") == F.col("wanted"), "left_semi").distinct()
    members = groups.join(texts, "rep").select("grp", "rep", "text")
    return members.repartition("grp").sortWithinPartitions("grp", "rep").mapInArrow(run, EDGES).distinct()


def set_order(members: np.ndarray) -> tuple[int, int, int]:
    """By this the least of unlike sets under one id is chosen."""
    k1, k2 = set_names([members])
    return len(members), int(k1[0]), int(k2[0])


# ---- the operator -----------------------------------------------------------------------------------


def document_classes(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, rep) of documents with a set, and (rep, weight, tokens, sketch) of each class of equal sets."""
    usable = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    name = ["n_shingles", "k1", "k2"]
    own = usable.groupBy("doc_id").agg(F.min(F.struct(*name)).alias("own")).select("doc_id", "own.*")
    classes = own.groupBy(*name).agg(F.min("doc_id").alias("rep"))
    members = own.join(classes, name).select("doc_id", "n_shingles", "rep")
    # repeated rows are made one before they meet; the join keeps the aggregation's partitioning
    full = usable.groupBy("doc_id", *name).agg(F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch"))
    reps = full.join(classes.withColumn("doc_id", F.col("rep")), ["doc_id", *name]).select("rep", (1 + F.floor(F.col("n_shingles") / UNIT)).alias("weight"), "tokens", "sketch")
    return members, stored(reps)


def near_components(docs: DataFrame, reps: DataFrame, percent: int, doc_id: str, text: str) -> DataFrame:
    """(id, component) of all representatives that are linked with another."""
    limit = percent / 100
    leaves, heavy, kept = paths(reps, limit)
    stuck = not heavy.isEmpty()
    if stuck:
        leaves = leaves.unionByName(heavy_blocks(heavy))
    loose = connected_components(loose_edges(leaves, reps, limit - LOOKS_NEAR), "a", "b")
    placed = loose.withColumnRenamed("id", "rep").join(reps.select("rep", "weight"), "rep")
    sizes = placed.groupBy("component").agg(F.count("*").alias("members"), F.sum("weight").alias("all"))
    sized = placed.join(sizes, "component").select("rep", "component", ((F.col("members") <= 2) | (F.col("all") <= LEAF)).alias("light"))
    groups = sized.where("light").select(F.xxhash64(F.lit("component"), "component").alias("grp"), "rep")
    # in a heavy component, members meet leaf by leaf; the leaf and the component name the group
    groups = groups.unionByName(leaves.join(sized.where("NOT light"), "rep").select(F.xxhash64("grp", "component").alias("grp"), "rep").distinct())
    found = connected_components(true_edges(groups, docs, percent, doc_id, text), "a", "b")
    if stuck:
        more = true_edges(stray_blocks(heavy, found), docs, percent, doc_id, text)
        found = connected_components(more.unionByName(found.select(F.col("id").alias("a"), F.col("component").alias("b"))), "a", "b")
    release(*kept)
    return found


def near_duplicates(docs: DataFrame, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= percent * union of their sets; component_id is the least
    doc_id that links reach.  A null, empty or blank text has no set, is linked with nothing and is kept.
    A row without an id is linked with nothing, has no component and is kept, with its own n_shingles.  Rows
    of one id are one document and get equal results; if their texts are unlike, its set is the least, by size
    and name, of those that aren't empty.  Very long texts are taken whole.  Other columns are not read.
    """
    signed = stored(signatures(docs, token_count(percent / 100), doc_id, text))
    members, reps = document_classes(signed)
    components = near_components(docs, reps, percent, doc_id, text)
    release(reps)
    named = members.join(components.withColumnRenamed("id", "rep"), "rep", "left").select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("size"), F.coalesce("component", "rep").alias("component"))
    rows = signed.select("doc_id", "n_shingles").join(named, F.col("doc_id") == F.col("id"), "left")
    component = F.coalesce("component", "doc_id")
    return rows.select("doc_id", F.coalesce("size", "n_shingles").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of the least id of each component; of repeated rows of an id, one.

    Rows without an id stay.  Of unlike rows of one id the one with the least text stays, then by its other
    columns.  Only rows of repeated ids are shuffled with their texts.
    """
    found = near_duplicates(docs, percent, doc_id, text)
    rows = stored(found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count("*").alias("n")).where("NOT kept OR n > 1"))
    stay = docs.join(small_side(rows.select(F.col("doc_id").alias("_id"))), F.col(doc_id).cast("long") == F.col("_id"), "left_anti")
    again = docs.join(small_side(rows.where("kept").select(F.col("doc_id").alias("_id"))), F.col(doc_id).cast("long") == F.col("_id"), "left_semi")
    least = F.struct(F.col(text), F.to_json(F.struct(*[F.col(c) for c in docs.columns])))
    one = again.groupBy(F.col(doc_id)).agg(F.min_by(F.struct(*[F.col(c) for c in docs.columns]), least).alias("_row")).select("_row.*")
    return stay.unionByName(one)
