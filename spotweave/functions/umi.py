"""Clustering of the distinct molecular identifiers of one session.

The column forms work on arrays inside the JVM and suit the usual groups of a few identifiers.  Larger
arrays, and the forms that need a graph, are Arrow UDFs.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from spotweave.functions.seq import col, hamming

#: Arrays above this size are labelled in an Arrow UDF: the column form costs the cube of the size.
NATIVE_LIMIT = 24


def is_near(a: str, b: str, k: int) -> bool:
    """Hamming distance at most k; identifiers of unlike length are never near."""
    return len(a) == len(b) and sum(x != y for x, y in zip(a, b)) <= k


def neighbours(umis: list[str], k: int) -> dict[str, list[str]]:
    """Identifiers near each other, each also to itself.

    Up to k differences leave one of k + 1 pieces unchanged, so only identifiers that share a piece at its
    place are compared.
    """
    near: dict[str, list[str]] = {u: [u] for u in umis}
    by_piece = defaultdict(list)
    for u in umis:
        n = len(u)
        for i in range(k + 1):
            by_piece[n, i, u[n * i // (k + 1) : n * (i + 1) // (k + 1)]].append(u)
    seen = set()
    for group in by_piece.values():
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                if (a, b) not in seen and is_near(a, b, k):
                    near[a].append(b)
                    near[b].append(a)
                seen.add((a, b))
    return near


def components(near: dict[str, list[str]], order: list[str]) -> list[list[str]]:
    """Connected components; the first of each in the given order leads."""
    out, seen = [], set()
    for seed in order:
        if seed in seen:
            continue
        part, stack = [], [seed]
        seen.add(seed)
        while stack:
            u = stack.pop()
            part.append(u)
            for v in near[u]:
                if v not in seen:
                    seen.add(v)
                    stack.append(v)
        out.append(part)
    return out


def by_count(counts: Counter) -> list[str]:
    """Most frequent first, ties by the identifier."""
    return sorted(counts, key=lambda u: (-counts[u], u))


def require(umis: list[str]) -> None:
    if not umis:
        raise ValueError("no molecular identifiers")


def dedup_adjacent(umis: list[str], k: int) -> list[str]:
    """Of each component, the shortest run of its most frequent members whose neighbours cover it."""
    require(umis)
    counts = Counter(umis)
    order = by_count(counts)
    near, kept = neighbours(order, k), []
    for part in components(near, order):
        ranked = sorted(part, key=lambda u: (-counts[u], u))
        covered: set[str] = set()
        for i, u in enumerate(ranked):
            covered |= {u, *near[u]}
            if len(covered) == len(part) or i == len(ranked) - 1:
                kept += ranked[: i + 1]
                break
    return kept


def dedup_directional(umis: list[str], k: int) -> list[str]:
    """Of the clusters reached from the most frequent along edges to at most half as frequent ones, the least.

    An edge leads from u to v if they are near and count(u) >= 2 count(v) - 1.  Clusters take only members
    not in an earlier cluster.
    """
    require(umis)
    counts = Counter(umis)
    order = by_count(counts)
    near = {u: [v for v in vs if v != u and counts[u] >= 2 * counts[v] - 1] for u, vs in neighbours(order, k).items()}
    return [min(part) for part in components(near, order)]


def dedup_hierarchical(umis: list[str], k: int, method: str = "single", fix_pair_rule: bool = False) -> list[str]:
    """Linkage clustering cut at k, the least identifier of each cluster.

    A pair is a special case by default: both are kept if they are near and one if not.  ``fix_pair_rule``
    treats pairs as all other sets.
    """
    require(umis)
    distinct = sorted(set(umis))
    if len(umis) == 2 and not fix_pair_rule:
        return list(umis) if is_near(umis[0], umis[1], k) else [min(umis)]
    if method == "single":
        return sorted(min(part) for part in components(neighbours(distinct, k), distinct))
    if method != "complete":
        raise ValueError(f"unknown linkage {method}")
    clusters = [[u] for u in distinct]

    def apart(a: list[str], b: list[str]) -> float:
        return max(sum(x != y for x, y in zip(p, q)) if len(p) == len(q) else float("inf") for p in a for q in b)

    while len(clusters) > 1:
        d, i, j = min((apart(clusters[i], clusters[j]), i, j) for i in range(len(clusters)) for j in range(i + 1, len(clusters)))
        if d > k:
            break
        clusters[i] += clusters.pop(j)
    return sorted(min(c) for c in clusters)


ALGORITHMS = {"AdjacentBi": dedup_directional, "Adjacent": dedup_adjacent, "hierarchical": dedup_hierarchical}


def cluster_column(umis: str | Column, k: int, algorithm: str = "AdjacentBi") -> Column:
    """Kept identifiers of an array, by any algorithm; an Arrow UDF."""
    if algorithm not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {algorithm}; there are {sorted(ALGORITHMS)}")
    work = ALGORITHMS[algorithm]

    @F.pandas_udf("array<string>")
    def kept(arrays: pd.Series) -> pd.Series:
        return arrays.map(lambda a: None if a is None else work(list(a), k))

    return kept(col(umis))


def component_labels(umis: Column, k: int) -> Column:
    """For each identifier of a sorted array, the index of the least one of its component."""
    near = F.transform(umis, lambda u: F.filter(F.sequence(F.lit(0), F.size(umis) - 1), lambda j: hamming(u, umis[j]) <= k))
    start = F.sequence(F.lit(0), F.size(umis) - 1)
    spread = F.aggregate(start, start, lambda labels, _: F.transform(near, lambda js: F.array_min(F.transform(js, lambda j: labels[j]))))
    return spread


def component_count(umis: str | Column, k: int) -> Column:
    """Number of components of the graph of identifiers at Hamming distance up to k.

    One identifier is one component, and with k = 0 each is; small arrays are labelled by array functions
    and large ones by the Arrow UDF.
    """
    a = col(umis)
    if k == 0:
        return F.size(a)
    ordered = F.array_sort(a)
    native = F.size(F.array_distinct(component_labels(ordered, k)))
    return F.when(F.size(a) == 0, 0).when(F.size(a) == 1, 1).when(F.size(a) <= NATIVE_LIMIT, native).otherwise(F.size(cluster_column(F.when(F.size(a) > NATIVE_LIMIT, a), k)))


def hierarchical_count(umis: str | Column, k: int, fix_pair_rule: bool = False) -> Column:
    """Number of identifiers that dedup_hierarchical keeps."""
    a = col(umis)
    pair = F.when(hamming(a[0], a[1]) <= k, 2).otherwise(1)
    whole = component_count(a, k)
    return whole if fix_pair_rule else F.when(F.size(a) == 2, pair).otherwise(whole)
