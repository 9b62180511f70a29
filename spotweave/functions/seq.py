"""Nucleotide and quality strings as Column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# IUPAC nucleotide codes.
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T", "U": "T", "W": "AT", "S": "CG", "M": "AC", "K": "GT", "R": "AG", "Y": "CT",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
}


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def slice_between(c: str | Column, start: int, end: int) -> Column:
    """Characters start..end-1, counted from 0; shorter where the string ends."""
    return F.substring(col(c), max(0, start) + 1, max(0, end - max(0, start)))


def barcode_slice(c: str | Column, start: int, length: int, overhang: int = 0) -> Column:
    return slice_between(c, max(0, start - overhang), start + length + overhang)


def join_slices(c: str | Column, bounds: list[int]) -> Column:
    """Pieces start..end of a list start, end, start, end, ... (from 0, end exclusive), put together."""
    if len(bounds) % 2:
        raise ValueError("bounds come in pairs")
    return F.concat(*[slice_between(c, s, e) for s, e in zip(bounds[::2], bounds[1::2])])


def iupac_regex(template: str) -> str:
    """Regular expression of a template of IUPAC codes; other letters are an error."""
    if wrong := set(template.upper()) - IUPAC.keys():
        raise ValueError(f"not nucleotide codes: {sorted(wrong)}")
    return "".join(f"[{IUPAC[c]}]" for c in template.upper())


def iupac_regex_column(template: str | Column) -> Column:
    """The same as an expression over a column of templates; null for other letters."""
    codes = F.create_map(*[F.lit(x) for k, v in IUPAC.items() for x in (k, f"[{v}]")])
    return F.aggregate(F.split(F.upper(col(template)), ""), F.lit(""), lambda a, c: F.concat(a, F.try_element_at(codes, c)))


def matches_template(c: str | Column, pattern: str) -> Column:
    """Whether the string begins with the pattern."""
    return col(c).rlike(f"^(?:{pattern})")


def low_quality_bases(quality: str | Column, cutoff: int, base: int = 33) -> Column:
    """Bases with a quality below the cutoff."""
    return F.size(F.filter(F.split(col(quality), ""), lambda c: (F.length(c) > 0) & (F.ascii(c) - base < cutoff)))


def content_percent(sequence: str | Column, bases: str) -> Column:
    """Per cent of the characters that are among ``bases``; an empty string divides by zero, which is an error."""
    s = col(sequence)
    return F.length(F.regexp_replace(s, f"[^{bases}]", "")) * F.lit(100.0) / F.length(s)


def hamming(a: str | Column, b: str | Column) -> Column:
    """Places in which two strings differ; null if their lengths do."""
    pairs = F.zip_with(F.split(col(a), ""), F.split(col(b), ""), lambda p, q: (p != q).cast("int"))
    return F.when(F.length(a) == F.length(b), F.aggregate(pairs, F.lit(0), lambda s, x: s + x))


def adaptor_position(sequence: str | Column, base: str, length: int, mismatches: int = 0) -> Column:
    """Where a run of one base begins, from 0; null if there is none.

    With mismatches the leftmost window of ``length`` with so many other bases counts; if it begins with
    another base it is shortened to begin with the base, and the first place of what remains is given,
    which may lie before the window.
    """
    s = col(sequence)
    if mismatches == 0:
        place = F.instr(s, base * length) - 1
        return F.when(place >= 0, place)
    starts = F.filter(
        F.when(F.length(s) >= length, F.sequence(F.lit(1), F.length(s) - (length - 1))),
        lambda i: F.length(F.replace(F.substring(s, i, F.lit(length)), F.lit(base), F.lit(""))) <= mismatches,
    )
    window = F.substring(s, F.try_element_at(starts, F.lit(1)), F.lit(length))
    lead = F.instr(window, base)
    # a window without the base at all keeps its last character
    rest = F.when(lead > 0, F.substring(window, lead, F.lit(length))).otherwise(F.substring(window, length, 1))
    return F.when(window.isNotNull(), F.position(rest, s) - 1)


def quality_trim_index(bases: str | Column, qualities: str | Column, cutoff: int, base: int = 33) -> Column:
    """Where to cut low quality from the 3' end.

    From the end, cutoff - quality adds up (G counts as quality cutoff - 1) until the sum falls below 0;
    the cut is where it was largest, first reached; the whole length if it was never positive.
    """
    b, q = col(bases), col(qualities)
    n = F.length(q)
    # each string is split once; a base beyond the bases' end is none
    lost = F.zip_with(F.slice(F.split(b, ""), F.lit(1), F.greatest(n, F.lit(1))), F.split(q, ""), lambda x, y: F.when(x == "G", F.lit(1)).otherwise(F.lit(cutoff + base) - F.ascii(y)))

    def step(state: Column, x: Column) -> Column:
        total = state["sum"] + x
        stop = state["stop"] | (total < 0)
        better = ~stop & (total > state["most"])
        return F.struct(
            F.when(state["stop"], state["sum"]).otherwise(total).alias("sum"), F.when(better, total).otherwise(state["most"]).alias("most"),
            F.when(better, state["at"] - 1).otherwise(state["cut"]).alias("cut"), (state["at"] - 1).alias("at"), stop.alias("stop"),
        )

    begin = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("most"), n.alias("cut"), n.alias("at"), F.lit(False).alias("stop"))
    return F.when(n == 0, F.lit(0)).otherwise(F.aggregate(F.reverse(lost), begin, step)["cut"])


def quality_trim_length(sequence: str | Column, qualities: str | Column, cutoff: int = 20, min_length: int = 30, base: int = 33) -> Column:
    """Length after quality trimming; null if the read is too short before or, by more than one base, after."""
    cut = quality_trim_index(sequence, qualities, cutoff, base)
    return F.when((F.length(col(sequence)) >= min_length) & (cut + 1 >= min_length), cut)
