"""I-1 to I-15: scalar functions as Column expressions (no Python per row)."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

C = str | Column


def _c(x: C) -> Column:
    return F.col(x) if isinstance(x, str) else x


def intervalue(low: int, high: int, step: int, x: C) -> Column:
    """I-1: the smallest ``low + k * step`` that is not below x; null beyond the range."""
    k = F.greatest(F.ceil((_c(x) - low) / step), F.lit(0))
    return F.when(k <= (high - low) // step, F.lit(low) + k * step)


#: Fixed values: (from, to, step, prefix) of the bucket ladders.
COVERAGE_STEPS = [(10, 20, 2, "00"), (20, 50, 3, "00"), (50, 100, 5, "00"), (100, 300, 10, "0"), (300, 700, 20, "0"), (700, 1000, 30, "0"), (1000, 2000, 50, ""), (2000, 5000, 100, "")]
FINE_STEPS = [(20, 100, 2, "00"), (100, 200, 2, "0"), (200, 1000, 5, "0"), (1000, 2000, 10, ""), (2000, 5000, 50, "")]


def _ladder(x: Column, out: Column, steps: list[tuple[int, int, int, str]]) -> Column:
    for low, high, step, prefix in steps:
        out = out.when((x >= low) & (x < high), F.concat(F.lit(prefix), intervalue(low, high, step, x).cast("long").cast("string")))
    return out.otherwise("10000")


def covrange(x: C) -> Column:
    """I-2: coarse coverage bucket label."""
    x = _c(x).cast("double")
    head = F.when(x == 0, "0000").when((x > 0) & (x < 9), F.concat(F.lit("000"), F.floor(x + 1).cast("string"))).when(x == 9, "0009").when((x > 9) & (x < 10), "0010")
    return _ladder(x, head, COVERAGE_STEPS)


def dcovrange(x: C) -> Column:
    """I-3: fine coverage bucket label."""
    x = _c(x).cast("double")
    whole = F.floor(x + 1).cast("string")
    head = F.when(x == 0, "0000").when((x > 0) & (x < 9), F.concat(F.lit("000"), whole)).when(x == 9, "0009").when((x > 9) & (x < 20), F.concat(F.lit("00"), whole))
    return _ladder(x, head, FINE_STEPS)


def gc_count(seq: C) -> Column:
    """I-4: upper-case G and C."""
    return F.length(_c(seq)) - F.length(F.translate(_c(seq), "GC", ""))


def gc_percent(seq: C) -> Column:
    return F.when(F.length(_c(seq)) > 0, 100.0 * gc_count(seq) / F.length(_c(seq)))


def complement(seq: C) -> Column:
    return F.translate(_c(seq), "ACGTacgt", "TGCAtgca")


def reverse_complement(seq: C) -> Column:
    """I-5."""
    return F.reverse(complement(seq))


def slice_1(seq: C, start: C | int, stop: C | int) -> Column:
    """I-5: characters start..stop, counted from 1, both included."""
    a, b = (F.lit(v) if isinstance(v, int) else _c(v) for v in (start, stop))
    return F.substring(_c(seq), a, b - a + 1)


def all_kmers(k: int = 4) -> list[str]:
    """Header order of k-mer tables: A, T, C, G expanded from the left."""
    return ["".join(x) for x in product("ATCG", repeat=k)]


def kmers(seq: C, k: int, letter: str = "[ACGT]") -> Column:
    """Every piece of ``k`` characters that match ``letter``, overlaps included, in one pass; null for null."""
    return F.regexp_extract_all(_c(seq), F.lit(f"(?s)(?=({letter}{{{k}}}))"), F.lit(1))


def kmer_counts(seq: C, k: int = 4) -> Column:
    """I-8: all k-mers of a sequence, each followed by its reverse complement (palindromes twice)."""
    seen = F.coalesce(kmers(seq, k), F.array().cast("array<string>"))
    return F.flatten(F.transform(seen, lambda x: F.array(x, reverse_complement(x))))


def kmer_vector(seq: C, k: int = 4, min_length: int = 500) -> Column:
    """I-8: frequencies in ``all_kmers`` order, 8 decimals; null below ``min_length`` or without a k-mer.

    The outer ``transform`` holds the k-mers of a sequence while each of the few possible ones is counted among them.
    """
    names = F.array(*[F.lit(x) for x in all_kmers(k)])
    count = lambda seen, x: F.size(seen) - F.size(F.array_remove(seen, x))
    share = lambda seen, x: F.round((count(seen, x) + count(seen, reverse_complement(x))) / (2 * F.size(seen)), 8)
    vectors = F.transform(F.array(kmers(seq, k)), lambda seen: F.when(F.size(seen) > 0, F.transform(names, lambda x: share(seen, x))))
    return F.when(F.length(_c(seq)) >= min_length, vectors[0])


def windows(seq: C, size: int) -> Column:
    """I-9: cuts of ``size`` while at least two more fit; the rest stays whole with the last cut."""
    n = F.length(_c(seq))
    cuts = F.greatest(F.ceil((n - 2 * size) / size), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), cuts), lambda i: F.when(i < cuts, F.substring(_c(seq), i * size + 1, F.lit(size))).otherwise(F.substring(_c(seq), i * size + 1, n)))


def pct_avg(a: C, b: C) -> Column:
    """I-10: difference over the mean; 0 when both are 0."""
    a, b = _c(a), _c(b)
    return F.when(a + b == 0, 0.0).otherwise(F.try_divide(200.0 * F.abs(a - b), a + b))


def pct_sum(a: C, b: C) -> Column:
    """I-10: difference over the sum, whose 0 counts as 1."""
    a, b = _c(a), _c(b)
    return 100.0 * F.abs(a - b) / F.when(a + b == 0, 1.0).otherwise(a + b)


def pct_ref(x: C, ref: C) -> Column:
    """I-10: difference over the reference; null where that is 0."""
    return F.try_divide(100.0 * F.abs(_c(x) - _c(ref)), _c(ref))


def delta(cpn: C, ctn: C, weight: int = 1) -> Column:
    """I-11: completeness less ``weight`` times contamination (1 within an assembly, 5 across)."""
    return _c(cpn) - weight * _c(ctn)


def strip_extension(name: C) -> Column:
    """I-12."""
    return F.regexp_replace(_c(name), r"\.[^.]*$", "")


def count_of(s: C, part: str) -> Column:
    """I-12: how often ``part`` occurs."""
    return ((F.length(_c(s)) - F.length(F.replace(_c(s), F.lit(part), F.lit("")))) / len(part)).cast("int")


def prefix_id(name: C, sep: str = "_") -> Column:
    """I-13."""
    return F.substring_index(_c(name), sep, 1)


def number(s: C) -> Column:
    """I-14: numeric text, null if it isn't one."""
    return _c(s).try_cast("double")


def round_even(x: C, digits: int) -> Column:
    """I-15: half to even."""
    return F.bround(_c(x), digits)


#: Weight of each lineage rank (G-17).
LINEAGE_WEIGHTS = {"root": 0.0, "k": 1.0, "p": 1.5, "c": 2.3, "o": 3.4, "f": 5.1, "g": 7.6, "s": 11.4}


def lineage_weight(lineage: C) -> Column:
    """G-17: weight of the rank before ``__``; unknown ranks count as root."""
    table = F.create_map(*[F.lit(x) for kv in LINEAGE_WEIGHTS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.substring_index(_c(lineage), "__", 1)), F.lit(0.0))


def vector_stats(v: C) -> Column:
    """E-33 (formulas and order are fixed): 15 statistics of an array of doubles, population moments, divisors guarded by 1e-7."""
    v = _c(v)
    n = F.size(v).cast("double")

    def total(f) -> Column:
        return F.aggregate(v, F.lit(0.0), lambda s, x: s + f(x))

    mean = total(lambda x: x) / n
    var = total(lambda x: (x - mean) * (x - mean)) / n
    std = F.sqrt(var)
    peak = F.array_max(F.transform(v, F.abs))
    rms = F.sqrt(total(lambda x: x * x) / (n + 1e-7))
    mean_abs = total(F.abs) / (n + 1e-7)
    root = F.pow(total(lambda x: F.sqrt(F.abs(x))) / (n + 1e-7), F.lit(2.0))
    skew = total(lambda x: F.pow(x - mean, F.lit(3.0))) / ((n - 1) * F.pow(std, F.lit(3.0)) + 1e-7)
    kurt = total(lambda x: F.pow(x - mean, F.lit(4.0))) / ((n - 1) * F.pow(std, F.lit(4.0)) + 1e-7)
    return F.when(n > 0, F.array(mean, var, std, F.array_max(v), F.array_min(v), peak, rms, mean_abs, root, rms / (mean + 1e-7), peak / (rms + 1e-7), peak / (mean + 1e-7), peak / (root + 1e-7), skew, kurt))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
