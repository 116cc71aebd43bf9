"""Column functions on variant fields: key=value cells, counts, alleles, sequence context.

Text cells follow the conventions of wide variant files: ``.`` and ``0`` mean "no annotation", cells with several hits
join them by ``&``, and INFO-like cells are ``key=value`` parts (or bare flags) joined by ``;``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASES = "ACGT"
#: The six substitutions with a pyrimidine reference.
CLASSES = ["CA", "CG", "CT", "TA", "TC", "TG"]
#: Order of the ten base counts: forward strand upper case, reverse lower case.
TEN_BASES = ["A", "C", "G", "T", "N", "a", "c", "g", "t", "n"]


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns`` added, evaluated once a row.

    Of a plain projection Spark puts the whole expression in the place of each mention in filters behind it, and of all that is made
    of it there; a generated row it takes as it is.
    """
    return df.select(*[c for c in df.columns if c not in columns], F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def info_get(info: Column, key: str) -> Column:
    """The value of ``key`` in a ``k=v;flag`` cell: of repeated keys the last; null if absent or a flag; ``None`` reads as ``0``."""
    found = F.filter(F.split(info, ";"), lambda x: x.startswith(f"{key}="))
    value = F.substring(F.try_element_at(found, F.lit(-1)), len(key) + 2, 1 << 30)
    return F.when(value == "None", F.lit("0")).otherwise(value)


def has_flag(info: Column, key: str) -> Column:
    """Whether ``key`` stands in the cell, with or without a value."""
    return F.exists(F.split(info, ";"), lambda x: (x == key) | x.startswith(f"{key}="))


def parse_counts(info: Column, key: str) -> Column:
    """A comma-separated list of counts as array<int>; what isn't a number becomes null."""
    return F.transform(F.split(info_get(info, key), ","), lambda x: x.try_cast("int"))


def is_valid(cell: Column) -> Column:
    return F.coalesce(~cell.isin(".", "0"), F.lit(False))


def vaf(ref_forward: Column, ref_reverse: Column, alt_forward: Column, alt_reverse: Column) -> Column:
    """Share of reads with the variant; 0 without reads."""
    alt = alt_forward + alt_reverse
    return F.coalesce(F.try_divide(alt.cast("double"), (ref_forward + ref_reverse + alt).cast("double")), F.lit(0.0))


def vaf2(*counts: Column) -> Column:
    return F.round(vaf(*counts), 2)


def complement(base: Column) -> Column:
    return F.translate(base, "ACGTacgt", "TGCAtgca")


def mutation_class(ref: Column, alt: Column) -> Column:
    """Reference and alternative base, seen from the strand where the reference is C or T."""
    change = F.concat(ref, alt)
    return F.when(ref.isin("C", "T"), change).otherwise(complement(change))


def folded_flanks(ref: Column, before: Column, after: Column) -> tuple[Column, Column]:
    """Flanking bases on the same strand as `mutation_class`."""
    own = ref.isin("C", "T")
    return F.when(own, before).otherwise(complement(after)), F.when(own, after).otherwise(complement(before))


def reverse_complement_triplet(before: Column, ref: Column, alt: Column, after: Column) -> Column:
    """A struct of the four bases read from the other strand."""
    return F.struct(complement(after).alias("before"), complement(ref).alias("ref"), complement(alt).alias("alt"), complement(before).alias("after"))


def flanking_bases(context: Column) -> tuple[Column, Column]:
    """Last base of the left and first base of the right flank of a ``left,right`` context."""
    sides = F.split(context, ",")
    return F.right(F.get(sides, 0), F.lit(1)), F.left(F.get(sides, 1), F.lit(1))


def exact_match_value(cell: Column) -> Column:
    """The last ``;`` part of the first ``&`` hit that matches exactly, else ``.``."""
    exact = F.filter(F.split(cell, "&"), lambda x: x.contains("MATCH=exact;"))
    return F.coalesce(F.element_at(F.split(F.get(exact, 0), ";"), -1), F.lit("."))


def min_mapability(cell: Column) -> Column:
    """Least of the ``&``-joined values; null for ``.`` (unmappable)."""
    return F.array_min(F.transform(F.split(cell, "&"), lambda x: x.try_cast("double")))


def genomic_region(function: Column) -> Column:
    first = F.substring_index(function, ";", 1)
    return (
        F.when(first.startswith("UTR") | first.contains("stream"), "near_gene")
        .when(first == "splicing", "exonic")
        .when(first.startswith("ncRNA"), "ncRNA")
        .otherwise(first)
    )


#: Up to so many terms, a binomial tail is summed from its first term.
FEW_TERMS = 64


def _stirling_rest(x: Column) -> Column:
    """ln x! less Stirling's x ln x - x + ln(2 pi x) / 2, for x above ``FEW_TERMS``."""
    square = x * x
    return (F.lit(1 / 12) - (F.lit(1 / 360) - F.lit(1 / 1260) / square) / square) / x


def _lower_tail(k: Column, n: Column) -> Column:
    """P(X <= k) for k below n / 2."""
    start = -n.cast("double") * F.ln(F.lit(2.0))
    few = F.aggregate(
        F.when(k >= 1, F.sequence(F.lit(1), F.least(k, F.lit(FEW_TERMS)).cast("int"))).otherwise(F.array().cast("array<int>")),
        F.struct(start.alias("log"), F.exp(start).alias("sum")),
        lambda acc, i: let(
            acc["log"] + F.ln((n - i + 1).cast("double") / i),
            lambda log: F.struct(log.alias("log"), (acc["sum"] + F.exp(log)).alias("sum")),
        ),
    )["sum"]
    size, low, high = n.cast("double"), k.cast("double"), (n - k).cast("double")
    lean = (n - 2 * k).cast("double") / size
    spread = size / 2 * ((1 - lean) * F.log1p(-lean) + (1 + lean) * F.log1p(lean))
    top = -spread + F.ln(size / (low * high * (2 * math.pi))) / 2 + _stirling_rest(size) - _stirling_rest(low) - _stirling_rest(high)
    # from the term of k down: behind sqrt(20 n) further terms all are below 1e-17 of the first
    steps = F.least(k, F.ceil(F.sqrt(20 * size)).cast("bigint") + 16)
    many = F.aggregate(
        F.when(k > FEW_TERMS, F.sequence(F.lit(0), (steps - 1).cast("int"))).otherwise(F.array().cast("array<int>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda acc, j: let(acc["term"] * (low - j) / (high + j + 1), lambda term: F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))),
    )["sum"]
    return F.when(k < 0, F.lit(0.0)).when(k <= FEW_TERMS, few).otherwise(F.exp(top) * many)


def binom_cdf_half(k: Column, n: Column) -> Column:
    """P(X <= k) for n fair coins.

    Few terms are summed from the first on, as logarithms; many from the last one down, which stands by Stirling's
    series, as far as they count (some times the square root of n).  Above n / 2 it is one less the other tail.
    """
    upper = 2 * k >= n
    near = F.when(upper, n - k - 1).otherwise(k)
    tail = let(near, lambda x: _lower_tail(x, n))
    return F.least(F.greatest(F.when(upper, 1 - tail).otherwise(tail), F.lit(0.0)), F.lit(1.0))


def genotype_from_vaf(share: Column, heterozygous: Column | None = None) -> Column:
    """1/1 from 0.75; else 0/1 from 0.3 (or always where ``heterozygous``); else 0/0."""
    at_least = F.lit(False) if heterozygous is None else heterozygous
    return F.when(share >= 0.75, "1/1").when((share >= 0.3) | at_least, "0/1").otherwise("0/0")


def right_trim_alleles(ref: Column, alts: Column) -> Column:
    """Struct of ref, alts (array), homlen and homseq after the longest suffix that all alleles share is cut.

    At least one base of every allele stays.
    """
    upper = F.upper(ref)

    def shared(alt: Column) -> Column:
        most = F.least(F.length(ref), F.length(alt)) - 1
        lengths = F.when(most >= 1, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))
        return F.size(F.filter(lengths, lambda k: F.right(upper, k) == F.right(F.upper(alt), k)))

    def cut(n: Column) -> Column:
        return F.struct(
            F.left(ref, F.length(ref) - n).alias("ref"),
            F.transform(alts, lambda a: F.left(a, F.length(a) - n)).alias("alts"),
            n.cast("bigint").alias("homlen"),
            F.when(n > 0, F.right(upper, n)).alias("homseq"),
        )

    # a suffix of length k agrees only if all shorter ones do, so the count of agreeing lengths is the longest
    return let(F.array_min(F.transform(alts, shared)), cut)


def seq_context_disrupts(base: Column, context: Column, motif: str) -> Column:
    """Whether ``base`` with its left or right flank makes ``motif``."""
    sides, n = F.split(context, ","), len(motif) - 1
    return (F.concat(F.right(F.get(sides, 0), F.lit(n)), base) == motif) | (F.concat(base, F.left(F.get(sides, 1), F.lit(n))) == motif)


def af_from_1kg(cell: Column, population: str = "EUR") -> Column:
    """Four characters behind ``<population>_AF=``, else behind ``AF=``; 0 for ``.``."""
    of = F.nullif(F.regexp_extract(cell, rf"{population}_AF=(.{{1,4}})", 1), F.lit(""))
    any_af = F.nullif(F.regexp_extract(cell, r"AF=(.{1,4})", 1), F.lit(""))
    return F.when(cell == ".", F.lit(0.0)).otherwise(F.coalesce(of, any_af).try_cast("double"))


def chrom_rank(chrom: Column) -> Column:
    """1 to 22, X 23, Y 24, anything else after them; a leading ``chr`` is ignored."""
    name = F.regexp_replace(chrom, "^chr", "")
    return F.when(name == "X", 23).when(name == "Y", 24).otherwise(F.coalesce(name.try_cast("int"), F.lit(25)))
