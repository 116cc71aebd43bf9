"""Temperature mixing of sources to a token budget.

A source's weight is its share of all tokens to the power of an exponent, normalised.  The exponent is bisected between
0 (all sources alike) and 1 (as they come): it is the largest whose weights reach a target entropy (a share of the
entropy between the natural one and the greatest), raised where the budget would otherwise repeat a source more often
than allowed.  A weight gives a source its quota of the budget.  The quota is realised in permutations: whole ones take
every document of the source once, and of one more permutation the longest beginning that still fits is taken.

A permutation orders a source's documents by a block (of about ``BLOCK_ROWS`` documents, from a hash of epoch and key)
and inside it by a finer hash.  Running sums go over blocks first and then inside the one block that holds the cut, so
that no task ever holds a source.  What is left to decide a row is one cut for each source.

All of it is Spark SQL expressions; the bisection is a fold over an array with a cell for each number of tokens that
sources have.  Rows: a null source is a source of its own; null and empty texts have zero tokens, and a source without
any token is taken once; a source's quota comes from its whole weight, however small; very long texts are counted without making their words; ties in the hash go by key, and rows
with equal keys are taken or left together; an empty table gives no rows; extra columns stay (`mix`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from strandline.llm._tables import let, stored

#: Entropy to reach, as a share of the way from the natural entropy to the greatest.
ENTROPY_SHARE = 0.5
#: Times that a source may be repeated on average.
MOST_REPEATS = 4.0
BISECTIONS = 40
#: Documents in a block of a permutation, on average, and blocks in a group of them.
BLOCK_ROWS = 4096
GROUP_BLOCKS = 4096
#: Sources with fewer tokens are told apart by the number; larger ones have so many cells for each e-fold of it.
FINE = 1 << 16
CELLS_A_FOLD = 10_000
#: Relative error of a weight that is taken for rounding.
ROUNDING = 1e-12
#: Sources up to which the cuts are broadcast (under 100 bytes each).
BROADCAST_SOURCES = 10_000
#: Parts that sums for one source are first made in.
SALTS = 64


def tokens_of(text: Column) -> Column:
    """Words between white space, counted without making them: the places where a word begins."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]++"))


def _raised(cells: Column, exponent: Column) -> Column:
    """Cells (share, m) with the share to the power of an exponent."""
    return F.transform(cells, lambda c: F.struct(F.when(c["share"] > 0, F.pow(c["share"], exponent)).otherwise(F.lit(0.0)).alias("share"), c["m"].alias("m")))


def _total(cells: Column) -> Column:
    return F.aggregate(cells, F.lit(0.0), lambda a, c: a + c["share"] * c["m"])


def _entropy(cells: Column) -> Column:
    """Of the normalised cells."""
    return let(
        _total(cells),
        lambda total: -F.aggregate(cells, F.lit(0.0), lambda a, c: a + F.when(c["share"] > 0, c["m"] * (c["share"] / total) * F.ln(c["share"] / total)).otherwise(F.lit(0.0))),
    )


def _bisect(holds, rounds: int = BISECTIONS) -> Column:
    """The largest exponent in 0..1 for which ``holds`` (true from 0 up to some exponent), to 2^-rounds."""
    ends = F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)),
        F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi")),
        lambda acc, _: let(
            (acc["lo"] + acc["hi"]) / 2,
            lambda mid: F.when(holds(mid), F.struct(mid.alias("lo"), acc["hi"].alias("hi"))).otherwise(F.struct(acc["lo"].alias("lo"), mid.alias("hi"))),
        ),
    )
    return F.when(holds(F.lit(1.0)), F.lit(1.0)).otherwise(ends["lo"])


def source_weights(
    sources: DataFrame, *, budget_share: float = 1.0, entropy_share: float = ENTROPY_SHARE, most_repeats: float = MOST_REPEATS
) -> DataFrame:
    """``sources`` (source, tokens, rows) with exponent and weight (shown to 6 decimals), and quota in tokens (of the whole weight).

    The budget is ``budget_share`` of all tokens.  Sources with about equal numbers of tokens have about equal weights: the exponent
    is sought over one cell for each of some 10^5 sizes, whatever the number of sources, with the mean of its sources and how many there are.
    """
    sizes = F.floor(F.log(F.greatest(F.col("tokens"), F.lit(1)).cast("double")) * CELLS_A_FOLD).cast("int")
    cell = F.when(F.col("tokens") < FINE, F.col("tokens")).otherwise(FINE + sizes)  # small numbers have cells of their own
    cells = sources.groupBy(cell.alias("cell")).agg(F.sum("tokens").alias("part"), F.count(F.lit(1)).alias("m"))
    mean = F.struct((F.col("part") / F.col("m")).alias("tokens"), "m")
    one = cells.agg(F.sort_array(F.collect_list(mean)).alias("each"), F.coalesce(F.sum("part"), F.lit(0)).alias("total"))
    share = lambda tokens: F.coalesce(F.try_divide(tokens.cast("double"), F.col("total").cast("double")), F.lit(0.0))
    one = one.select("total", F.floor(F.lit(float(budget_share)) * F.col("total")).cast("bigint").alias("budget"), F.transform("each", lambda c: F.struct(share(c["tokens"]).alias("share"), c["m"].alias("m"))).alias("cells"))
    cells = F.col("cells")
    some = F.aggregate(cells, F.lit(0).cast("bigint"), lambda a, c: a + F.when(c["share"] > 0, c["m"]).otherwise(F.lit(0)))
    one = one.withColumn("own", _entropy(cells)).withColumn("target", F.col("own") + F.lit(float(entropy_share)) * F.greatest(F.ln(F.greatest(some, F.lit(1)).cast("double")) - F.col("own"), F.lit(0.0)))

    def repeats(exponent: Column) -> Column:
        def most(raised: Column, norm: Column) -> Column:
            times = lambda r, c: F.when(c["share"] > 0, r["share"] / norm * F.col("budget") / (c["share"] * F.col("total"))).otherwise(F.lit(0.0))
            return F.coalesce(F.array_max(F.zip_with(raised, cells, times)), F.lit(0.0))

        return let(_raised(cells, exponent), lambda raised: let(_total(raised), lambda norm: most(raised, norm)))

    reaches = _bisect(lambda a: _entropy(_raised(cells, a)) >= F.col("target") - 1e-9)
    # the repeats of the most repeated source fall as the exponent grows, so their limit bounds it from below
    limited = 1.0 - _bisect(lambda b: repeats(1.0 - b) <= F.lit(float(most_repeats)))
    one = one.withColumn("exponent", F.round(F.greatest(reaches, limited), 6))
    found = one.select("total", "budget", "exponent", _total(_raised(cells, F.col("exponent"))).alias("norm")).first()  # four numbers
    raised = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double") / F.lit(float(found["total"] or 1)), F.lit(found["exponent"]))).otherwise(F.lit(0.0))
    weight = F.coalesce(F.try_divide(raised, F.lit(found["norm"])), F.lit(0.0))
    # a share that is a whole number of tokens but for the last bits is that number
    quota = F.floor(weight * F.lit(found["budget"]) * (1 + ROUNDING)).cast("bigint")
    return sources.select("source", "tokens", "rows", F.lit(found["exponent"]).alias("exponent"), F.round(weight, 6).alias("weight"), quota.alias("quota"))


def _permuted(rows: DataFrame, key: str) -> DataFrame:
    """Adds block and order of each row in the permutation number epoch (columns epoch, rows and ``key`` are there)."""
    blocks = F.greatest(F.floor((F.col("rows") + (BLOCK_ROWS - 1)) / BLOCK_ROWS).cast("bigint"), F.lit(1))
    mixed = F.md5(F.concat_ws(":", F.col("epoch").cast("string"), F.col(key).cast("string")).cast("binary"))
    number = lambda start, digits: F.conv(F.substring(mixed, start, digits), 16, 10).cast("bigint")
    return rows.withColumn("block", F.shiftright(number(1, 8) * blocks, 32)).withColumn("order", number(9, 15))


def _with_sources(rows: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    small = sources.withColumnRenamed("source", "same_source")
    small = F.broadcast(small) if n_sources <= BROADCAST_SOURCES else small
    return rows.join(small, F.col("source").eqNullSafe(F.col("same_source"))).drop("same_source")


def _cut(sums: DataFrame, part: str) -> DataFrame:
    """source, cut_``part`` (where the running sum of tokens passes the room) and the room that is left in it."""
    until = F.sum("tokens").over(Window.partitionBy("source").orderBy(part))
    found = sums.withColumn("until", until).where("until > room AND until - tokens <= room")
    return found.select("source", F.col(part).alias(f"cut_{part}"), (F.col("room") - F.col("until") + F.col("tokens")).alias("room"))


def source_cuts(rows: DataFrame, *, budget_share: float = 1.0, entropy_share: float = ENTROPY_SHARE, most_repeats: float = MOST_REPEATS) -> DataFrame:
    """A row for each source: exponent, weight, whole permutations (passes) and the cut of one more.

    ``rows``: key, source, n.  Of permutation number passes, the blocks before cut_block are taken, and in that block
    the rows up to cut (order and key; null: none).
    """
    parts = rows.groupBy("source", F.pmod(F.xxhash64("key"), F.lit(SALTS)).alias("salt")).agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    sources = parts.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.sum("rows").alias("rows"))
    sources = source_weights(stored(sources), budget_share=budget_share, entropy_share=entropy_share, most_repeats=most_repeats)
    passes = F.when(F.col("tokens") > 0, F.floor(F.try_divide(F.col("quota"), F.col("tokens")))).otherwise(F.lit(1)).cast("bigint")
    sources = sources.withColumn("epoch", passes).withColumn("left", F.greatest(F.col("quota") - F.col("epoch") * F.col("tokens"), F.lit(0)))
    sources = stored(sources)
    n_sources = sources.count()
    dealt = _permuted(_with_sources(rows, sources.select("source", "rows", "epoch", "left"), n_sources), "key")
    blocks = dealt.groupBy("source", "block", F.col("left").alias("room")).agg(F.sum("n").alias("tokens"))
    blocks = stored(blocks.withColumn("group", F.floor(F.col("block") / GROUP_BLOCKS)))
    # first among groups of blocks, then among the blocks of one group: no window is longer than a source's groups
    groups = _cut(blocks.groupBy("source", "group", "room").agg(F.sum("tokens").alias("tokens")), "group")
    among = _with_sources(blocks.drop("room"), groups, n_sources).where("group = cut_group")
    cut = stored(_cut(among.select("source", "block", "room", "tokens"), "block"))
    inside = _with_sources(dealt.select("key", "source", "n", "block", "order"), cut, n_sources).where("block = cut_block")
    so_far = F.sum("n").over(Window.partitionBy("source").orderBy("order", "key"))
    ends = inside.withColumn("so_far", so_far).where("so_far <= room").groupBy("source").agg(F.max(F.struct("order", "key")).alias("cut"))
    cuts = sources.join(cut.select(F.col("source").alias("s1"), "cut_block"), F.col("source").eqNullSafe(F.col("s1")), "left").drop("s1")
    cuts = cuts.join(ends.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2")), "left").drop("s2")
    return stored(cuts.select("source", "exponent", "weight", "rows", F.col("epoch").alias("passes"), "cut_block", "cut"))


def taken(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """A row for each time that a row of ``rows`` (key, source and others) is taken: its permutation (epoch) and block there."""
    each = _with_sources(rows, cuts, cuts.count()).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("passes"))))
    each = _permuted(each, "key")
    before = (F.col("block") < F.col("cut_block")) | ((F.col("block") == F.col("cut_block")) & F.coalesce(F.struct("order", "key") <= F.col("cut"), F.lit(False)))
    return each.where((F.col("epoch") < F.col("passes")) | F.coalesce(before, F.lit(False))).drop("rows", "passes", "cut_block", "cut", "order")


def narrow(df: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """key, source and n (tokens) of every row, written once: the texts are read no more."""
    return stored(df.select(df[key].alias("key"), df[source].alias("source"), tokens_of(df[text]).cast("bigint").alias("n")))


def mixing_plan(df: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", **limits: float) -> DataFrame:
    """``key``, source, n_tokens, exponent, weight, epoch and block of every row taken, once for each time it is taken."""
    rows = narrow(df, key=key, text=text, source=source)
    found = taken(rows, source_cuts(rows, **limits))
    return found.select(F.col("key").alias(key), "source", F.col("n").alias("n_tokens"), "exponent", "weight", "epoch", "block")


def mix(df: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", **limits: float) -> DataFrame:
    """The rows of ``df``, each as often as it is taken, columns unchanged.  Texts are not shuffled."""
    cuts = source_cuts(narrow(df, key=key, text=text, source=source), **limits)
    packed = df.select(df[key].alias("key"), df[source].alias("source"), F.struct(*[df[c] for c in df.columns]).alias("whole"))
    return taken(packed, cuts).select("whole.*")
