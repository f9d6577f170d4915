"""Mix sources to target weights: which words of which document go to which shard, and where.

The words of a source form one stream, its documents in hashed order, cut into blocks of
equal words. A target of several times the source takes whole passes over its blocks and a
part of a last one, each pass in a permutation of its own; the last block is trimmed, so a
source's words meet its target exactly. What a source gives, counted in blocks, is its
quota. A tree halves the range of output shards until single ones are left, and at each
node the quotas of all sources are split by a multivariate hypergeometric draw, as if the
node's blocks were dealt without looking. A shard draws its part of every source's permuted
list, disjoint from all others, and orders its blocks at random.

DataFrame functions only. Numbers inside large groups come from hashed slices that are
shifted by what the slices before hold, so no task sees a source or a shard as a whole.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.sources.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_TIMES = 3  # a source is taken at most so often
SHARDS = 16
BLOCK_WORDS = 65_536  # at most, in a block
FINEST = 1024  # a source has about as many blocks at least, or one per word
SLICE_ROWS = 20_000  # rows that are numbered together, about
CHUNK = 10_000  # rows that one row becomes at once
FANOUT = 256  # sources, or groups of them, that one row of the tree holds
SEED = 42


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def _key(*parts: Column | int | str) -> Column:
    return F.xxhash64(F.lit(SEED), *[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _unit(key: Column) -> Column:
    """A hash as a number in [0, 1), in the order of the hash."""
    return F.least(key.cast("double") / 2.0**64 + 0.5, F.lit(1 - 2.0**-53))


def _repeated(df: DataFrame, times: Column, name: str) -> DataFrame:
    """Each row so many times, numbered from 0; many copies are made by many tasks."""
    counted = df.withColumn("_times", times)

    def number(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(low, high)).alias(name)

    few = counted.where((F.col("_times") > 0) & (F.col("_times") <= CHUNK))
    chunks = counted.where(F.col("_times") > CHUNK).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("_times") - 1, F.lit(CHUNK).cast("bigint"))).alias("_from")
    )
    last = F.least(F.col("_from") + CHUNK, F.col("_times")) - 1
    many = chunks.repartition("_from", *df.columns).select(*df.columns, number(F.col("_from"), last))
    first = F.lit(0).cast("bigint")
    return few.select(*df.columns, number(first, F.col("_times") - 1)).unionByName(many)


def _numbered(
    df: DataFrame, by: str, key: Column, rows: Column, ties: Sequence[str], held: str | None = None
) -> DataFrame:
    """Append ``place``, 0-based by hash inside each group, and ``before``, the sum of ``held``.

    ``rows`` is about how many rows the group has. ``df`` is read twice.
    """
    slices = F.greatest(F.ceil(rows / F.lit(SLICE_ROWS)), F.lit(1))
    cut = df.withColumn("_key", key).withColumn("_slice", F.floor(_unit(F.col("_key")) * slices))
    amount = F.col(held) if held else F.lit(0)
    sizes = cut.groupBy(by, "_slice").agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_held"))
    earlier = Window.partitionBy(by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        by,
        "_slice",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_held_before"),
    )
    inside = Window.partitionBy(by, "_slice").orderBy("_key", *ties)
    above = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumns(
            {
                "place": F.row_number().over(inside) - 1,
                "before": F.coalesce(F.sum(amount).over(above), F.lit(0)),
            }
        )
        .join(shifts, [by, "_slice"])
        .withColumns(
            {
                "place": F.col("place") + F.col("_rows_before"),
                "before": F.col("before") + F.col("_held_before"),
            }
        )
        .drop("_key", "_slice", "_rows_before", "_held_before")
    )


def ranked_sources(documents: DataFrame) -> DataFrame:
    """Every source with its size, its number of rows and its rank by code point, null last."""
    totals = documents.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count(F.lit(1)).alias("source_rows")
    )
    order = F.asc_nulls_last("source")
    sliced = stage(totals.repartitionByRange(order).withColumn("_slice", F.spark_partition_id()))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("n"))  # one row per slice
    shifts = counts.select("_slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_slice").orderBy(order)
    rank = F.row_number().over(inside) - 1 + F.col("_before")
    return sliced.join(shifts, "_slice").select("source", "source_size", "source_rows", rank.alias("rank"))


def with_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Append ``target``: shares of all words by repeating weights, none above its limit.

    What a limit cuts off is shared among the others by weight until none is above. Every
    round is one aggregate: the words a weight of one gets only rise, and they decide which
    sources are at their limits.
    """
    weight = F.array(*[F.lit(w) for w in weights])[F.col("rank") % len(weights)]
    rows = sources.withColumns(
        {"weight": weight.cast("bigint"), "limit": F.col("source_size") * F.lit(MOST_TIMES)}
    )
    wide = "decimal(38,0)"
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    rate, full = Fraction(0), -1
    while True:
        above = F.col("limit").cast(wide) * F.lit(str(rate.denominator)).cast(wide) < F.col(
            "weight"
        ).cast(wide) * F.lit(str(rate.numerator)).cast(wide)
        state = rows.agg(
            F.count(F.when(above, 1)).alias("n"),
            F.sum(F.when(above, F.col("limit")).otherwise(0)).alias("full"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if state.n == full:
            break
        full = state.n
        rate = Fraction(total - (state.full or 0), state.open or 1)
    share = F.when(above, F.col("limit").cast("double")).otherwise(
        F.col("weight") * F.lit(rate.numerator / rate.denominator)
    )
    return rows.withColumn("target", share).drop("weight", "limit")


def _log_factorial(n: Column) -> Column:
    """From a table below 20, by the series of Stirling above; right to about 12 digits."""
    known = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(20)])
    x = n.cast("double")
    series = 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    large = (x + 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi) + series
    return F.when(n < 20, F.get(known, n.cast("int"))).otherwise(large)


def _log_choose(n: Column, k: Column) -> Column:
    return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def hypergeometric(good: Column, total: Column, draws: Column, unit: Column) -> Column:
    """How many of ``draws`` out of ``total`` are among the ``good``, for a number in [0, 1).

    The inverse of the distribution function, summed up from 12 standard deviations below
    the mean, or from the smallest possible value; what lies beyond is less than 1e-30.
    """
    bad = total - good
    whole = F.greatest(total, F.lit(1)).cast("double")
    mean = draws * good / whole
    spread = F.sqrt(mean * (1 - good / whole) * (whole - draws) / F.greatest(whole - 1, F.lit(1.0)))
    zero = F.lit(0).cast("bigint")
    low = F.greatest(zero, draws - bad, F.floor(mean - 12 * spread - 4))
    high = F.least(good, draws, F.ceil(mean + 12 * spread + 4))
    chance = F.exp(_log_choose(good, low) + _log_choose(bad, draws - low) - _log_choose(total, draws))

    def step(state: Column, k: Column) -> Column:
        ratio = (good - k) * (draws - k) / ((k + 1) * (bad - draws + k + 1)).cast("double")
        p = state["p"] * ratio
        up = F.struct((k + 1).alias("k"), p.alias("p"), (state["sum"] + p).alias("sum"))
        return F.when(state["sum"] < unit, up).otherwise(state)

    start = F.struct(low.alias("k"), chance.alias("p"), chance.alias("sum"))
    found = F.aggregate(F.sequence(low, high - 1), start, step, lambda s: s["k"])
    return F.when(low < high, found).otherwise(low)


def _split(children: Column, draws: Column, where: Column) -> Column:
    """Deal ``draws`` over children (structs of id and n) in turn; id and drawn of each."""

    def deal(state: Column, child: Column) -> Column:
        unit = _unit(_key("split", where, child["id"]))
        x = hypergeometric(child["n"], state["total"], state["draws"], unit)
        return F.struct(
            (state["total"] - child["n"]).alias("total"),
            (state["draws"] - x).alias("draws"),
            F.concat(
                state["found"], F.array(F.struct(child["id"].alias("id"), x.alias("drawn")))
            ).alias("found"),
        )

    start = F.struct(
        F.aggregate(children, F.lit(0).cast("bigint"), lambda s, c: s + c["n"]).alias("total"),
        draws.alias("draws"),
        F.array().cast("array<struct<id:bigint,drawn:bigint>>").alias("found"),
    )
    return F.aggregate(children, start, deal, lambda s: s["found"])


def shard_quotas(quotas: DataFrame, shards: int) -> DataFrame:
    """Columns rank, shard and n: each rank's ``quota`` split over the shards.

    Every shard gets the same number of blocks, but for one. A node of the tree is a range
    of shards with one row per source. Its left half's draws are dealt over groups of
    sources first and inside each group then, so a row never holds more than ``FANOUT``
    numbers however many sources there are.
    """
    state = quotas.agg(F.count(F.lit(1)).alias("n"), F.sum("quota").alias("total")).first()
    total, levels = state.total or 0, 1
    while FANOUT**levels < state.n:
        levels += 1

    def edge(shard: Column) -> Column:
        product = shard.cast("decimal(20,0)") * F.lit(str(total)).cast("decimal(18,0)")
        return F.floor(product / F.lit(shards)).cast("bigint")

    nodes = quotas.select("rank", F.col("quota").alias("n"), F.lit(0).alias("low"), F.lit(shards).alias("high"))
    for _ in range(math.ceil(math.log2(shards))):
        nodes = stage(nodes)  # few rows: sources times shards
        single = nodes.where("high - low = 1")
        split = nodes.where("high - low > 1").withColumn(
            "middle", (F.col("low") + F.ceil((F.col("high") - F.col("low")) / 2)).cast("int")
        )
        span = ["low", "middle", "high"]
        drawn = None
        for level in reversed(range(levels)):
            group = F.floor(F.col("rank") / F.lit(FANOUT**level))
            sums = split.groupBy(*span, group.alias("id")).agg(F.sum("n").alias("n"))
            above = sums.groupBy(*span, F.floor(F.col("id") / F.lit(FANOUT)).alias("parent")).agg(
                F.array_sort(F.collect_list(F.struct("id", "n"))).alias("children")
            )
            if drawn is None:
                above = above.withColumn("drawn", edge(F.col("middle")) - edge(F.col("low")))
            else:
                above = above.join(drawn.withColumnRenamed("id", "parent"), [*span, "parent"])
            where = F.concat_ws(":", "low", "high", F.lit(level))
            dealt = F.inline(_split(F.col("children"), F.col("drawn"), where))
            drawn = above.select(*span, dealt)
        both = split.join(drawn.withColumnRenamed("id", "rank"), [*span, "rank"])
        halves = F.inline(
            F.array(
                F.struct(F.col("drawn").alias("n"), F.col("low"), F.col("middle").alias("high")),
                F.struct((F.col("n") - F.col("drawn")).alias("n"), F.col("middle").alias("low"), F.col("high")),
            )
        )
        nodes = both.select("rank", halves).unionByName(single)
    return nodes.select("rank", F.col("low").alias("shard"), "n")


@dataclass(frozen=True)
class Mix:
    """What a mix consists of, as staged tables.

    ``documents`` has a row per input row: rank, source, doc_id, size, source_size, target,
    key (a hash of id and text) and start, the place of its first word in its source.
    ``draws`` has a row per block that a shard takes: rank, block, repeat (which pass),
    words (less than the block only where the target is met), shard and place in it.
    """

    documents: DataFrame
    draws: DataFrame

    def _cut(self) -> DataFrame:
        """The parts of documents by block; documents without words have none."""
        wide = F.col("block_words")
        last = F.floor((F.col("start") + F.col("size") - 1) / wide)
        cut = _repeated(
            self.documents.where("size > 0"), last - F.floor(F.col("start") / wide) + 1, "_nth"
        ).withColumn("block", F.floor(F.col("start") / wide) + F.col("_nth"))
        first = F.greatest(F.col("start"), F.col("block") * wide)
        end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * wide)
        return cut.drop("_nth").withColumns(
            {
                "first_word": first - F.col("start"),
                "offset": first - F.col("block") * wide,
                "_n": end - first,
            }
        )

    def _drawn(self, how: str) -> DataFrame:
        joined = self._cut().join(self.draws, ["rank", "block"], how)
        reach = F.coalesce(F.col("words"), F.lit(0)) - F.col("offset")  # a trimmed block ends earlier
        return joined.withColumn("n_words", F.greatest(F.least(F.col("_n"), reach), F.lit(0)))

    def pieces(self) -> DataFrame:
        """The mix: which words of which document stand where in which shard.

        The pieces of a shard in the order of place and offset are its text.
        """
        return self._drawn("inner").where("n_words > 0").select(
            "shard", "place", "offset", "source", "doc_id", "key", "repeat", "first_word", "n_words"
        )

    def taken(self) -> DataFrame:
        """Per input row the words that the mix takes, repeats counted."""
        columns = ["doc_id", "size", "source_size", "target"]
        words = self._drawn("left").groupBy("rank", "start", *columns).agg(F.sum("n_words").alias("taken"))
        none = self.documents.where("size = 0").select(*columns, F.lit(0).cast("bigint").alias("taken"))
        return words.select(*columns, "taken").unionByName(none)


def piece_texts(pieces: DataFrame, docs: DataFrame) -> DataFrame:
    """The pieces with their ``text``: the words, joined by single spaces."""
    texts = docs.select(
        F.col("doc_id").alias("_id"), _key("document", F.col("doc_id"), F.col("text")).alias("key"), "text"
    ).dropDuplicates(["_id", "key"])
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    said = F.array_join(F.slice(words, F.col("first_word") + 1, F.col("n_words")), " ")
    same = pieces["doc_id"].eqNullSafe(texts["_id"])
    joined = pieces.withColumnRenamed("key", "_key").join(texts, same & (F.col("_key") == F.col("key")))
    return joined.select(*[c for c in pieces.columns if c != "key"], said.alias("text"))


def mix_documents(docs: DataFrame, shards: int = SHARDS, weights: Sequence[int] = WEIGHTS) -> Mix:
    """Mix the sources of ``docs`` (doc_id, text, source) to weights that repeat over them.

    Other columns do not matter. The size of a document is its number of words, of a null
    text 0. Sources are ordered by code point, a null source comes last. Each source's
    taken words are its target, rounded; no word is taken more than three times. Rows that
    agree in id and text are one document with copies, which stand side by side in the
    source's stream. Null ids are ids like any other. An empty table gives an empty mix,
    and so do texts without words. The same rows give the same mix, however they are split.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    rows = docs.select(
        "source",
        "doc_id",
        word_count(F.col("text")).alias("size"),
        _key("document", F.col("doc_id"), F.col("text")).alias("key"),
    )
    grouped = stage(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")))
    block_words = F.greatest(
        F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.col("source_size") / FINEST))
    ).cast("bigint")
    sources = stage(
        with_targets(stage(ranked_sources(grouped)), weights).withColumns(
            {
                "block_words": block_words,
                "blocks": F.ceil(F.col("source_size") / block_words),
                "wanted": F.round("target").cast("bigint"),
            }
        )
    )
    of_source = sources.select(F.col("source").alias("_of"), *[c for c in sources.columns if c != "source"])
    placed = stage(
        grouped.join(of_source, F.col("source").eqNullSafe(F.col("_of")))
        .select(
            *grouped.columns, "rank", "source_size", "source_rows", "target", "block_words"
        )
        .withColumn("_words", F.col("size") * F.col("copies"))
    )
    streamed = _numbered(
        placed, "rank", F.col("key"), F.col("source_rows"), ["doc_id", "size"], held="_words"
    ).drop("place", "_words", "source_rows")
    documents = stage(
        _repeated(streamed, F.col("copies"), "_copy")
        .withColumn("start", F.col("before") + F.col("_copy") * F.col("size"))
        .drop("before", "copies", "_copy")
    )
    return Mix(documents, _draws(sources, shards))


def _draws(sources: DataFrame, shards: int) -> DataFrame:
    """The blocks that each shard takes."""
    size, wanted = F.col("source_size"), F.col("wanted")
    repeats = F.ceil(wanted / F.greatest(size, F.lit(1)))
    passes = sources.where("wanted > 0").select(
        "rank",
        size,
        wanted,
        "block_words",
        "blocks",
        F.explode(F.sequence(F.lit(0).cast("bigint"), repeats - 1)).alias("repeat"),
    )
    end = F.least((F.col("block") + 1) * F.col("block_words"), size)
    blocks = _repeated(passes, F.col("blocks"), "block").withColumns(
        {
            "_pass": F.col("rank") * MOST_TIMES + F.col("repeat"),
            "words": end - F.col("block") * F.col("block_words"),
        }
    )
    order = _key("block", F.col("rank"), F.col("repeat"), F.col("block"))
    listed = _numbered(stage(blocks), "_pass", order, F.col("blocks"), ["block"], held="words")
    left = wanted - F.col("repeat") * size - F.col("before")
    chosen = stage(
        listed.where(left > 0).select(
            "rank",
            "block",
            "repeat",
            (F.col("repeat") * F.col("blocks") + F.col("place")).alias("nth"),
            F.least(F.col("words"), left).alias("words"),
        )
    )
    quotas = chosen.groupBy("rank").agg(F.count(F.lit(1)).alias("quota"))
    dealt = stage(shard_quotas(stage(quotas), shards))
    earlier = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begins = dealt.select("rank", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    lists = begins.groupBy("rank").agg(F.array_sort(F.collect_list("begin")).alias("begins"))
    nth = F.col("nth")
    shard = F.size(F.filter("begins", lambda begin: begin <= nth)) - 1
    in_shards = stage(chosen.join(lists, "rank").withColumn("shard", shard).drop("begins", "nth"))
    held = in_shards.groupBy("shard").agg(F.count(F.lit(1)).alias("held"))
    order = _key("shard", F.col("rank"), F.col("repeat"), F.col("block"))
    shuffled = _numbered(in_shards.join(held, "shard"), "shard", order, F.col("held"), ["rank", "repeat", "block"])
    return stage(shuffled.drop("held", "before"))
