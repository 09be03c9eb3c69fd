"""Mixing sources to target weights: blocks, drawn shards, permuted indexes.

The words of a source, its documents in order, are packed into blocks of a
fixed length.  A source's share of the mix, a number of words, becomes so many
slots; each slot draws its output shard, so a shard's counts by source are
multinomial draws while every source's total stays what its target says.
A pseudorandom permutation of the source's block indexes maps slots to
blocks: slot j takes the block at place j modulo the number of blocks, so that
no block comes again before all have come.  Blocks and slots meet by index.

Built-in functions only.  Nothing depends on the order of rows or on
partitions, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.store import land
from ledgerlake.operators.windows import row_number_spread

WEIGHTS = (5, 2, 1)         # of the sources in order, repeating
SHARE = 1.5                 # size of the mix, in sizes of all documents
MOST = 2                    # times that a word is taken at most
BLOCK = 256                 # words in a block
SHARD_SLOTS = 4096          # slots in an output shard, on average
ROUNDS = 24                 # of the permutation
CHUNK = 4096                # slots made from one row
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]*"


def word_count(text: Column) -> Column:
    """Words of a text: each, with the space around it, is cut to one letter
    (null: 0)."""
    marks = F.regexp_replace(text, GAP + WORD + GAP, "x")
    return F.coalesce(F.when(text.rlike(WORD), F.length(marks)), F.lit(0)).cast("long")


def permute(x: Column, n: Column, seed: Column, inverse: bool = False) -> Column:
    """The place of ``x`` in a pseudorandom permutation of 0, .. , n - 1.

    A swap-or-not shuffle: each round pairs x with (k - x) mod n, k being the
    round's key, and a bit of the pair's hash says whether the two change
    places.  A round undoes itself, so the inverse runs them backward.
    """
    def step(v: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(seed, r), n) - v, n)
        swap = F.xxhash64(seed, r, F.greatest(v, partner)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, partner).otherwise(v)

    rounds = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    return F.aggregate(F.array(*[F.lit(r) for r in rounds]), x.cast("long"), step)


def targets(sized: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, rank, source_size, target) of a table (source, size).

    A source that would pass ``most`` times its size stops there, and the rest
    is shared anew among the others by weight until none passes: with a level
    L for all, a source gets the lesser of L times its weight and its cap, and
    L rises until the shares add up.
    """
    if not 0 <= share <= most:
        raise ValueError("share: from 0 to the number of times that a word may be taken")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = row_number_spread(sums, [], [F.col("source").asc_nulls_last()], "rank")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int"))
    table = land(ranked.select("source", F.col("rank").cast("long").alias("rank"), "source_size", weight.alias("weight"), (F.col("source_size") * most).cast("double").alias("cap")), "mix-sources")
    whole = table.agg(F.sum("source_size"), F.sum("weight")).head()
    wanted = share * (whole[0] or 0)
    level, full = wanted / (whole[1] or 1), -1
    while True:         # each round fills more sources, or is the last
        free = F.col("cap") > level * F.col("weight")
        now = table.agg(F.count_if(~free), F.sum(F.when(~free, F.col("cap"))), F.sum(F.when(free, F.col("weight")))).head()
        if now[0] == full or not now[2]:
            break
        full, level = now[0], (wanted - (now[1] or 0)) / now[2]
    return table.select("source", "rank", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def _placed(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """``docs`` (columns id, source, size, text) with their source's row and
    ``start``: the words of the source before the document.

    Documents are laid out by source, id, size and a hash; a source's words
    are summed within each range of the layout, and the sums of earlier
    ranges are added, so that a large source is the work of many tasks.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = docs.join(sources.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named"))).drop("named", "source")
    order = ["rank", "id", "size", "hash", "row"]
    keyed = joined.withColumn("hash", F.xxhash64("text") if "text" in docs.columns else F.col("hash")).withColumn("row", F.monotonically_increasing_id())
    laid = land(keyed.repartitionByRange(n, *order).withColumn("range", F.spark_partition_id()), "mix-layout")
    here = Window.partitionBy("range", "rank").orderBy("id", "size", "hash", "row").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = laid.groupBy("rank", "range").agg(F.sum("size").alias("sum")).select("rank", "range", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("passed"))
    return (laid.withColumn("within", F.coalesce(F.sum("size").over(here), F.lit(0))).join(ranges, ["rank", "range"])
            .withColumn("start", F.col("within") + F.col("passed")).drop("within", "passed", "range", "row", "hash"))


def slots(sources: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(rank, slot, shard, block, words): the mix as slots of blocks.

    ``words`` counts from the block's beginning; it is less than the block
    only in the last slot of a source, which ends at the target.
    """
    blocks = F.ceil(F.col("source_size") / block)
    base = (sources.where(F.col("source_size") > 0)
            .select("rank", F.floor(F.col("target") + 0.5).alias("take"), blocks.alias("n"), (blocks * block - F.col("source_size")).alias("lack"))
            .withColumn("end_at", permute(F.col("n") - 1, F.col("n"), F.col("rank"), inverse=True))       # place of the block that isn't full
            .withColumn("count", F.ceil((F.col("take") + F.col("lack") * (MOST + 1)) / block)))
    shards = F.greatest(F.lit(1), F.ceil(F.lit((base.agg(F.sum("take")).head()[0] or 0) / block / shard_slots))).cast("long")
    chunks = base.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("count") / CHUNK)))).repartition(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rank", "chunk")
    first = F.col("chunk") * CHUNK
    made = chunks.withColumn("slot", F.explode(F.sequence(first, first + (CHUNK - 1)))).where(F.col("slot") < F.col("count"))
    place, turn = F.pmod(F.col("slot"), F.col("n")), F.floor(F.col("slot") / F.col("n"))
    passed = F.col("slot") * block - F.col("lack") * (turn + F.when(place > F.col("end_at"), 1).otherwise(0))
    held = F.lit(block) - F.when(place == F.col("end_at"), F.col("lack")).otherwise(0)
    made = made.withColumn("words", F.least(held, F.col("take") - passed)).where(F.col("words") > 0)
    return made.select("rank", "slot", F.pmod(F.xxhash64("rank", "slot", F.lit("shard")), shards).alias("shard"),
                       permute(place, F.col("n"), F.col("rank")).alias("block"), "words")


def shard_counts(made: DataFrame) -> DataFrame:
    """(shard, rank, slots, words): the draw, by output shard and source."""
    return made.groupBy("shard", "rank").agg(F.count("*").alias("slots"), F.sum("words").alias("words"))


def _pieces(placed: DataFrame, block: int, with_text: bool) -> DataFrame:
    """The documents cut at block bounds: block, first and last (exclusive)
    word in the block, first word in the document."""
    start, end = F.col("start"), F.col("start") + F.col("size")
    def piece(b: Column) -> Column:
        low, high = F.greatest(start, b * block), F.least(end, (b + 1) * block)
        fields = [b.alias("block"), (low - b * block).alias("low"), (high - b * block).alias("high"), (low - start).alias("first_word")]
        if with_text:
            fields.append(F.array_join(F.slice("words", (low - start + 1).cast("int"), (high - low).cast("int")), " ").alias("piece"))
        return F.struct(*fields)

    source = placed.withColumn("words", F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)) if with_text else placed
    cut = source.where(F.col("size") > 0).withColumn("p", F.explode(F.transform(F.sequence(F.floor(start / block), F.floor((end - 1) / block)), piece)))
    return cut.select("rank", "id", "size", "start", "source_size", "target", "p.*")


def _prepared(docs: DataFrame, key: str, text: str, source: str, with_text: bool, **parameters) -> tuple[DataFrame, DataFrame]:
    body = F.coalesce(F.col(text), F.lit(""))
    columns = [F.col(key).alias("id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"),
               body.alias("text") if with_text else F.xxhash64(body).alias("hash")]
    sized = docs.select(*columns)
    if not with_text:
        sized = land(sized, "mix-sizes")        # texts are read and counted once
    sources = land(targets(sized.select("source", "size"), **parameters), "mix-targets")
    return _placed(sized, sources), sources


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK, **parameters) -> DataFrame:
    """(shard, rank, slot, at, key, first_word, text): the mix itself, a row
    for each stretch of a document that a slot holds; ``at`` is its place in
    the slot, ``rank`` the number of its source.

    See ``shares`` for nulls, empty tables, repeats and other columns.
    """
    placed, sources = _prepared(docs, key, text, source, True, **parameters)
    both = _pieces(placed, block, True).join(land(slots(sources, block), "mix-slots"), ["rank", "block"]).where(F.col("low") < F.col("words"))
    left = F.least(F.col("high"), F.col("words")) - F.col("low")
    return both.select("shard", "rank", "slot", F.col("low").alias("at"), F.col("id").alias(key), "first_word",
                       F.array_join(F.slice(F.split("piece", " "), F.lit(1), left.cast("int")), " ").alias("text"))


def shares(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK, **parameters) -> DataFrame:
    """(key, size, source_size, target, taken) per row of ``docs``: its words,
    its source's words, the words that the mix should take of the source, and
    those that it takes of the row (repeats counted).

    Null texts have no words, rows without words are never taken, null
    sources form the last source, null keys are keys like any other, repeated
    rows count each for itself; a source without words has target 0.  An empty
    table gives no rows; other columns play no part.  A source's taken words
    are its target, rounded.
    """
    placed, sources = _prepared(docs, key, text, source, False, **parameters)
    placed = land(placed, "mix-placed")
    parts = _pieces(placed, block, False).join(land(slots(sources, block), "mix-slots").select("rank", "block", "words"), ["rank", "block"], "left")
    got = F.greatest(F.least(F.col("high"), F.coalesce("words", F.lit(0))) - F.col("low"), F.lit(0))
    of_row = parts.groupBy("rank", "start", "id", "size", "source_size", "target").agg(F.sum(got).cast("long").alias("taken"))
    none = placed.where(F.col("size") == 0).withColumn("taken", F.lit(0).cast("long"))
    out = ["id", "size", "source_size", "target", "taken"]
    return of_row.select(*out).unionByName(none.select(*out)).withColumnRenamed("id", key)
