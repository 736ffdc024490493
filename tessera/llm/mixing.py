"""Mixing sources to target weights, by blocks of a fixed number of words.

1. The texts of a source are laid end to end in (hash, id) order and cut into blocks of
   ``block_words`` words; a text takes part in the blocks that its words fall into.
2. Each source's target is its weight's share of all words, at most ``max_epochs`` times what the
   source holds; what is above that is shared again by weight until no source is above
   (:func:`targets`).  A target becomes a number of block draws.
3. A shard is ``shard_slots`` slots of the output, and its source counts are a multinomial draw:
   every slot draws its source with a probability in proportion to the sources' block draws
   (:func:`shard_draws`).  The draws of a source are numbered over all shards.
4. A pseudorandom permutation keyed by source maps these numbers to the source's draw indices;
   index k reads block ``k mod n_blocks``, from a place of its own in every epoch
   ``k div n_blocks``.  So no block is read twice in an epoch, and none more than ``max_epochs``
   times.  Where a source was drawn oftener than its target allows, the slots whose index lies
   beyond it (pseudorandom ones, some square root of the draws in number) go to the sources that
   were drawn too seldom, so every target is met to a block.
5. Blocks are joined by (source, index) with the words of the texts: the mix, one row per slot
   (:func:`mixed_blocks`).  What each text gives to it (:func:`placed_words`) and the texts as the
   mix takes them (:func:`mixed_texts`) are read off these rows.

All steps are DataFrame functions.  No window orders a whole source: offsets come from sums per
(source, hash bucket); draws of a large source are made in runs that are dealt to many tasks.
The window over sources has one row per source.

Nulls: a null source is a source of its own, last in order; a null or empty text has no words
and is taken 0 times; a null id only orders first.  Repeated rows are separate rows with their
own words.  An empty table gives no rows.  Very long texts spread over many blocks.  Other
columns are not read here; :func:`mixed_texts` carries them along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.llm.common import WORD, n_buckets, released, saved, scatter_points, scattered

WEIGHTS = (5, 2, 1)
#: the white space between words
SPACES = " \t\n\x0b\f\r"
#: shards numbered together, and the least number of cells that the number line is cut into
RUN, CELLS = 256, 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key that is never null; a null source sorts after all others."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3,
            block_words: int = 64) -> DataFrame:
    """Per source of ``sized`` (skey, size): words, target words, blocks and block draws.

    With sources in order of size / weight, those before some place are held at their limit and
    the rest share what is left by weight; the first place whose limit is not below its share
    is where the held ones end.
    """
    by_name = W.orderBy("skey")
    ratio = F.col("source_size") / F.col("weight")
    before = W.orderBy(ratio, "skey").rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(F.lit(1))
    s = sized.groupBy("skey").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                            (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    held = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * max_epochs
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("_level", (F.sum("source_size").over(every) - held) / open_weight) \
        .withColumn("_first", F.col("source_size") * max_epochs / F.col("weight") >= F.col("_level")) \
        .withColumn("_level", F.min(F.when(F.col("_first"), F.struct(ratio.alias("r"), "skey", "_level"))).over(every)["_level"])
    target = F.least(F.col("source_size") * max_epochs, F.col("_level") * F.col("weight")).cast("double")
    blocks = F.ceil(F.col("source_size") / block_words)
    draws = F.when(F.col("source_size") > 0, F.round(target * blocks / F.col("source_size"))).otherwise(0)
    return s.select("skey", "source_size", target.alias("target"), blocks.cast("long").alias("n_blocks"),
                    draws.cast("long").alias("n_draws"))


def _sources(of: DataFrame, length: Column, start: str, total: int, names: int) -> tuple[DataFrame, int]:
    """``of`` laid end to end by name, ``length`` each, as one row per source and cell; a cell's width."""
    named = W.orderBy("skey").rowsBetween(W.unboundedPreceding, 0)
    width = max(1, -(-total // max(CELLS, 8 * names)))
    s = of.withColumn("_n", length).withColumn(start, F.sum("_n").over(named) - F.col("_n")).where("_n > 0")
    cells = F.sequence(F.floor(F.col(start) / width), F.floor((F.col(start) + F.col("_n") - 1) / width))
    return s.withColumn("_end", F.col(start) + F.col("_n")).withColumn("_cell", F.explode(cells)).drop("_n"), width


def _tasks(spark: SparkSession, draws: int) -> int:
    return max(4 * spark.sparkContext.defaultParallelism, draws >> 20)


def shard_draws(of: DataFrame, shard_slots: int = 4096, seed: int = 0) -> DataFrame:
    """The multinomial draw of every shard: shard, skey and the slots that drew this source, in order."""
    spark = of.sparkSession
    total, names = of.agg(F.coalesce(F.sum("n_draws"), F.lit(0)), F.count("skey")).first()
    spans, width = _sources(of.select("skey", "n_draws"), F.col("n_draws"), "_from", total, names)
    at = F.pmod(F.xxhash64("id", F.lit("source"), F.lit(seed)), F.lit(max(1, total)))
    slots = spark.range(0, total, 1, _tasks(spark, total)).select(
        F.floor(F.col("id") / shard_slots).alias("shard"), F.pmod("id", F.lit(shard_slots)).cast("int").alias("slot"),
        at.alias("_at")).withColumn("_cell", F.floor(F.col("_at") / width))
    return slots.join(spans, "_cell").where("_at >= _from and _at < _end") \
        .groupBy("skey", "shard").agg(F.array_sort(F.collect_list("slot")).alias("slots"))


def draws(of: DataFrame, shard_slots: int = 4096, seed: int = 0) -> DataFrame:
    """Every block draw: skey, block, epoch, shard, slot (place within the shard)."""
    drawn = saved(shard_draws(of, shard_slots, seed), "shard-draws").withColumn("_run", F.floor(F.col("shard") / RUN))
    n = F.size("slots").cast("long")
    runs = drawn.groupBy("skey", "_run").agg(F.sum(n).alias("_sum"))
    got = runs.groupBy("skey").agg(F.sum("_sum").alias("_got"))
    sources = of.where("n_draws > 0").select("skey", "n_blocks", "n_draws").join(got, "skey", "left") \
        .withColumn("_got", F.coalesce("_got", F.lit(0).cast("long"))).withColumn("_over", F.greatest(F.col("_got") - F.col("n_draws"), F.lit(0)))
    # the permutation's points are the same for all draws of a source
    points = scatter_points(F.greatest(F.col("_got"), F.lit(1)), F.col("skey"), F.lit(seed))
    sources = saved(sources.withColumn("_over_from", F.sum("_over").over(
        W.orderBy("skey").rowsBetween(W.unboundedPreceding, 0)) - F.col("_over")).withColumn("_points", points), "sources")
    over, names, total = sources.agg(F.coalesce(F.sum("_over"), F.lit(0)), F.count("skey"),
                                     F.coalesce(F.sum("n_draws"), F.lit(0))).first()

    base = runs.withColumn("_base", F.sum("_sum").over(W.partitionBy("skey").orderBy("_run")) - F.col("_sum")).drop("_sum")
    w = W.partitionBy("skey", "_run").orderBy("shard").rowsBetween(W.unboundedPreceding, 0)
    numbered = drawn.join(base, ["skey", "_run"]).withColumn("_first", F.col("_base") + F.sum(n).over(w) - n)
    # few bytes make many draws, so shards are dealt to tasks by the number of draws
    k = numbered.repartition(_tasks(of.sparkSession, total), "skey", "shard").join(sources, "skey").select(
        "skey", "shard", "_first", "_got", "n_draws", "n_blocks", "_over_from", "_points", F.posexplode("slots").alias("_i", "slot"))
    k = k.withColumn("_k", scattered(F.col("_first") + F.col("_i"), F.col("_got"), F.col("skey"), F.lit(seed),
                                     points=F.col("_points")))

    # an index beyond the target takes a draw of a source that was drawn too seldom; the others meet no cell
    short, width = _sources(sources.select("skey", "n_blocks", "_got", "n_draws"),
                            F.greatest(F.col("n_draws") - F.col("_got"), F.lit(0)), "_from", over, names)
    short = short.select("_cell", "_from", "_end", F.col("skey").alias("_skey"), F.col("n_blocks").alias("_blocks"),
                         F.col("_got").alias("_has"))
    k = k.withColumn("_at", F.when(F.col("_k") >= F.col("n_draws"), F.col("_over_from") + F.col("_k") - F.col("n_draws"))) \
        .withColumn("_cell", F.coalesce(F.floor(F.col("_at") / width), -1 - F.col("_k")))
    k = k.join(short, (k["_cell"] == short["_cell"]) & (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_end")), "left") \
        .select(F.coalesce("_skey", "skey").alias("skey"), F.coalesce("_blocks", "n_blocks").alias("n_blocks"), "shard", "slot",
                F.coalesce(F.col("_has") + F.col("_at") - F.col("_from"), F.col("_k")).alias("_k"))
    epoch = F.floor(F.col("_k") / F.col("n_blocks"))
    start = F.pmod(F.xxhash64("skey", epoch, F.lit(seed)), F.col("n_blocks"))
    return k.select("skey", F.pmod(F.col("_k") + start, F.col("n_blocks")).alias("block"), epoch.alias("epoch"), "shard",
                    F.col("slot").cast("long").alias("slot"))


def laid_out(docs: DataFrame, order: list[str], source: str = "source", text: str = "text",
             keep: list[str] | None = None, most_shared: int = 200_000) -> DataFrame:
    """``docs`` (or its columns ``keep``) with skey, size (words) and first_word, the place of its first word in its source.

    Rows are written with their place within a hash bucket of their source, so words are counted once; the
    buckets' starts follow from that table, and are shared with all tasks only if at most ``most_shared``."""
    bucket = F.pmod(F.xxhash64(*order), F.lit(n_buckets(docs)))
    d = docs.withColumn("skey", source_key(F.col(source))).withColumn("size", n_words(F.col(text))).withColumn("_bucket", bucket)
    w = W.partitionBy("skey", "_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in order]) \
        .rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumn("_within", F.sum("size").over(w) - F.col("size"))
    columns = [c for c in dict.fromkeys([*(keep or docs.columns), "skey", "size"]) if c != "first_word"]
    placed = saved(d.select(*columns, "_bucket", "_within"), "laid-out")
    sums = placed.groupBy("skey", "_bucket").agg(F.sum("size").alias("_sum"))
    starts = saved(sums.select("skey", "_bucket", (F.sum("_sum").over(W.partitionBy("skey").orderBy("_bucket"))
                                                   - F.col("_sum")).alias("_start")), "bucket-starts")
    if starts.count() <= most_shared:
        starts = F.broadcast(starts)
    return placed.join(starts, ["skey", "_bucket"]).select(*columns, (F.col("_start") + F.col("_within")).alias("first_word"))


def blocks_of(laid: DataFrame, block_words: int) -> DataFrame:
    """One row per text and block: block, from_word (within the text), words."""
    first, end = F.col("first_word"), F.col("first_word") + F.col("size")
    b = laid.where("size > 0").select("skey", "first_word", "size", F.explode(F.sequence(
        F.floor(first / block_words), F.floor((end - 1) / block_words))).alias("block"))
    lo = F.greatest(F.col("block") * block_words, first)
    hi = F.least((F.col("block") + 1) * block_words, end)
    return b.select("skey", "first_word", "block", (lo - first).alias("from_word"), (hi - lo).alias("words"))


def mixture(docs: DataFrame, order: list[str], source: str = "source", text: str = "text",
            weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, block_words: int = 64,
            shard_slots: int = 4096, seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The laid-out texts (without text), the sources with targets, and the draws."""
    laid = laid_out(docs, order, source, text, [c for c in order if c != text])
    of = targets(laid, weights, max_epochs, block_words)
    return laid, of, draws(of, shard_slots, seed)


def in_shards(drawn: DataFrame) -> DataFrame:
    """``drawn`` with source_draws: how many draws of its source the shard holds."""
    counts = drawn.groupBy("shard", "skey").agg(F.count(F.lit(1)).alias("source_draws"))
    return drawn.join(counts, ["shard", "skey"])


def block_texts(laid: DataFrame, block_words: int, text: str = "text") -> DataFrame:
    """One row per block: skey, block, parts (first_word, from_word, words, text; in order).

    A part's text holds its words, each with the white space that follows it."""
    first, end = F.col("first_word"), F.col("first_word") + F.col("size")
    # as many words before the text as its first block holds of others: then every run of words is one block's
    others = (first % block_words).cast("int")
    runs = F.regexp_extract_all(F.concat(F.repeat(F.lit("x "), others), F.ltrim(F.col(text), F.lit(SPACES))),
                                F.lit(f"(?:{WORD}+[\\x20\\x09-\\x0D]*+){{1,{block_words}}}+"), F.lit(0))
    cuts = laid.where("size > 0").select("skey", "first_word", "size", F.posexplode(runs).alias("_i", "_text"))
    block = F.floor(first / block_words) + F.col("_i")
    lo = F.greatest(block * block_words, first)
    part = F.struct("first_word", (lo - first).alias("from_word"),
                    (F.least((block + 1) * block_words, end) - lo).alias("words"),
                    F.when(F.col("_i") == 0, F.substring("_text", 2 * others + 1, F.length("_text"))).otherwise(F.col("_text")).alias("text"))
    return cuts.select("skey", block.alias("block"), part.alias("p")).groupBy("skey", "block") \
        .agg(F.array_sort(F.collect_list("p")).alias("parts"))


def mixed_blocks(docs: DataFrame, order: list[str], source: str = "source", text: str = "text",
                 weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, block_words: int = 64,
                 shard_slots: int = 4096, seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The laid-out rows of ``docs``, the sources with targets, and the mix itself.

    The mix has one row per slot: shard, slot, skey, block, epoch, source_draws (draws of this
    source in the shard), words (the block's text, a line break between texts) and parts."""
    laid = laid_out(docs, order, source, text)
    of = targets(laid, weights, max_epochs, block_words)
    drawn = in_shards(saved(draws(of, shard_slots, seed), "draws"))
    mix = block_texts(laid, block_words, text).join(drawn, ["skey", "block"])
    words = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    return laid, of, mix.select("shard", "slot", "skey", "block", "epoch", "source_draws", words.alias("words"), "parts")


def _summed(laid: DataFrame, of: DataFrame, got: DataFrame, zero: dict) -> DataFrame:
    """``laid`` with source_size, target and ``got``'s columns, which are ``zero`` where it has no row."""
    rows = laid.where("size > 0").join(got, ["skey", "first_word"], "left")
    none = laid.where("size = 0")
    for c, value in zero.items():
        rows, none = rows.withColumn(c, F.coalesce(c, value)), none.withColumn(c, value)
    return rows.unionByName(none).join(of.select("skey", "source_size", "target"), "skey")


def taken_words(laid: DataFrame, of: DataFrame, drawn: DataFrame, block_words: int = 64) -> DataFrame:
    """``laid`` with source_size, target and taken: the words that the mix takes of each text."""
    uses = drawn.groupBy("skey", "block").agg(F.count(F.lit(1)).alias("uses"))
    got = blocks_of(laid, block_words).join(uses, ["skey", "block"]) \
        .groupBy("skey", "first_word").agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
    return _summed(laid, of, got, {"taken": F.lit(0).cast("long")})


PLACES = "array<struct<shard: bigint, slot: bigint, epoch: bigint, block: bigint, words: bigint, source_draws: bigint, words_crc32: bigint>>"


def placed_words(laid: DataFrame, of: DataFrame, mix: DataFrame) -> DataFrame:
    """``laid`` with source_size, target, taken and places: every slot of the mix that holds words
    of the text, how many of them, the shard's draws of the source, and a checksum of the slot."""
    crc = F.crc32(F.encode("words", "UTF-8"))
    parts = mix.select("shard", "slot", "skey", "epoch", "block", "source_draws", crc.alias("words_crc32"),
                       F.explode(F.transform("parts", lambda p: F.struct(p["first_word"].alias("first_word"),
                                                                         p["words"].alias("words")))).alias("p"))
    place = F.struct("shard", "slot", "epoch", "block", F.col("p.words").alias("words"), "source_draws", "words_crc32")
    got = parts.groupBy("skey", F.col("p.first_word").alias("first_word")) \
        .agg(F.sum("p.words").alias("taken"), F.array_sort(F.collect_list(place)).cast(PLACES).alias("places"))
    return _summed(laid, of, got, {"taken": F.lit(0).cast("long"), "places": F.array().cast(PLACES)})


def mixed_texts(docs: DataFrame, order: list[str], source: str = "source", text: str = "text",
                weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, block_words: int = 64,
                seed: int = 0, shard_slots: int = 4096, most_parts: int = 2000) -> DataFrame:
    """``docs`` as the mix takes them: a text appears once per epoch in which it has a part, cut
    to the words drawn in that epoch, each with the white space that follows it.

    Rows come in the order of the mix, by the first slot that holds a part of them; a shard's rows
    are in one partition."""
    columns = docs.columns
    laid, of, mix = mixed_blocks(docs, order, source, text, weights, max_epochs, block_words, shard_slots, seed)
    released(docs.sparkSession)
    # dealt by text before they are grouped by text and epoch, so the join below finds them in place
    parts = mix.select("shard", "slot", "skey", "epoch", F.explode("parts").alias("p")) \
        .withColumn("first_word", F.col("p.first_word")).repartition("skey", "first_word")
    cut = F.array_sort(F.collect_list(F.struct("p.from_word", "p.text")))
    rows = parts.groupBy("skey", "first_word", "epoch") \
        .agg(F.min(F.struct("shard", "slot")).alias("_at"), cut.alias("_cut")) \
        .withColumn("_text", F.array_join(F.transform("_cut", lambda p: p["text"]), "")).drop("_cut")
    rows = laid.where("size > 0").drop(text).join(rows, ["skey", "first_word"]).withColumnRenamed("_text", text)
    total = of.agg(F.sum("n_draws")).first()[0] or 0
    shards = max(1, -(-total // shard_slots))
    n = min(shards, most_parts)
    rows = rows.withColumn("_part", F.floor(F.col("_at.shard") * n / shards).cast("int"))
    return rows.repartitionById(n, "_part").sortWithinPartitions("_at", "first_word").select(*columns)
