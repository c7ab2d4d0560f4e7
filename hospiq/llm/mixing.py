"""Operator 10: mixing sources to target weights (DataFrame functions only).

1. Every source's documents, in a fixed pseudorandom order, make one stream of
   words, which is cut into blocks of a fixed length (the last is shorter).
2. A source's target is a number of block slots; the last takes as many words
   of its block as are missing. Slots of all sources are dealt to output shards
   of a fixed size by one pseudorandom permutation, so a shard's source counts
   are drawn from the multinomial law with the target shares, conditioned on
   the sources' totals (the mix meets its targets). The drawn counts are a
   table, from which everything that follows is made.
3. By the counts of the shards before it, a shard's slots of a source have
   numbers; the n-th slot of a source takes block ``permutation(n mod blocks)``:
   a keyed swap-or-not permutation of the block numbers, computed per row. So no
   block repeats before all of its source's blocks had a turn.
4. Slots meet documents in a join on (source, block).

Running offsets are built in two levels (bucket totals, then inside a bucket),
so a source with a third of all rows is split over many tasks. Targets are found
by aggregations over one row for each source, of which there may be many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_PATTERN, materialize, numbered, read_table

BLOCK_WORDS = 256       # words in a block
BUCKET_ROWS = 20_000    # rows meant for a part of a source's running offsets
SHARD_SLOTS = 4096      # block slots in an output shard
ROUNDS = 24             # of a permutation
RUN = 1 << 13           # slots that one small row stands for until they are needed
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size``: size counts the words of the whole text."""
    return docs.select("doc_id", "source", F.coalesce(
        F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"))


def targets(spark: SparkSession, sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target``: the weights, repeating over the sources
    in code point order (null last), share the whole size; a target stops at
    ``max_epochs`` times its source's size and the excess is shared anew by
    weight. Sources are numbered by range partitions. The level, target over
    weight of the sources that are not capped, only rises from one sharing to
    the next; each is one aggregation, until no further source is capped."""
    per = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    per = numbered(per, [F.col("source").cast("binary").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    per = materialize(per.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_epochs).alias("cap")), "weights")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while total:
        over = F.col("cap") <= F.col("weight") * F.lit(level)
        r = per.agg(F.count_if(over).alias("n"), F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)).alias("caps"),
                    F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("free")).first()
        if r["n"] == capped or not r["free"]:
            break
        capped, level = r["n"], (total - r["caps"]) / r["free"]
    share = F.col("weight") * F.lit(level)
    return per.select("source", "source_size", F.when(share < F.col("cap"), share).otherwise(F.col("cap").cast("double")).alias("target"))


def permuted(n: Column, size: Column, key: Column, rounds: int = ROUNDS, back: bool = False) -> Column:
    """Swap-or-not: a keyed permutation of 0 .. size-1. In each round x and its
    partner (k - x) mod size change places or not, by a hash of the larger.
    ``back``: its inverse, the same rounds from the last to the first."""
    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, r), size) - x, size)
        swap = F.xxhash64(key, -r - 1, F.greatest(x, partner)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, partner).otherwise(x)
    order = range(rounds - 1, -1, -1) if back else range(rounds)
    return F.aggregate(F.array(*[F.lit(r) for r in order]), n.cast("long"), step)


def plan(sources: DataFrame, seed: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per source: its number of blocks and of slots, and the words that the
    last slot takes (0: the whole block). Whole turns take every block; in the
    turn begun last, the words before a slot are those of whole blocks but for
    the short block, whose slot the inverse permutation gives."""
    p = (sources.filter("source_size > 0").withColumn("block_words", F.lit(block_words).cast("long"))
         .withColumn("n_blocks", F.ceil(F.col("source_size") / block_words))
         .withColumn("key", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull(), F.lit(seed)))
         .withColumn("words", F.round("target").cast("long")))
    p = (p.withColumn("turns", F.floor(F.col("words") / F.col("source_size")))
         .withColumn("rest", F.col("words") - F.col("turns") * F.col("source_size"))
         .withColumn("missing", F.col("n_blocks") * block_words - F.col("source_size"))
         .withColumn("short_at", permuted(F.col("n_blocks") - 1, F.col("n_blocks"), F.xxhash64("key", "turns"), back=True)))
    # after the short block a slot starts ``missing`` words earlier
    passed = F.col("rest") >= (F.col("short_at") + 1) * block_words - F.col("missing")
    whole = F.when(passed, F.floor((F.col("rest") + F.col("missing")) / block_words)).otherwise(
        F.least(F.floor(F.col("rest") / block_words), F.col("short_at")))
    p = p.withColumn("whole", whole).withColumn(
        "last_words", F.col("rest") - (F.col("whole") * block_words - F.when(passed, F.col("missing")).otherwise(0)))
    return p.withColumn("n_slots", F.col("turns") * F.col("n_blocks") + F.col("whole") + (F.col("last_words") > 0).cast("long")).select(
        "source", "source_size", "target", "block_words", "n_blocks", "key", "n_slots", "last_words")


def _runs(rows: DataFrame, count: str) -> DataFrame:
    """Each row ``count`` times, with ``i`` = 0, 1 ...: first as runs, small
    rows that are dealt over a fixed number of partitions (adaptive execution
    would pack all of them into one), then as single ones."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = rows.filter(F.col(count) > 0).withColumn(
        "run", F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1, F.lit(RUN).cast("long"))))
    keys = [F.col(c) for c in rows.columns if c in ("source", "shard")]
    return (runs.repartition(parts, *keys, F.col("run"))
            .withColumn("i", F.explode(F.sequence(F.col("run"), F.least(F.col("run") + RUN, F.col(count)) - 1))).drop("run"))


def shard_counts(planned: DataFrame, seed: int) -> DataFrame:
    """``source, shard, slots``: how many of its slots a shard draws from each
    source. All slots, source by source, stand in one line; a permutation of the
    line is cut into shards of ``SHARD_SLOTS``."""
    spark = planned.sparkSession
    line = planned.select("source", "n_slots").filter("n_slots > 0")
    total = line.agg(F.sum("n_slots")).first()[0] or 0
    if not total:
        return spark.createDataFrame([], planned.select("source").schema.add("shard", "long").add("slots", "long"))
    # where a source's slots start in the line: places by runs of sources, then inside a run
    placed = numbered(materialize(line, "line"), [F.col("source").cast("binary").asc_nulls_last()], "place")
    placed = placed.withColumn("part", F.floor(F.col("place") / 10_000))
    sums = placed.groupBy("part").agg(F.sum("n_slots").alias("s"))
    sums = sums.select(F.col("part").alias("s_part"), (F.sum("s").over(W.orderBy("part")) - F.col("s")).alias("base"))
    inside = F.sum("n_slots").over(W.partitionBy("part").orderBy("place")) - F.col("n_slots")
    placed = (placed.withColumn("inside", inside).join(sums, F.col("part") == F.col("s_part"))
              .select("source", "n_slots", (F.col("base") + F.col("inside")).alias("first")))
    slot = _runs(placed, "n_slots").select("source", permuted(F.col("first") + F.col("i"), F.lit(total).cast("long"), F.lit(seed + 1)).alias("at"))
    return slot.groupBy("source", F.floor(F.col("at") / SHARD_SLOTS).alias("shard")).agg(F.count(F.lit(1)).alias("slots"))


def slots(planned: DataFrame, counts: DataFrame, seed: int) -> DataFrame:
    """``source, block, shard, slot_key, words_taken``: one row for each block
    slot of the mix, from the shards' drawn counts; words_taken 0 takes the
    whole block."""
    before = F.sum("slots").over(W.partitionBy("source").orderBy("shard")) - F.col("slots")
    p = planned.select(F.col("source").alias("p_source"), "n_blocks", "n_slots", "key", "last_words")
    dealt = counts.withColumn("before", before).join(p, F.col("source").eqNullSafe(F.col("p_source")))
    n = _runs(dealt, "slots").withColumn("n", F.col("before") + F.col("i"))
    epoch = F.floor(F.col("n") / F.col("n_blocks"))
    return n.select("source", permuted(F.pmod("n", "n_blocks"), F.col("n_blocks"), F.xxhash64("key", epoch)).alias("block"), "shard",
                    F.xxhash64("key", "n", F.lit(seed + 3)).alias("slot_key"),
                    F.when(F.col("n") == F.col("n_slots") - 1, F.col("last_words")).otherwise(0).alias("words_taken"))


def pieces(sizes: DataFrame, planned: DataFrame, seed: int) -> DataFrame:
    """``source, block, doc_id, size, copies, from_word, in_block, words``:
    which words of which document fill a block, and where in it."""
    buckets = max(256, -(-sizes.count() // BUCKET_ROWS))
    rows = (sizes.filter("size > 0").groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("total", F.col("size") * F.col("copies"))
            .withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(buckets))))
    sums = rows.groupBy("source", "bucket").agg(F.sum("total").alias("in_bucket"))
    base = sums.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"),
                       (F.sum("in_bucket").over(W.partitionBy("source").orderBy("bucket")) - F.col("in_bucket")).alias("base"))
    order = W.partitionBy("source", "bucket").orderBy(F.xxhash64("doc_id", F.lit(seed + 2)), "doc_id", "size")
    placed = (rows.withColumn("inner", F.sum("total").over(order) - F.col("total"))
              .join(base, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
              .select("doc_id", "source", "size", "copies", (F.col("base") + F.col("inner")).alias("start"), "total"))
    p = planned.select(F.col("source").alias("p_source"), "block_words")
    spans = placed.join(p, F.col("source").eqNullSafe(F.col("p_source"))).withColumn("end", F.col("start") + F.col("total"))
    b = spans.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / F.col("block_words")), F.floor((F.col("end") - 1) / F.col("block_words")))))
    low = F.greatest(F.col("start"), F.col("block") * F.col("block_words"))
    high = F.least(F.col("end"), (F.col("block") + 1) * F.col("block_words"))
    return b.select("source", "block", "doc_id", "size", "copies", (low - F.col("start")).alias("from_word"),
                    (low - F.col("block") * F.col("block_words")).alias("in_block"), (high - low).alias("words"))


def mix(docs: DataFrame, seed: int = 20240601, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS):
    """(decisions, manifest). Decisions: one row per row of ``docs``: ``doc_id,
    source, size, source_size, target, taken``. Manifest: ``shard, slot_key,
    source, block, doc_id, from_word, words``, the blocks of each shard in
    pseudorandom order, from which a writer fetches the words.

    A null text has size 0 and, like an empty one, is never taken. A null
    source is a source of its own, the last. Rows that repeat id, source and
    size share what their copies take evenly, the remainder lost to none by
    rounding up to the whole number below 3 times the size. Other columns are
    not read. An empty table, or one without words, gives taken 0 everywhere.
    The same rows always give the same mix, however they are partitioned.
    """
    sizes = materialize(sized(docs), "sizes")
    sources = materialize(targets(docs.sparkSession, sizes, weights, max_epochs), "targets")
    planned = materialize(plan(sources, seed), "plan")
    fill = pieces(sizes, planned, seed)
    counts = materialize(shard_counts(planned, seed), "counts")
    deal = slots(planned, counts, seed)
    uses = deal.groupBy("source", "block").agg(F.count_if(F.col("words_taken") == 0).alias("uses"), F.max("words_taken").alias("part"))
    # the planner sees a few source rows here, not the slots made from them:
    # without the hint it would broadcast a side that grows with the data
    u = uses.select(F.col("source").alias("u_source"), F.col("block").alias("u_block"), "uses", "part").hint("merge")
    same = F.col("source").eqNullSafe(F.col("u_source")) & (F.col("block") == F.col("u_block"))
    # of the block of a source's last slot only the first words
    some = F.greatest(F.lit(0), F.least(F.col("words"), F.col("part") - F.col("in_block")))
    taken = (fill.join(u, same).groupBy("doc_id", "source", "size")
             .agg(F.sum(F.col("words") * F.col("uses") + some).alias("all"), F.max("copies").alias("copies"))
             .select(F.col("doc_id").alias("t_id"), F.col("source").alias("t_source"), F.col("size").alias("t_size"),
                     F.least(F.ceil(F.col("all") / F.col("copies")), F.col("size") * max_epochs).alias("taken")).hint("merge"))
    s = sources.select(F.col("source").alias("s_source"), "source_size", "target")
    decisions = (sizes.join(s, F.col("source").eqNullSafe(F.col("s_source")))
                 .join(taken, F.col("doc_id").eqNullSafe(F.col("t_id")) & F.col("source").eqNullSafe(F.col("t_source"))
                       & (F.col("size") == F.col("t_size")), "left")
                 .select("doc_id", "source", "size", "source_size", "target",
                         F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))
    d = deal.select(F.col("source").alias("u_source"), F.col("block").alias("u_block"), "shard", "slot_key", "words_taken").hint("merge")
    words = F.when(F.col("words_taken") == 0, F.col("words")).otherwise(F.least(F.col("words"), F.col("words_taken") - F.col("in_block")))
    manifest = (fill.join(d, same).withColumn("words", words).filter("words > 0")
                .select("shard", "slot_key", "source", "block", "doc_id", "from_word", "words"))
    return decisions, manifest


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))[0].select("doc_id", "size", "source_size", "target", "taken")
