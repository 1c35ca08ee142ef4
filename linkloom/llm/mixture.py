"""A mix of sources by target weights, dealt to output shards by a multivariate hypergeometric splitting tree; native expressions only.

Every source's documents are put on an axis of words in the order of a hash; its target is
cut into a whole number of blocks of equal length, and documents belong to the block that
their middle is in. An axis goes round at most twice, so that no document is taken more
than twice. What is taken then differs from the target by half a document at most; one document
of the source, that whose size is nearest to the difference, is taken once more or less, in the last block.
The blocks of all sources are dealt to shards of equal numbers of blocks as a random order
of them would be: a node of the tree holds how many blocks of each source its shards get,
and draws how many of them go to its left half without replacement. A shard then takes the
next places of each source's permuted blocks, disjoint from all others', and is shuffled
on its own. All draws are hashes of rows, nodes and a seed, so that reruns agree.

Order on the axis is by bits of the hash first: sums of these buckets come before sums in
them, so that a source of any size is spread over tasks. Equal rows are one row with a
count until they are dealt. Null texts and texts without words have size 0 and are taken
with no words; a null source is a source, the last; null and repeated doc_ids are allowed.
Other columns are ignored. An empty table gives an empty result. The table of sources goes
into one row of the tree's root; the driver sees sums over it only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Workspace, fresh

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Of all sizes, what is taken; of a source's size, what is taken at most.
SHARE, MOST = 1.5, 2
#: Words of a block, blocks of a shard, words of an axis bucket.
BLOCK_WORDS, SHARD_BLOCKS, BUCKET_WORDS = 1024, 1024, 1 << 20
#: Primes; at least one does not divide a number of blocks, and then gives a permutation of them.
PRIMES = (179424673, 179424691, 179424697)
#: Levels of the tree that are one job.
LEVELS = 4


def sized(ws: Workspace, docs: DataFrame) -> DataFrame:
    """row (a number), source, doc_id, size, print (hash of the text), n (rows that are equal in these), h; written."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col("source").cast("string").alias("source"), "doc_id", size.alias("size"), F.xxhash64(F.col("text").cast("string")).alias("print"))
    rows = rows.groupBy("source", "doc_id", "size", "print").agg(F.count("*").alias("n"))
    return ws.table(rows.select(F.monotonically_increasing_id().alias("row"), "*", F.xxhash64("doc_id", "size", "print").alias("h")), "sizes")


def _numbered(ws: Workspace, sources: DataFrame) -> DataFrame:
    """``sources`` with rank, from 1 in the order of code points, null last: ranges are counted, then numbered."""
    order = [F.col("source").isNull(), F.col("source")]
    rows = ws.table(sources.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    sizes = rows.groupBy("range").agg(F.count("*").alias("n"))
    sizes = sizes.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return rows.join(sizes, "range").withColumn("rank", F.row_number().over(Window.partitionBy("range").orderBy(*order)) + F.col("base")).drop("range", "base")


def targets(ws: Workspace, sizes: DataFrame, seed: int) -> DataFrame:
    """A row for each source: rank, source, source_size, target, quota (blocks), block (words), bits (of its buckets), step and shift (of its permutation)."""
    sources = _numbered(ws, sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    sources = ws.table(sources.withColumn("weight", weight), "sources")
    most = F.col("source_size") * MOST
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        stopped = most <= F.lit(level) * F.col("weight")
        sums = sources.agg(F.count(F.when(stopped, 1)).alias("full"), F.sum(F.when(stopped, most)).alias("taken"), F.sum(F.when(~stopped, F.col("weight"))).alias("weight")).first()
        if sums["full"] == full or not sums["weight"]:
            break
        full, level = sums["full"], (SHARE * total - (sums["taken"] or 0)) / sums["weight"]
    target = F.least(most.cast("double"), F.lit(level) * F.col("weight"))
    out = sources.withColumn("target", target).withColumn("quota", F.when(F.col("target") > 0, F.greatest(F.lit(1), F.round(F.col("target") / BLOCK_WORDS))).otherwise(F.lit(0)).cast("long"))
    bits = F.greatest(F.lit(0), F.least(F.lit(40), F.ceil(F.log2(F.col("source_size") / BUCKET_WORDS)))).cast("int")
    step = F.coalesce(*(F.when(F.col("quota") % p != 0, F.lit(p)) for p in PRIMES), F.lit(1)).cast("long")
    shift = F.when(F.col("quota") > 0, F.pmod(F.xxhash64(F.lit(seed), F.col("rank")), F.col("quota")))
    return ws.table(out.select("rank", "source", "source_size", "target", "quota", F.try_divide("target", "quota").alias("block"), F.coalesce(bits, F.lit(0)).alias("bits"), step.alias("step"), shift.alias("shift")), "targets")


def on_axis(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """``sizes`` with its source's columns and start: the words before the row on the source's axis."""
    rows = sizes.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("bucket", F.when(F.col("bits") > 0, F.expr("shiftrightunsigned(h, 64 - bits)")).otherwise(F.lit(0)).cast("long"))
    words, before = F.col("size") * F.col("n"), (Window.unboundedPreceding, -1)
    buckets = rows.groupBy("rank", "bucket").agg(F.sum(words).alias("words"))
    base = F.coalesce(F.sum("words").over(Window.partitionBy("rank").orderBy("bucket").rowsBetween(*before)), F.lit(0))
    rows = rows.join(buckets.select("rank", "bucket", base.alias("base")), ["rank", "bucket"])
    own = F.sum(words).over(Window.partitionBy("rank", "bucket").orderBy("h", "doc_id", "size", "print").rowsBetween(*before))
    return rows.withColumn("start", F.col("base") + F.coalesce(own, F.lit(0))).drop("base", "bucket")


def _times(limit: Column) -> Column:
    """How many of a row's equal documents have their middle before ``limit`` on the axis."""
    return F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least(F.col("n"), F.ceil((limit - F.col("start")) / F.col("size") - 0.5)))).otherwise(F.lit(0))


def fitted(ws: Workspace, axis: DataFrame) -> DataFrame:
    """``axis`` with more: 1 or -1 for one document of a source that is taken once more, or less, as that brings the source nearest to its target."""
    times = _times(F.col("target")) + _times(F.col("target") - F.col("source_size"))
    rows = axis.withColumn("times", F.when(F.col("quota") > 0, times).otherwise(F.lit(0)))
    # Written, so that its size is known before the join: rows of a source are not sent to one task for it.
    gaps = ws.table(rows.groupBy("rank").agg((F.max("target") - F.sum(F.col("times") * F.col("size"))).alias("gap")), "gaps")
    rows = rows.join(gaps, "rank")
    free = F.when(F.col("gap") > 0, F.col("times") < MOST).otherwise(F.col("times") > 0) & (F.col("n") == 1) & (F.col("quota") > 0)
    off = F.abs(F.abs("gap") - F.col("size"))
    best = rows.where(free & (off < F.abs("gap"))).groupBy("rank").agg(F.min_by(F.struct("row", F.signum("gap").cast("int").alias("more")), F.struct(off.alias("off"), F.col("h"), F.col("row"))).alias("best"))
    best = best.select(F.col("best.row").alias("row"), F.col("best.more").alias("more"))
    return axis.join(best, "row", "left").withColumn("more", F.coalesce("more", F.lit(0)))


def copies(axis: DataFrame) -> DataFrame:
    """A row for each time a document is taken: row, turn (of equal rows), round (0 or 1), rank, place (of its block among the source's permuted blocks), h, size."""
    rows = axis.where("quota > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    middle = F.col("start") + F.col("turn") * F.col("size") + F.col("size") / 2
    rounds = F.filter(F.array(middle, middle + F.col("source_size")), lambda x: x < F.col("target"))
    rounds = F.when(F.col("more") > 0, F.concat(rounds, F.array(F.col("target")))).when(F.col("more") < 0, F.slice(rounds, F.lit(1), F.size(rounds) - 1)).otherwise(rounds)
    rows = rows.select("row", "turn", "rank", "h", "size", "quota", "block", "step", "shift", F.posexplode(rounds).alias("round", "at"))
    number = F.least(F.floor(F.col("at") / F.col("block")), F.col("quota") - 1)
    return rows.select("row", "turn", "round", "rank", ((number * F.col("step") + F.col("shift")) % F.col("quota")).alias("place"), "h", "size")


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def uniform(*parts) -> Column:
    """A number from 0 to 1 by a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * 2.0**-53


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``marked`` among ``total`` are in a random draw of ``drawn``: the inverse of its distribution at ``u``.

    Probabilities are taken from the mode outwards as multiples of the mode's, first for their sum, then until ``u`` of it is reached.
    """
    d = lambda x: x.cast("double")

    def sample(z: Column) -> Column:
        n, k, m, mode = d(z["total"]), d(z["marked"]), d(z["drawn"]), z["mode"]
        up = lambda x: (k - x) * (m - x) / ((x + 1) * (n - k - m + x + 1))
        down = lambda x: x * (n - k - m + x) / ((k - x + 1) * (m - x + 1))
        width = F.least(z["high"] - z["low"], F.ceil(12 * F.sqrt(m * (k / n) * (1 - k / n))) + 10)
        steps = F.sequence(F.lit(1).cast("long"), width.cast("long"))
        one, none = F.lit(1.0), F.lit(0.0)
        begin = F.struct(one.alias("a"), one.alias("b"), one.alias("sum"))

        def add(acc: Column, i: Column) -> Column:
            nexts = F.struct((acc["a"] * up(d(mode + i - 1))).alias("a"), (acc["b"] * down(d(mode - i + 1))).alias("b"))
            return _let(nexts, lambda y: F.struct(y["a"].alias("a"), y["b"].alias("b"), (acc["sum"] + y["a"] + y["b"]).alias("sum")))

        def find(acc: Column, i: Column) -> Column:
            nexts = F.struct((acc["a"] * up(d(mode + i - 1))).alias("a"), (acc["b"] * down(d(mode - i + 1))).alias("b"))
            hit = lambda y: F.when(acc["found"].isNotNull(), acc["found"]).when(acc["left"] < y["a"], mode + i).when(acc["left"] < y["a"] + y["b"], mode - i)
            return _let(nexts, lambda y: F.struct(y["a"].alias("a"), y["b"].alias("b"), (acc["left"] - y["a"] - y["b"]).alias("left"), hit(y).alias("found")))

        whole = F.aggregate(steps, begin, add)["sum"]
        left = z["u"] * whole - 1
        start = F.struct(one.alias("a"), one.alias("b"), left.alias("left"), F.when(left < none, mode).alias("found"))
        return F.coalesce(F.aggregate(steps, start, find)["found"], mode)

    low, high = F.greatest(F.lit(0).cast("long"), drawn + marked - total), F.least(drawn, marked)
    mode = F.greatest(low, F.least(high, F.floor((d(drawn) + 1) * (d(marked) + 1) / (d(total) + 2))))
    given = F.struct(total.alias("total"), marked.alias("marked"), drawn.alias("drawn"), low.alias("low"), high.alias("high"), mode.cast("long").alias("mode"), u.alias("u"))
    return _let(given, lambda z: F.when(z["low"] == z["high"], z["low"]).otherwise(sample(z)))


def _halves(blocks: int, shards: int, seed: int) -> Column:
    """The two children of a node (lo, hi, parts), or the node itself where it is one shard."""
    edge = lambda i: F.call_function("div", i.cast("long") * F.lit(blocks).cast("long"), F.lit(shards).cast("long"))
    lo, hi = F.col("lo"), F.col("hi")
    mid = F.floor((lo + hi) / 2).cast("long")

    def draw(acc: Column, x: Column) -> Column:
        chosen = hypergeometric(acc["rest"], x["blocks"], acc["want"], uniform(F.lit(seed), lo, hi, x["rank"]))
        return _let(chosen, lambda c: F.struct((acc["rest"] - x["blocks"]).alias("rest"), (acc["want"] - c).alias("want"), F.concat(acc["out"], F.array(c)).alias("out")))

    begin = F.struct((edge(hi) - edge(lo)).alias("rest"), (edge(mid) - edge(lo)).alias("want"), F.array().cast("array<bigint>").alias("out"))
    given = F.struct(mid.alias("mid"), F.aggregate("parts", begin, draw)["out"].alias("left"))

    def children(z: Column) -> Column:
        part = lambda number: F.filter(F.zip_with(F.col("parts"), z["left"], lambda x, c: F.struct(x["rank"].alias("rank"), number(x, c).alias("blocks"))), lambda x: x["blocks"] > 0)
        left = F.struct(lo.alias("lo"), z["mid"].alias("hi"), part(lambda x, c: c).alias("parts"))
        right = F.struct(z["mid"].alias("lo"), hi.alias("hi"), part(lambda x, c: x["blocks"] - c).alias("parts"))
        return F.array(left, right)

    return F.when(hi - lo > 1, _let(given, children)).otherwise(F.array(F.struct(lo.alias("lo"), hi.alias("hi"), F.col("parts").alias("parts"))))


def tree(ws: Workspace, sources: DataFrame, shard_blocks: int, seed: int) -> DataFrame:
    """shard, rank and blocks: how many blocks of each source every shard gets."""
    blocks = sources.agg(F.sum("quota")).first()[0] or 0
    shards = max(1, -(-blocks // shard_blocks))
    parts = F.array_sort(F.collect_list(F.struct("rank", F.col("quota").alias("blocks"))))
    nodes = sources.where("quota > 0").agg(parts.alias("parts")).select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "parts")
    depth = (shards - 1).bit_length()
    for level in range(depth):
        nodes = nodes.select(F.explode(_halves(blocks, shards, seed)).alias("node")).select("node.*")
        if level % LEVELS == LEVELS - 1:
            # The next levels of each subtree are work of their own.
            nodes = ws.table(nodes.repartition(int(ws.spark.conf.get("spark.sql.shuffle.partitions")), "lo"), f"level{level + 1}")
    return nodes.select(F.col("lo").alias("shard"), F.explode("parts").alias("p")).select("shard", "p.rank", "p.blocks")


def mixed(ws: Workspace, sizes: DataFrame, sources: DataFrame, axis: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = 0) -> DataFrame:
    """A row for each time a document is taken: row, turn, round, size, rank, shard and position in it."""
    dealt = ws.table(tree(ws, sources, shard_blocks, seed), "shards")
    first = F.coalesce(F.sum("blocks").over(Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = dealt.withColumn("first", first).select("shard", "rank", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1)).alias("place"))
    # A row for each block, whatever size is guessed from the shards: never broadcast.
    rows = copies(axis).join(places.hint("merge"), ["rank", "place"])
    shuffled = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "shard", "h", "turn", "round"), "h", "row", "turn", "round")
    return rows.withColumn("position", F.row_number().over(shuffled)).select("row", "turn", "round", "size", "rank", "shard", "position")


def mix(docs: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows of ``sized`` on their axes, the sources, the mix) of ``docs`` (doc_id, text, source)."""
    ws = Workspace(docs.sparkSession, "mixture")
    sizes = sized(ws, docs)
    sources = targets(ws, sizes, seed)
    axis = ws.table(fitted(ws, ws.table(on_axis(sizes, sources), "places")), "axis")
    return axis, sources, mixed(ws, sizes, sources, axis, shard_blocks, seed)


def mix_table(docs: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row of ``docs``."""
    axis, _, taken = mix(docs, shard_blocks, seed)
    taken = taken.groupBy("row", "turn").agg(F.sum("size").alias("taken"), F.count("*").alias("rounds"))
    rows = axis.select("row", "doc_id", "size", "source_size", "target", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("turn"))
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("taken", "rounds")]
    return rows.join(taken, ["row", "turn"], "left").select("doc_id", "size", "source_size", "target", *counts)


def with_texts(docs: DataFrame, axis: DataFrame, taken: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, as often as it does, with _shard and _position: the training files in order."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"))
    key = [F.col("doc.source").cast("string").alias("source"), F.col("doc.doc_id").alias("doc_id"), F.xxhash64(F.col("doc.text").cast("string")).alias("print")]
    rows = rows.select("doc", *key).withColumn("turn", F.row_number().over(Window.partitionBy("source", "doc_id", "print").orderBy("print")) - 1).alias("l")
    plan = taken.join(axis.select("row", "source", "doc_id", "print"), "row").alias("r")
    same = F.lit(True)
    for c in ("source", "doc_id", "print", "turn"):
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return rows.join(plan, same).select("l.doc.*", F.col("r.shard").alias(fresh(docs, "_shard")), F.col("r.position").alias(fresh(docs, "_position")))
