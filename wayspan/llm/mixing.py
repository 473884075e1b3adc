"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Native: DataFrame operations only.  Every document has a keyed 64-bit hash, and the
order of these is a random permutation of its source.  A source is cut into 2**bits
blocks by the leading bits, some ``DOCS_PER_BLOCK`` documents each at any size.  Its
target gives an exact quota of block copies: whole rounds over all blocks, then blocks
in permuted order, and a last one document by document, each taken if it still fits.

The quotas of all sources are the root of a binary tree.  A node of n copies gives
half of them to its left child, drawn without replacement: its numbers by source are
multivariate hypergeometric, drawn one after the other by inversion.  The leaves are
the output shards.  Each draws its numbers from the permuted copies of the sources,
disjoint from all others', and orders its documents by a keyed hash.  What a document
is taken is the number of copies that the shards draw of it.

Where a source's quota ends is found in steps of ``STEP_BITS`` bits: only sums of 1,024
groups of a source are ever ordered, then those within one of them, and so on; only
the documents of the one last block meet in one row.

Defined cases: null and empty texts have size 0 and take 0; a very long text is one
document; a null source is a source, last in order; documents of equal doc_id, text
and source are told apart by number: how many of them are taken is fixed, which of
them is not; documents of unequal text never stand or fall together; a source of no
words has target 0 and passes its share to the others; an empty table gives an empty
result; extra columns of any name and type are kept by ``mix``, whose own get a
number if a column has their name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import scope, settled
from .common import free_name

#: Weights by source in order, repeating; the share of all words to take; the most rounds.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_ROUNDS = 2.0
DOCS_PER_BLOCK = 128
#: Bits of the hash that one step of the search for a quota's end settles.
STEP_BITS = 10
LEVELS = 4  # 2**LEVELS shards
SEED = 20240607


def size_of(text: Column) -> Column:
    """Words of the text: it counts where a word begins."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MAX_ROUNDS) -> DataFrame:
    """(source, source_size) -> also ``target``, by filling up under caps.

    A source is capped if the common level of water, words for each unit of weight,
    reaches its cap / weight.  With sources ordered by that ratio, source i is capped
    exactly if (total - caps up to i) <= ratio_i * (weights after i).
    The sources are few beside the documents; this is one small task.
    """
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("w", w).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    everything = W.partitionBy()
    s = s.withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything)).withColumn("ratio", F.col("cap") / F.col("w"))
    up = W.orderBy("ratio", F.col("source").isNull(), F.col("source")).rowsBetween(W.unboundedPreceding, 0)
    s = s.withColumn("caps", F.sum("cap").over(up)).withColumn("after", F.sum("w").over(everything) - F.sum("w").over(up))
    s = s.withColumn("full", F.col("total") - F.col("caps") >= F.col("ratio") * F.col("after"))
    s = s.withColumns({"left": F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0.0)), "open": F.sum(F.when(~F.col("full"), F.col("w"))).over(everything)})
    return s.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("left") * F.col("w") / F.col("open")).alias("target"))


def _noise(*cols, seed: int = SEED) -> Column:
    return F.xxhash64(*cols, F.lit(seed))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _leading(h: Column, bits: Column) -> Column:
    """The number that the leading ``bits`` bits of a hash make."""
    return F.when(bits == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", h, (F.lit(64) - bits).cast("int")))


# --- documents -----------------------------------------------------------------------


def _keyed(docs: DataFrame, *payload: Column) -> DataFrame:
    """The payload with source, size, a hash of the document's identity, and the task that read it."""
    key = _noise(F.col("doc_id"), F.col("text"), F.col("source"))
    return docs.select(*payload, F.col("source").alias("source"), size_of(F.col("text")).alias("size"), key.alias("key"), F.spark_partition_id().alias("task"))


def numbered(rows: DataFrame) -> DataFrame:
    """``h``: a hash of its own for each row, from ``key`` and the row's number among those of equal key.

    Rows that repeat are settled with their task, numbered within it, and moved up by
    what the tasks before it hold, so a key that many rows share is never in one task.
    """
    many = settled(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.lit(True).alias("again")))
    marked = rows.join(many, "key", "left")
    once = marked.where("again is null").withColumn("nth", F.lit(0).cast("long"))
    more = settled(marked.where("again"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("key").orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offset = settled(more.groupBy("key", "task").agg(F.count("*").alias("n")).withColumn("before", before).drop("n"))
    place = F.row_number().over(W.partitionBy("key", "task").orderBy("key"))
    more = more.withColumn("place", place).join(offset, ["key", "task"]).withColumn("nth", F.col("before") + F.col("place") - 1)
    names = [c for c in rows.columns if c not in ("key", "task")]
    h = _noise("key", "nth", F.lit("order")).alias("h")
    return once.select(*names, h).unionByName(more.select(*names, h))


# --- quotas -----------------------------------------------------------------------------


def _ends(sums: DataFrame, state: DataFrame) -> DataFrame:
    """(source, node, rest): of each source's groups (source, node, words) in order the one in which ``rest`` ends, and what is left for it."""
    w = W.partitionBy("source").orderBy("node").rowsBetween(W.unboundedPreceding, 0)
    s = sums.withColumn("upto", F.sum("words").over(w)).withColumnRenamed("source", "s")
    j = s.join(state.select("source", "rest"), _same("s", "source")).where("upto > rest")
    best = F.min_by(F.struct("node", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest")), F.col("node")).alias("b")
    return j.groupBy("source").agg(best).select("source", "b.*")


def quotas(sized: DataFrame, docs_per_block: int = DOCS_PER_BLOCK, step_bits: int = STEP_BITS) -> DataFrame:
    """A row for each source: source_size, target, bits, rounds, ``last`` (the block in which its quota ends) and ``chosen`` (hashes of documents taken there)."""
    top = settled(sized.groupBy("source", _leading(F.col("h"), F.lit(step_bits)).alias("top")).agg(F.sum("size").alias("words"), F.count("*").alias("n")).coalesce(8))
    by_source = top.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("n").alias("n"))
    goal = targets(by_source.select("source", "source_size")).withColumnRenamed("source", "s").drop("source_size")
    q = by_source.join(goal, _same("s", "source")).drop("s")
    bits = F.floor(F.log2(F.greatest(F.lit(1.0), F.col("n") / F.lit(docs_per_block)))).cast("int")
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    q = q.withColumns({"bits": bits, "rounds": rounds}).withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
    q = settled(q.drop("n").coalesce(1))  # a row for each source: one file
    depth, most = step_bits, q.agg(F.max("bits")).first()[0] or 0
    upto = lambda d: F.least(F.col("bits"), F.lit(d))
    first = top.join(q.select(F.col("source").alias("s"), "bits"), _same("s", "source"))
    node = F.call_function("shiftrightunsigned", F.col("top"), (F.lit(step_bits) - upto(depth)).cast("int"))
    state = settled(_ends(first.groupBy("source", node.alias("node")).agg(F.sum("words").alias("words")), q).coalesce(1))

    def inside(d: int) -> DataFrame:
        """Documents of each source's group so far."""
        at = state.join(q.select(F.col("source").alias("s"), "bits"), _same("s", "source")).drop("s").withColumnRenamed("source", "s")
        return sized.where("size > 0").join(at, _same("s", "source") & (_leading(F.col("h"), upto(d)) == F.col("node"))).drop("s")

    while depth < most:  # 2**10 times the documents are one step more
        deeper = inside(depth).withColumn("node", _leading(F.col("h"), upto(depth + step_bits)))
        state = settled(_ends(deeper.groupBy("source", "node").agg(F.sum("size").alias("words")), state).coalesce(1))
        depth += step_bits
    # the documents of the last block, in order, each taken if it still fits
    block = inside(max(depth, most)).groupBy("source", "node").agg(F.first("rest").alias("rest"), F.array_sort(F.collect_list(F.struct("h", "size"))).alias("docs"))
    none = F.struct(F.col("rest").alias("rest"), F.array().cast("array<bigint>").alias("chosen"))
    took = lambda a, d: F.struct((a["rest"] - d["size"]).alias("rest"), F.array_append(a["chosen"], d["h"]).alias("chosen"))
    greedy = F.aggregate("docs", none, lambda a, d: F.when(d["size"] <= a["rest"], took(a, d)).otherwise(a), lambda a: a["chosen"])
    last = block.select(F.col("source").alias("s"), F.col("node").alias("last"), greedy.alias("chosen"))
    out = q.join(last, _same("s", "source"), "left")
    return out.select("source", "source_size", "target", "bits", "rounds", F.coalesce("last", F.lit(0)).alias("last"), F.coalesce("chosen", F.array().cast("array<bigint>")).alias("chosen"))


# --- the splitting tree ---------------------------------------------------------------------


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` from ``total`` without replacement are among ``good``, by inversion at ``u`` in [0, 1).

    Weights are chained from the lower end of the likely range (eight deviations either
    way) by the ratio of neighbouring probabilities.
    """
    given = F.struct(*[c.cast("double").alias(k) for k, c in zip("nkmu", (total, good, draws, u), strict=True)])

    def ranged(g: Column) -> Column:
        mean = F.coalesce(F.try_divide(g["m"] * g["k"], g["n"]), F.lit(0.0))
        variance = F.coalesce(mean * F.try_divide(g["n"] - g["k"], g["n"]) * F.try_divide(g["n"] - g["m"], g["n"] - 1), F.lit(0.0))
        return F.struct(*[g[c].alias(c) for c in "nkmu"], mean.alias("mean"), (F.sqrt(F.greatest(F.lit(0.0), variance)) * 8 + 2).alias("spread"))

    def weighed(g: Column) -> Column:
        low = F.greatest(F.lit(0.0), g["m"] - (g["n"] - g["k"]), F.floor(g["mean"] - g["spread"])).cast("long")
        high = F.least(g["k"], g["m"], F.ceil(g["mean"] + g["spread"])).cast("long")
        return _let(F.struct(*[g[c].alias(c) for c in "nkmu"], F.sequence(low, F.greatest(low, high)).alias("support")), chained)

    def chained(g: Column) -> Column:
        ratio = lambda x: F.try_divide((g["k"] - x) * (g["m"] - x), (x + 1) * (g["n"] - g["k"] - g["m"] + x + 1))
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.element_at(g["support"], 1).alias("x"))
        step = lambda a, x: F.struct((a["w"] * F.coalesce(ratio(x.cast("double")), F.lit(0.0))).alias("w"), (a["sum"] + a["w"]).alias("sum"), x.alias("x"))
        goal = g["u"] * F.aggregate(g["support"], start, step, lambda a: a["sum"])
        return _let(goal, lambda t: F.aggregate(g["support"], start, lambda a, x: F.when((a["sum"] > t) & (a["sum"] > 0), a).otherwise(step(a, x)), lambda a: a["x"]))

    return _let(_let(given, ranged), weighed)


def _halved(level: int) -> Column:
    """(left, right): the counts of a node's children; sources one after the other, each given those before."""
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)
    start = F.struct(total.alias("n"), F.ceil(total / 2).cast("long").alias("m"), F.array().cast("array<bigint>").alias("left"))

    def draw(a: Column, c: Column) -> Column:
        noise = _noise(F.col("shard"), F.size(a["left"]), F.lit(level))
        u = F.call_function("shiftrightunsigned", noise, F.lit(11)) / F.lit(float(1 << 53))
        return _let(hypergeometric(a["n"], c, a["m"], u), lambda x: F.struct((a["n"] - c).alias("n"), (a["m"] - x).alias("m"), F.array_append(a["left"], x).alias("left")))

    left = F.aggregate("counts", start, draw, lambda a: a["left"])
    return _let(left, lambda x: F.struct(x.alias("left"), F.zip_with("counts", x, lambda c, y: c - y).alias("right")))


def split(plan: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(source, copies): the tree's root -> (source, bounds): where in its permuted copies each shard begins.

    The tree is one row for each node, with an array over the sources, which are few.
    """
    order = F.struct(F.col("source").isNull().alias("null"), F.col("source").alias("source"), F.col("copies").alias("copies"))
    root = settled(plan.agg(F.array_sort(F.collect_list(order)).alias("all")))
    t = root.select("all", F.col("all")["copies"].alias("counts"), F.lit(0).cast("long").alias("shard"))
    for level in range(levels):
        halves = t.withColumn("halves", _halved(level))
        child = F.explode(F.array(F.struct(F.col("halves.left").alias("counts"), (F.col("shard") * 2).alias("shard")), F.struct(F.col("halves.right").alias("counts"), (F.col("shard") * 2 + 1).alias("shard"))))
        t = halves.select("all", child.alias("c")).select("all", "c.*")
    each = t.select("shard", F.explode(F.arrays_zip(F.col("all"), F.col("counts").alias("n"))).alias("z")).select("shard", F.col("z.all.source").alias("source"), F.col("z.n").alias("n"))
    lists = each.groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "n"))), lambda x: x["n"]).alias("n"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("bounds"))
    bounds = F.aggregate("n", start, lambda a, n: F.struct((a["at"] + n).alias("at"), F.array_append(a["bounds"], a["at"]).alias("bounds")), lambda a: a["bounds"])
    return lists.select("source", bounds.alias("bounds"))


def planned(sized: DataFrame, levels: int = LEVELS) -> DataFrame:
    """A row for each source: its quota, and the bounds of the shards in its permuted copies."""
    q = settled(quotas(sized).coalesce(1))
    copies = F.col("rounds") * F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) + F.col("last") + (F.size("chosen") > 0).cast("long")
    b = split(q.select("source", copies.alias("copies")), levels).withColumnRenamed("source", "s")
    return q.join(b, _same("s", "source")).drop("s")


def drawn(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows (source, size, h) with source_size, target and ``shards``: the shard of each copy that the shards draw."""
    j = rows.join(plan.withColumnRenamed("source", "s"), _same("s", "source")).drop("s").withColumn("block", _leading(F.col("h"), F.col("bits")))
    more = (F.col("block") < F.col("last")) | ((F.col("block") == F.col("last")) & F.array_contains("chosen", F.col("h")))
    n = F.when(F.col("size") > 0, F.col("rounds") + more.cast("long")).otherwise(F.lit(0))
    blocks = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits"))
    at = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(n, F.lit(1)) - 1), lambda c: c * blocks + F.col("block"))
    shard = F.transform(at, lambda p: F.size(F.filter("bounds", lambda b: b <= p)) - 1)
    none = F.array().cast("array<int>")
    return j.withColumn("shards", F.when(n > 0, shard).otherwise(none)).drop("block", "bits", "rounds", "last", "chosen", "bounds")


def mixture(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards) of every document; the texts are read once and not shuffled.

    ``shards`` names the output shard of each copy taken.
    """
    with scope() as kept:
        sized = settled(numbered(settled(_keyed(docs, F.col("doc_id").cast("long").alias("doc_id")))))
        out = drawn(sized, settled(planned(sized, levels).coalesce(1)))
        return kept.result(out.select("doc_id", "size", "source_size", "target", (F.size("shards") * F.col("size")).alias("taken"), F.array_join(F.col("shards").cast("array<string>"), ",").alias("shards")))


def mix(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The mixed corpus: a row for each copy taken, with all columns of ``docs``, ``__shard`` and ``__order`` within it."""
    with scope() as kept:
        sized = settled(numbered(settled(_keyed(docs))))
        plan = kept.result(planned(sized, levels).coalesce(1))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    t = drawn(numbered(_keyed(docs, row)), plan).select("row", "h", F.posexplode("shards").alias("copy", "shard"))
    names = free_name("__shard", docs.columns), free_name("__order", docs.columns)
    return t.select("row.*", F.col("shard").cast("long").alias(names[0]), _noise("h", "copy", "shard").alias(names[1]))


def write_shards(mixed: DataFrame, path: str, levels: int = LEVELS) -> None:
    """One folder for each shard of ``mix``'s result; its rows, shuffled within it, stand in ``__order``."""
    shard, order = mixed.columns[-2:]
    mixed.repartition(2**levels, shard).sortWithinPartitions(shard, order).write.partitionBy(shard).parquet(path)
