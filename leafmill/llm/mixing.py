"""Mixing sources to target weights by a time-varying curriculum, in DataFrame functions only.

Targets: sources in code-point order (null last) get the weights in turn and share
`share` times all words; a target stops at `cap` times its source's size, and the excess is
shared again by weight (water filling, solved in one pass over the sources sorted by
cap * size / weight).

Order: within its source a document's place comes from md5(seed:id), so reruns agree. The
running sum of words is taken in two steps, over (source, key range) cells of about
CELL_ROWS rows and then over the cells' sums, so no task gets a whole source.

Curriculum: source i is sampled at the rate 1 + g_i * (2u - 1) over training progress u in
[0, 1]. Its integral is u + g_i * (u^2 - u); a document whose demand begins at the share y of its
source's target gets the position where that integral reaches y. Documents are range-sorted
by position; those not taken follow, spread by their place in their source.

Edge cases: null text or a text without words has size 0 and is never taken; a null source
is a source of its own; a null id is ordered by md5 of "seed:"; rows that share an id are
separate documents; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, shielded, small

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SLOPES = (3, 1, 2), (0.8, -0.8, 0.0)
CELL_ROWS = 512


def targets(sources: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """sources: source, source_size, n. Adds rank, weight, slope, target."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle: Column = lambda values: F.element_at(F.array(*[F.lit(float(x)) for x in values]), ((F.col("rank") - 1) % len(values) + 1).cast("int"))
    ranked = sources.withColumn("rank", F.row_number().over(by_name)).withColumns({"weight": cycle(weights), "slope": cycle(slopes)})
    ranked = ranked.withColumns({"most": F.lit(float(cap)) * F.col("source_size"), "all_words": F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))})
    filling = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    level = ranked.withColumn("level", (F.col("all_words") - before) / rest)
    open_ = F.col("level") < F.col("most") / F.col("weight")
    return (
        level.withColumns({"open": open_, "final": F.max(F.when(open_, F.col("level"))).over(Window.partitionBy())})
        .withColumn("target", F.when(F.col("open"), F.col("final") * F.col("weight")).otherwise(F.col("most")))
        .select("source", "source_size", "n", "rank", "slope", "target", "all_words")
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, slopes: tuple = SLOPES, share: float = 1.5, cap: float = 2.0, seed: int = 0) -> DataFrame:
    """One row per document, sorted by its first position: <id>, size, source, source_size,
    target, taken, positions (of each time it is taken, in words of the mix)."""
    word = F.regexp_count(F.col(f"`{text_col}`").cast("string"), F.lit(WORD)).cast("long")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))))
    sized = cut(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"), F.coalesce(word, F.lit(0)).alias("size"), key.alias("key")), "mix-sizes")
    aimed = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), weights, slopes, share, cap), "mix-targets")
    own = sized.withColumnRenamed("source", "own_source").join(small(aimed), F.col("own_source").eqNullSafe(F.col("source")), "inner")
    cells = F.ceil(F.col("n") / CELL_ROWS)
    own = own.withColumn("cell", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * cells / F.lit(1 << 32)).cast("long"))
    sums = own.groupBy("rank", "cell").agg(F.sum("size").alias("words"))
    starts = sums.select(
        F.col("rank").alias("start_rank"), F.col("cell").alias("start_cell"),
        F.coalesce(F.sum("words").over(Window.partitionBy("rank").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
    )
    within = Window.partitionBy("rank", "cell").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = own.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(starts, (F.col("rank") == F.col("start_rank")) & (F.col("cell") == F.col("start_cell")))
    begin = F.col("start") + F.col("within")
    times = F.sequence(F.lit(0), F.lit(int(-(-cap // 1)) - 1))
    demand = F.filter(F.transform(times, lambda p: p * F.col("source_size") + begin), lambda d: (F.col("size") > 0) & (2.0 * d + F.col("size") < 2.0 * F.col("target")))
    g = F.col("slope")

    def position(d: Column) -> Column:
        y = F.least(d / F.col("target"), F.lit(1.0))
        return F.lit(2.0) * y / ((F.lit(1.0) - g) + F.sqrt((F.lit(1.0) - g) * (F.lit(1.0) - g) + F.lit(4.0) * g * y)) * F.col("all_words")

    out = placed.withColumn("positions", F.transform(demand, position))
    return out.select(F.col("id").alias(id_col), "size", "source", "source_size", "target", (F.col("size") * F.size("positions")).alias("taken"), "positions", F.coalesce(F.try_element_at("positions", F.lit(1)), F.col("all_words") + begin).alias("sort_by")).orderBy("sort_by").drop("sort_by")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """docs, each row as often as the mix takes it, sorted by position. Rows that share an id are documents of
    their own."""
    docs, names = shielded(docs)
    own = F.col(names[id_col])
    twice = cut(docs.select(own.alias("__twice")).groupBy("__twice").count().filter("count > 1").select("__twice"), "mix-ids")
    parts, keys = [docs], [own.cast("string")]
    if twice.take(1):
        # told apart in a written copy, in which each has a number
        few, same = small(twice), own.eqNullSafe(F.col("__twice"))
        parts = [docs.join(few, same, "left_anti"), cut(docs.join(few, same, "left_semi").withColumn("__copy", F.monotonically_increasing_id()), "mix-again")]
        keys.append(F.concat_ws(":", own.cast("string"), F.col("__copy").cast("string")))
    keyed = [p.withColumn("__key", k) for p, k in zip(parts, keys, strict=True)]
    every = keyed[0] if len(keyed) == 1 else keyed[0].unionAll(keyed[1].drop("__copy"))
    # counted with their positions: texts are only shuffled for the join if the list is too long to broadcast
    taken = mix(every, "__key", names[text_col], names[source_col], **options).filter("size(positions) > 0").select(F.col("__key").alias("__of"), "positions")
    taken = small(cut(taken.withColumnRenamed("positions", "__positions"), "mix-taken"), weight=F.size("__positions") + 1)
    met = [p.join(taken, F.col("__key").eqNullSafe(F.col("__of"))).withColumn("__at", F.explode("__positions")).select(*docs.columns, "__at") for p in keyed]
    return (met[0] if len(met) == 1 else met[0].unionAll(met[1])).orderBy("__at").drop("__at").toDF(*names)
