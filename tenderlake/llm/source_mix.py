"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources share the budget by weight, none beyond a number of epochs of its own
size. A source's whole epochs come first; for what remains, its documents are
ordered by exponential keys scaled by their quality weight and taken until the
sum of their sizes reaches the rest of the target.

The order's prefix sums need no sort of a whole source. The range of a source's
keys is cut into PARTS, whose sums are added up in order; only the part that
holds the target's edge is cut again, and so on until that part has few rows
or but one key. Then it is ordered row by row. Each cut leaves a small fraction
of the rows, however the keys lie and however many rows a source has.

All randomness is a hash of the id and the text, so reruns agree, and rows
without an id or with a repeated one have keys of their own. Rows that are alike
in id, text and source have one key; where the edge falls among them they are
numbered, in any order, and only so many are taken. Null is a source of its
own; null and empty texts have size 0. Other columns, whatever their names, are
left alone. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import aside, placed, written

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
#: Parts that a source's range of keys is cut into, and rows that are few enough to be ordered.
PARTS, FEW = 4096, 4096


def n_words(text: Column) -> Column:
    """The number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 0.2 and 1: the share of the text that is not marks which running text seldom has."""
    marks = F.regexp_count(text, F.lit(r"[#*$%&|<>!{}=_~^\\]"))
    return F.coalesce(F.greatest(F.lit(0.2), 1 - 5.0 * marks / F.greatest(F.length(text), F.lit(1))), F.lit(1.0))


def sampling_key(doc_id: Column, text: Column, weight: Column, seed: int, hashed: bool = False) -> Column:
    """The exponential key -ln(u) / weight for u uniform in (0, 1): the smallest come first. With hashed, text is its xxhash64."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, text if hashed else F.xxhash64(text)), 11).cast("double") + 0.5) / float(2**53)
    return -F.log(u) / weight


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """sizes (source, source_size, rows: a row a source) with target.

    Sources in code-point order, null last, get the weights in turn and share
    the sum of all sizes; where a share exceeds most times the source's size it
    stops there and the others share the excess by weight. A share stops when
    cap / weight is below the common level, so sources are filled in the order
    of that ratio; the first whose ratio is above what is left for it and all
    later ones shows the level. These windows are over sources, not rows.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    caps = sizes.withColumn("w", weight.cast("double")).withColumn("cap", F.col("source_size") * most)
    full = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    levels = caps.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    levels = levels.withColumn("w_left", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    stops = F.col("cap") * F.col("w_left") <= F.col("left") * F.col("w")
    levels = levels.withColumn("at", F.when(~stops, F.struct(F.col("cap") / F.col("w"), "left", "w_left")))
    levels = levels.withColumn("level", F.min("at").over(every))
    share = F.col("w") * F.col("level.left") / F.col("level.w_left")
    return levels.select("source", "source_size", "rows", F.when(stops | F.col("level").isNull(), F.col("cap").cast("double")).otherwise(share).alias("target"))


def _keyed(doc_id: Column, text: Column, source: Column, quality: Column, seed: int, size: Column | None = None) -> list[Column]:
    """A row's source, size and key; with size, text is a text's hash."""
    key = sampling_key(doc_id, text, F.greatest(F.coalesce(quality, F.lit(1.0)), F.lit(0.01)), seed, size is not None)
    return [source.alias("__source"), (n_words(text) if size is None else size).alias("__size"), key.alias("__key")]


def cuts(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, parts: int | None = None, few: int | None = None) -> DataFrame:
    """What decides for each source of rows (__source, __size, __key), a row a source.

    source, source_size, target, epochs (whole ones), below, last, edge and
    edge_rows: taken once more are the keys below the one and up to the other,
    where they are not null. Where the target's edge falls among several rows of
    one key, edge is that key and edge_rows the number of them that are taken.
    """
    parts, few = parts or PARTS, few or FEW
    found = rows.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size"), F.count(F.lit(1)).alias("rows"), F.min("__key").alias("low"), F.max("__key").alias("high"))
    plan = targets(found.select("source", "source_size", "rows"), weights, most).join(found.select(F.col("source").alias("s"), "low", "high"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0).cast("long")
    plan = plan.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    plan = written(plan, "mix-plan")
    # sources with a rest that is less than their size: one range of keys each, with what comes before it
    ranges = plan.where("rest > 0 AND rest < source_size").select("source", "rest", "low", "high", "rows", F.lit(0).cast("long").alias("before"))
    inside = rows
    while True:
        ranges = written(ranges, "mix-ranges")
        inside = inside.join(ranges.withColumnRenamed("source", "s"), F.col("__source").eqNullSafe(F.col("s"))).where("__key BETWEEN low AND high")
        if ranges.where((F.col("rows") > few) & (F.col("low") < F.col("high"))).isEmpty():
            break
        part = F.least(F.floor((F.col("__key") - F.col("low")) / (F.col("high") - F.col("low")) * parts), F.lit(parts - 1)).cast("long")
        sums = inside.withColumn("part", F.when(F.col("low") < F.col("high"), part).otherwise(0)).groupBy("__source", "rest", "before", "part")
        sums = sums.agg(F.sum("__size").alias("words"), F.count(F.lit(1)).alias("rows"), F.min("__key").alias("low"), F.max("__key").alias("high"))
        # at most `parts` rows a source
        upto = F.col("before") + F.sum("words").over(Window.partitionBy("__source").orderBy("part"))
        first = sums.withColumn("upto", upto).where("upto > rest").groupBy("__source").agg(F.min_by(F.struct("rest", "low", "high", "rows", (F.col("upto") - F.col("words")).alias("before")), "part").alias("x"))
        ranges = first.select(F.col("__source").alias("source"), "x.rest", "x.low", "x.high", "x.rows", "x.before")
        inside = written(inside.select("__source", "__size", "__key"), "mix-inside")
    # rows of one key are one place, and alike; the few places left are ordered
    places = inside.groupBy("__source", "rest", "before", "low", "__key").agg(F.sum("__size").alias("words"), F.count(F.lit(1)).alias("n"))
    ranked = Window.partitionBy("__source").orderBy("__key").rowsBetween(Window.unboundedPreceding, 0)
    # a row is taken if the target is nearer with it than without it
    places = places.withColumn("reach", F.col("before") + F.sum("words").over(ranked)).withColumn("one", F.col("words") / F.col("n"))
    whole = F.col("reach") - F.col("one") / 2 <= F.col("rest")
    some = F.floor((F.col("rest") - F.col("reach") + F.col("words")) / F.col("one") + 0.5)
    cut = ~whole & (F.col("n") > 1) & (F.col("one") > 0) & (some > 0)
    last = places.groupBy("__source").agg(F.max(F.when(whole, F.col("__key"))).alias("last"), F.min_by(F.struct(F.col("__key").alias("edge"), some.alias("edge_rows")), F.when(cut, F.col("__key"))).alias("cut"))
    # where the edge lies, all keys below the range are taken, and in it those up to the last one
    ends = ranges.select(F.col("source").alias("s"), "low").join(last, F.col("s").eqNullSafe(F.col("__source")), "left").drop("__source")
    chosen = plan.drop("low").join(ends, F.col("source").eqNullSafe(F.col("s")), "left")
    below = F.when(F.col("rest") >= F.col("source_size"), float("inf")).otherwise(F.col("low"))
    return written(chosen.select("source", "source_size", "target", "epochs", below.cast("double").alias("below"), "last", "cut.edge", "cut.edge_rows"), "mix-cuts")


def _joined(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """rows with the cuts of their source, a row a source, and __copies."""
    names = {c: f"__cut_{c}" for c in chosen.columns}
    both = rows.join(chosen.withColumnsRenamed(names), F.col("__source").eqNullSafe(F.col("__cut_source")))
    once = F.coalesce(F.col("__key") < F.col("__cut_below"), F.lit(False)) | F.coalesce(F.col("__key") <= F.col("__cut_last"), F.lit(False))
    both = both.withColumn("__copies", F.col("__cut_epochs") + once.cast("long"))
    if chosen.where("edge IS NOT NULL").isEmpty():
        return both
    at_edge = F.coalesce(F.col("__key") == F.col("__cut_edge"), F.lit(False))
    return both.where(~at_edge).unionByName(_some(both.where(at_edge)))


def _some(alike: DataFrame) -> DataFrame:
    """The rows of edges, the first __cut_edge_rows of each source with a copy more.

    They are written once, with the place where they were read, and numbered by
    the counts of the partitions read before and within their own partition.
    """
    rows = written(alike.withColumn("__read_at", F.monotonically_increasing_id()), "mix-edge")
    part = F.shiftright("__read_at", 33)  # the partition, in the upper bits
    counts = rows.groupBy("__source", part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # a row for each partition
    counts = counts.withColumn("__before", F.sum("__n").over(Window.partitionBy("__source").orderBy("__part")) - F.col("__n")).toDF("__s", "__part", "__n", "__before")
    numbered = rows.withColumn("__number", F.row_number().over(Window.partitionBy("__source", part).orderBy("__read_at")))
    numbered = numbered.join(counts, F.col("__source").eqNullSafe(F.col("__s")) & (part == F.col("__part")))
    more = (F.col("__before") + F.col("__number") <= F.col("__cut_edge_rows")).cast("long")
    return numbered.withColumn("__copies", F.col("__copies") + more).select(*alike.columns)


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", quality: str | None = None, size: str | None = None, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: int = 7) -> DataFrame:
    """docs' rows as often as the mix takes them, with docs' columns but for those that quality and size name.

    quality is a column of weights, none below 0.01; without it the texts' marks
    make them. size is a column of the texts' numbers of words, where they are
    known. Only the sources' cuts are joined to docs, so texts are not shuffled
    for it.
    """
    moved, back = aside(docs)
    own = lambda c: F.col(placed(docs, c))
    weight = own(quality) if quality else quality_weight(own(text))
    keyed = _keyed(own(doc_id), F.xxhash64(own(text)) if size else own(text), own(source), weight, seed, own(size) if size else None)
    chosen = cuts(written(moved.select(*keyed), "mix-rows"), weights, most)
    taken = _joined(moved.select("*", *keyed), chosen).where("__copies > 0")
    kept = [c for c, name in zip(back, docs.columns) if name not in (quality, size)]
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*kept)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", quality: str | None = None, size: str | None = None, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: int = 7) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted) and copies for every row of docs.

    The document at a target's edge is taken if that brings its source nearer to
    the target. quality is as in repeated(). Where the numbers of words are known,
    size names their column, text names one of the texts' xxhash64, and texts
    need not be read again; quality has to be given then.
    """
    ident, words, own = F.col(f"`{doc_id}`"), F.col(f"`{text}`"), F.col(f"`{source}`")
    keyed = _keyed(ident, words, own, F.col(f"`{quality}`") if quality else quality_weight(words), seed, F.col(f"`{size}`") if size else None)
    rows = written(docs.select(ident.alias("__id"), *keyed), "mix-rows")
    mixed = _joined(rows, cuts(rows.drop("__id"), weights, most))
    return mixed.select(F.col("__id").alias(doc_id), F.col("__size").alias("size"), F.col("__cut_source_size").alias("source_size"), F.col("__cut_target").alias("target"), (F.col("__size") * F.col("__copies")).alias("taken"), F.col("__copies").alias("copies"))
