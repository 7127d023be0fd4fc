"""Mixing sources to target weights by entropy balancing, in native DataFrame operations."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storelake.llm.quality import WHITE_RUN
from storelake.sinks.files import stored

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0  # times that a document, and so a source, may be taken
TOLERANCE = 1e-7
MAX_STEPS = 60  # bisection alone reaches the tolerance within these
UNITS = 1 << 20  # rates are rounded to these parts, so that their sums are exact in any order
PART_ROWS = 1 << 18  # groups of equal rows whose running sum one task takes
BINS_PER_OCTAVE = 8


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\u000b\f\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WHITE_RUN))).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``target`` for each row of ``source``, ``source_size``: shares by weight of the sum of all sizes.

    Sources take the weights in turn by code point, null last. A target stops at ``most`` times its source's size and
    the excess goes to the others by weight: in the order of size over weight, the sources that stop come first, and the
    first that stays below its limit fixes the level of all after it. This is one row per source, ordered in one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = sources.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int")))
    limit = F.col("source_size") * most
    order = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    leveled = weighed.withColumn("level", level).withColumn("limit", limit)
    water = F.max(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))).over(whole)
    target = F.least(F.col("limit"), F.coalesce(water, F.lit(float("inf"))) * F.col("weight"))
    return leveled.select("source", "source_size", F.when(F.col("source_size") > 0, target).otherwise(F.lit(0.0)).alias("target"))


def _exact_sum(value: Column) -> Column:
    """A sum that does not depend on the order of its rows."""
    return F.sum(value.cast("decimal(38,12)")).cast("double")


def _rate(tilt: Column, size: Column, scale: Column) -> Column:
    return F.least(F.lit(MOST), F.exp(F.least(F.lit(50.0), tilt * size / scale)))


def tilts(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``tilt`` and ``scale`` (mean size) for each source: rates exp(tilt * size / scale), at most three, meet its target.

    These rates are nearest in entropy to taking each document once. The dual is convex and, for a source by itself,
    of one variable: Newton steps on the histogram of sizes, kept between bounds by halving, run for all sources at once.
    ``sizes`` has source, size and n; ``wanted`` has source, source_size and target.
    """
    histogram = sizes.filter("size > 0")
    shape = histogram.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
    state = stored(
        wanted.filter("source_size > 0")
        .withColumnRenamed("source", "s")
        .join(shape, F.col("s").eqNullSafe(F.col("source")))
        .select(
            "source", "target", "scale", (F.col("target") >= MOST * F.col("source_size")).alias("full"),
            F.lit(0.0).alias("tilt"), F.lit(-60.0).alias("low"), (F.log(F.lit(MOST)) * F.col("scale")).alias("high"), F.lit(1.0).alias("miss"),
        )
    )
    for _ in range(MAX_STEPS):
        if not state.filter((F.col("miss") > TOLERANCE) & ~F.col("full")).limit(1).count():
            break
        rate = _rate(F.col("tilt"), F.col("size"), F.col("scale"))
        words = F.col("n") * F.col("size")
        sums = (
            histogram.withColumnRenamed("source", "s")
            .join(state, F.col("s").eqNullSafe(F.col("source")))
            .groupBy("source")
            .agg(
                _exact_sum(words * rate).alias("mixed"),
                _exact_sum(F.when(rate < MOST, words * rate * F.col("size") / F.col("scale")).otherwise(F.lit(0.0))).alias("slope"),
            )
        )
        step = state.withColumnRenamed("source", "s").join(sums, F.col("s").eqNullSafe(F.col("source"))).drop("s")
        over = F.col("mixed") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - (F.col("mixed") - F.col("target")) / F.greatest(F.col("slope"), F.lit(1e-300))
        miss = F.abs(F.col("mixed") - F.col("target")) / F.greatest(F.col("target"), F.lit(1e-9))
        moved = F.when((newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        state = stored(
            step.select(
                "source", "target", "scale", "full",
                F.when(miss > TOLERANCE, moved).otherwise(F.col("tilt")).alias("tilt"), low.alias("low"), high.alias("high"), miss.alias("miss"),
            )
        )
    return state


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows (``__h``, ``__id``) with a number from 0 among those of one hash, dealt over the tasks that wrote them.

    A task numbers its own rows of a hash, and the counts of the tasks before it are added.
    """
    dealt = rows.withColumn("__task", F.shiftrightunsigned("__id", 33))
    earlier = Window.partitionBy("__h").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("__h", "__task").agg(F.count(F.lit(1)).alias("__rows"))
    before = stored(counts.select("__h", "__task", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before")))
    own = F.row_number().over(Window.partitionBy("__h", "__task").orderBy("__id")) - 1
    placed = dealt.withColumn("__own", own).join(before, ["__h", "__task"])
    return placed.withColumn("__number", F.col("__before") + F.col("__own")).drop("__task", "__own", "__before")


def _running_units(groups: DataFrame, part_rows: int) -> DataFrame:
    """``__begin``, the units before each group of equal rows (``__n`` of ``__units`` each), by source, size and hash.

    Sums run within narrow cells of size, each dealt by hash over as many parts as its groups need, and over the parts of
    a source, of which there is one for each ``part_rows`` groups and one more for each cell.
    """
    cell = F.floor(F.log2(F.greatest(F.col("size"), F.lit(1)).cast("double")) * BINS_PER_OCTAVE)
    celled = groups.withColumn("__cell", cell)
    counts = celled.groupBy(F.col("__source").alias("__s1"), F.col("__cell").alias("__c1"))
    parts = stored(counts.agg(F.ceil(F.count(F.lit(1)) / part_rows).alias("__parts")))
    same = F.col("__source").eqNullSafe(F.col("__s1")) & (F.col("__cell") == F.col("__c1"))
    dealt = celled.join(parts, same).drop("__s1", "__c1").withColumn("__part", F.pmod("__h", "__parts"))
    total = F.sum(F.col("__units") * F.col("__n"))
    earlier = Window.partitionBy("__s2").orderBy("__c2", "__p2").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(F.col("__source").alias("__s2"), F.col("__cell").alias("__c2"), F.col("__part").alias("__p2"))
    begins = stored(
        sums.agg(total.alias("__sum")).select("__s2", "__c2", "__p2", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__first"))
    )
    at = F.col("__source").eqNullSafe(F.col("__s2")) & (F.col("__cell") == F.col("__c2")) & (F.col("__part") == F.col("__p2"))
    within = Window.partitionBy("__source", "__cell", "__part").orderBy("size", "__h").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(total.over(within), F.lit(0))
    return dealt.join(begins, at).withColumn("__begin", F.col("__first") + inside)


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, text: str = "text", source: str = "source", part_rows: int = PART_ROWS
) -> DataFrame:
    """All rows without their text, with ``size``, ``source_size``, ``target`` and ``copies``.

    Copies follow the rates: with the documents of a source in the order of their size, a document gets as many copies
    as whole numbers are passed by the running sum of rates, so that what rounding takes from one it gives to the next
    of about that size. Equal rows are one entry of that sum, and each finds its place in it by a number among them, so
    neither a large cell of sizes nor a large group of equal rows meets in one task. All sums are of whole numbers or
    decimals, so that reruns agree. Null texts, and texts without words, have size 0 and no copies; null sources are a
    source. Input columns of these names are replaced.
    """
    kept = [c for c in docs.columns if c not in (text, "size", "source_size", "target", "copies")]
    sized = docs.withColumn("size", word_count(F.col(text))).select(*kept, "size", F.xxhash64(*sorted(kept), text).alias("__h"))
    rows = stored(sized.withColumns({"__source": F.col(source), "__id": F.monotonically_increasing_id()}))
    sizes = stored(rows.groupBy(F.col("__source").alias("source"), "size").agg(F.count(F.lit(1)).alias("n")))
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    wanted = stored(targets(totals, weights))
    solved = tilts(sizes, wanted)
    per_source = stored(
        wanted.join(
            solved.select(F.col("source").alias("s"), "tilt", "scale", "full"), F.col("source").eqNullSafe(F.col("s")), "left"
        ).select(F.col("source").alias("__s"), "source_size", "target", "tilt", "scale", "full")
    )
    rate = F.when(F.col("full"), F.lit(MOST)).otherwise(_rate(F.col("tilt"), F.col("size"), F.col("scale")))
    units = F.when(F.col("size") > 0, F.coalesce(F.round(rate * UNITS), F.lit(0.0))).otherwise(F.lit(0.0)).cast("long")
    groups = rows.groupBy("__source", "size", "__h").agg(F.count(F.lit(1)).alias("__n"))
    rated = stored(groups.join(per_source, F.col("__source").eqNullSafe(F.col("__s"))).withColumn("__units", units))
    begun = stored(
        _running_units(rated, part_rows).select(
            F.col("__source").alias("__s3"), F.col("size").alias("__size3"), F.col("__h").alias("__h3"),
            "source_size", "target", "__units", "__begin",
        )
    )
    same = (F.col("__h") == F.col("__h3")) & (F.col("size") == F.col("__size3")) & F.col("__source").eqNullSafe(F.col("__s3"))
    begin = F.col("__begin") + F.col("__number") * F.col("__units")
    passed = lambda x: F.floor((x + UNITS // 2) / UNITS)
    copies = F.least(F.lit(int(MOST)), passed(begin + F.col("__units")) - passed(begin))
    placed = _numbered(rows).join(begun, same)
    return placed.select(*kept, "size", "source_size", "target", copies.cast("int").alias("copies"))


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """All rows, whole, with ``copies``. Rows equal in every column share the copies that ``mix`` gives them evenly."""
    kept = [c for c in docs.columns if c != "copies"]
    rows = docs.select(*kept).withColumn("__row", F.xxhash64(*kept))
    mixed = mix(rows.select("__row", "text", "source"), weights)
    shares = stored(mixed.groupBy("__row").agg(F.sum("copies").alias("__sum"), F.count(F.lit(1)).alias("__rows")))
    turn = F.row_number().over(Window.partitionBy("__row").orderBy(F.lit(0)))
    even = F.floor(F.col("__sum") / F.col("__rows")) + (F.col("__turn") <= F.col("__sum") % F.col("__rows")).cast("int")
    return rows.join(shares, "__row").withColumn("__turn", turn).select(*kept, even.cast("int").alias("copies"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))
