"""Mixing sources to target weights by entropy balancing.

Sources in code point order (null last) weigh 5, 2, 1, repeating, and share
150 % of all words; no source gets more than twice its words, and what it cannot
take is shared by weight among the others.  Document rates stay as close to 1 as
the targets allow: they minimise the relative entropy to the uniform rates under
one token constraint per source and the limit of 2.  The solution is an
exponential tilt, ``rate = min(2, exp(lambda * size / mean size))``, with one
multiplier per source, which safeguarded Newton steps on the convex dual find.

Rates only depend on source and size, so Newton works on the histogram of sizes,
which Spark counts once; each step is one aggregation by source, written to the
shared folder.  Rates become whole copies by systematic rounding along the sizes
of a source, and the remainder is filled up from the smallest documents, so a
source misses its target by less than one document.

Defined results: a null text has size 0; documents of size 0 count one copy and
take no words; a null source is a source of its own; equal rows stay separate
rows; an empty table gives an empty table.  The choice among documents of equal
source and size follows a hash of the id, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilpay.llm.common import counted_ranks, drop, new_dir, stage, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
TOLERANCE = 1e-9
STEPS = 100


def _key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: ``s``, ``source_size``, ``docs`` (with words) and ``target``.

    ``sizes`` has ``s``, ``source`` and ``size``.  Sources are few next to documents;
    their order is one sort of one row each.
    """
    per = sizes.groupBy("s", "source").agg(
        F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("docs")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1)
    per = per.withColumn("weight", weight).withColumn("limit", F.lit(float(most)) * F.col("source_size"))
    # sources with the smallest limit per weight fill up first; the others share what is left
    order = Window.orderBy(F.col("limit") / F.col("weight"), "s")
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    others = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = F.sum("source_size").over(Window.partitionBy())
    per = per.withColumn("level", (F.lit(share) * everything - before) / others)
    open_ = F.col("limit") / F.col("weight") > F.col("level")
    level = F.min_by(F.when(open_, F.col("level")), F.when(open_, F.col("limit") / F.col("weight"))).over(Window.partitionBy())
    target = F.coalesce(F.least(F.col("limit"), level * F.col("weight")), F.col("limit"))
    return per.select("s", "source", "source_size", "docs", target.alias("target"))


def _rate(most: int) -> Column:
    tilt = F.col("lambda") * F.col("size") / F.col("mean")
    # the exponent is cut where the limit holds anyway
    return F.when(F.col("full"), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.exp(F.least(tilt, F.lit(5.0)))))


def multipliers(histogram: DataFrame, goal: DataFrame, most: int = MOST) -> DataFrame:
    """``goal`` with ``lambda``, ``mean`` and ``full`` (every document at the limit)."""
    spark = histogram.sparkSession
    none = F.lit(None).cast("double")
    state = goal.select(
        "*", (F.col("source_size") / F.greatest("docs", F.lit(1))).alias("mean"),
        (F.col("target") >= F.lit(most) * F.col("source_size") * (1 - 1e-12)).alias("full"),
        F.lit(0.0).alias("lambda"), none.alias("lo"), none.alias("hi"), F.lit(0.0).alias("miss"),
    )
    names, path = state.columns, None
    for _ in range(STEPS):
        rate = _rate(most)
        words = F.col("n") * F.col("size")
        sums = (
            state.join(histogram, "s").groupBy("s").agg(
                F.sum(words * rate).alias("taken"),
                F.sum(F.when(rate < most, words * rate * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"),
            )
        )
        over = F.coalesce(F.col("taken") - F.col("target"), F.lit(0.0))
        lo = F.when(over <= 0, F.col("lambda")).otherwise(F.col("lo"))
        hi = F.when(over > 0, F.col("lambda")).otherwise(F.col("hi"))
        newton = F.col("lambda") - over / F.nullif(F.col("slope"), F.lit(0.0))
        inside = newton.isNotNull() & (F.col("lo").isNull() | (newton > F.col("lo"))) & (F.col("hi").isNull() | (newton < F.col("hi")))
        safe = (
            F.when(F.col("hi").isNull(), 2 * F.abs("lambda") + 1)
            .when(F.col("lo").isNull(), -2 * F.abs("lambda") - 1)
            .otherwise((F.col("lo") + F.col("hi")) / 2)
        )
        miss = F.when(F.col("full") | (F.col("target") <= 0), 0.0).otherwise(F.abs(over) / F.col("target"))
        step = (
            state.join(sums, "s", "left").withColumn("miss", miss).withColumn("lo", lo).withColumn("hi", hi)
            .withColumn("lambda", F.when((F.col("miss") <= TOLERANCE), F.col("lambda")).when(inside, newton).otherwise(safe))
            .select(*names)
        )
        new = new_dir(spark, "mixing-step")
        step.write.parquet(new)
        if path:
            drop(spark, path)
        state, path = spark.read.schema(step.schema).parquet(new), new
        worst = state.agg(F.max("miss")).first()[0]
        if worst is None or worst <= TOLERANCE:
            return state
    raise RuntimeError(f"the dual did not settle in {STEPS} steps")


def _copies(histogram: DataFrame, solved: DataFrame, most: int) -> DataFrame:
    """Copies ``k`` that all documents of a source and size take together."""
    cells = histogram.join(solved, "s").withColumn("want", F.col("n") * _rate(most))
    falling = Window.partitionBy("s").orderBy(F.col("size").desc())
    until = F.sum("want").over(falling.rowsBetween(Window.unboundedPreceding, 0))
    earlier = F.coalesce(F.sum("want").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    cells = cells.withColumn("k", F.least(F.floor(until + 0.5) - F.floor(earlier + 0.5), F.lit(most) * F.col("n")))
    short = F.col("target") - F.sum(F.col("size") * F.col("k")).over(Window.partitionBy("s"))
    rising = Window.partitionBy("s").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("short", short).withColumn("room", F.lit(most) * F.col("n") - F.col("k"))

    def fill(lack: Column, room: str) -> Column:
        below = F.coalesce(F.sum(F.col("size") * F.col(room)).over(rising), F.lit(0))
        return F.greatest(F.lit(0), F.least(F.floor((lack - below) / F.col("size")), F.col(room)))

    cells = cells.withColumn("more", fill(F.col("short"), "room")).withColumn("less", fill(-F.col("short"), "k"))
    return cells.select("s", "size", "n", (F.col("k") + F.col("more") - F.col("less")).cast("long").alias("k"))


def mixture(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", most: int = MOST) -> DataFrame:
    """One row per (id, source, size): ``m`` equal rows, of which each takes ``every`` copies and ``extra`` of them one more."""
    sizes = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"))
    sizes = stage(sizes.withColumn("s", _key("source")), "mixing-sizes")
    histogram = stage(sizes.filter("size > 0").groupBy("s", "size").agg(F.count(F.lit(1)).alias("n")), "mixing-histogram")
    goal = stage(targets(sizes), "mixing-targets")
    cells = _copies(histogram, multipliers(histogram, goal, most), most)
    ranked = counted_ranks(sizes.select("s", "size", "doc_id"), ["s", "size"], ["doc_id"], sizes.count())
    rest = F.pmod(F.col("k"), F.col("n"))
    placed = ranked.join(cells, ["s", "size"], "left").select(
        "doc_id", "s", "size", "m",
        F.coalesce(F.floor(F.col("k") / F.col("n")), F.lit(1)).cast("long").alias("every"),
        F.coalesce(F.greatest(F.lit(0), F.least(rest - F.col("first"), F.col("m"))), F.lit(0)).alias("extra"),
    )
    return placed.join(goal.select("s", "source", "source_size", "target"), "s")


def mix_report(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: id, size, its source's size and target, and the words taken."""
    each = mixture(docs, text, source, doc_id).select(
        "*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("nth")
    )
    copies = F.col("every") + F.when(F.col("nth") <= F.col("extra"), 1).otherwise(0)
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"))


def mix_documents(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """The mix itself: rows of ``docs``, repeated or left out as their copies say."""
    plan = mixture(docs, text, source, doc_id).select(
        F.col("doc_id").alias("__id"), F.col("s").alias("__s"), F.col("size").alias("__size"), "m", "every", "extra"
    )
    plan = plan.select("__id", "__s", "__size", *[F.col(c).alias(f"__{c}") for c in ("every", "extra", "m")])
    keyed = docs.withColumn("__key", _key(source)).withColumn("__words", word_count(text))
    met = keyed.join(
        plan, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__s")) & (F.col("__words") == F.col("__size"))
    )
    equal = Window.partitionBy(doc_id, "__key", "__words").orderBy(F.xxhash64(*docs.columns))
    copies = F.col("__every") + F.when(F.row_number().over(equal) <= F.col("__extra"), 1).otherwise(0)
    counted = met.withColumn("__copies", copies).filter("__copies > 0")
    return counted.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*docs.columns)
