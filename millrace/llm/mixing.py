"""Mixing sources to target weights: Efraimidis-Spirakis order, prefix-summed to budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.base import WORD, driver_rows
from millrace.operators.joins import keyed_join, measure
from millrace.operators.keys import dense_ids
from millrace.session import materialize

KEY_BUCKETS = 4096
#: Up to so many documents that still fit are gone through in order on the driver.
FINISH_ROWS = 10_000


def unit(id_value: Column, seed: int) -> Column:
    """A number in (0, 1) that a text and the seed fix: 52 bits of a digest, plus a half."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), id_value))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """``source, source_size, target`` from ``source, size``.

    Sources in order (null last) get the ``weights``, repeating.  A source's share of all sizes
    is by weight, at most ``most`` times its own size; what is beyond goes to the others by
    weight until none is above.  That end is found at once: in order of cap to weight the capped
    sources come first, and the others share what the caps leave.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    keys, _ = dense_ids(totals, ["source"], "place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    placed = keys.select(
        "source", "source_size", "place",
        F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")).alias("w"),
        (F.col("source_size") * F.lit(float(most))).alias("cap"),
    )
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("w"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    capped = placed.withColumn("total", total).withColumn("capped", F.col("cap") * weight <= left * F.col("w"))
    free_weight = F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything)
    free_total = F.col("total") - F.coalesce(
        F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0.0)
    )
    return capped.select(
        "source", "source_size",
        F.when(F.col("capped"), F.col("cap")).otherwise(free_total / free_weight * F.col("w")).alias("target"),
    )


def on_source(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join one row per source; it is broadcast if measured small, else hot sources are spread."""
    stored = materialize(right, "mix-sources")
    return keyed_join(left, stored, ["source"], right_size=measure(stored), null_safe=True)


def draw_prefix(rows: DataFrame, plan: DataFrame, key_buckets: int) -> DataFrame:
    """``rows`` with the columns of their source in ``plan`` and ``drawn``: by rising key, whether
    the sizes up to and with the row are within the source's ``budget``."""
    bucket = F.least(F.floor((1 - F.exp(-F.col("key"))) * key_buckets), F.lit(key_buckets - 1)).cast("int")
    keyed = rows.withColumn("bucket", bucket)
    ranges = on_source(
        keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words")), plan.select("source", "budget")
    )
    running = Window.partitionBy("source").orderBy("bucket")
    ends = (
        ranges.withColumn("through", F.sum("words").over(running))
        .filter(F.col("through") > F.col("budget"))
        .groupBy("source")
        .agg(F.min(F.struct("bucket", (F.col("through") - F.col("words")).alias("before"))).alias("end"))
        .select("source", F.col("end.bucket").alias("end"), F.col("end.before").alias("before"))
    )
    steps = plan.join(
        ends.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left"
    ).select(
        *plan.columns, F.coalesce("end", F.lit(key_buckets)).alias("end"), F.coalesce("before", F.lit(0)).alias("before")
    )
    placed = on_source(keyed, steps)
    order = Window.partitionBy("source").orderBy("key", "id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    last_range = placed.filter(F.col("bucket") == F.col("end")).withColumn(
        "drawn", F.col("before") + F.sum("size").over(order) <= F.col("budget")
    )
    others = placed.filter(F.col("bucket") != F.col("end")).withColumn("drawn", F.col("bucket") < F.col("end"))
    return others.unionByName(last_range).drop("bucket", "end", "before")


def still_fit(drawn: DataFrame) -> DataFrame:
    """The rows not drawn that fit what their source's draw leaves; that becomes ``budget``."""
    so_far = drawn.groupBy("source").agg(F.sum(F.when(F.col("drawn"), F.col("size")).otherwise(0)).alias("so_far"))
    left = F.col("budget") - F.col("so_far")
    rest = on_source(drawn.filter(~F.col("drawn") & (F.col("size") > 0)), so_far).filter(F.col("size") <= left)
    return materialize(rest.select("id", "source", "size", "key", "row", left.alias("budget")), "mix-rest")


def draw_past_misfits(drawn: DataFrame, key_buckets: int) -> DataFrame:
    """``row`` of what is drawn after the first document that does not fit.

    By rising key, every document is taken that fits what is left.  What did not fit once never
    does later, so prefix sums over the documents that still fit, repeated until none does, take
    the same ones; few are gone through directly.
    """
    spark = drawn.sparkSession
    rest = still_fit(drawn)
    found = driver_rows(spark, [], "row bigint")
    while (n := rest.count()) > FINISH_ROWS:
        plan = rest.groupBy("source").agg(F.first("budget").alias("budget"))
        more = materialize(draw_prefix(rest.drop("budget"), plan, key_buckets), "mix-more")
        found = found.unionByName(more.filter("drawn").select("row"))
        rest = still_fit(more)
    if n:
        left, taken = {}, []
        for r in rest.orderBy("key", "id", "size").select("source", "size", "budget", "row").collect():
            gap = left.setdefault(r["source"], r["budget"])
            if r["size"] <= gap:
                left[r["source"]] = gap - r["size"]
                taken.append((r["row"],))
        found = found.unionByName(driver_rows(spark, taken, "row bigint"))
    return materialize(found, "mix-past")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    most_epochs: int = 3,
    seed: int = 20,
    quality: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    key_buckets: int = KEY_BUCKETS,
    past_misfits: bool = True,
    row_col: str | None = None,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` for every document.

    A document's size is its number of words.  A source is first taken whole as often as its
    target holds it; what remains of the target is drawn without replacement: every document has
    the key -ln(u) / quality, and by rising key every document is taken that fits what is left
    (without ``past_misfits``: up to the first that does not fit).  The last gap goes to that one of the other documents whose size is nearest to it, if that is
    nearer than leaving the gap.  ``taken`` is ``copies * size``.

    Keys fall into ``key_buckets`` ranges.  Sizes are added per source and range within tasks
    first, running sums over the ranges find the range in which a budget ends, and only that
    range is sorted: a source with a third of all rows is never in one task.

    Null text and text without words: size 0, nothing taken.  A null source is a source, the
    last.  A row without an id is drawn by a digest of its text.  Rows that repeat an id tie; ties go by size, equal rows are
    interchangeable.  An empty table gives no rows.  Other columns are ignored.  ``quality`` is
    an expression over the documents (positive; null counts as 1).  ``row_col``, a key of the
    rows, stays in the result.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    given = F.lit(None).cast("bigint") if row_col is None else F.col(row_col)
    sized = materialize(
        docs.select(
            given.alias("carried"),
            F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"),
            (F.lit(None) if quality is None else quality).cast("double").alias("given"),
            F.length(text_col).alias("chars"),
            F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("?"), F.md5(F.coalesce(text_col, F.lit(""))))).alias("drawn_by"),
        ).select(
            "carried", "id", "source", "size", "drawn_by",
            F.coalesce(
                "given",
                F.lit(1.0) if quality is not None else F.when(
                    (F.col("chars") / F.when(F.col("size") > 0, F.col("size"))).between(3.0, 12.0), 1.0
                ).otherwise(0.5),
            ).alias("w"),
        ).select(
            "carried", "id", "source", "size",
            (-F.log(unit(F.col("drawn_by"), seed)) / F.greatest(F.col("w"), F.lit(1e-9))).alias("key"),
        ),
        "mix",
    )
    targets = source_targets(sized, weights, most_epochs)
    epochs = F.coalesce(F.floor(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))), F.lit(0))
    plan = materialize(
        targets.withColumn("epochs", F.least(epochs, F.lit(most_epochs)).cast("bigint")).withColumn(
            "budget", F.col("target") - F.col("epochs") * F.col("source_size")
        ),
        "mix-plan",
    )
    drawn = materialize(
        draw_prefix(sized, plan, key_buckets).select(
            "carried", "id", "source", "size", "key", "source_size", "target", "epochs", "budget",
            (F.col("drawn") & (F.col("size") > 0)).alias("drawn"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "mix-drawn",
    )
    if past_misfits:
        past = draw_past_misfits(drawn, key_buckets).withColumn("past", F.lit(True))
        drawn = materialize(
            keyed_join(drawn, past, ["row"], "left", measure(past), balance=False)
            .withColumn("drawn", F.col("drawn") | F.coalesce("past", F.lit(False)))
            .drop("past"),
            "mix-drawn",
        )
    so_far = drawn.groupBy("source").agg(
        F.sum(F.when(F.col("drawn"), F.col("size")).otherwise(0)).alias("so_far")
    )
    gap = F.col("budget") - F.col("so_far")
    miss = F.abs(gap - F.col("size"))
    filler = materialize(
        on_source(drawn.filter(~F.col("drawn") & (F.col("size") > 0)), so_far)
        .filter(miss < gap)
        .groupBy("source")
        .agg(F.min(F.struct(miss.alias("miss"), "key", "row")).alias("f"))
        .select(F.col("f.row").alias("row"), F.lit(True).alias("fills")),
        "mix-fill",
    )
    copies = F.when(F.col("size") > 0, F.col("epochs") + (F.col("drawn") | F.coalesce("fills", F.lit(False))).cast("int"))
    return (
        keyed_join(drawn, filler, ["row"], "left", measure(filler), balance=False)
        .withColumn("copies", F.coalesce(copies, F.lit(0)).cast("bigint"))
        .select(
            *([] if row_col is None else [F.col("carried").alias(row_col)]),
            F.col("id").alias(id_col), "size", "source_size", "target",
            (F.col("copies") * F.col("size")).alias("taken"), "copies",
        )
    )
