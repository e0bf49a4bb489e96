"""Mixing sources to target weights along a curriculum that changes over training.

Each source has a target in words: its share by weight, at most ``max_epochs`` times its own
size. Inside a source the documents stand in a hashed order; the source is passed through as
often as its target holds, the last pass only as far as the target reaches. A schedule gives
each source a demand density over training time, piecewise linear between knots; its integral
is the words of the source consumed by a time. Inverting that integral at a document's place in
its source gives the document's training position, and documents are range-sorted by position.

No source is summed in one task: words are added up per (source, hash slice), the sums of the
slices are laid end to end, and only the rows of one slice, a bounded number, share a window.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsforge.llm.common import exchanges, row_key, written

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Curriculum:
    """``weights`` repeat over the sources in code point order, null last.

    ``schedules`` repeat likewise: a tuple of densities at equally spaced times from 0 to 1,
    none negative, not all zero.
    """

    weights: tuple[int, ...] = (1, 2, 3)
    max_epochs: int = 3
    schedules: tuple[tuple[float, ...], ...] = field(default=((3.0, 1.0), (1.0, 1.0), (1.0, 2.0, 1.0)))
    slice_rows: int = 4096


def words_of(text: Column) -> Column:
    """Number of words of a text; null is 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, op: Curriculum) -> DataFrame:
    """(source, source_size, rank, target) from (source, source_size): one row per source.

    Shares by weight, cut at ``max_epochs`` times the source's size, the rest dealt again by
    weight: that settles where every uncut source has one common rate per weight. Sources in
    rising order of cap per weight are cut until the rate of those left stays below their cap.
    Works on the table of sources only.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    s = sizes.withColumn("rank", F.row_number().over(order) - 1)
    weights = F.array(*[F.lit(w) for w in op.weights])
    s = s.withColumn("weight", F.get(weights, (F.col("rank") % len(op.weights)).cast("int")).cast("long"))
    s = s.withColumn("cap", F.col("source_size") * op.max_epochs)
    line = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, all_rows = line.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("left_words", F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    s = s.withColumn("left_weight", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    s = s.withColumn("rate", F.col("left_words") / F.col("left_weight"))
    # The first source whose cap is not below its share ends the cutting.
    s = s.withColumn("rate", F.min(F.when(F.col("rate") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "rank", "rate"))).over(all_rows)["rate"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("rate"), F.lit(0.0)) * F.col("weight"))
    return s.select("source", "source_size", "rank", target.alias("target"))


def placed(docs: DataFrame, op: Curriculum = Curriculum(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source, source_size, rank, target, words, start, taken), one row per document.

    ``start``: words of its source before it in the hashed order (ties by id, then text). ``words``:
    the whole words the source gives. ``taken``: full passes of the document and what the last
    pass reaches of it. Null text is empty, null source a source of its own; equal texts are
    counted each. Equal rows of one id are documents with places of their own, one after the
    other; they share a row until the places are known, so many repeats do not fill a slice.
    Rows with a null id stand last in their source, by a hash of the text. Reruns
    agree, as order comes from ids and texts alone.
    """
    key = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    return _places(docs, op, key, id_col, text_col, source_col)[0].drop("key")


def _places(docs: DataFrame, op: Curriculum, key: Column, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, bool]:
    """The rows of :func:`placed` with ``key``, and whether a key occurs twice.

    ``key`` is a digest that breaks ties and draws for null ids.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), words_of(F.col(text_col)).alias("size"), key.alias("key")
    ).withColumn("draw", F.coalesce(F.md5(F.col("doc_id").cast("string")), F.concat(F.lit("g"), "key")))  # g: after all digests
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    rows = written(rows, "sizes")  # the texts are read once
    count, most = rows.agg(F.count(F.lit(1)), F.coalesce(F.max("copies"), F.lit(0))).first()
    slices = -(-count // op.slice_rows)  # only deals out the work; the order is that of the draws
    part = F.when(F.col("doc_id").isNull(), F.col("key")).otherwise(F.col("draw"))
    part = (F.conv(F.substring(part, 1, 8), 16, 10).cast("long") * slices / F.lit(2**32)).cast("long")
    rows = rows.withColumn("slice", part + F.when(F.col("doc_id").isNull(), slices).otherwise(0))
    parts = rows.groupBy("source", "slice").agg(F.sum(F.col("size") * F.col("copies")).alias("part"))
    whole = targets(parts.groupBy("source").agg(F.sum("part").alias("source_size")), op)
    parts = parts.join(whole, parts["source"].eqNullSafe(whole["source"])).drop(whole["source"])
    ahead = Window.partitionBy("rank").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = written(parts.withColumn("base", F.coalesce(F.sum("part").over(ahead), F.lit(0))), "slices")
    both = rows.join(parts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")) & (rows["slice"] == parts["slice"])).drop(parts["slice"])
    inside = Window.partitionBy("rank", "slice").orderBy("draw", "doc_id", "key").rowsBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("start", F.col("base") + F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0)))
    if most > 1:
        both = both.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        both = both.withColumn("start", F.col("start") + (F.col("copy") - 1) * F.col("size"))
    both = both.withColumn("words", F.round("target").cast("long"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("words") - full * F.col("source_size")
    taken = full * F.col("size") + F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("start")))
    return both.select("key", "doc_id", "size", "source", "source_size", "rank", "target", "words", "start", taken.cast("long").alias("taken")), most > 1


def _position(consumed: Column, rank: Column, op: Curriculum) -> Column:
    """The time at which a source's demand reaches the share ``consumed`` of its target.

    The density runs straight from knot to knot, so the integral up to a time is a parabola
    in each piece; its root is the position.
    """
    choice = rank % len(op.schedules)
    out = F.lit(None).cast("double")
    for k, knots in enumerate(op.schedules):
        width = 1.0 / (len(knots) - 1)
        areas = [width * (a + b) / 2 for a, b in zip(knots, knots[1:])]
        need, done, value = consumed * sum(areas), 0.0, F.lit(1.0)
        pieces = []
        for i, (a, b) in enumerate(zip(knots, knots[1:])):
            slope, over = (b - a) / width, need - done
            if slope == 0:
                step = over / a if a else F.lit(0.0)
            else:
                step = (F.sqrt(F.greatest(F.lit(0.0), a * a + 2 * slope * over)) - a) / slope
            done += areas[i]
            pieces.append((need <= done, i * width + F.least(F.lit(width), step)))
        for test, place in reversed(pieces):
            value = F.when(test, place).otherwise(value)
        out = F.when(choice == k, value).otherwise(out)
    return out


def position(at: Column, taken: Column, op: Curriculum) -> Column:
    """Training time, 0 to 1, of ``taken`` words that start ``at`` words into their source."""
    return _position((at + taken / 2) / F.col("words"), F.col("rank"), op)


def scheduled(placement: DataFrame, op: Curriculum = Curriculum()) -> DataFrame:
    """One row per pass of a document that the mix takes: epoch, pass_words, position.

    Words past the target in the last pass are not taken; a document without words has no
    pass. Rows are range-sorted by position.
    """
    passes = F.explode(F.sequence(F.lit(0), F.lit(op.max_epochs - 1))).alias("epoch")
    rows = placement.where("taken > 0").select("*", passes)
    at = F.col("epoch") * F.col("source_size") + F.col("start")
    rows = rows.withColumn("pass_words", F.least(F.col("size"), F.greatest(F.lit(0), F.col("words") - at)).cast("long")).where("pass_words > 0")
    rows = rows.withColumn("position", position(at, F.col("pass_words"), op))
    spread = rows.repartitionByRange(exchanges(placement.sparkSession), "position", "doc_id", "epoch")
    return spread.sortWithinPartitions("position", "doc_id", "epoch")


def mixed_documents(docs: DataFrame, op: Curriculum = Curriculum()) -> DataFrame:
    """The mixed corpus in training order, with the columns of ``docs``.

    A document comes once for each pass, always whole: where a source's target ends inside a
    document, that pass takes the document when at least half of it lies before the target, so
    the source ends within half a document of it. Rows with a null id are documents like others,
    and so is each of several equal rows. Other columns may have any name.
    """
    spots, repeats = _places(docs, op, row_key(docs), "doc_id", "text", "source")
    taken = scheduled(spots, op).where("2 * pass_words >= size").select("key", "doc_id", "position", "epoch")
    rows = docs.select(row_key(docs).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    both = (rows.dropDuplicates(["key"]) if repeats else rows).join(taken, "key")  # equal rows: one for all their passes
    sorted_rows = both.repartitionByRange(exchanges(docs.sparkSession), "position", "doc_id", "epoch").sortWithinPartitions("position", "doc_id", "epoch")
    return sorted_rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])
