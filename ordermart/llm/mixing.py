"""Mixing sources to target weights by capped water-filling.

Targets: every source gets a share of the mix by weight; sources whose share
is above ``max_epochs`` times their size are clamped there, and the rest of
the mix is shared again by weight among the others until none is above.

Sampling: a target of 1.3 times a source's size is one whole repetition and a
sample of 0.3 of the source. The sample is the documents with the lowest
seeded hashes whose sizes sum up to the rest; at most three documents are then
put in or out to come nearer. The hash where the sum ends is
found from histograms over hash cells, two levels of 4096 cells, so a source
that holds a third of all rows is summed map-side like any other and only the
documents of its last cell are put in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import guarded, numbered, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MAX_EPOCHS, SEED = 1.5, 2.0, 20240607
CELL = 12


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with __size (words of the whole text; null: 0) and __key, the
    seeded order of the documents (63 bits of a hash of doc_id and text)."""
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).bitwiseAND(F.lit((1 << 63) - 1))
    return docs.withColumns({"__size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint"),
                             "__key": key})


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """source, source_size, weight and target of each source of ``rows``.

    Sources in code-point order, null last, take ``weights`` in turn."""
    sizes = rows.groupBy("source").agg(F.sum("__size").alias("source_size"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = stored(numbered(sizes, [F.col("source").asc_nulls_last()], "sources").select(
        "source", "source_size", F.element_at(cycle, (F.col("ordinal") % len(weights)).cast("int") + 1).alias("weight"),
        (F.col("source_size") * F.lit(float(max_epochs))).alias("cap")), "source-weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        # the clamped sources at this level of the water; one row comes back
        over = F.col("cap") < F.lit(level) * F.col("weight")
        held, open_weight = table.agg(F.sum(F.when(over, F.col("cap")).otherwise(0.0)),
                                      F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        if not open_weight:
            break
        higher = (share * total - held) / open_weight
        if higher <= level:
            break
        level = higher
    return table.withColumn("target", F.least("cap", F.lit(level) * F.col("weight")))


def _cell(level: int):
    return F.shiftright("__key", 63 - CELL * level).bitwiseAND(F.lit((1 << CELL) - 1))


def _sampled():
    """Whether the document is in the fractional repetition."""
    return (F.col("__key") <= F.col("cut")) != F.coalesce(F.array_contains("changed", F.col("__key")), F.lit(False))


def cutoffs(rows: DataFrame, goals: DataFrame, changes: int = 3) -> DataFrame:
    """``goals`` with whole (repetitions of every document), cut (documents
    with keys up to it are taken once more; -1: none) and changed (at most
    ``changes`` keys for which that is reversed: each is the one whose size
    brings the sum nearest to the target)."""
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = stored(goals.withColumn("whole", F.floor(epochs).cast("bigint")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")), "goals")
    now = goals.select(F.col("source").alias("s"), F.col("rest").alias("left"))
    inside, cells = rows.select("source", "__size", "__key"), []
    for level in (1, 2):
        cells.append(f"c{level}")
        part = inside.withColumn(f"c{level}", _cell(level))
        sums = part.groupBy("source", *cells).agg(F.sum("__size").alias("n"))
        before = F.sum("n").over(Window.partitionBy("source").orderBy(f"c{level}"))
        hist = sums.withColumn("through", before).join(now, F.col("source").eqNullSafe(F.col("s")))
        # the first cell that goes beyond what is left
        beyond = hist.where("through > left").groupBy(F.col("source").alias("s")).agg(
            F.min(F.struct(f"c{level}", (F.col("left") - (F.col("through") - F.col("n"))).alias("left"))).alias("x"))
        now = stored(beyond.select("s", F.col(f"x.c{level}").alias(f"__c{level}"), "x.left"), f"cells-{level}")
        inside = part.join(now.drop("left"), F.col("source").eqNullSafe(F.col("s")) & (F.col(f"c{level}") == F.col(f"__c{level}"))
                           ).drop("s", f"__c{level}")
        now = now.select("s", "left")
    through = F.sum("__size").over(Window.partitionBy("source").orderBy("__key"))
    first_out = (inside.withColumn("through", through).join(now, F.col("source").eqNullSafe(F.col("s")))
                 .where("through > left").groupBy(F.col("source").alias("s"))
                 .agg(F.min(F.struct("__key", (F.col("left") - (F.col("through") - F.col("__size"))).alias("left"))).alias("x"))
                 .select("s", (F.col("x.__key") - 1).alias("cut"), "x.left"))
    # no document goes beyond: all are taken (the rest equals the source)
    cut = stored(goals.join(first_out, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "whole",
        F.when(F.col("rest") <= 0, -1).otherwise(F.coalesce("cut", F.lit((1 << 63) - 1))).alias("cut"),
        F.when(F.col("rest") <= 0, 0.0).otherwise(F.coalesce("left", F.lit(0.0))).alias("left"),
        F.array().cast("array<bigint>").alias("changed")), "cuts")
    for _ in range(changes):
        near = (rows.join(cut.select(F.col("source").alias("s"), "cut", "left", "changed"), F.col("source").eqNullSafe(F.col("s")))
                .withColumn("gain", F.when(_sampled(), -F.col("__size")).otherwise(F.col("__size")))
                .withColumn("error", F.abs(F.col("left") - F.col("gain")))
                .where(F.col("error") < F.abs("left"))
                .groupBy(F.col("source").alias("s")).agg(F.min(F.struct("error", "__key", "gain")).alias("x")))
        cut = stored(cut.join(near, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "whole", "cut", (F.col("left") - F.coalesce("x.gain", F.lit(0))).alias("left"),
            F.when(F.col("x").isNull(), F.col("changed"))
            .when(F.array_contains("changed", F.col("x.__key")), F.array_remove("changed", F.col("x.__key")))
            .otherwise(F.concat("changed", F.array("x.__key"))).alias("changed")), "cuts")
    return cut


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` with its own columns and a struct __mix: size, source_size,
    target (of the source), taken (words the mix takes of the document, all
    repetitions counted) and repeats (how often the document is in the mix).

    Sizes are words; null and empty texts have none and are never sampled
    beyond the whole repetitions. Documents without a source form the last
    source. Rows that repeat doc_id and text share a key and are taken
    together. Sources without words have target 0. An empty table gives no
    rows. Reruns with one seed agree.
    """
    rows = stored(sized(docs.select("doc_id", "text", "source"), seed)
                  .groupBy("source", "__key").agg(F.sum("__size").alias("__size")), "sizes")
    plan = cutoffs(rows, targets(rows, weights, share, max_epochs))
    plan = plan.select(F.col("source").alias("__source"), F.struct("source_size", "target", "whole", "cut", "changed").alias("__plan"))
    once_more = (F.col("__key") <= F.col("__plan.cut")) != F.array_contains("__plan.changed", F.col("__key"))
    repeats = F.col("__plan.whole") + once_more.cast("bigint")
    return (sized(docs, seed).join(plan, F.col("source").eqNullSafe(F.col("__source")))
            .withColumn("__mix", F.struct(F.col("__size").alias("size"), F.col("__plan.source_size").alias("source_size"),
                                          F.col("__plan.target").alias("target"),
                                          (F.col("__size") * repeats).alias("taken"), repeats.alias("repeats")))
            .drop("__size", "__key", "__source", "__plan"))


@guarded
def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken."""
    return (mix(docs, **options).where("__mix.repeats > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__mix.repeats").cast("int"))))
            .drop("__mix", "__copy"))


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents mixed by source: weights 5, 2, 1 in turn, 150 % of all
    words, at most two epochs of a source."""
    found = mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    return found.select("doc_id", "__mix.size", "__mix.source_size", "__mix.target", "__mix.taken", "__mix.repeats", "source")
