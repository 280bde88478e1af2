"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws a uniform number from the hash of (seed, doc_id); its key is
``-ln(u) / quality``, and the documents of a source are taken by growing key.  A
source takes as many complete epochs as its target holds, then the prefix of that
order whose words come nearest to the rest.

No source is ever sorted as a whole.  Keys are mapped to (0, 1); word counts per
digit (2**12 digits, then 2**12 finer ones inside the one digit that holds the
budget's end) leave about 1 / 2**24 of a source to order exactly, and the last
document taken becomes the source's threshold.  Documents are then only compared
with the thresholds of their source, so a source with a third of all rows spreads
over all tasks.  Everything is DataFrame functions.

Null sources form a source of their own, after the others; null texts and texts
without words have size 0 and are taken 0 words; sources without words have
target 0; identical rows (id and size) are taken or left together; an empty table
gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketrec.llm.common import count_words, materialise

SEED = 20
DIGITS = 4096
MAX_EPOCHS = 3
NO_ID = -(1 << 63)
#: Fixed value: characters that lower a text's quality weight.
JUNK = "!#$%&*<>{}|^~=_0123456789"


def quality_weight(text: Column) -> Column:
    """1 for texts without junk characters, less with their share."""
    junk = F.length(text) - F.length(F.translate(text, JUNK, ""))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(20.0) * F.coalesce(junk, F.lit(0)) / F.greatest(F.coalesce(F.length(text), F.lit(0)), F.lit(1)))


def uniform(doc_id: Column, seed: int) -> Column:
    hexa = F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary")), 1, 13)
    return (F.conv(hexa, 16, 10).cast("double") + 0.5) / float(1 << 52)


def keyed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, size and sampling key of every document."""
    d = docs.select("doc_id", "source", count_words(F.col("text")).alias("size"), quality_weight(F.col("text")).alias("w"))
    return d.select("doc_id", "source", "size", (-F.ln(uniform(F.col("doc_id"), seed)) / F.col("w")).alias("key"))


def targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of sources (source, source_size): weights 1, 2, 3, repeating by code
    point, share the total; what a cap cuts off goes to the others by weight.

    Sources are filled in the order of cap over weight; the capped ones are a
    prefix of it.  One row per source, so the two orders are over a small table."""
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sizes.withColumn("weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    by_cap = Window.orderBy(F.expr("source_size * (6 div weight)"),
                            F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    s = s.select("source", "source_size", "weight",
                 F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("below"),
                 F.sum("weight").over(after).alias("left"),
                 F.sum("source_size").over(every).alias("total"))
    s = s.withColumn("capped", F.expr(f"{max_epochs} * source_size * left <= (total - {max_epochs} * below) * weight"))
    free = F.expr("total") - max_epochs * F.coalesce(F.sum(F.when(F.col("capped"), F.col("source_size"))).over(every), F.lit(0))
    share = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    return s.select("source", "source_size", F.when(F.col("capped"), (max_epochs * F.col("source_size")).cast("double"))
                    .otherwise((F.col("weight") * free).cast("double") / share).alias("target"))


def _digit(key: Column, level: int) -> Column:
    return F.floor((F.lit(1.0) - F.exp(-key)) * float(DIGITS ** level))


def _end_digit(rows: DataFrame, level: int) -> DataFrame:
    """Per source, the digit in which its budget ``rest`` ends and the words before it.
    rows: source, rest, base, key, size."""
    sums = rows.withColumn("digit", _digit(F.col("key"), level)).groupBy("source", "rest", "base", "digit").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy("digit")
    sums = sums.withColumn("upto", F.col("base") + F.sum("words").over(order))
    return (sums.filter("upto - words < rest and rest <= upto").groupBy("source")
            .agg(F.min_by("digit", "upto").alias("digit"), F.min(F.col("upto") - F.col("words")).alias("base")))


def thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source: the last document of the fractional epoch as (key, id, size),
    null if none is taken.  plan: source, rest (words of the fractional epoch)."""
    same = lambda a, b: a.join(b.withColumnRenamed("source", "s"), F.expr("source <=> s")).drop("s")
    budget = plan.select("source", "rest").filter("rest > 0")
    cur = same(rows, budget.withColumn("base", F.lit(0).cast("long")))
    for level in (1, 2):
        end = materialise(_end_digit(cur, level), "mix-digit")
        cur = same(rows, same(budget, end)).filter(_digit(F.col("key"), level) == F.col("digit")).drop("digit")
    order = Window.partitionBy("source").orderBy("key", "id", "size")
    mid = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2 + F.col("base")
    tail = cur.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("mid", mid)
    last = tail.filter("mid < rest").groupBy("source").agg(F.max(F.struct("key", "id", "size")).alias("last"))
    # nothing of the last digit fits: the documents of smaller digits are still taken
    edge = cur.groupBy("source").agg(F.min("key").alias("edge"))
    return edge.join(last.withColumnRenamed("source", "s"), F.expr("source <=> s"), "left").drop("s")


def mix(docs: DataFrame, seed: int = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, source, size, source_size, target, copies (how often the mix takes the
    document) and taken (its words in the mix)."""
    rows = materialise(keyed(docs, seed), "mix-keys")
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("epochs", epochs.cast("long"))
    plan = materialise(plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-plan")
    ends = thresholds(rows, plan)
    both = plan.join(ends.withColumnRenamed("source", "s"), F.expr("source <=> s"), "left").drop("s")
    both = materialise(both.withColumnRenamed("source", "s"), "mix-ends")
    own = F.struct("key", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "size")
    extra = F.when(F.col("last").isNotNull(), own <= F.col("last")).otherwise(F.coalesce(F.col("key") < F.col("edge"), F.lit(False)))
    copies = F.col("epochs") + extra.cast("long")
    return (rows.join(both, F.expr("source <=> s")).withColumn("copies", copies)
            .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def mixed_documents(docs: DataFrame, seed: int = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: rows of ``docs`` repeated as often as it takes them.  Ids with a
    null are matched as equal; rows of one id and different sizes are taken each by its own count."""
    counts = mix(docs, seed, max_epochs).filter("copies > 0").groupBy(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size")).agg(F.max("copies").alias("__copies"))
    full = docs.withColumn("__words", count_words(F.col("text")))
    own = F.expr("doc_id <=> __id and source <=> __source and __words = __size")
    return full.join(counts, own).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*[full[c] for c in docs.columns])


def op8_query(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         1.0::DOUBLE / (1.0::DOUBLE + 20.0::DOUBLE * coalesce(length(text) - length(translate(text, '{JUNK}', '')), 0)
                        / greatest(coalesce(length(text), 0), 1)) AS w,
         (CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{SEED}'), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
k AS (SELECT doc_id, source, size, -ln(u) / w AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1 AS weight FROM k GROUP BY source),
f AS (SELECT *, coalesce(sum(source_size) OVER (ORDER BY source_size * (6 // weight), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
             sum(weight) OVER (ORDER BY source_size * (6 // weight), source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w,
             sum(source_size) OVER () AS total FROM s),
c AS (SELECT *, {MAX_EPOCHS} * source_size * rest_w <= (total - {MAX_EPOCHS} * below) * weight AS capped FROM f),
t AS (SELECT source, source_size, CASE WHEN capped THEN ({MAX_EPOCHS} * source_size)::DOUBLE ELSE
             (weight * (total - {MAX_EPOCHS} * coalesce(sum(source_size) FILTER (capped) OVER (), 0)))::DOUBLE
             / sum(weight) FILTER (NOT capped) OVER () END AS target FROM c),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
r AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
             sum(k.size) OVER (PARTITION BY k.source ORDER BY key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING) - k.size / 2.0::DOUBLE AS mid
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, ((epochs + CASE WHEN rest > 0 AND mid < rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM r"""
