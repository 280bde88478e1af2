"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketrec.session import checkpoint_dir, scratch_path

#: White space of the word rule, and the word pattern.
WHITE_SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{WHITE_SPACE}]+"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; where
    the package was sent with --py-files or is installed, this changes nothing."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [x for x in env.get("PYTHONPATH", "").split(":") if x]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: later
    steps start from files that survive the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the tables of ``materialise`` that ``tables`` read; nothing may read them afterwards."""
    for df in tables:
        spark = df.sparkSession
        base = f"{checkpoint_dir(spark).rstrip('/')}/basketrec-"
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base).toUri().getPath()
            if p.toUri().getPath().startswith(own):
                fs.delete(p, True)


def smallest_draws(rows: DataFrame, draw: str, n: int, *ties: str) -> pa.Table:
    """The ``n`` rows with the smallest values of column ``draw`` (uniform 64-bit hashes),
    ties by the other columns; all rows if there are no more.  Tasks hand on only rows
    below a bound that about 2 * n rows of the table reach, not n rows each; should equal
    draws leave fewer than n below it, all rows are ordered."""
    share = 2.0 * n / max(rows.count(), 1)
    if share < 1:
        below = rows.filter(F.col(draw) < int(share * 2.0 ** 64) - 2 ** 63)
        found = below.orderBy(draw, *ties).limit(n).toArrow()
        if found.num_rows == n:
            return found
    return rows.orderBy(draw, *ties).limit(n).toArrow()


def fair_share(counts: dict, total: int, least: int) -> int:
    """The most rows a group may give so that all groups, giving what they have up to
    that, stay within ``total``; never less than ``least``."""
    left, n = total, len(counts)
    for c in sorted(counts.values()):
        if c * n > left:
            return max(least, left // n)
        left, n = left - c, n - 1
    return max([least, *counts.values()])


def smallest_draws_by(rows: DataFrame, group: str, counts: dict, draw: str, n: int | dict, *ties: str) -> pa.Table:
    """``smallest_draws`` of each value of column ``group`` (with its number of rows in
    ``counts``), in the order of group, draw and ties; ``n`` for all groups or for each.
    Rows of a group come below a bound for its count; a row number within partitions,
    then within groups, keeps equal draws out of a single task."""
    most = n if isinstance(n, dict) else dict.fromkeys(counts, n)

    def kept(bound: dict) -> pa.Table:
        spark = rows.sparkSession
        limits = spark.createDataFrame([(g, b, most[g]) for g, b in bound.items()], f"__group {rows.schema[group].dataType.simpleString()}, __below long, __most int")
        some = rows.join(F.broadcast(limits), F.col(group) == F.col("__group")).filter(F.col(draw) <= F.col("__below")).withColumn("__part", F.spark_partition_id())
        for by in ((group, "__part"), (group,)):
            some = some.withColumn("__row", F.row_number().over(Window.partitionBy(*by).orderBy(draw, *ties))).filter("__row <= __most")
        return some.select(*rows.columns).toArrow()

    if not counts:
        return rows.limit(0).toArrow()
    top = 2 ** 63 - 1
    found = kept({g: top if 2 * most[g] >= c else int(2.0 * most[g] / c * 2.0 ** 64) - 2 ** 63 for g, c in counts.items()})
    got = {x["values"]: x["counts"] for x in found[group].value_counts().to_pylist()}
    short = [g for g, c in counts.items() if got.get(g, 0) < min(c, most[g])]
    if short:
        found = pa.concat_tables([found.filter(pc.invert(pc.is_in(found[group], pa.array(short, found[group].type)))), kept(dict.fromkeys(short, top))])
    return found.sort_by([(c, "ascending") for c in (group, draw, *ties)])


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: the text is empty)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def count_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
