"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
"""Tables of at most this many (narrow) rows may be broadcast; larger ones are shuffled."""

HOT_ROWS = 1_000_000
"""A join key with more rows than this is spread over several tasks."""


def build_session(app: str = "copse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC timestamps."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written tables: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without the setting; it then gets a temporary
    folder. On a cluster a machine-local folder would be lost with its machine,
    so a missing setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="copse-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet, under the shared scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/copse/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a plan with no history.

    Unlike a cached block the written table outlives any executor, and being
    Parquet it still allows column pruning.
    """
    return cut_to(df, new_folder(df.sparkSession, name))


def cut_to(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a table this package has written to the scratch folder."""
    if not path.startswith(f"{scratch_root(spark).rstrip('/')}/copse/"):
        raise ValueError(f"{path} is not a scratch table")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the known row count allows it, else leave the join to Spark."""
    return df.hint("broadcast") if rows <= limit else df


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread_by: str,
    counted: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    how: str = "inner",
) -> DataFrame:
    """Inner or left join of many rows to a table with unique keys, with hot keys salted.

    Keys with more than ``hot_rows`` rows on the left are found by a map-side
    merged count (over ``counted``, where that holds the same keys at less
    cost). Their left rows are dealt out over several tasks by a hash of
    ``spread_by``, and their right row is copied to each of these. There are at
    most ``rows / hot_rows`` such keys; all others are joined as usual.
    """
    counts = (left if counted is None else counted).groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = cut(counts.filter(F.col("_n") > hot_rows).withColumn("_parts", F.ceil(F.col("_n") / hot_rows)), "hot")
    many = hot.count()
    if not many:
        return left.join(right, keys, how)
    hot = broadcast_if_small(hot.drop("_n"), many)
    # A NULL key finds no partner; such rows only need to be spread out.
    parts = F.coalesce(F.col("_parts"), F.when(F.greatest(*[F.col(k).isNull().cast("int") for k in (keys * 2)]) == 1, 1024))
    salt = F.coalesce(F.pmod(F.xxhash64(spread_by), parts), F.lit(0).cast("long"))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    dealt = left.join(hot, keys, "left").withColumn("_salt", salt).drop("_parts")
    copied = right.join(hot, keys, "left").withColumn("_salt", copies).drop("_parts")
    return dealt.join(copied, [*keys, "_salt"], how).drop("_salt")
