"""Session-level helpers: reading tables, cutting lineage, dropping rows that were delivered twice."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``sf_dir`` (a file or a folder of files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Only a local session (tests, bench) may leave it unset; it gets a folder of this machine. A cluster must name one.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="punji-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back; it outlives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a compressed table to the shared checkpoint folder, for many reads of some columns each.

    Row groups are small, as a row may hold a whole shard of something.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


REPEATED_ROWS = 1_000_000  # keys that may be sent to every executor


def once(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key of ``df``, a table as it is read; rows delivered twice are alike, so which one stays doesn't matter.

    Few rows come twice: only those are shuffled, the others, with their texts, stay where they are. The repeated keys
    are counted first, from their columns alone; beyond REPEATED_ROWS of them all rows are shuffled.
    """
    repeated = df.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").select(*(F.col(k).alias(f"__{k}") for k in keys))
    many = repeated.limit(REPEATED_ROWS + 1).count()
    if not many:
        return df
    if many > REPEATED_ROWS:
        return df.dropDuplicates(list(keys))
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(F.col(f"__{k}"))
    sent = F.broadcast(repeated)
    return df.join(sent, same, "left_anti").unionByName(df.join(sent, same, "left_semi").dropDuplicates(list(keys)))


def clean_text(column) -> F.Column:
    """Null as the empty text."""
    return F.coalesce(column, F.lit(""))


def short_list(df: DataFrame, most: int = 10_000) -> DataFrame:
    """``df``, a list written by hand, checked to have at most ``most`` rows, so that it may be sent to every executor."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"a list of more than {most} rows isn't sent to every executor")
    return df


def computed(df: DataFrame, **columns) -> DataFrame:
    """``df`` with ``columns``, each computed once per row, however often later expressions use it.

    A generator of one element stands between: the optimizer doesn't merge projections across it.
    """
    for name, value in columns.items():
        kept = [F.col(c) for c in df.columns if c != name]
        df = df.select(*kept, F.explode(F.array(value)).alias(name))
    return df
