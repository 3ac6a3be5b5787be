"""Tables written between steps, in a folder that the driver and every executor share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import new_folder

#: Ids are broadcast up to this many (8 bytes each, and as much again for the hash table); beyond it both sides are shuffled.
BROADCAST_IDS = 1_000_000


#: Rows and bytes of a batch that goes to a Python worker. Texts are long: batches by rows alone would not be bounded.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of this session's Python workers, unless they are set lower."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        try:
            now = spark.conf.get(key)
        except Exception:  # a version without it
            continue
        digits = "".join(c for c in now if c.isdigit())
        if not digits or now[-1:] == "b" and int(digits) > most or now.isdigit() and not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, upper and lower case taken as one."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Scratch:
    """Written tables of one operator call. They cut the lineage, so that a lost executor costs one step at most."""

    def __init__(self, spark: SparkSession, name: str):
        small_batches(spark)
        self.spark = spark
        self.base = new_folder(spark, name)
        self.made = 0

    def table(self, df: DataFrame) -> DataFrame:
        """df, written as Parquet and read back; `path_of` tells where."""
        self.made += 1
        path = f"{self.base}/{self.made}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table that nothing reads any more."""
        path = getattr(df, "_scratch_path", None)
        if path:
            jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


def _hinted(df: DataFrame, id_cols: list[str], ids: DataFrame, id_names: list[str]) -> tuple[DataFrame, Column]:
    names = [free_name(df, f"id_of_row_{k}") for k in range(len(id_names))]
    ids = ids.select(*(F.col(c).alias(n) for c, n in zip(id_names, names, strict=True)))
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    equal = reduce(lambda a, b: a & b, [F.col(c) == F.col(n) for c, n in zip(id_cols, names, strict=True)])
    return F.broadcast(ids) if few else ids, equal


def without_ids(df: DataFrame, id_cols: list[str], ids: DataFrame, id_names: list[str]) -> DataFrame:
    """Rows of df whose id (of one column or several) is not among ids (a written table); rows with a null id stay."""
    ids, equal = _hinted(df, id_cols, ids, id_names)
    return df.join(ids, equal, "left_anti")


def with_ids(df: DataFrame, id_cols: list[str], ids: DataFrame, id_names: list[str]) -> DataFrame:
    """Rows of df whose id (of one column or several) is among ids (a written table)."""
    ids, equal = _hinted(df, id_cols, ids, id_names)
    return df.join(ids, equal, "left_semi")
