"""Small helpers shared by the training-data operators of this subpackage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Broadcast a lookup only when its measured number of rows and of bytes is at most this.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32_000_000

_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Only a local session may do without the setting; a cluster must name one.
    """
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        place = tempfile.mkdtemp(prefix="potsherd-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system."""
    jvm = spark.sparkContext._jvm
    if jvm is None:
        return
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            delete(spark, path)
        except Exception:  # the session may be gone by now
            return


class Scratch:
    """Tables written to the shared folder, which cut the lineage and survive lost executors.

    ``keep`` writes a DataFrame as Parquet and returns it reread. ``drop`` removes a table that no later step reads.
    What remains goes when Python ends, for results are lazy and may still read it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/potsherd-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        self.n = 0
        _written.append((spark, self.root))

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.n}"
        self.n += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            if path := self.paths.pop(id(t), None):
                delete(self.spark, path)


def weight(df: DataFrame) -> Column:
    """Bytes of a row's values, nearly."""

    def of(name: str, kind: str) -> Column:
        if kind in ("string", "binary"):
            return F.octet_length(col(name))
        if kind.startswith("array") and "string" not in kind:
            return 8 * F.size(col(name))
        return F.octet_length(F.to_json(F.struct(col(name)))) if kind.startswith(("array", "map", "struct")) else F.lit(8)

    total = F.lit(0).cast("long")
    for name, kind in df.dtypes:
        total = total + F.coalesce(of(name, kind), F.lit(0))
    return total


def small(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a written table has at most ``limit`` rows of at most ``size`` bytes together; reads no more than that many rows."""
    told = df.limit(limit + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(weight(df)).alias("size")).first()
    return told.n <= limit and (told.size or 0) <= size


def joinable(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its measured rows and bytes allow it, else as it is."""
    return F.broadcast(df) if small(df, limit) else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names near ``names`` that ``df`` doesn't have yet (Spark compares without case)."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its literal name, which may hold dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_text(name: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))
