"""A table with one row per key, kept up to date by micro-batches and safe to restart.

``root/of=B/bucket=K`` holds the rows whose key hashes to K; B, the number of buckets, is
fixed when the table is made. A batch is joined to the buckets it touches and to no
other. Their new contents are written whole to a folder of the batch, then each bucket's
folder takes the old one's place, then the batch is marked as done:

* stopped before the folder of the batch is whole: nothing has changed, the batch runs again;
* stopped while folders are moved: what is left in the batch's folder is moved when the
  batch comes again, without another look at the table;
* run again after its mark: nothing happens.

No state lives in the object, so a new one, in a new process, goes on. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeflow.operators.changelog import upsert
from gradeflow.sources import folders
from gradeflow.sources.tables import empty_frame, write_parquet

BUCKET = "bucket"
#: Marks kept per stream; a query repeats its last batch only.
MARKS = 100


@dataclass(frozen=True)
class KeyedTable:
    """``order`` decides which row of a key stays; end it with a unique column."""

    root: str
    schema: T.StructType
    keys: Sequence[str]
    order: Sequence[str]
    buckets: int = 64

    @property
    def data(self) -> str:
        return f"{self.root}/of={self.buckets}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The current row of every key, with its bucket; a filter on the bucket skips folders."""
        others = [p for p in folders.matching(spark, f"{self.root}/of=*") if not p.endswith(f"/of={self.buckets}")]
        if others:
            raise ValueError(f"the table was made with another number of buckets: {others[0]}")
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        if not folders.matching(spark, f"{self.data}/{BUCKET}=*"):
            return empty_frame(spark, schema)
        return spark.read.schema(schema).parquet(self.data)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.rows(spark).drop(BUCKET)

    def merge(self, batch: DataFrame, stream: str, number: int, passes: int = 1) -> bool:
        """Bring a batch in; False if it was in already. The batch is read once and once more a pass.

        In several ``passes`` the disk holds the shuffles of some buckets at a time.
        """
        spark = batch.sparkSession
        mark = f"{self.root}/_marks/stream={stream}/{number}"
        if folders.exists(spark, mark):
            return False
        staged = f"{self.root}/_staged/stream={stream}/batch_id={number}"
        if not folders.exists(spark, staged):
            self._stage(batch.select(*self.schema.fieldNames()), staged, passes)
        for new in folders.matching(spark, f"{staged}/{BUCKET}=*"):
            folders.replace(spark, new, f"{self.data}/{new.rsplit('/', 1)[1]}")
        folders.touch(spark, mark)
        folders.delete(spark, staged)
        folders.delete(spark, f"{self.root}/_marks/stream={stream}/{number - MARKS}")
        return True

    def _stage(self, batch: DataFrame, staged: str, passes: int) -> None:
        """Write the new contents of the buckets that the batch touches."""
        spark = batch.sparkSession
        touched = [r[0] for r in batch.select(self.bucket()).distinct().collect()]  # numbers below ``buckets``
        whole, updates = folders.waiting(self.root), batch.select("*", self.bucket())
        for some in [touched[n::passes] for n in range(passes) if touched[n::passes]] or [touched]:
            before = self.rows(spark).where(F.col(BUCKET).isin(some))
            new = updates if len(some) == len(touched) else updates.where(F.col(BUCKET).isin(some))
            write_parquet(upsert(before, new, self.keys, self.order), whole, partition_by=[BUCKET], mode="append")
        folders.replace(spark, whole, staged)
