"""Results that several later steps read: stored once, in the folder all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def use_checkpoint_folder(spark: SparkSession) -> None:
    """Point checkpoints at ``spark.checkpoint.dir``; local sessions may leave it unset."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    context.setCheckpointDir(folder)


def stored(frame: DataFrame) -> DataFrame:
    """The same rows, computed now and read from the shared folder from then on.

    Shuffle files of the steps before are of no more use, but Spark removes them only when the driver
    happens to collect its garbage. Asking for that here keeps a long job to the disk of its largest step.
    """
    use_checkpoint_folder(frame.sparkSession)
    result = frame.checkpoint(eager=True)
    del frame
    gc.collect()
    result.sparkSession.sparkContext._jvm.System.gc()
    return result


class Steps:
    """Intermediate tables of a loop, as Parquet in the shared folder.

    A plain scan knows nothing of the plans before it, so a round costs the same planning as the first.
    """

    def __init__(self, spark: SparkSession):
        use_checkpoint_folder(spark)
        self.spark = spark
        self.folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/steps-{uuid.uuid4().hex}"
        self.made = 0

    def keep(self, frame: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.made}"
        self.made += 1
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def clear(self) -> None:
        """Remove the tables; nothing read from them may be used afterwards."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
