"""A ledger of landed files, kept by the log of Spark's file stream.

Listing a landing folder and comparing paths with a table opens every file again, or brings
all paths to one place. The file stream remembers in its checkpoint which files it has given
out. Each call takes the files that came since, in batches of bounded size, and stages their
rows as Parquet; rows stay pending until the caller confirms that they are loaded.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "__batch"
FILE_PATH = "file_path"
STATE = "batch long, confirmed boolean"


class LandingLedger:
    """New files of ``path``, each given out once, remembered below ``folder``.

    ``max_files`` bounds the files of one batch and with it what a failure repeats;
    ``latest_first`` takes the newest files first. A batch that is repeated after a failure
    holds the same files and replaces what it had staged.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        folder: str,
        schema: T.StructType | str,
        max_files: int | None = None,
        latest_first: bool = False,
        file_format: str = "json",
    ):
        self.spark, self.path, self.folder, self.format = spark, path, folder.rstrip("/"), file_format
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self.max_files, self.latest_first = max_files, latest_first

    def discover(self) -> int:
        """Stage the rows of all files that came since the last call; returns the number of
        batches it took."""
        reader = self.spark.readStream.schema(self.schema).format(self.format).option("latestFirst", self.latest_first)
        if self.max_files:
            reader = reader.option("maxFilesPerTrigger", self.max_files)
        stream = reader.load(self.path).select("*", F.col("_metadata.file_path").alias(FILE_PATH))
        taken: list[int] = []

        def stage(rows: DataFrame, batch: int) -> None:
            rows.write.mode("overwrite").parquet(f"{self.folder}/rows/{BATCH}={batch}")
            self._note(batch, False)
            taken.append(batch)

        writer = stream.writeStream.foreachBatch(stage).option("checkpointLocation", f"{self.folder}/progress")
        writer.trigger(availableNow=True).start().awaitTermination()
        return len(taken)

    def pending(self) -> DataFrame:
        """Rows of all files not confirmed yet, with their ``file_path`` and ``__batch``."""
        staged, confirmed = self._state()
        schema = T.StructType([*self.schema.fields, T.StructField(FILE_PATH, T.StringType()), T.StructField(BATCH, T.LongType())])
        if staged is None or staged == confirmed:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.folder}/rows")
        return rows.where((F.col(BATCH) > (-1 if confirmed is None else confirmed)) & (F.col(BATCH) <= staged))

    def confirm(self, batch: int | None = None) -> None:
        """Rows up to ``batch``, or all that are staged, are loaded."""
        staged, _ = self._state()
        upto = staged if batch is None else batch
        if upto is not None:
            self._note(upto, True)

    def _note(self, batch: int, confirmed: bool) -> None:
        self.spark.createDataFrame([(batch, confirmed)], STATE).coalesce(1).write.mode("append").parquet(f"{self.folder}/state")

    def _state(self) -> tuple[int | None, int | None]:
        """The last batch staged and the last one confirmed."""
        try:
            state = self.spark.read.schema(STATE).parquet(f"{self.folder}/state")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None, None
        found = state.agg(F.max("batch").alias("staged"), F.max(F.when(F.col("confirmed"), F.col("batch"))).alias("confirmed"))
        return tuple(found.first())
