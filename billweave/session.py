"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "billweave", cpus: int | str = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench. On a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        # Small test data: partitions of a few megabytes keep all cores at work.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder that the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only a local session, where one machine
    holds driver and executors, may fall back to a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="billweave-")
    return f"{base.rstrip('/')}/billweave/{purpose}-{uuid.uuid4().hex[:12]}"


def read_if_present(
    spark: SparkSession, path: str, schema: str, source: str = "parquet", path_column: str | None = None, **options
) -> DataFrame:
    """Read ``path`` under ``schema``; an absent path is an empty table, any other error is raised.

    ``path_column`` adds each row's file path, without percent escapes.
    """
    try:
        read = spark.read.format(source).schema(schema).options(**options).load(path)
        # A plus sign is itself in a path, but a space to url_decode.
        file_path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        read = spark.createDataFrame([], schema)
        file_path = F.lit(None).cast("string")
    return read.withColumn(path_column, file_path) if path_column else read
