"""Session settings shared by jobs and tests."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app="meterspan", cores="*", **conf):
    """A session for one machine. On a cluster the submitter sets these."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        # The JVM does not compile methods above 8000 bytes; smaller pieces run faster.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark):
    """Use the shared folder of the session; make a local one only in local mode."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared)
    elif context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="meterspan-checkpoint-"))


def scratch_folder(spark, name):
    """A fresh folder that every executor can reach, below the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def written(df, name):
    """The rows written once and read back: the lineage ends here, and the reader
    knows the size, which a join needs to choose its strategy."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
