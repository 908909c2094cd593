"""EML tree → Parquet message table + rejects file + counts.

    ingest_emails(spark, "/data/mail", "/out/messages", overwrite=True,
                  codec="GZIP", rejects_path="/out/ingestion_errors.txt")

1. Refuse early when the output exists and ``overwrite`` is false
   (an exception; the process is never exited).
2. List and read every file under the input, whatever its name (see
   :mod:`tessera.sources.files`) — or take a ``(path, content)`` DataFrame.
3. Parse once with :func:`tessera.operators.email.parse_emails` and stage
   the parsed rows (messages and errors) as Parquet under the shared
   checkpoint folder: the lineage is cut there, so a lost executor never
   forces a re-parse of the whole tree, and both outputs read the stage.
4. Write the message table with the requested codec and 25 MiB row groups.
   Processed / failed / attachment counts, and the time spent on processed and
   on failed files, are observed while the stage is written (no extra pass).
5. If any file failed, write the distinct reject messages as text at a
   timestamped path; remove the stage and return the counts.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import email as E
from tessera.operators.metrics import observe, timed_counts
from tessera.session import remove_path, scratch_path
from tessera.sinks import writers as W
from tessera.sources.files import read_binary_files


def rejects_file_name(base: str, now: _dt.datetime | None = None) -> str:
    """``name.ext`` → ``name<yyyyMMdd-HHmm>.ext``; no extension → suffix.

    A 24-hour clock is used and the whole base name is kept.
    """
    stamp = (now or _dt.datetime.now()).strftime("%Y%m%d-%H%M")
    slash = base.rfind("/")
    dot = base.rfind(".")
    if dot > slash + 1:
        return base[:dot] + stamp + base[dot:]
    return base + stamp


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def ingest_emails(spark: SparkSession, source: str | DataFrame, output_path: str,
                  overwrite: bool = True, codec: str = "UNCOMPRESSED",
                  rejects_path: str = "ingestion_errors", parallelism: int | None = None,
                  now: _dt.datetime | None = None) -> dict:
    """Run the ingestion; returns counts and the paths written."""
    if not overwrite and path_exists(spark, output_path):
        raise FileExistsError(f"output already exists and overwrite is disabled: {output_path}")
    files = read_binary_files(spark, source) if isinstance(source, str) else source
    if parallelism:
        files = files.repartition(parallelism)
    stage = scratch_path(spark, "email-stage")
    parsed_live, counters = observe(
        E.parse_emails(files), "email_ingest",
        **timed_counts("processed", F.col("error").isNull(), "elapsedMicros"),
        **timed_counts("failed", F.col("error").isNotNull(), "elapsedMicros"),
        attachments=F.coalesce(F.sum(F.size(F.col("attachments"))), F.lit(0)).cast("bigint"),
        skipped_attachments=F.coalesce(F.sum("skippedAttachments"), F.lit(0)).cast("bigint"))
    parsed_live.write.mode("errorifexists").parquet(stage)
    stats = counters.get
    parsed = spark.read.parquet(stage)

    W.write_parquet(E.messages(parsed).drop("path"), output_path, codec=codec,
                    mode="overwrite" if overwrite else "errorifexists")
    written = None
    if stats["failed"]:
        written = rejects_file_name(rejects_path, now)
        E.rejects(parsed).write.mode("overwrite").text(written)
    remove_path(spark, stage)
    return {**stats, "output_path": output_path, "rejects_path": written}
