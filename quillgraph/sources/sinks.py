"""What a run leaves behind: single text and JSON files, and tables as Parquet."""

from __future__ import annotations

import json
import subprocess

from pyspark.sql import DataFrame, SparkSession


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """UTF-8, folders made, overwritten; through Hadoop's file systems, so any store will do."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_json(spark: SparkSession, path: str, data: object) -> None:
    """Indented by two, letters as they are."""
    write_text(spark, path, json.dumps(data, ensure_ascii=False, indent=2))


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def render(command: list[str]) -> bool:
    """An external renderer, if one is set up; a failure is reported, never raised."""
    try:
        subprocess.run(command, check=True)
        return True
    except (OSError, subprocess.CalledProcessError):
        return False
