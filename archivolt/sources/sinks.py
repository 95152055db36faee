"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, headers: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """CSV with minimal quoting; ``headers`` may repeat names (K1, K3)."""
    out = df if headers is None else df.select(*[F.col(f"`{c}`").alias(h) for c, h in zip(df.columns, headers)])
    # Spark's writer takes white space off the ends of cells unless told not to
    kept = out.write.mode(mode).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    kept.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_report(df: DataFrame, path: str, category: str = "category", run: str | None = None) -> None:
    """One folder of CSV per category, under the run's name (K2)."""
    df.write.mode("overwrite").option("header", True).partitionBy(category).csv(f"{path}/{run}" if run else path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """One text line per row (K4); every line ends in a line break."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_snapshot(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """A snapshot that later runs compare with (K6)."""
    df.write.mode("overwrite").format(kind).save(path)


def append_processed(df: DataFrame, key: str, path: str) -> None:
    """Appends keys to a tracking table (K7)."""
    df.select(key).write.mode("append").parquet(path)


def write_archive(records: DataFrame, path: str) -> None:
    """Web-archive files, one per partition: columns rec_type, target_uri, warc_date, http_status, payload (string) (K8).

    ``path`` must be below a folder that all executors share. Each file is written under another name and renamed when
    it is complete, so a task that is tried again leaves no half file and no second copy.
    """
    folder = path.removeprefix("file://")

    def run(batches):
        import gzip
        import os

        import pandas as pd
        from pyspark import TaskContext

        task = TaskContext.get()
        os.makedirs(folder, exist_ok=True)
        name, n = f"{folder}/part-{task.partitionId():05d}.warc.gz", 0
        with gzip.open(f"{name}.{task.taskAttemptId()}", "wb") as out:
            out.write(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
            for b in batches:
                for kind, uri, date, status, payload in b.itertuples(index=False):
                    body = (payload or "").encode()
                    if status is not None:
                        body = f"HTTP/1.1 {status} -\r\nContent-Type: text/plain\r\n\r\n".encode() + body
                    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nWARC-Date: {date}\r\nContent-Length: {len(body)}\r\n\r\n"
                    out.write(head.encode() + body + b"\r\n\r\n")
                    n += 1
        os.replace(f"{name}.{task.taskAttemptId()}", name)
        yield pd.DataFrame({"n": [n]})

    records.select("rec_type", "target_uri", "warc_date", "http_status", "payload").mapInPandas(run, "n long").agg(F.sum("n")).collect()
