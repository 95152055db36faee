"""Web-archive record source: .warc, .warc.gz and records inside .wacz or .zip files, nested ones included.

A file is a partition and is read as a stream, record by record; nothing is unpacked to disk. A file that breaks off
keeps the records before the break and has a last row of the type ``unreadable``, with the reason as its payload.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import zipfile
import zlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = (
    "file string, file_ord int, pos bigint, rec_type string, target_uri string, warc_date string, content_type string, "
    "http_status string, location string, http_content_type string, payload binary"
)
ENDINGS = (".warc", ".warc.gz", ".wacz", ".zip")
#: Type of the row that stands for what couldn't be read.
UNREADABLE = "unreadable"


def archive_files(path: str) -> list[str]:
    """Archive files at or below a path, sorted, each once."""
    if os.path.isfile(path):
        return [path]
    return sorted({os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.lower().endswith(ENDINGS)})


def _headers(stream) -> tuple[str, dict[str, str]] | None:
    """First line and header fields of a block; None at the end."""
    first = stream.readline()
    while first in (b"\r\n", b"\n"):
        first = stream.readline()
    if not first:
        return None
    fields: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields.setdefault(name.strip().lower(), value.strip())
    return first.decode("utf-8", "replace").strip(), fields


def records(stream) -> Iterator[dict]:
    """Records of an uncompressed stream."""
    while True:
        head = _headers(stream)
        if head is None or not head[0].startswith("WARC/"):
            return
        fields = head[1]
        length = int(fields.get("content-length", "0") or 0)
        body = stream.read(length)
        record = {
            "rec_type": fields.get("warc-type"),
            "target_uri": fields.get("warc-target-uri", "").strip("<>") or None,
            "warc_date": fields.get("warc-date"),
            "content_type": fields.get("content-type"),
            "http_status": None,
            "location": None,
            "http_content_type": None,
            "payload": body,
        }
        if body.startswith(b"HTTP/"):
            inner = io.BytesIO(body)
            http = _headers(inner)
            status = http[0].split(" ")
            record |= {
                "http_status": status[1] if len(status) > 1 else None,
                "location": http[1].get("location"),
                "http_content_type": http[1].get("content-type"),
                "payload": inner.read(),
            }
        yield record
        if len(body) < length:
            raise EOFError(f"record of {length} bytes ends after {len(body)}")


def _open(name: str, raw, within: tuple[bytes, ...] = ()) -> Iterator[tuple[str, object]]:
    """(name, uncompressed stream) of the record files in a stream, at any depth.

    ``within`` are the digests of the nested archives around; one that holds itself isn't opened again.
    """
    low = name.lower()
    if low.endswith((".wacz", ".zip")):
        with zipfile.ZipFile(raw) as z:
            for member in sorted(z.namelist()):
                if member.lower().endswith(ENDINGS):
                    with z.open(member) as inner:
                        # a nested archive needs to be seekable
                        if member.lower().endswith((".wacz", ".zip")):
                            body = inner.read()
                            digest = hashlib.sha256(body).digest()
                            if digest not in within:
                                yield from _open(f"{name}!{member}", io.BytesIO(body), (*within, digest))
                        else:
                            yield from _open(f"{name}!{member}", inner, within)
    elif low.endswith(".gz"):
        yield name, io.BufferedReader(gzip.GzipFile(fileobj=raw))
    elif low.endswith(".warc"):
        yield name, raw


class _File(InputPartition):
    def __init__(self, path: str, ord_: int):
        super().__init__(ord_)
        self.path, self.ord = path, ord_


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        return [_File(p, i) for i, p in enumerate(archive_files(self.options["path"]))]

    def read(self, partition):
        kinds = {k.strip() for k in self.options.get("types", "").split(",") if k.strip()}
        prefix, with_payload = self.options.get("uriprefix", ""), self.options.get("payload", "true") == "true"
        base = os.path.basename(partition.path)

        def broken(name: str, why: Exception):
            return (name, partition.ord, None, UNREADABLE, None, None, None, None, None, None, repr(why).encode())

        with open(partition.path, "rb") as raw:
            try:
                for name, stream in _open(base, raw):
                    try:
                        for pos, r in enumerate(records(stream)):
                            if (kinds and r["rec_type"] not in kinds) or (prefix and not (r["target_uri"] or "").startswith(prefix)):
                                continue
                            yield (
                                name, partition.ord, pos, r["rec_type"], r["target_uri"], r["warc_date"], r["content_type"],
                                r["http_status"], r["location"], r["http_content_type"], r["payload"] if with_payload else None,
                            )
                    except (EOFError, OSError, ValueError, zlib.error) as why:
                        if not kinds or UNREADABLE in kinds:
                            yield broken(name, why)
            except (EOFError, OSError, ValueError, zipfile.BadZipFile, zlib.error) as why:
                if not kinds or UNREADABLE in kinds:
                    yield broken(base, why)


class WebArchive(DataSource):
    """``spark.read.format("warc").option("types", "response").load(path)``; options types, uriPrefix, payload."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader({k.lower(): v for k, v in self.options.items()})


def read_records(spark, path: str, **options: str):
    """Records of all archives at a path."""
    spark.dataSource.register(WebArchive)
    reader = spark.read.format("warc")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def wacz_pages(spark, path: str, member: str = "pages/pages.jsonl"):
    """Entries of the page lists inside archives: file, url, status."""
    import json

    import pandas as pd

    def run(batches):
        for b in batches:
            rows = []
            for file, content in zip(b.path, b.content):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for line in z.read(member).decode("utf-8", "replace").splitlines() if member in z.namelist() else []:
                        try:
                            entry = json.loads(line)
                        except ValueError:
                            continue
                        if isinstance(entry, dict) and entry.get("url"):
                            rows.append((os.path.basename(file), entry["url"], entry.get("status")))
            yield pd.DataFrame(rows, columns=["file", "url", "status"]).astype({"status": "Int32"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{wacz,zip}").load(path)
    return files.select("path", "content").mapInPandas(run, "file string, url string, status int")
