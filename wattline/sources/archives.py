"""Zip archives expanded into their members."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

MEMBER_SCHEMA = "archive string, member string, content binary, error string"


def read_archives(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return expand_archives(raw.select("path", "content"))


def expand_archives(archives: DataFrame) -> DataFrame:
    """One row per member, flattened to base names; folders are skipped.

    An archive that is empty or unreadable gives one row with an ``error``; a damaged or
    encrypted member gives such a row with its name, and the other members are read.
    Input columns are ``path`` and ``content``; archives spread over tasks.
    """

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                found = 0
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for info in z.infolist():
                            base = info.filename.rsplit("/", 1)[-1]
                            if info.is_dir() or not base:
                                continue
                            found += 1
                            data, error = read_member(z, info)
                            yield pd.DataFrame([(path, base, data, error)], columns=names)
                    if not found:
                        yield pd.DataFrame([(path, None, None, "empty archive")], columns=names)
                except zipfile.BadZipFile as error:
                    yield pd.DataFrame([(path, None, None, str(error))], columns=names)

    def read_member(z: zipfile.ZipFile, info: zipfile.ZipInfo) -> tuple[bytes | None, str | None]:
        try:
            return z.read(info), None
        except (zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, NotImplementedError) as error:
            return None, f"{type(error).__name__}: {error}"

    names = ["archive", "member", "content", "error"]
    return archives.select("path", "content").mapInPandas(expand, MEMBER_SCHEMA)
