"""Small files in the shared folder, read and written by the driver: records, logs, joined extracts.

Paths go through Hadoop's file systems, so any store that Spark reaches will do.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_folder: bool
    modified: float  # seconds since 1970


class SharedFiles:
    """File operations of one session."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway

    def _at(self, path: str):  # noqa: ANN202
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self._conf), at

    def entries(self, path: str) -> list[Entry]:
        """What a folder holds, by name; nothing if it does not exist."""
        system, at = self._at(path)
        if not system.exists(at):
            return []
        found = [
            Entry(f"{path}/{s.getPath().getName()}", s.getPath().getName(), s.isDirectory(), s.getModificationTime() / 1000)
            for s in system.listStatus(at)
        ]
        return sorted(found, key=lambda e: e.name)

    def delete(self, path: str) -> None:
        system, at = self._at(path)
        system.delete(at, True)

    def move(self, path: str, target: str) -> None:
        """Rename a file; the target's folder is made if need be, and the target must not exist."""
        system, at = self._at(path)
        _, final = self._at(target)
        system.mkdirs(final.getParent())
        if not system.rename(at, final):
            raise OSError(f"could not move {path} to {target}")

    def read(self, path: str) -> str:
        system, at = self._at(path)
        stream = system.open(at)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        system, at = self._at(path)
        stream = system.create(at, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a file that does not exist yet; False if it does.  It appears whole and to one writer only.

        The text is written beside it and moved without overwriting: by a hard
        link on a local disk, elsewhere by the file system's own rename, which
        is atomic on HDFS.
        """
        folder, name = path.rsplit("/", 1)
        beside = f"{folder}/.{name}-{uuid.uuid4().hex}"
        self.write(beside, text)
        system, source = self._at(beside)
        try:
            if system.getScheme() == "file":
                local = [unquote(urlparse(p).path) for p in (beside, path)]
                try:
                    os.link(*local)
                except FileExistsError:
                    return False
                return True
            _, target = self._at(path)
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), self._conf)
            no_options = self._gateway.new_array(getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
            try:
                context.rename(source, target, no_options)
            except Exception as error:  # the rename of some systems fails with an error of their own
                if system.exists(target):
                    return False
                raise error
            return True
        finally:
            if system.exists(source):
                system.delete(source, False)

    def parquet_schema(self, path: str) -> StructType:
        """The schema a Parquet file was written with, nullability included, as its footer holds it."""
        hadoop = self._jvm.org.apache.parquet.hadoop
        _, at = self._at(path)
        reader = hadoop.ParquetFileReader.open(hadoop.util.HadoopInputFile.fromPath(at, self._conf))
        try:
            notes = reader.getFooter().getFileMetaData().getKeyValueMetaData()
            return StructType.fromJson(json.loads(notes.get("org.apache.spark.sql.parquet.row.metadata")))
        finally:
            reader.close()

    def join(self, parts: Iterable[str], target: str, head: bytes = b"") -> None:
        """``head`` and the parts one after the other as one file.  Streamed, a buffer at a time.

        Written beside the target and moved, so no reader sees half of it.
        """
        folder, name = target.rsplit("/", 1)
        beside = f"{folder}/.{name}-{uuid.uuid4().hex}"
        system, at = self._at(beside)
        out = system.create(at, True)
        try:
            out.write(bytearray(head))
            for part in parts:
                own_system, own = self._at(part)
                stream = own_system.open(own)
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
                finally:
                    stream.close()
        finally:
            out.close()
        self.delete(target)
        self.move(beside, target)
