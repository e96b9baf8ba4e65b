"""Bronze, silver and gold zones below one root URI.

A dataset name is checked on the driver before a URI is built, so no name can
leave its layer.  JSON documents keep nulls and non-ASCII text; whole documents
are written as one file each, tabular datasets as Parquet folders.
"""

from __future__ import annotations

import abc
import enum
import json
import re
import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME = re.compile(r"[A-Za-z0-9_=.\-]+")


class Layer(str, enum.Enum):
    BRONZE = "bronze"
    SILVER = "silver"
    GOLD = "gold"


def dataset_name(name: str) -> str:
    """The normal form of ``name``; ValueError if it is empty, absolute or leaves its layer."""
    text = str(name)
    if not text or text.startswith("/"):
        raise ValueError(f"not a relative dataset name: {text!r}")
    kept: list[str] = []
    for part in text.split("/"):
        if part in ("", "."):
            continue
        if part == "..":
            if not kept:
                raise ValueError(f"{text!r} leaves its layer")
            kept.pop()
        elif not _NAME.fullmatch(part):
            raise ValueError(f"{part!r} has characters outside [A-Za-z0-9_=.-]")
        else:
            kept.append(part)
    if not kept:
        raise ValueError(f"{text!r} names the layer itself")
    return "/".join(kept)


class DocumentStore(abc.ABC):
    """What any store of JSON documents offers."""

    @abc.abstractmethod
    def put_json(self, layer: Layer, name: str, value: Any) -> str: ...

    @abc.abstractmethod
    def get_json(self, layer: Layer, name: str) -> Any: ...


@dataclass
class LakeStore(DocumentStore):
    """Layers on any file system that Spark reaches (``file:``, ``s3a:``, ``hdfs:``)."""

    spark: SparkSession
    root: str

    def uri(self, layer: Layer, name: str | None = None) -> str:
        base = f"{self.root.rstrip('/')}/{Layer(layer).value}"
        return base if name is None else f"{base}/{dataset_name(name)}"

    def _fs(self, uri: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(uri)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def create_layers(self) -> None:
        for layer in Layer:
            fs, path = self._fs(self.uri(layer))
            fs.mkdirs(path)

    def put_json(self, layer: Layer, name: str, value: Any) -> str:
        """Serialise, write beside the file, then put it in the file's place: a failure at any point leaves the old one whole."""
        payload = json.dumps(value, ensure_ascii=False, indent=2).encode("utf-8")
        uri, hadoop = self.uri(layer, name), self.spark._jvm.org.apache.hadoop.fs
        fs, path = self._fs(uri)
        fs.mkdirs(path.getParent())
        beside = hadoop.Path(path.getParent(), f".{uuid.uuid4().hex}")
        stream = fs.create(beside, True)
        try:
            stream.write(payload)
        finally:
            stream.close()
        replace = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        replace[0] = hadoop.Options.Rename.OVERWRITE
        hadoop.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration()).rename(beside, path, replace)
        return uri

    def get_json(self, layer: Layer, name: str) -> Any:
        uri = self.uri(layer, name)
        fs, path = self._fs(uri)
        if not fs.exists(path):
            raise FileNotFoundError(uri)
        stream = fs.open(path)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8"))
        finally:
            stream.close()

    def write_rows(self, layer: Layer, name: str, frame: DataFrame, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> str:
        uri = self.uri(layer, name)
        frame.write.mode(mode).partitionBy(*partition_by).parquet(uri)
        return uri

    def read_rows(self, layer: Layer, name: str) -> DataFrame:
        return self.spark.read.parquet(self.uri(layer, name))

    def write_json_rows(self, layer: Layer, name: str, frame: DataFrame) -> str:
        uri = self.uri(layer, name)
        frame.write.mode("overwrite").option("ignoreNullFields", "false").json(uri)
        return uri

    def read_json_rows(self, layer: Layer, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).json(self.uri(layer, name))


def payload_field(payload: str, path: str, kind: str):
    """A typed field of a raw JSON payload column; null when absent or not of that type."""
    return F.expr(f"try_cast(get_json_object({payload}, '{path}') AS {kind})")
