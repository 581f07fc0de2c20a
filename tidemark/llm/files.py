"""Files that tasks write and read by themselves, below the shared folder, through Arrow's file systems."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from tidemark.session import shared_folder


def folder(spark: SparkSession, purpose: str) -> str:
    """The full address, with scheme, of a fresh shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark, purpose))
    address = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
    return address.replace("file:/", "file:///", 1) if address.startswith("file:/") and not address.startswith("file://") else address


def opened(address: str):
    """A random-access input file."""
    system, path = fs.FileSystem.from_uri(address)
    return system.open_input_file(path)


def created(base: str, suffix: str) -> tuple[str, object]:
    """Address and output stream of a new file; a repeated task makes another, and only the one it reports counts."""
    system, root = fs.FileSystem.from_uri(base)
    system.create_dir(root, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    return f"{base}/{name}", system.open_output_stream(f"{root}/{name}", compression=None)
