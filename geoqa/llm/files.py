"""Binary files in the cluster's shared storage, from driver and tasks."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from geoqa.session import ensure_checkpoint_dir


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """(file system, path in it) of a folder or file: a local path, or a URI of a scheme that Arrow
    knows (file, hdfs, s3 and its Hadoop names, gs, abfs).  Another scheme is an error."""
    if re.match(r"file:/|/", uri):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the checkpoint folder, which driver and executors share."""
    uri = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    system, path = opened(uri)
    system.create_dir(path)
    return uri
