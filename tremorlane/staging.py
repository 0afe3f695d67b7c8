"""Where intermediate tables go: storage that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_made: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Only a local-mode session that names none gets a temporary folder; on a
    cluster a machine-local folder would not survive the loss of its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix="tremorlane-")
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    path = f"{shared_root(spark)}/tremorlane/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever storage Spark can reach."""
    place, files = _located(spark, path)
    return files.exists(place)


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders under `path` that a writer has finished, by name."""
    pattern, files = _located(spark, f"{path}/*/_SUCCESS")
    found = files.globStatus(pattern) or []  # nothing where there is no such folder
    return sorted(mark.getPath().getParent().getName() for mark in found)


def delete_dir(spark: SparkSession, path: str) -> None:
    place, files = _located(spark, path)
    files.delete(place, True)


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Make a folder, for a stream that watches it before anything is there."""
    place, files = _located(spark, path)
    files.mkdirs(place)


def join_files(spark: SparkSession, folder: str, pattern: str, path: str, head: bytes) -> None:
    """`head` and then the files of a folder, by name, as one file; the folder is deleted.

    Bytes go from file to file through a buffer, whatever the size. The file
    gets its name by a move when it is whole, and replaces an older one.
    """
    place, files = _located(spark, path)
    hadoop = spark._jvm.org.apache.hadoop
    opened = hadoop.fs.Path(f"{folder}/.joined")
    out = files.create(opened, True)
    try:
        out.write(head)
        found = files.globStatus(hadoop.fs.Path(f"{folder}/{pattern}"))
        for name in sorted(status.getPath().toString() for status in found):
            part = files.open(hadoop.fs.Path(name))
            try:
                hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
            finally:
                part.close()
    finally:
        out.close()
    files.delete(place, True)
    if not files.rename(opened, place):
        raise OSError(f"could not move the joined file to {path}")
    files.delete(hadoop.fs.Path(folder), True)


def clear_staging(spark: SparkSession) -> int:
    """Delete the folders this process got from `fresh_dir`; gives their number.

    For when the results that read them have been taken.
    """
    count = len(_made)
    while _made:
        place, files = _located(spark, _made.pop())
        files.delete(place, True)
    return count


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())
