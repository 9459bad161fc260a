"""The folder shared by all machines of the cluster, for tables that must outlive a job."""

import tempfile
import uuid
from collections.abc import Collection

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where nothing is set, a local session gets a temporary folder of its own. On a cluster
    that would be a folder only one machine sees, so it is an error there.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="feedloom-"))
    return context.getCheckpointDir().rstrip("/")


_given: list[str] = []
_DONE = "_DONE"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing has used before."""
    _given.append(f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}")
    return _given[-1]


def clear_folders(spark: SparkSession, since: int = 0, keep: Collection[str] = ()) -> int:
    """Removes what ``new_folder`` has given out, and tells how many folders there were.

    For when no result that was made from them is still to be read. ``since`` is a number that
    ``given_folders`` told: only what was given out later is removed, but for what is in ``keep``.
    """
    removed = 0
    for path in _given[since:]:
        if path not in keep:
            removed += remove_folder(spark, path)
            _given.remove(path)
    return removed


def given_folders() -> int:
    """How many folders have been given out and not been removed."""
    return len(_given)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything has been written there."""
    place, files = _files(spark, path)
    return files.exists(place)


def folders_in(spark: SparkSession, path: str, done: bool = False) -> list[str]:
    """Names of the folders in a folder, none if it does not exist; with ``done`` the marked ones."""
    place, files = _files(spark, path)
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()]
    return [n for n in names if not done or folder_exists(spark, f"{path}/{n}/{_DONE}")]


def mark_done(spark: SparkSession, path: str) -> None:
    """Marks a folder as completely written."""
    place, files = _files(spark, f"{path}/{_DONE}")
    files.create(place, True).close()


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Removes a folder with all that is in it; tells whether there was one."""
    place, files = _files(spark, path)
    return files.delete(place, True)


def bytes_in(spark: SparkSession, path: str) -> int:
    """The size of all that is in a folder."""
    place, files = _files(spark, path)
    return files.getContentSummary(place).getLength()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file, in place of the one there is."""
    place, files = _files(spark, path)
    stream = files.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as a text, None where there is none."""
    place, files = _files(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _files(spark: SparkSession, path: str):
    """The path and its file system, as Spark itself reaches it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())
