"""Which file of a log holds which ordinals, so that a range opens only the files it needs.

The manifest of a log lies in its folder, as a table with a row for each file: the least and the
largest ordinal and the number of rows, and the size and time of the file as it was then. Files
that are not in it, or have changed since, are always opened, so a manifest that is older than
its log costs time but no rows.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import folders_in, mark_done, new_folder, remove_folder

MANIFEST = "_manifest"
_FILE = ("file", "length", "modified")
SCHEMA = "file string, length bigint, modified timestamp, least bigint, most bigint, rows bigint"


def _of_files(frame: DataFrame, *more) -> DataFrame:
    return frame.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
        *more,
    )


def log_files(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``length`` and ``modified`` of the files of a log, none of which is opened."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return _of_files(listing)


def _versions(spark: SparkSession, path: str) -> list[int]:
    names = folders_in(spark, f"{path}/{MANIFEST}", done=True)
    return sorted(int(name) for name in names if name.isdigit())


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The manifest of a log, None where there is none."""
    versions = _versions(spark, path)
    if not versions:
        return None
    return spark.read.schema(SCHEMA).parquet(f"{path}/{MANIFEST}/{versions[-1]}")


def checked(spark: SparkSession, path: str) -> DataFrame | None:
    """The files there are now, with what the manifest knows of them; ``rows`` is null if nothing.

    None where there is no manifest.
    """
    known = manifest(spark, path)
    if known is None:
        return None
    return log_files(spark, path).join(known, list(_FILE), "left")


def write_manifest(
    spark: SparkSession, path: str, ordinal: str = "ordinal", fmt: str = "parquet"
) -> None:
    """Makes the manifest of a log, or brings it up to date; files known to it are not opened.

    The last manifest but one is removed; a reader of the last one is not disturbed.
    """
    versions = _versions(spark, path)
    files = checked(spark, path)
    if files is None:
        unknown, found = log_files(spark, path), None
    else:
        known = files.where("rows is not null")
        unknown, found = files.where("rows is null").select(*_FILE), known
    log = spark.read.format(fmt).schema(f"`{ordinal}` bigint").load(path)
    names = [r["file"] for r in unknown.select("file").collect()] if found is not None else None
    if names is not None:
        log = log.where(F.col("_metadata.file_path").isin(names))
    bounds = _of_files(log, F.col(ordinal).alias("_ordinal")).groupBy(*_FILE).agg(
        F.min("_ordinal").alias("least"),
        F.max("_ordinal").alias("most"),
        F.count(F.lit(1)).alias("rows"),
    )
    fresh = unknown.join(bounds, list(_FILE), "left").fillna(0, "rows")
    whole = fresh if found is None else found.unionByName(fresh)
    following = f"{path}/{MANIFEST}/{versions[-1] + 1 if versions else 0}"
    whole.coalesce(1).write.mode("overwrite").parquet(following)
    mark_done(spark, following)
    for old in versions[:-1]:
        remove_folder(spark, f"{path}/{MANIFEST}/{old}")


def within_files(
    log: DataFrame, path: str, start: int | None = None, end: int | None = None
) -> DataFrame:
    """``log``, as it was loaded from ``path``, without files that have no ordinal in the range.

    The range is that of ``replay_range``, which still has to be applied. Without a manifest it is
    the whole log. The driver gets the names of the files needed; it holds those of all anyway.
    """
    if start is None and end is None:
        return log
    files = checked(log.sparkSession, path)
    if files is None:
        return log
    needed = F.col("rows").isNull()
    overlap = F.col("rows") > 0
    if start is not None:
        overlap &= F.col("most") > start
    if end is not None:
        overlap &= F.col("least") <= end
    judged = files.select("file", (needed | F.coalesce(overlap, F.lit(False))).alias("needed"))
    found = judged.collect()
    names = [r["file"] for r in found if r["needed"]]
    return log if len(names) == len(found) else log.where(F.col("_metadata.file_path").isin(names))


def log_head_of(
    spark: SparkSession, path: str, ordinal: str = "ordinal", fmt: str = "parquet"
) -> DataFrame:
    """One row ``head``: the largest ordinal of the log in ``path``, -1 where there is none.

    Only files that the manifest does not know are opened.
    """
    log = spark.read.format(fmt).schema(f"`{ordinal}` bigint").load(path)
    files = checked(spark, path)
    most = F.max(ordinal).alias("most")
    if files is None:
        found = log.agg(most)
    else:
        found = files.agg(F.max("most").alias("most"))
        names = [r["file"] for r in files.where("rows is null").select("file").collect()]
        if names:
            unknown = log.where(F.col("_metadata.file_path").isin(names))
            found = found.unionByName(unknown.agg(most))
    return found.agg(F.coalesce(F.max("most"), F.lit(-1).cast("bigint")).alias("head"))


def land_log(
    raw: DataFrame, path: str | None = None, files: int = 16, ordinal: str = "ordinal"
) -> str:
    """Writes a log in the order of its ordinals, with its manifest, and returns its path.

    Each file holds a range of ordinals. Rows without one lie in the first.
    """
    spark = raw.sparkSession
    path = path or new_folder(spark, "log")
    ordered = raw.repartitionByRange(files, ordinal).sortWithinPartitions(ordinal)
    ordered.write.parquet(path)
    write_manifest(spark, path, ordinal)
    return path
