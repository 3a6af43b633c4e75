"""The folder that all executors can reach, for results jobs hand on."""

import posixpath
import re
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """``folder``, or else the one the session names in ``spark.checkpoint.dir``.

    Executors that are processes of their own share the session's warehouse too,
    so it is taken where neither is given. On a cluster a folder of the driver's
    own machine is refused, unless it is or lies in one of these two: what is
    mounted on every machine looks the same, and Spark's own checkpoints and
    tables rely on those settings too. Nothing is set or made: the session stays
    as the caller configured it.
    """
    context = spark.sparkContext
    named = (
        spark.conf.get(SETTING, None)
        or context.getConf().get(SETTING)
        or context.getCheckpointDir()
    )
    warehouse = spark.conf.get(WAREHOUSE, None)
    if not re.match(r"local(\[|$)", context.master):
        named = named or warehouse
    folder = folder or named
    if not folder:
        raise ValueError(f"give a folder, or name one in {SETTING}")
    shared = _lies_in(folder, named) or _lies_in(folder, warehouse)
    on_cluster = not context.master.startswith("local")
    if on_cluster and not shared and _of_one_machine(spark, folder):
        raise ValueError(f"executors can't share {folder}")
    return folder.rstrip("/")


def _lies_in(folder: str, named: str | None) -> bool:
    if not named:
        return False
    inner, outer = (
        posixpath.normpath(re.sub(r"^(?i:file):/*", "/", place)) + "/"
        for place in (folder, named)
    )
    return inner.startswith(outer)


def _of_one_machine(spark: SparkSession, folder: str) -> bool:
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", folder)
    if scheme is None:
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
        scheme = re.match(r"([^:]*):", default or "file:")
    return scheme.group(1).lower() == "file"


def fresh_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark, folder)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this run has made, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(place, True)
