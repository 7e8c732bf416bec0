"""Folders of numbered entries, through the file system that their address names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def holds_file(spark: SparkSession, path: str, suffix: str = ".parquet") -> bool:
    """Whether ``path`` is a folder with a data file; an unfinished write has none yet."""
    folder, system = file_system(spark, path)
    return system.exists(folder) and first_file(system, folder, suffix)


def first_file(system, folder, suffix: str) -> bool:
    """Whether there is a data file; the listing ends at the first."""
    entries = system.listStatusIterator(folder)
    while entries.hasNext():
        entry = entries.next()
        name = entry.getPath().getName()
        if entry.isFile() and name.endswith(suffix) and name[0] not in "._":
            return True
    return False


def numbers(spark: SparkSession, path: str, label: str) -> list[int]:
    """The n of the folders ``<label>=<n>`` below ``path``, ascending, complete or not."""
    folder, system = file_system(spark, path)
    if not system.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in system.listStatus(folder)]
    found = [name.removeprefix(f"{label}=") for name in names if name.startswith(f"{label}=")]
    return sorted(int(n) for n in found if n.isdigit())


def claim(spark: SparkSession, path: str) -> bool:
    """Create the file ``path`` unless there is one; only one of several claimants gets True."""
    target, system = file_system(spark, path)
    try:
        return bool(system.createNewFile(target))
    except Exception as error:
        # some file systems raise where another claimant was first
        if system.exists(target):
            return False
        raise error


def remove(spark: SparkSession, path: str) -> None:
    folder, system = file_system(spark, path)
    system.delete(folder, True)


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, or None; no job is run."""
    target, system = file_system(spark, path)
    jvm = spark._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(system.open(target), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def data_files(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """The data files directly in a folder, in order of their names."""
    folder, system = file_system(spark, path)
    entries = [entry.getPath() for entry in system.listStatus(folder) if entry.isFile()]
    return sorted(p.toString() for p in entries if p.getName().endswith(suffix) and p.getName()[0] not in "._")
