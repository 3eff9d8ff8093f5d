"""Folders of written data, on whatever file system their path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path`` that a write job has finished."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return []
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return [n for n in names if fs.exists(path_of(f"{path}/{n}/_SUCCESS"))]


def file_names(spark: SparkSession, path: str) -> set[str]:
    """Names directly below ``path``; none if it does not exist."""
    fs, folder = _file_system(spark, path)
    return {s.getPath().getName() for s in fs.listStatus(folder)} if fs.exists(folder) else set()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def move_into(spark: SparkSession, paths: list[str], folder: str) -> None:
    """Move files into a folder, under their own names; one of that name there is replaced."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        fs, source = _file_system(spark, path)
        target = path_of(f"{folder}/{source.getName()}")
        fs.mkdirs(target.getParent())
        fs.delete(target, False)
        if not fs.rename(source, target):
            raise OSError(f"could not move {path} to {folder}")


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files directly below ``path`` that a Spark reader would read."""
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    files = [s.getPath() for s in fs.listStatus(folder) if s.isFile()]
    return sorted(f.toString() for f in files if not f.getName().startswith(("_", ".")))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, finished or not."""
    fs, root = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()) if fs.exists(root) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one piece; one of that name is replaced."""
    fs, target = _file_system(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is no such file."""
    fs, source = _file_system(spark, path)
    if not fs.exists(source):
        return None
    with_bytes = fs.open(source)
    try:
        size = fs.getFileStatus(source).getLen()
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(with_bytes, size)).decode()
    finally:
        with_bytes.close()


def file_marks(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """Path, length and time of change of each of these files that is there."""
    found = []
    for path in paths:
        fs, source = _file_system(spark, path)
        if fs.exists(source):
            status = fs.getFileStatus(source)
            found.append((path, int(status.getLen()), int(status.getModificationTime())))
    return found
