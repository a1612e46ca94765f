"""Metadata-only file-system calls through Hadoop's FileSystem API (works for any
scheme the cluster mounts). No file content passes through the driver. They need a
session with a JVM gateway and raise without one (Spark Connect), rather than touch the
driver's own disk."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _jvm(spark: SparkSession):
    try:
        return spark.sparkContext._jvm
    except Exception as e:
        raise RuntimeError("file-system calls need a session with a JVM gateway") from e


def _fs(spark: SparkSession, path: str):
    p = _jvm(spark).org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str, make_parent: bool = True) -> str:
    """Move a file and return where it is now. A file that is there already stays: the new
    one gets its modification time, and if need be a number, before its suffix."""
    fs, s = _fs(spark, src)
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    d = make(dst)
    if make_parent:
        fs.mkdirs(d.getParent())
    if fs.exists(d):
        folder, name = dst.rsplit("/", 1)
        stem, dot, suffix = name.partition(".") if not name.startswith(".") else (name, "", "")
        stem = f"{stem}~{fs.getFileStatus(s).getModificationTime()}"
        k = 0
        while fs.exists(d):
            d = make(f"{folder}/{stem}{f'-{k}' if k else ''}{dot}{suffix}")
            k += 1
    if not fs.rename(s, d):
        raise OSError(f"cannot rename {src} to {d.toString()}")
    return d.toString()


def create_empty(spark: SparkSession, path: str, text: str = "") -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    if text:
        out.write(bytearray(text.encode("utf-8")))
    out.close()


def _list(spark: SparkSession, folder: str, dirs: bool) -> list[str]:
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().toString() for st in fs.listStatus(p) if bool(st.isDirectory()) == dirs)


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    return [f for f in _list(spark, folder, False) if f.endswith(suffix)]


def list_dirs(spark: SparkSession, folder: str) -> list[str]:
    return _list(spark, folder, True)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a staging folder this library created."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file, read by the driver."""
    fs, p = _fs(spark, path)
    jvm = _jvm(spark)
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def mtime(spark: SparkSession, path: str) -> int:
    """A file's modification time (epoch milliseconds)."""
    fs, p = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())


def set_mtime(spark: SparkSession, path: str, millis: int) -> None:
    """Set a file's modification time (epoch milliseconds); a metadata call."""
    fs, p = _fs(spark, path)
    fs.setTimes(p, millis, -1)
