"""Files through Hadoop's file systems, so that any store that Spark reads can be checked."""

from __future__ import annotations

from pyspark.sql import SparkSession


def fs_of(spark: SparkSession, path: str):
    """(file system, path) of a path or URI."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = fs_of(spark, path)
    return fs.exists(p)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file over another: readers see the old one or the new one."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, p = fs_of(spark, target)
    p, q = fs.makeQualified(p), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(source))
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.valueOf("OVERWRITE")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(q, p, options)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or folder to a name that isn't taken."""
    fs, p = fs_of(spark, target)
    if fs.exists(p) or not fs.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source), p):
        raise OSError(f"cannot rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = fs_of(spark, path)
    fs.delete(p, True)


def files_below(spark: SparkSession, root: str) -> list[str]:
    """All files below a root (or the file itself), by name, without hidden ones."""
    fs, p = fs_of(spark, root)
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        at = it.next().getPath()
        if not at.getName().startswith(("_", ".")):
            found.append(at.toString())
    return sorted(found)


def size_of(spark: SparkSession, path: str) -> int:
    fs, p = fs_of(spark, path)
    return fs.getFileStatus(p).getLen()


def sha256_of(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file, read in pieces by the JVM: memory doesn't grow with the file."""
    fs, p = fs_of(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def sha256_of_all(spark: SparkSession, paths: list[str]) -> str:
    """SHA-256 of files one after the other, as if they were one."""
    jvm = spark.sparkContext._jvm
    digest = jvm.java.security.MessageDigest.getInstance("SHA-256")
    for path in paths:
        fs, p = fs_of(spark, path)
        stream = fs.open(p)
        try:
            jvm.org.apache.commons.codec.digest.DigestUtils.updateDigest(digest, stream)
        finally:
            stream.close()
    return jvm.org.apache.commons.codec.binary.Hex.encodeHexString(digest.digest())


def has_magic(spark: SparkSession, path: str, magic: bytes = b"PAR1") -> bool:
    """Whether a file begins and ends with four bytes."""
    size = size_of(spark, path)
    if size < 8:
        return False
    fs, p = fs_of(spark, path)
    want = int.from_bytes(magic, "big")
    stream = fs.open(p)
    try:
        head = stream.readInt()
        stream.seek(size - 4)
        return head == want and stream.readInt() == want
    finally:
        stream.close()
