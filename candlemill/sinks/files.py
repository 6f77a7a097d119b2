"""Whether a path is there, and its removal, on any file system Spark writes to."""


def _find(spark, path):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark, path):
    found, files = _find(spark, path)
    return files.exists(found)


def remove(spark, path):
    found, files = _find(spark, path)
    return files.delete(found, True)


def names(spark, path):
    """Names of what the folder holds; none if it isn't there."""
    found, files = _find(spark, path)
    return [status.getPath().getName() for status in files.listStatus(found)] if files.exists(found) else []
