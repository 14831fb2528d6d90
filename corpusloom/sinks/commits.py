"""Files that only one of several writers can make."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Make a file with all of its content, unless it is there already; tells whether this call made it.

    The content is written beside it and then put in place in one step that fails if the name is taken: a hard link on a local disk, elsewhere
    a rename that may not overwrite, which is atomic on HDFS. On object stores it is as safe as their connector's rename.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(conf)
    if files.exists(target):
        return False
    # names that begin with a dot are not read as data
    beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = files.create(beside, False)
    out.write(bytearray(content.encode()))
    out.close()
    try:
        if files.getScheme() == "file":
            os.link(beside.toUri().getPath(), target.toUri().getPath())
        else:
            never = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            renames = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            renames[0] = never
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(beside, target, renames)
    except Exception:
        if files.exists(target):
            return False
        raise
    finally:
        files.delete(beside, False)
    return True
