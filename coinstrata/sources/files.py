"""Folders and files through the Hadoop file system API: local paths, HDFS and object
stores alike."""

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return hadoop_path, hadoop_path.getFileSystem(conf)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def visible_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly below ``path``, hidden ones left out, in name order."""
    hadoop_path, fs = _path(spark, path)
    return sorted(
        entry.getPath().toString()
        for entry in fs.listStatus(hadoop_path)
        if entry.isDirectory() and not entry.getPath().getName().startswith(".")
    )


def fingerprint(spark: SparkSession, paths: list[str]) -> tuple:
    """Size and modification time of each path, to notice changed input."""
    state = []
    for path in paths:
        hadoop_path, fs = _path(spark, path)
        modified = fs.getFileStatus(hadoop_path).getModificationTime()
        state.append((path, fs.getContentSummary(hadoop_path).getLength(), modified))
    return tuple(state)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote."""
    hadoop_path, fs = _path(spark, path)
    fs.delete(hadoop_path, True)


def create_for_session(spark: SparkSession, path: str) -> None:
    """Create a folder that is deleted when the application ends."""
    hadoop_path, fs = _path(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder this library wrote, replacing the target; nothing if it is not there."""
    source_path, fs = _path(spark, source)
    if fs.exists(source_path):
        target_path, _ = _path(spark, target)
        fs.delete(target_path, True)
        fs.mkdirs(target_path.getParent())
        fs.rename(source_path, target_path)


def visible_files(spark: SparkSession, path: str) -> list[str]:
    """Files directly below ``path``, hidden ones left out, in name order."""
    hadoop_path, fs = _path(spark, path)
    return sorted(
        entry.getPath().toString()
        for entry in fs.listStatus(hadoop_path)
        if entry.isFile() and not entry.getPath().getName().startswith(".")
    )


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of ``text``."""
    hadoop_path, fs = _path(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def text_of(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    hadoop_path, fs = _path(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Give a file its final name; fails if that name is taken."""
    jvm = spark._jvm
    source_path, _ = _path(spark, source)
    target_path, _ = _path(spark, target)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target_path.toUri(), conf)
    options = spark.sparkContext._gateway.new_array(
        getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0
    )
    context.rename(source_path, target_path, options)
