"""Session helpers: a local session for tests/bench, and the shared scratch
folder (``spark.checkpoint.dir``) used for versions, checkpoints and
streaming state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lexispark") -> SparkSession:
    """Local session with the settings used by tests and ``bench.py``."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """One process: every task sees the driver's folders."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder: ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system folder and is read
    from the session; without it this raises, as a machine's own folder is
    not seen by the others. Only a local session gets a fresh folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="lexispark-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (works for any scheme)."""
    fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path`` (empty if it is missing)."""
    fs, hpath = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(hpath)] if fs.exists(hpath) else []


def read_text_file(spark: SparkSession, path: str) -> str:
    """Read a small file through Hadoop FS."""
    fs, hpath = _fs(spark, path)
    stream = fs.open(hpath)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def create_text_file(spark: SparkSession, path: str, content: str) -> bool:
    """Write a small file that must not exist yet; False if it does."""
    fs, hpath = _fs(spark, path)
    try:
        out = fs.create(hpath, False)
    except Exception as e:  # Hadoop raises FileAlreadyExistsException, or its own kind by store
        if fs.exists(hpath):
            return False
        raise e
    out.write(bytearray(content.encode("utf-8")))
    out.close()
    return True


def publish(spark: SparkSession, src: str, dst: str) -> None:
    """Rename a finished file to a name that its writer alone may use."""
    fs, hsrc = _fs(spark, src)
    if not fs.rename(hsrc, _fs(spark, dst)[1]):
        raise RuntimeError(f"could not publish {dst}")


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)
