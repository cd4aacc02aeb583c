"""What plans share between driver and executors: the package itself, and tables in the shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the executors' Python workers, once for each application: Arrow functions name
    what they run by its module."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="kinmatch-zip-")  # the driver serves it to executors; nothing else reads it
    target = os.path.join(folder, "kinmatch_pkg.zip")
    with zipfile.ZipFile(target, "w") as z:
        for at, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(at, n)
                    z.write(full, os.path.join("kinmatch", os.path.relpath(full, top)))
    spark.sparkContext.addPyFile(target)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where it is unset, only a local master
    gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is not set; driver and executors need a shared folder")
        found = tempfile.mkdtemp(prefix="kinmatch-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once however often it is read, and kept when executors are lost."""
    path = f"{shared_dir(df.sparkSession)}/kinmatch/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
