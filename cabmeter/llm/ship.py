"""Make the package importable in Python workers."""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import SparkSession

from cabmeter.session import fresh_dir

_ready: set[str] = set()


def _package() -> bytes:
    """The package's sources as a zip archive."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    return out.getvalue()


def ensure_importable(spark: SparkSession) -> None:
    """Operators that run Python in tasks need this package there. Where a
    task finds it (it is installed, or on the workers' path) nothing is done;
    else its sources are written to the shared folder and added to the
    session's Python files. Looked up once per application."""
    app = spark.sparkContext.applicationId
    if app in _ready:
        return

    def look(batches):
        import importlib.util as util

        import pyarrow as pa

        for batch in batches:
            try:
                found = util.find_spec("cabmeter.llm.textops") is not None
            except ImportError:
                found = False
            yield pa.RecordBatch.from_arrays([pa.array([found] * batch.num_rows)], names=["found"])

    if not spark.range(1).mapInArrow(look, "found boolean").first()["found"]:
        path = f"{fresh_dir(spark, 'python')}/cabmeter_sources.zip"
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        stream = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(jvm_path)
        stream.write(bytearray(_package()))
        stream.close()
        spark.sparkContext.addPyFile(path)
    _ready.add(app)
