"""Make the package importable in Python workers (fetch functions run there).

On a cluster the package is shipped at submit time (``--py-files`` or an
installed wheel).  When the shared checkpoint folder is a plain filesystem
path (local mode, tests) the package is zipped there and added with
``addPyFile`` so the Python workers import the same code as the driver.
"""

from __future__ import annotations

import os
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    from walletflow.session import scratch_path

    target = scratch_path(spark, "pyfiles")
    if target.startswith("file:"):
        target = target[len("file:"):]
    if "://" in target:
        _SHIPPED.add(key)  # remote storage: shipped at submit time
        return
    os.makedirs(target, exist_ok=True)
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(target, "walletflow.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in root:
                continue
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.join("walletflow", os.path.relpath(full, pkg_dir)))
    sc.addPyFile(path)
    _SHIPPED.add(key)
