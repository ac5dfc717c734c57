"""The package itself as a file that Spark sends to its executors."""

import tempfile
from functools import lru_cache
from pathlib import Path
from zipfile import ZipFile

from pyspark.sql import SparkSession


@lru_cache(maxsize=None)
def _ship(application_id: str, spark: SparkSession) -> None:
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="starmart-package-")) / "starmart.zip"
    with ZipFile(archive, "w") as file:
        for source in sorted(root.rglob("*.py")):
            file.write(source, source.relative_to(root.parent))
    # Spark copies it from the driver to every executor and puts it on the path of Python workers.
    spark.sparkContext.addPyFile(str(archive))


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for an application."""
    _ship(spark.sparkContext.applicationId, spark)
