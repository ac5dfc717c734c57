"""Outputs that change as a whole: written beside their place, then moved to it.

While a job runs, the output at ``path`` is the old one. The new one is written to ``_<name>.staging``
in the same folder, whose name readers of the folder pass over. A commit moves the old output to
``_<name>.previous``, the new one to its place, and removes the old one. A job that is lost before the
commit leaves the old output; one that is lost between the two moves leaves it as ``previous``, from
where the next ``recover`` brings it back. One job writes to an output at a time.

On file systems a move is a rename. Stores that copy on rename keep the order of the steps.
"""

from pyspark.sql import SparkSession

from starmart.sources import files


def _beside(path: str, kind: str) -> str:
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_{name}.{kind}" if folder or path.startswith("/") else f"_{name}.{kind}"


def recover(spark: SparkSession, path: str) -> bool:
    """Bring back the output that a lost commit had moved away; whether there was one."""
    previous = _beside(path, "previous")
    if files.exists(spark, path) or not files.exists(spark, previous):
        return False
    files.move(spark, previous, path)
    return True


def stage(spark: SparkSession, path: str) -> str:
    """Where to write the new output; what a lost job has left there goes."""
    recover(spark, path)
    staged = _beside(path, "staging")
    files.remove(spark, staged)
    return staged


def commit(spark: SparkSession, path: str) -> None:
    """Put the staged output in its place."""
    previous, staged = _beside(path, "previous"), _beside(path, "staging")
    if not files.exists(spark, staged):
        raise FileNotFoundError(staged)
    if files.exists(spark, path):
        # Only with a whole output in place is the one before it of no use any more.
        files.remove(spark, previous)
        files.move(spark, path, previous)
    files.move(spark, staged, path)
    files.remove(spark, previous)


def drop_staged(spark: SparkSession, path: str) -> None:
    files.remove(spark, _beside(path, "staging"))
