"""Ad-hoc SQL over a published folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cairn.functions.scalars import register_sql_functions
from cairn.sources.readers import register_manifest
from cairn.sources.sinks import write_csv

#: Rows shown; an export has all of them.
SHOWN = 500


class Engine:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.relations = register_manifest(spark, folder)
        register_sql_functions(spark)

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text)

    def download(self, text: str, path: str) -> None:
        """SNK12: all rows of a query as CSV with a header, in the query's own order; NULL as blank."""
        write_csv(self.sql(text), path)

    def shown(self, text: str) -> DataFrame:
        return self.sql(text).limit(SHOWN)


def ship(spark: SparkSession) -> None:
    """Let the Python workers of a cluster import this package: a zip of it goes to every executor, once a session."""
    import tempfile
    import zipfile
    from pathlib import Path

    import cairn

    context, root = spark.sparkContext, Path(cairn.__file__).resolve().parent
    if getattr(context, "_cairn_shipped", False):
        return
    # made by the driver and served by it: executors fetch it, nobody reads this path
    target = Path(tempfile.mkdtemp(prefix="cairn-")) / "cairn.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    context._cairn_shipped = True
