"""CSV, JSON and text files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def load_csv(spark: SparkSession, folder: str, filename: str = "sales.csv", schema: T.StructType | str | None = None) -> DataFrame:
    """A UTF-8 CSV file with a header. When it is missing, the first ``*.csv`` of the folder by name.

    Without a schema the types are inferred, which reads the file once more.
    """
    if not filename.lower().endswith(".csv"):
        raise ValueError(f"unsupported file format: {filename}")
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    try:
        return reader.csv(f"{folder.rstrip('/')}/{filename}")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
        first = listing.select("path").orderBy("path").first()  # lists the names, reads no content
        if first is None:
            raise
        return reader.csv(first["path"])


def _flat(df: DataFrame) -> DataFrame:
    lists = {
        f.name: F.concat_ws(", ", f.name) if isinstance(f.dataType.elementType, T.StringType) else F.to_json(f.name)
        for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)
    }
    nested = {f.name: F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, (T.MapType, T.StructType))}
    changed = lists | nested
    return df.withColumns(changed) if changed else df


def save_csv(df: DataFrame, path: str) -> None:
    """Overwrites a folder of CSV files with a header; lists are joined by ', ', other nested values are JSON."""
    _flat(df).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def save_report(df: DataFrame, path: str) -> None:
    """Overwrites a folder of JSON lines; a path ending in .csv ends in .json instead."""
    df.write.mode("overwrite").json(path.removesuffix(".csv") + ".json" if path.endswith(".csv") else path)


def insight_lines(insights: DataFrame) -> DataFrame:
    """(line): numbered sentences from (seq, text)."""
    return insights.select(F.format_string("%d. %s", "seq", "text").alias("line"))


def save_insights(insights: DataFrame, path: str) -> None:
    """Overwrites a text folder with one numbered sentence per line, in order."""
    insight_lines(insights.orderBy("seq").coalesce(1)).write.mode("overwrite").text(path)  # a handful of sentences
