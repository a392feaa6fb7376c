"""GeoJSON documents read back as feature rows."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.schemas import DOCUMENT_PARTS, FEATURE, FEATURE_COLLECTION


def read_parts(spark: SparkSession, path: str) -> DataFrame | None:
    """Index of the parts of a document that this library wrote (see ``sinks.files``), or None for another one."""
    try:
        return spark.read.schema(DOCUMENT_PARTS).parquet(f"{path.rstrip('/')}/_parts")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_features(spark: SparkSession, path: str, collection: bool = False) -> DataFrame:
    """``type, geometry, properties`` rows.

    The default reads one feature per line, which is splittable. ``collection`` reads FeatureCollection documents: one that this
    library wrote is known by its index of parts and has a feature a line, so its parts are read in any number of tasks; any
    other document is read whole, by one task each.
    """
    if not collection:
        return spark.read.schema(FEATURE).json(path)
    if read_parts(spark, path) is None:
        documents = spark.read.schema(FEATURE_COLLECTION).option("multiLine", "true").json(path)
        return documents.select(F.explode("features").alias("feature")).select("feature.*")
    feature = F.regexp_extract("value", r"(?s)^,?(\{.*\})$", 1)  # neither the opening nor the closing line of the document
    lines = spark.read.text(path).select(feature.alias("value")).filter("value <> ''")
    return lines.select(F.from_json("value", FEATURE).alias("feature")).select("feature.*")
