"""Object store content addressed by ``s3://bucket/key``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

URI_SCHEME = "s3://"
URI_PATTERN = r"(?s)^s3://([^/]+)/(.+)$"


def parse_object_uri(col: Column) -> Column:
    """Struct (bucket, key); null for what is not a full object address."""
    return F.when(
        col.rlike(URI_PATTERN),
        F.struct(
            F.regexp_extract(col, URI_PATTERN, 1).alias("bucket"),
            F.regexp_extract(col, URI_PATTERN, 2).alias("key"),
        ),
    )


def read_objects(spark: SparkSession, root: str, bucket: str, glob: str | None = None) -> DataFrame:
    """(uri, content) of the objects below a folder that holds the bucket. The
    listing and reading are Spark's; no path list passes through the driver."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    prefix = root.rstrip("/") + "/"
    marker = F.regexp_replace(F.lit(prefix), r"^[a-z0-9]+:/*", "/")
    plain = F.regexp_replace(F.col("path"), r"^[a-z0-9]+:/*", "/")
    key = F.substring(plain, F.length(marker) + 1, F.lit(2**30))
    return reader.load(root).select(
        F.concat(F.lit(f"{URI_SCHEME}{bucket}/"), key).alias("uri"), "content",
        F.col("modificationTime").alias("modification_time"),
    )
