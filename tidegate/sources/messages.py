"""Reading messages and choosing their attributes and queues."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidegate.schemas import BASE_SYSTEM_ATTRIBUTES, FIFO_SYSTEM_ATTRIBUTES, MESSAGE_SCHEMA

MAX_RECEIVE_BATCH = 10
MAX_WAIT_SECONDS = 20


def promote_attributes(df: DataFrame, names: list[str]) -> DataFrame:
    """Add a ``promoted`` struct with presence and text of some user attributes.
    Written to the landing folder, policies on them prune files and row groups."""
    entry = lambda n: F.try_element_at("message_attributes", F.lit(n))
    fields = [
        F.struct(
            entry(n).isNotNull().alias("present"), entry(n)["string_value"].alias("text")
        ).alias(n)
        for n in names
    ]
    return df.withColumn("promoted", F.struct(*fields))


def landing_schema(promoted: list[str]) -> T.StructType:
    if not promoted:
        return MESSAGE_SCHEMA
    pair = T.StructType(
        [T.StructField("present", T.BooleanType()), T.StructField("text", T.StringType())]
    )
    names = T.StructType([T.StructField(n, pair) for n in promoted])
    return T.StructType(MESSAGE_SCHEMA.fields + [T.StructField("promoted", names)])


def read_messages(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    promoted: list[str] = (),
) -> DataFrame:
    """Messages of a landing folder as a table or as a stream."""
    schema = landing_schema(list(promoted))
    if not streaming:
        return spark.read.schema(schema).format(fmt).load(path)
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger is not None:
        if max_files_per_trigger < 1:
            raise ValueError("max_files_per_trigger must be at least 1")
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def spread(df: DataFrame, workers: int | None = None) -> DataFrame:
    """Let ``workers`` tasks share one queue. Without a number: as many as there are
    cores, and only where the frame has fewer partitions (a few large files);
    a frame that is spread already is not shuffled again."""
    if workers is not None:
        return df.repartition(workers)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def attribute_names(text: str | None) -> list[str]:
    """Comma list -> trimmed names, blanks dropped."""
    return [n.strip() for n in (text or "").split(",") if n.strip()]


def project_attributes(
    df: DataFrame, enabled: bool = True, names: str | None = None, fifo: bool | None = None
) -> DataFrame:
    """Keep the wanted user attributes (none, the named ones, or all) and the
    system attributes of the queue kind. ``fifo=None`` decides per row. Promoted
    columns of attributes that were not asked for are dropped with them."""
    wanted = attribute_names(names)
    user = F.col("message_attributes")
    if not enabled:
        user = F.when(user.isNotNull(), F.map_filter(user, lambda k, v: F.lit(False)))
    elif wanted:
        user = F.map_filter(user, lambda k, v: k.isin(*wanted))
    suffix = F.coalesce(F.col("queue_url").endswith(".fifo"), F.lit(False))
    ordered = suffix if fifo is None else F.lit(fifo)
    system = F.map_filter(
        F.col("attributes"),
        lambda k, v: k.isin(*BASE_SYSTEM_ATTRIBUTES)
        | (ordered & k.isin(*FIFO_SYSTEM_ATTRIBUTES)),
    )
    out = df.withColumns({"message_attributes": user, "attributes": system})
    if "promoted" in df.columns and (wanted or not enabled):
        kept = [n for n in df.schema["promoted"].dataType.fieldNames() if enabled and n in wanted]
        stored = F.struct(*[F.col("promoted")[n].alias(n) for n in kept])
        out = out.withColumn("promoted", stored) if kept else out.drop("promoted")
    return out


def union_queues(queues: list[tuple[str, DataFrame]]) -> DataFrame:
    """Many queues as one frame, each row naming its queue."""
    frames = [frame.withColumn("queue_url", F.lit(url)) for url, frame in queues]
    return reduce(DataFrame.unionByName, frames)


def queue_list(urls: Column, single: Column | None = None) -> Column:
    """Ordered distinct queues of a comma list; the single one where it is blank."""
    blanks = r"^[\x00-\x20]+|[\x00-\x20]+$"
    listed = F.array_distinct(
        F.filter(
            F.transform(F.split(F.coalesce(urls, F.lit("")), ","),
                        lambda u: F.regexp_replace(u, blanks, "")),
            lambda u: u != "",
        )
    )
    if single is None:
        return listed
    one = F.regexp_replace(single, blanks, "")
    alone = F.when(one != "", F.array(one)).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(listed) > 0, listed).otherwise(F.coalesce(alone, F.array().cast("array<string>")))


def queue_assignment(df: DataFrame, queues: Column, max_tasks: int, keep: list[str]) -> DataFrame:
    """Which queue of each list gets how many workers under a limit: a lone queue
    gets all of them, else the first ``max_tasks`` get one each. A report only:
    Spark reads every queue."""
    n = F.size(queues)
    return df.select(*keep, n.alias("n_queues"), F.posexplode(queues).alias("position", "queue_url")).select(
        *keep, "queue_url", F.col("position").cast("long"),
        F.when((F.col("n_queues") == 1), F.lit(max_tasks))
        .when(F.col("position") < max_tasks, F.lit(1))
        .otherwise(F.lit(0)).cast("long").alias("workers"),
    )
