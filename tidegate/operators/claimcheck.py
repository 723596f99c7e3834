"""Bodies by reference: a lookup join against object content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions.jsonpath import compact_json, json_path, split_path
from tidegate.functions.payload import decode_object, inspect_leaf, replace_leaf
from tidegate.operators.errors import outcome, settle, track_errors, usable
from tidegate.sources.object_store import ObjectStore
from tidegate.sources.objects import URI_PATTERN, URI_SCHEME

# A hot address is split over this many tasks.
SALTS = 64
BLANKS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def trimmed(col: Column) -> Column:
    return F.regexp_replace(col, BLANKS, "")


def as_uri(col: Column) -> Column:
    """The trimmed text where it is an object address, else null."""
    text = trimmed(col)
    return F.when(text.startswith(URI_SCHEME), text)


def fetch(
    df: DataFrame,
    objects: DataFrame | ObjectStore,
    uri: str,
    out: str,
    fmt: str | None = None,
    try_base64: bool = True,
    plain: Column | None = None,
) -> DataFrame:
    """Add struct ``out`` (value, error_class, error_message) for the address in
    column ``uri``; null where there is no address. Rows for which ``plain`` holds
    get the object's text as it is, whatever ``fmt`` says.

    ``objects`` is a store, whose objects are fetched by address, only those asked for and
    each once, or a table of all objects (uri, content).

    Each object is read and decoded once, then copied at most once per salt that
    its messages really use. Rows without an address get keys of their own, so
    they do not pile up in one task.
    """
    address = F.col(uri).isNotNull() & F.col(uri).rlike(URI_PATTERN)
    rows = df.withColumns(
        {
            "fetch_key": F.coalesce(F.col(uri), F.concat(F.lit(" "), "message_id")),
            "fetch_salt": F.pmod(F.xxhash64("message_id"), F.lit(SALTS)).cast("int"),
            "fetch_plain": F.lit(fmt is None) if plain is None else F.coalesce(plain, F.lit(False)),
        }
    )
    none = F.lit(None)
    if isinstance(objects, ObjectStore):
        if df.isStreaming:
            found = objects.column(F.when(address, F.col(uri)))
            rows = rows.withColumn("fetched", found)
            rows = rows.withColumns({"content": F.col("fetched.content"), "failure": F.col("fetched.failure")})
            joined = rows.withColumn(out, content_or_failure(fmt, try_base64)).drop("fetched", "content", "failure")
            return with_missing(joined, uri, out)
        objects = objects.fetched(df.sparkSession, rows.where(address).select(F.col(uri).alias("uri")))
    if df.isStreaming:
        # A micro-batch joins the static objects directly.
        decoded = one_per_address(objects).withColumnRenamed("uri", "fetch_key").withColumn(
            "fetch_plain", F.explode(F.array(F.lit(True), F.lit(False)))
        )
        decoded = decoded.select("fetch_key", "fetch_plain", content_of(fmt, try_base64).alias(out))
        joined = rows.join(decoded, ["fetch_key", "fetch_plain"], "left")
    else:
        # At most 2 * SALTS uses per address: a bounded set, pre-aggregated on the map side.
        wanted = (
            rows.where(address).groupBy("fetch_key")
            .agg(F.collect_set(F.struct("fetch_plain", "fetch_salt")).alias("uses"))
        )
        ways = F.array_distinct(F.transform("uses", lambda u: u["fetch_plain"]))
        salts = F.filter("uses", lambda u: u["fetch_plain"] == F.col("fetch_plain"))
        decoded = (
            one_per_address(objects).withColumnRenamed("uri", "fetch_key")
            .join(wanted.hint("merge"), "fetch_key")
            .select("fetch_key", "uses", "content", "failure", F.explode(ways).alias("fetch_plain"))
            .select("fetch_key", salts.alias("uses"), content_or_failure(fmt, try_base64).alias(out))
            .select("fetch_key", F.explode("uses").alias("use"), out)
            .select("fetch_key", "use.*", out)
        )
        # Contents grow when they are unpacked: neither side is built as a broadcast.
        joined = rows.join(decoded.hint("merge"), ["fetch_key", "fetch_plain", "fetch_salt"], "left")
    return with_missing(joined, uri, out)


def with_missing(joined: DataFrame, uri: str, out: str) -> DataFrame:
    """Errors for addresses that led to nothing."""
    none = F.lit(None)
    missing = F.when(
        F.col(uri).rlike(URI_PATTERN),
        outcome(none, F.lit("ObjectNotFound"), F.concat(F.lit("Object not found: "), F.col(uri))),
    ).otherwise(
        outcome(none, F.lit("InvalidUri"), F.concat(F.lit("Invalid object address: "), F.col(uri)))
    )
    return joined.withColumn(
        out, F.when(F.col(uri).isNotNull(), F.coalesce(F.col(out), missing))
    ).drop("fetch_key", "fetch_salt", "fetch_plain")


def one_per_address(objects: DataFrame) -> DataFrame:
    """An address listed twice is one object: the latest where the listing has a
    ``modification_time``, else the one with the largest content."""
    if "failure" in objects.columns:  # fetched by address, so there is one already
        return objects
    newest = [c for c in ("modification_time",) if c in objects.columns]
    keys = F.struct(*newest, F.length("content"), "content")
    return objects.groupBy("uri").agg(F.max_by("content", keys).alias("content")).withColumn(
        "failure", F.lit(None).cast("string")
    )


def content_or_failure(fmt: str | None, try_base64: bool) -> Column:
    """The decoded content; null where there is no object, an error where the store failed."""
    none = F.lit(None)
    failed = outcome(none, F.lit("ObjectStoreError"), F.col("failure"))
    return F.when(F.col("failure").isNotNull(), failed).when(
        F.col("content").isNotNull(), content_of(fmt, try_base64)
    )


def content_of(fmt: str | None, try_base64: bool) -> Column:
    """Object content as text: as it is where ``fetch_plain`` holds, else decoded."""
    as_it_is = decode_object(F.col("content"))
    if fmt is None:
        return as_it_is
    packed = F.when(~F.col("fetch_plain"), F.col("content"))
    return F.when(F.col("fetch_plain"), as_it_is).otherwise(decode_object(packed, fmt, try_base64))


def keep_or(result: str, value: Column) -> Column:
    """The fetched struct, or the given value where nothing was fetched."""
    none = F.lit(None)
    return F.coalesce(F.col(result), outcome(value, none, none))


def claim_check(
    df: DataFrame,
    objects: DataFrame | ObjectStore,
    path: str | None = None,
    fmt: str | None = None,
    try_base64: bool = True,
) -> DataFrame:
    """Body, or its text leaf at ``path``, is an object address: put the object's
    text there (decompressed if ``fmt`` is given). Anything else stays."""
    rows = track_errors(df)
    parts = split_path(path)
    body = usable(F.col("body"))
    if not parts:
        rows = rows.withColumn("claim_uri", as_uri(body))
        rows = fetch(rows, objects, "claim_uri", "claim", fmt, try_base64)
        return settle(
            rows.withColumn("claim", keep_or("claim", F.col("body"))), "claim"
        ).drop("claim_uri")
    leaf = F.get_json_object(compact_json(body), json_path(parts))
    rows = reject_non_json(rows.withColumn("claim_leaf", leaf))
    rows = rows.withColumn("claim_uri", as_uri(usable(F.col("claim_leaf"))))
    rows = settle_fetch(fetch(rows, objects, "claim_uri", "claim", fmt, try_base64), "claim")
    return put_leaf(rows, parts, F.col("claim_text"), "claim_leaf", False).drop(
        "claim_uri", "claim_text", "claim_leaf"
    )


def reject_non_json(rows: DataFrame) -> DataFrame:
    """A path needs JSON: other non-empty bodies fail."""
    bad = (
        F.col("error_class").isNull() & (F.col("body") != "") & compact_json(F.col("body")).isNull()
    )
    bad = F.coalesce(bad, F.lit(False))
    return rows.withColumns(
        {
            "error_class": F.when(bad, "JsonError").otherwise(F.col("error_class")),
            "error_message": F.when(bad, "Invalid JSON in message").otherwise(F.col("error_message")),
        }
    )


def settle_fetch(rows: DataFrame, result: str) -> DataFrame:
    """Fetched text to ``<result>_text``, its error to the row."""
    return settle(
        rows.withColumns(
            {f"{result}_text": F.lit(None).cast("string"),
             result: keep_or(result, F.lit(None))}
        ),
        result, f"{result}_text",
    )


def put_leaf(
    rows: DataFrame, parts: list[str], leaf: Column, present: str, as_json: bool
) -> DataFrame:
    """Set the leaf; only bodies that have something at the path go to Python."""
    touched = usable(F.when(F.col(present).isNotNull(), F.col("body")))
    result = replace_leaf(touched, parts, leaf, as_json)
    rows = rows.withColumn("replaced", result)
    kept = F.when(
        F.col("replaced.error_class").isNull() & F.col("replaced.value").isNull(),
        outcome(F.col("body"), F.lit(None), F.lit(None)),
    ).otherwise(F.col("replaced"))
    return settle(rows.withColumn("replaced", kept), "replaced")


def decode_and_fetch(
    df: DataFrame,
    objects: DataFrame | ObjectStore,
    path: str | None,
    fmt: str = "AUTO",
    try_base64: bool = True,
) -> DataFrame:
    """Text leaf at ``path``: fetch it if it is an address, decompress, and if it
    was not fetched and is now an address, fetch that as it is. The result goes
    back as JSON where it parses. At most one fetch per message."""
    parts = split_path(path)
    if not parts:
        return track_errors(df)
    rows = track_errors(df).withColumn(
        "leaf", inspect_leaf(usable(F.col("body")), parts, fmt, try_base64, URI_SCHEME)
    )
    rows = rows.withColumns(
        {
            "fetch_uri": F.col("leaf.address"),
            "leaf_result": outcome(
                F.col("leaf.plain"), F.col("leaf.error_class"), F.col("leaf.error_message")
            ),
        }
    )
    # One lookup serves both kinds of address; an inner one is not unpacked again.
    rows = fetch(rows, objects, "fetch_uri", "fetched", fmt, try_base64, plain=~F.col("leaf.direct"))
    rows = rows.withColumns(
        {
            "leaf_result": F.coalesce("fetched", "leaf_result"),
            "leaf_text": F.lit(None).cast("string"),
            "leaf_there": F.when(F.col("leaf.present"), F.lit(True)),
        }
    ).drop("leaf", "fetched", "fetch_uri")
    rows = settle(rows, "leaf_result", "leaf_text")
    return put_leaf(rows, parts, F.col("leaf_text"), "leaf_there", True).drop(
        "leaf_text", "leaf_there"
    )
