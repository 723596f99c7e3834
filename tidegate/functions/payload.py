"""Base64, gzip and zlib decoding of message bodies, and JSON leaf replacement.

Detection is native. Inflating needs Python, so one Arrow UDF does it and gives
back a struct with the value or the error: a bad body never fails its batch.
"""

from __future__ import annotations

import binascii
import ctypes
import json
import re
import uuid
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

FORMATS = ("GZIP", "DEFLATE", "ZLIB", "NONE", "AUTO")

# What marks base64 text, and the first bytes of each container.
MIN_BASE64_LENGTH = 16
BASE64_PATTERN = r"^[A-Za-z0-9+/\-_]+={0,2}$"
GZIP_MAGIC = "1F8B"
ZLIB_MAGICS = ("7801", "785E", "789C", "78DA")

DECODED = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("value", "error_class", "error_message")]
)

STRICT_BASE64 = re.compile(r"[A-Za-z0-9+/]*(={0,2})", re.ASCII)
URL_OR_STRICT = re.compile(r"[A-Za-z0-9+/\-_]+={0,2}", re.ASCII)
BLANKS = "".join(map(chr, range(33)))


def check_format(name: str) -> str:
    upper = name.upper()
    if upper not in FORMATS:
        raise ValueError(f"unknown compression format {name!r}")
    return upper


# --- native columns -------------------------------------------------------------


def is_likely_base64(col: Column) -> Column:
    """Long enough and made of base64 letters only, ends trimmed of control blanks."""
    trimmed = F.regexp_replace(col, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    test = (F.length(trimmed) >= MIN_BASE64_LENGTH) & trimmed.rlike(BASE64_PATTERN)
    return F.coalesce(test, F.lit(False))


def detect_compression(data: Column) -> Column:
    """GZIP, ZLIB or NONE from the first two bytes of a binary column."""
    magic = F.hex(F.substring(data, 1, 2))
    return (
        F.when(magic == GZIP_MAGIC, F.lit("GZIP"))
        .when(magic.isin(*ZLIB_MAGICS), F.lit("ZLIB"))
        .otherwise(F.lit("NONE"))
    )


def base64_bytes(col: Column) -> Column:
    """Bytes of a text in the standard base64 alphabet, padding whole or left off; null for
    any other text: another alphabet, blanks anywhere, a length that no bytes have."""
    plain = F.rtrim(col, F.lit("="))
    pad, rest = F.length(col) - F.length(plain), F.length(plain) % 4
    fits = col.rlike(r"\A[A-Za-z0-9+/]*={0,2}\z") & (rest != 1) & ((pad == 0) | (rest + pad == 4))
    whole = F.rpad(plain, (F.length(plain) + 3 - (F.length(plain) + 3) % 4).cast("int"), "=")
    return F.when(fits, F.unbase64(whole))


def may_be_compressed(col: Column, fmt: str, try_base64: bool) -> Column:
    """Whether ``decompress`` could change or reject the text. Texts that cannot
    be compressed are kept away from the Python worker."""
    if fmt == "NONE":
        return F.lit(False)
    if fmt != "AUTO":
        return F.coalesce(F.length(col) > 0, F.lit(False))
    looks_inflatable = F.coalesce(
        detect_compression(F.substring(col, 1, 2).cast("binary")) != "NONE", F.lit(False)
    )
    return (is_likely_base64(col) | looks_inflatable) if try_base64 else looks_inflatable


# --- per-value helpers used inside the Arrow UDFs ---------------------------------


def strict_base64(text: str) -> bytes | None:
    """Bytes of standard base64 (padding may be left off entirely), else None."""
    match = STRICT_BASE64.fullmatch(text)
    if match is None:
        return None
    pad = len(match.group(1))
    rest = (len(text) - pad) % 4
    if rest == 1 or (pad and rest + pad != 4):
        return None
    return binascii.a2b_base64(text + "=" * (-len(text) % 4))


def sniff(data: bytes) -> str:
    magic = data[:2].hex().upper()
    return "GZIP" if magic == GZIP_MAGIC else "ZLIB" if magic in ZLIB_MAGICS else "NONE"


def inflate(data: bytes, fmt: str) -> bytes:
    """Inflate a whole buffer; a stream that stops early is an error. Gzip may
    hold several members, and bytes after the last one are ignored."""
    if not data or fmt == "NONE":
        return data
    wbits = 31 if fmt == "GZIP" else 15
    out, rest = [], data
    while True:
        stream = zlib.decompressobj(wbits)
        out.append(stream.decompress(rest))
        if not stream.eof:
            raise zlib.error("unexpected end of compressed stream")
        rest = stream.unused_data
        if fmt != "GZIP" or sniff(rest) != "GZIP":
            return b"".join(out)


def inflate_text(text: str, fmt: str, try_base64: bool) -> str:
    raw = None
    if try_base64:
        trimmed = text.strip(BLANKS)
        if len(trimmed) >= MIN_BASE64_LENGTH and URL_OR_STRICT.fullmatch(trimmed):
            raw = strict_base64(text)
    if raw is None:
        raw = text.encode("utf-8")
    found = sniff(raw) if fmt == "AUTO" else fmt
    return text if found == "NONE" else inflate(raw, found).decode("utf-8", "replace")


def inflate_object(data: bytes, fmt: str, try_base64: bool) -> str:
    """Object content: compressed bytes are inflated as they are, anything else
    goes the text route."""
    found = sniff(data)
    if found != "NONE" and fmt in ("AUTO", found) or (found == "ZLIB" and fmt == "DEFLATE"):
        return inflate(data, found).decode("utf-8", "replace")
    text = data.decode("utf-8", "replace")
    return inflate_text(text, fmt, try_base64) if text else text


# A token no document can hold by chance: it tags numbers written in the JVM's form.
MARK = f"\ue000{uuid.uuid4().hex}"
MARKED = re.compile(f'"{MARK}([^"]*){MARK}"')


def _float(text: str):
    """Floats whose usual shortest text differs between Python and the JVM are
    carried as marked text in the JVM's form (``1.0E20``)."""
    number = float(text)
    if number == 0 or 1e-3 <= abs(number) < 1e7:
        return number
    if number in (float("inf"), float("-inf")):
        raise ValueError("number out of range")
    digits, _, power = f"{number!r}".partition("e")
    sign = "-" if digits.startswith("-") else ""
    whole, _, fraction = digits.lstrip("-").partition(".")
    exponent = int(power or 0) + len(whole) - 1
    figures = (whole + fraction).lstrip("0")
    if whole == "0":
        exponent = int(power or 0) - (len(fraction) - len(fraction.lstrip("0"))) - 1
    figures = figures.rstrip("0") or "0"
    return f"{MARK}{sign}{figures[0]}.{figures[1:] or '0'}E{exponent}{MARK}"


def _reject(name: str):
    raise ValueError(f"{name} is not JSON")


def read_json(text: str):
    try:
        return json.loads(text, parse_float=_float, parse_constant=_reject)
    except RecursionError as error:
        raise ValueError("nested too deeply") from error


def write_json(value) -> str:
    text = json.dumps(value, separators=(",", ":"), ensure_ascii=False)
    if MARK in text:
        text = MARKED.sub(r"\1", text)
    return text.encode("utf-8", "replace").decode("utf-8")


def find_parent(document, parts: list[str]):
    """The object that holds the last name of the path, when its value is text."""
    node = document
    for name in parts[:-1]:
        if not isinstance(node, dict) or name not in node:
            return None
        node = node[name]
    if not isinstance(node, dict) or not isinstance(node.get(parts[-1]), str):
        return None
    return None if node[parts[-1]].startswith(MARK) else node


def json_or_text(text: str):
    try:
        return read_json(text)
    except ValueError:
        return text


# --- Arrow UDFs -------------------------------------------------------------------


def give_back() -> None:
    """Return what the batch before used to the system: bodies of all lengths leave gaps that
    a worker would keep to its end."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not every C library has it
        pass


def _results(values, work) -> pd.DataFrame:
    give_back()
    rows = []
    for value in values:
        try:
            rows.append((work(value), None, None))
        except zlib.error as error:
            rows.append((None, "DecompressionError", f"Decompression failed: {error}"))
        except (ValueError, RecursionError) as error:
            rows.append((None, "JsonError", f"Invalid JSON: {error}"))
    return pd.DataFrame(rows, columns=["value", "error_class", "error_message"], dtype=object)


def decode_text(col: Column, fmt: str = "AUTO", try_base64: bool = True) -> Column:
    """Struct of the decompressed text or the error. Null in, null value out."""
    fmt = check_format(fmt)

    @F.pandas_udf(DECODED)
    def decode(texts: pd.Series) -> pd.DataFrame:
        return _results(texts, lambda t: inflate_text(t, fmt, try_base64) if t else None)

    sent = F.when(may_be_compressed(col, fmt, try_base64), col)
    result = decode(sent)
    return F.struct(
        F.when(result["error_class"].isNull(), F.coalesce(result["value"], col)).alias("value"),
        result["error_class"].alias("error_class"),
        result["error_message"].alias("error_message"),
    )


def decode_object(data: Column, fmt: str | None = None, try_base64: bool = True) -> Column:
    """Struct of an object's content as text, decompressed when ``fmt`` is given."""
    if fmt is None:
        return F.struct(
            F.make_valid_utf8(data.cast("string")).alias("value"),
            F.lit(None).cast("string").alias("error_class"),
            F.lit(None).cast("string").alias("error_message"),
        )
    fmt = check_format(fmt)

    @F.pandas_udf(DECODED)
    def decode(blobs: pd.Series) -> pd.DataFrame:
        return _results(
            blobs, lambda b: None if b is None else inflate_object(bytes(b), fmt, try_base64)
        )

    return decode(data)


def decode_leaf(body: Column, parts: list[str], fmt: str, try_base64: bool) -> Column:
    """Struct of the body with the text leaf at ``parts`` decompressed and put
    back as JSON, or as text where it is not JSON."""
    fmt = check_format(fmt)

    def work(text):
        if not text:
            return text
        document = read_json(text)
        parent = find_parent(document, parts)
        if parent is None:
            return text
        leaf = parent[parts[-1]]
        plain = inflate_text(leaf, fmt, try_base64) if leaf else leaf
        parent[parts[-1]] = json_or_text(plain)
        return write_json(document)

    @F.pandas_udf(DECODED)
    def decode(bodies: pd.Series) -> pd.DataFrame:
        return _results(bodies, work)

    return decode(body)


LEAF_STATE = T.StructType(
    [
        T.StructField("present", T.BooleanType()),
        T.StructField("direct", T.BooleanType()),
        T.StructField("address", T.StringType()),
        T.StructField("plain", T.StringType()),
        T.StructField("error_class", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)


def inspect_leaf(
    body: Column, parts: list[str], fmt: str, try_base64: bool, scheme: str
) -> Column:
    """Struct about the text leaf at ``parts``: whether there is one, its
    decompressed text, and the object address that the leaf is (``direct``) or
    that was packed in it."""
    fmt = check_format(fmt)

    def address(text: str) -> str | None:
        trimmed = text.strip(BLANKS)
        return trimmed if trimmed.startswith(scheme) and len(trimmed) > len(scheme) else None

    def work(text):
        parent = find_parent(read_json(text), parts) if text else None
        if parent is None:
            return (False, False, None, None)
        leaf = parent[parts[-1]]
        found = address(leaf)
        if found:
            return (True, True, found, None)
        plain = inflate_text(leaf, fmt, try_base64) if leaf else leaf
        return (True, False, address(plain), plain)

    @F.pandas_udf(LEAF_STATE)
    def inspect(bodies: pd.Series) -> pd.DataFrame:
        results = _results(bodies, work)
        states = [v if v is not None else (False, False, None, None) for v in results["value"]]
        out = pd.DataFrame(states, columns=["present", "direct", "address", "plain"], dtype=object)
        return out.assign(
            error_class=results["error_class"], error_message=results["error_message"]
        )

    return inspect(body)


def replace_leaf(body: Column, parts: list[str], leaf: Column, as_json: bool) -> Column:
    """Struct of the body with its text leaf at ``parts`` set to ``leaf`` (kept
    where that is null), as JSON where it parses if ``as_json``, else as text."""

    def work(pair):
        text, new = pair
        if not text:
            return text
        document = read_json(text)
        parent = find_parent(document, parts)
        if parent is None:
            return text
        value = parent[parts[-1]] if new is None else new
        parent[parts[-1]] = json_or_text(value) if as_json else value
        return write_json(document)

    @F.pandas_udf(DECODED)
    def replace(bodies: pd.Series, leaves: pd.Series) -> pd.DataFrame:
        return _results(zip(bodies, leaves), work)

    return replace(body, leaf)
