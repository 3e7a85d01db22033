"""Canonical JSON, content identities and keyed pseudonyms as native expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def lower_escapes(text: Column) -> Column:
    """VARIANT prints control characters in upper-case hex; they are brought to lower case."""
    out = text
    for code in [*range(8), 11, *range(14, 32)]:
        if f"{code:04X}" != f"{code:04x}":
            out = F.replace(out, F.lit(f"\\u{code:04X}"), F.lit(f"\\u{code:04x}"))
    return F.when(F.contains(text, F.lit("\\u00")), out).otherwise(text)


def canonical_json(doc: Column) -> Column:
    """Sorted keys, no spaces, UTF-8 unescaped. Null for text that is not JSON or repeats a key."""
    return F.get(F.transform(F.array(F.to_json(F.try_parse_json(doc))), lower_escapes), F.lit(0))  # the text is made once


def sha(text: Column) -> Column:
    return F.sha2(text, 256)


def identity(prefix: str, fields: Mapping[str, Column]) -> Column:
    """``prefix`` + sha256 of the canonical JSON of flat fields, nulls kept."""
    doc = F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})
    return F.concat(F.lit(prefix), sha(doc))


def namespaced(namespace: str, value: Column) -> Column:
    """sha256 of namespace, a zero byte and the value: equal values of different kinds never meet."""
    return sha(F.concat(F.lit(namespace), F.char(F.lit(0)), value))


def hmac_sha256(key: bytes, value: Column) -> Column:
    """HMAC-SHA256 with both padded keys as literals, so no row leaves the JVM."""
    if len(key) < 32:
        raise ValueError("a pseudonym key has 32 bytes or more")
    import hashlib

    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(value, "UTF-8")), 256))), 256)


def pseudonym(kind: str, key: bytes, value: Column) -> Column:
    """A keyed token such as ``repository_`` or ``path_`` and the HMAC; null stays null."""
    return F.concat(F.lit(kind), hmac_sha256(key, value))


def distinct_keys(*keys: bytes) -> None:
    if len(set(keys)) != len(keys):
        raise ValueError("pseudonym keys of different kinds must differ")


def _compose(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def nfc(text: Column) -> Column:
    """Canonical composition; only texts beyond ASCII reach Python."""
    wide = text.rlike(r"[^\x00-\x7F]")
    return F.when(wide, F.pandas_udf(_compose, StringType())(F.when(wide, text))).otherwise(text)  # Python is sent nulls for the others


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) == "", None).otherwise(text)


def ratio(part: Column, whole: Column, places: int = 12) -> Column:
    """``part / whole`` to ``places``; null if the whole is 0."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), places)


def path_safe(text: Column) -> Column:
    """A file-name component: other characters than letters, digits, ``._-`` become ``_``; at most 120, never empty.

    A short hash of the raw value keeps two values apart that would read the same.
    """
    safe = F.left(F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", ""), F.lit(120))
    return F.concat(F.when(safe == "", "unknown").otherwise(safe), F.lit("-"), F.left(sha(text), F.lit(8)))


def semver_key(version: Column) -> Column:
    """A sortable (major, minor, patch) of a version text; null if it isn't one."""
    part = lambda k: F.regexp_extract(version, r"^(\d+)\.(\d+)\.(\d+)$", k).cast("int")
    return F.when(version.rlike(r"^\d+\.\d+\.\d+$"), F.struct(part(1).alias("major"), part(2).alias("minor"), part(3).alias("patch")))
