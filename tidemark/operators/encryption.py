"""Field encryption with Spark's AES functions (GCM, random IV per value).

Sensitive columns are found by name or pattern, in nested structs and arrays of
structs too. A ciphertext is text with a prefix, so encrypted and plain values
can share a column. Set ``spark.sql.redaction.string.regex`` where plans are
logged, as key material is part of the expressions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: marks a ciphertext.
PREFIX = "encrypted:"


def _sensitive(name: str, names: Sequence[str], patterns: Sequence[str]) -> bool:
    return name.lower() in {n.lower() for n in names} or any(
        re.match(p, name, re.IGNORECASE) for p in patterns
    )


def _as_text(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StructType, T.MapType, T.ArrayType)):
        return F.to_json(col)
    return col.cast("string")


def encrypt_value(text: Column, key: Column) -> Column:
    """Ciphertext of a text; null stays null."""
    sealed = F.base64(F.aes_encrypt(F.encode(text, "UTF-8"), key, F.lit("GCM")))
    return F.when(text.isNotNull(), F.concat(F.lit(PREFIX), sealed))


def decrypt_value(text: Column, key: Column) -> Column:
    """Plain text of a ciphertext, null when it cannot be opened; other text as it is."""
    body = F.try_to_binary(F.substring(text, len(PREFIX) + 1, 2147483647), F.lit("base64"))
    opened = F.try_aes_decrypt(body, key, F.lit("GCM")).cast("string")
    return F.when(text.startswith(PREFIX), opened).otherwise(text)


def is_encrypted(text: Column) -> Column:
    return F.coalesce(text.startswith(PREFIX), F.lit(False))


def _encrypt_fields(col: Column, kind: T.DataType, key, names, patterns) -> Column:
    """Rebuild a struct, or an array of structs, with its sensitive fields encrypted."""
    if isinstance(kind, T.StructType):
        rebuilt = F.struct(
            *[
                _encrypt_one(f.name, col[f.name], f.dataType, key, names, patterns).alias(f.name)
                for f in kind.fields
            ]
        )
        return F.when(col.isNotNull(), rebuilt)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return F.transform(col, lambda e: _encrypt_fields(e, kind.elementType, key, names, patterns))
    return col


def _encrypt_one(name, col, kind, key, names, patterns) -> Column:
    if _sensitive(name, names, patterns):
        return encrypt_value(_as_text(col, kind), key)
    return _encrypt_fields(col, kind, key, names, patterns)


def encrypt_fields(
    df: DataFrame, key: Column, names: Sequence[str] = (), patterns: Sequence[str] = ()
) -> DataFrame:
    """Encrypt every sensitive field; encrypted ones become text."""
    return df.select(
        *[
            _encrypt_one(f.name, F.col(f"`{f.name}`"), f.dataType, key, names, patterns).alias(f.name)
            for f in df.schema.fields
        ]
    )


def _opened(text: Column, key: Column) -> Column:
    """Plain text of a ciphertext; one that cannot be opened stays as it is."""
    return F.coalesce(decrypt_value(text, key), text)


def _decrypt_nested(col: Column, kind: T.DataType, key: Column) -> Column:
    if isinstance(kind, T.StringType):
        return _opened(col, key)
    if isinstance(kind, T.StructType):
        rebuilt = F.struct(*[_decrypt_nested(col[f.name], f.dataType, key).alias(f.name) for f in kind.fields])
        return F.when(col.isNotNull(), rebuilt)
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda e: _decrypt_nested(e, kind.elementType, key))
    return col


def _closed(col: Column, kind: T.DataType, path: str) -> list[tuple[str, Column]]:
    """Paths of the text fields below ``col``, with whether a ciphertext is left there."""
    if isinstance(kind, T.StringType):
        return [(path, is_encrypted(col))]
    if isinstance(kind, T.StructType):
        return [x for f in kind.fields for x in _closed(col[f.name], f.dataType, f"{path}.{f.name}")]
    if isinstance(kind, T.ArrayType):
        below = _closed(F.lit(None).cast(kind.elementType), kind.elementType, path)

        def left(n: int) -> Column:
            return F.coalesce(F.exists(col, lambda e: _closed(e, kind.elementType, path)[n][1]), F.lit(False))

        return [(name, left(n)) for n, (name, _) in enumerate(below)]
    return []


def decrypt_fields(df: DataFrame, key: Column) -> DataFrame:
    """Open every ciphertext in text columns, structs and arrays.

    One that the key cannot open stays; ``decrypt_errors`` has its path (``contact.phone``,
    without positions in arrays).
    """
    opened = df.select(
        *[_decrypt_nested(F.col(f"`{f.name}`"), f.dataType, key).alias(f.name) for f in df.schema.fields]
    )
    paths = [x for f in df.schema.fields for x in _closed(F.col(f"`{f.name}`"), f.dataType, f.name)]
    errors = F.array_compact(F.array(*[F.when(left, F.lit(path)) for path, left in paths]))
    return opened.withColumn("decrypt_errors", errors if paths else F.array().cast("array<string>"))


@dataclass(frozen=True)
class KeyInfo:
    key_id: str
    active: bool = True
    expires_at: datetime | None = None

    def usable(self, now: datetime | None = None) -> bool:
        moment = now or datetime.now(timezone.utc)
        return self.active and (self.expires_at is None or moment < self.expires_at)


def rotate_key(
    df: DataFrame, columns: Sequence[str], old_key: Column, new_key: Column, info: KeyInfo, now=None
) -> DataFrame:
    """Re-encrypt ciphertext columns under a new key in one projection.

    Refuses an inactive or expired new key. Values the old key cannot open are
    left as they are and named in ``rotate_errors``.
    """
    if not info.usable(now):
        raise ValueError(f"key {info.key_id} is inactive or expired")
    renewed, faults = {}, []
    for name in columns:
        held = F.col(name)
        opened = decrypt_value(held, old_key)
        stuck = is_encrypted(held) & opened.isNull()
        renewed[name] = F.when(is_encrypted(held) & ~stuck, encrypt_value(opened, new_key)).otherwise(held)
        faults.append(F.when(stuck, F.lit(name)))
    return df.withColumns(
        {**renewed, "key_id": F.lit(info.key_id), "rotate_errors": F.array_compact(F.array(*faults))}
    )
