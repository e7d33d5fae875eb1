"""Digests and AES-256-GCM payload columns; keys come from a table, never from code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def encrypt(plain: Column, key: Column) -> Column:
    """base64 of IV, ciphertext and tag; null stays null. A new IV each time, so store the result before using it twice."""
    return F.base64(F.aes_encrypt(plain.cast("binary"), key, F.lit("GCM")))


def decrypt(cipher: Column, key: Column) -> Column:
    return F.aes_decrypt(F.unbase64(cipher), key, F.lit("GCM")).cast("string")


def try_decrypt(cipher: Column, key: Column) -> Column:
    """null where the key doesn't fit or the text is no ciphertext."""
    return F.try_aes_decrypt(F.unbase64(cipher), key, F.lit("GCM")).cast("string")


def with_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` plus the column ``dek`` of their key_id; a missing key raises when a row that needs it is read."""
    joined = rows.join(keys.select("key_id", "dek"), "key_id", "left")
    missing = F.raise_error(F.concat(F.lit("no key "), F.col("key_id"))).cast("binary")
    return joined.withColumn("dek", F.when(F.col("dek").isNotNull(), F.col("dek")).otherwise(missing))


def decrypted(rows: DataFrame, keys: DataFrame, column: str = "payload") -> DataFrame:
    """``rows`` with the payload in plain text, each row by its own key."""
    return with_keys(rows, keys).withColumn(column, decrypt(F.col(column), F.col("dek"))).drop("dek")


def encrypted(rows: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    out = with_keys(rows, keys)
    for column in columns:
        out = out.withColumn(column, encrypt(F.col(column), F.col("dek")))
    return out.drop("dek")
