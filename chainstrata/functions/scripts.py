"""Locking scripts: class, address, and address families."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# Alphabets and checksum constants of the public address formats.
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
BECH32_FINAL = 1
BECH32M_FINAL = 0x2BC830A3
HUMAN_PART = "bc"

# Address families by leading characters.
ADDRESS_FAMILIES = (
    ("1", "P2PKH (Legacy)"),
    ("3", "P2SH (SegWit)"),
    ("bc1", "Bech32 (Native)"),
)
OTHER_FAMILY = "P2PK (Satoshi)"


def script_class(script_hex: Column) -> Column:
    """Class of a locking script by its byte pattern; null when none applies."""
    text = F.lower(script_hex)
    size = F.length(text)
    return (
        F.when((size == 50) & text.startswith("76a9") & text.endswith("88ac"), "p2pkh")
        .when((size == 46) & text.startswith("a9") & text.endswith("87"), "p2sh")
        .when((size == 44) & text.startswith("0014"), "p2wpkh")
        .when((size == 68) & text.startswith("0020"), "p2wsh")
        .when((size == 68) & text.startswith("5120"), "p2tr")
    )


def payload_hex(script_hex: Column) -> Column:
    """The hash or key part a standard script pays to, null for other scripts.

    Legacy classes already carry their version byte and checksum here, computed
    with the JVM's sha2, so the Python step only changes the number base.
    """
    text, kind = F.lower(script_hex), script_class(script_hex)
    body = (
        F.when(kind == "p2pkh", F.concat(F.lit("00"), F.substring(text, 7, 40)))
        .when(kind == "p2sh", F.concat(F.lit("05"), F.substring(text, 5, 40)))
        .when(kind.isin("p2wpkh", "p2wsh", "p2tr"), F.substring(text, 5, 64))
    )
    body = F.when(body.rlike("^[0-9a-f]+$"), body)
    digest = F.sha2(F.unhex(F.sha2(F.unhex(body), 256)), 256)
    return F.when(kind.isin("p2pkh", "p2sh"), F.concat(body, F.substring(digest, 1, 8))).otherwise(body)


def _base58(raw: np.ndarray) -> np.ndarray:
    """Rows of 25 bytes to base 58, all rows at once: long division of 32-bit limbs by 58^5."""
    padded = np.zeros((len(raw), 28), np.uint8)
    padded[:, 3:] = raw
    limbs = padded.view(">u4").astype(np.uint64)
    digits = np.zeros((len(raw), 35), np.uint8)
    for group in range(6, -1, -1):
        rest = np.zeros(len(raw), np.uint64)
        for i in range(limbs.shape[1]):
            rest = rest << np.uint64(32) | limbs[:, i]
            limbs[:, i], rest = rest // np.uint64(58**5), rest % np.uint64(58**5)
        for place in range(4, -1, -1):
            digits[:, group * 5 + place] = rest % np.uint64(58)
            rest //= np.uint64(58)
    text = np.frombuffer(BASE58.encode(), np.uint8)[digits].view("S35").ravel().astype(str)
    zero_bytes = (np.cumsum(raw != 0, axis=1) == 0).sum(axis=1)
    zero_digits = (np.cumsum(digits != 0, axis=1) == 0).sum(axis=1)
    return np.array([t[d - z:] for t, d, z in zip(text, zero_digits, zero_bytes)], dtype=object)


def _bech32(version: int, program: np.ndarray) -> np.ndarray:
    """Rows of equal-length programs to the checksummed five-bit form, all rows at once."""
    rows, size = program.shape
    width = -(-size * 8 // 5)
    bits = np.zeros((rows, width * 5), np.uint8)
    bits[:, :size * 8] = np.unpackbits(program, axis=1)
    words = bits.reshape(rows, width, 5) @ np.array([16, 8, 4, 2, 1], np.int64)
    words = np.concatenate([np.full((rows, 1), version), words], axis=1)
    state = np.ones(rows, np.int64)

    def feed(value) -> None:
        nonlocal state
        top = state >> 25
        state = (state & 0x1FFFFFF) << 5 ^ value
        for i, generator in enumerate(BECH32_GENERATOR):
            state ^= (top >> i & 1) * generator

    for value in [ord(c) >> 5 for c in HUMAN_PART] + [0] + [ord(c) & 31 for c in HUMAN_PART]:
        feed(value)
    for column in words.T:
        feed(column)
    for _ in range(6):
        feed(0)
    state ^= BECH32M_FINAL if version else BECH32_FINAL
    checksum = np.stack([state >> 5 * (5 - i) & 31 for i in range(6)], axis=1)
    every = np.concatenate([words, checksum], axis=1)
    letters = np.frombuffer(BECH32.encode(), np.uint8)[every]
    return np.char.add(HUMAN_PART + "1", letters.view(f"S{every.shape[1]}").ravel().astype(str)).astype(object)


@F.pandas_udf(StringType())
def _encode_batches(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for kinds, payloads in batches:
        out = pd.Series(None, index=kinds.index, dtype=object)
        for kind, rows in payloads.dropna().groupby(kinds):
            raw = np.frombuffer(bytes.fromhex("".join(rows)), np.uint8).reshape(len(rows), -1)
            legacy = kind in ("p2pkh", "p2sh")
            out[rows.index] = _base58(raw) if legacy else _bech32(1 if kind == "p2tr" else 0, raw)
        yield out


def script_address(script_hex: Column) -> Column:
    """Address of a standard locking script, null for any other.

    Classes, slices and checksums are computed in the JVM; Arrow batches cross
    to Python only for the change of number base, done on whole columns. No
    shuffle is involved, so a script that a third of all outputs pay costs no
    more than any other.
    """
    return _encode_batches(script_class(script_hex), payload_hex(script_hex))


def address_or_outpoint(address: Column, txid: Column, vout: Column) -> Column:
    """Outputs without a derived address stand for themselves as ``txid:vout``."""
    return F.coalesce(address, F.concat_ws(":", txid, vout.cast("string")))


def key_prefix(txid: Column) -> Column:
    """First four hex characters, one of 65,536 layout buckets."""
    return F.substring(txid, 1, 4)


def address_family(address: Column) -> Column:
    label = F.lit(OTHER_FAMILY)
    for start, name in ADDRESS_FAMILIES:
        label = F.when(address.startswith(start), name).otherwise(label)
    return label
