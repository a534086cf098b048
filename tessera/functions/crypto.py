"""Hashing, signatures and encryption as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = {256: 64, 1: 64}


def _digest(data: Column, bits: int) -> Column:
    return F.unhex(F.sha1(data)) if bits == 1 else F.unhex(F.sha2(data, 256))


def hmac_hex(key: str, message: Column, bits: int = 256) -> Column:
    """RFC 2104 HMAC (SHA-256 or SHA-1) of a binary/string column, as lower-case hex.

    ``H((K ^ opad) || H((K ^ ipad) || m))`` with the key padded to the block size;
    the pads are built from the literal key on the driver, the hashing runs in
    the JVM per row.
    """
    block = _BLOCK[bits]
    k = key.encode("utf-8")
    if len(k) > block:
        import hashlib

        k = (hashlib.sha1 if bits == 1 else hashlib.sha256)(k).digest()
    k = k.ljust(block, b"\0")
    ipad = bytes(b ^ 0x36 for b in k).hex()
    opad = bytes(b ^ 0x5C for b in k).hex()
    inner = _digest(F.concat(F.unhex(F.lit(ipad)), message.cast("binary")), bits)
    outer = F.concat(F.unhex(F.lit(opad)), inner)
    return F.sha1(outer) if bits == 1 else F.sha2(outer, 256)


def verify_body_signature(secret: str | None, body: Column, signature: Column) -> Column:
    """P23 (e-mail): HMAC-SHA256 of the raw body; no secret configured -> pass."""
    if not secret:
        return F.lit(True)
    return F.coalesce(hmac_hex(secret, body, 256) == F.lower(signature), F.lit(False))


def form_signature_message(url: Column, params: Column) -> Column:
    """URL followed by the url-encoded, key-sorted form parameters (``k=v&k=v``)."""
    sorted_entries = F.array_sort(F.map_entries(params))
    enc = F.transform(
        sorted_entries,
        lambda e: F.concat(F.url_encode(e["key"]), F.lit("="), F.url_encode(F.coalesce(e["value"], F.lit("")))),
    )
    return F.concat(url, F.array_join(enc, "&"))


def verify_form_signature(token: str | None, url: Column, params: Column, signature: Column) -> Column:
    """P23 (chat): HMAC-SHA1 of url + sorted form params; no token -> pass."""
    if not token:
        return F.lit(True)
    return F.coalesce(hmac_hex(token, form_signature_message(url, params), 1) == F.lower(signature), F.lit(False))


def dedup_key(channel: str | Column, profile_id: Column, payload: Column) -> Column:
    """sha256 of ``channel:profile:canonical payload``.

    The payload is a MAP; its canonical form is the JSON of its entries sorted
    by key (our own stable encoding, not Python's ``repr``).
    """
    ch = F.lit(channel) if isinstance(channel, str) else channel
    canon = F.to_json(F.array_sort(F.map_entries(payload)))
    return F.sha2(F.concat_ws(":", ch, profile_id, canon), 256)


def pseudonymise(value: Column, salt: str) -> Column:
    """keyed one-way id (sha256 of salt + value)."""
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)


def encrypt_pii(value: Column, key: str) -> Column:
    """AES-GCM encryption with a caller-supplied 16/24/32-byte key, base64 text."""
    return F.base64(F.aes_encrypt(value.cast("binary"), F.lit(key)))


def decrypt_pii(value: Column, key: str) -> Column:
    return F.try_aes_decrypt(F.unbase64(value), F.lit(key)).cast("string")
