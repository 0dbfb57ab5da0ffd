"""The 64-bit Farm fingerprint of strings, as warehouses compute it, for whole Arrow batches.

Strings of one length class (up to 3, 7, 16, 32, 64 bytes, longer) go through the arithmetic of that class together, a vector
operation per step; long strings take a step per 64 bytes, with the strings that still have them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from clipquarry.functions.columns import col

U = np.uint64
# The published multipliers of the hash.
K0, K1, K2 = U(0xC3A5C85C97CB3127), U(0xB492B66FBE98F273), U(0x9AE16A3B2F90404F)
SEED = U(81)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> U(n)) | (x << U(64 - n))


def _shift(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> U(47))


def _two(u: np.ndarray, v: np.ndarray, mul: np.ndarray) -> np.ndarray:
    return _shift((v ^ _shift((u ^ v) * mul)) * mul) * mul


class _Bytes:
    """Little-endian words at places of a buffer."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = np.concatenate((data, np.zeros(8, np.uint8)))

    def word(self, at: np.ndarray, size: int = 8) -> np.ndarray:
        picked = np.ascontiguousarray(self.data[at[:, None] + np.arange(size)])
        return picked.view(f"<u{size}")[:, 0].astype(U)


def _tiny(s: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    a, b, c = (s.data[at + k].astype(U) for k in (0 * n, n >> 1, n - 1))
    return _shift((a + (b << U(8))) * K2 ^ (n.astype(U) + (c << U(2))) * K0) * K2


def _to_7(s: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    size = n.astype(U)
    return _two(size + (s.word(at, 4) << U(3)), s.word(at + n - 4, 4), K2 + size * U(2))


def _to_16(s: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    mul = K2 + n.astype(U) * U(2)
    a, b = s.word(at) + K2, s.word(at + n - 8)
    return _two(_turn(b, 37) * mul + a, (_turn(a, 25) + b) * mul, mul)


def _ends(s: _Bytes, at: np.ndarray, n: np.ndarray, first: np.uint64) -> tuple[np.ndarray, ...]:
    """What strings of 17 to 64 bytes make of their first and last 16: the multiplier, the first word, and both sums."""
    mul = K2 + n.astype(U) * U(2)
    a, b = s.word(at) * first, s.word(at + 8)
    c, d = s.word(at + n - 8) * mul, s.word(at + n - 16) * K2
    return mul, a, _turn(a + b, 43) + _turn(c, 30) + d, a + _turn(b + K2, 18) + c


def _to_32(s: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    mul, _, one, other = _ends(s, at, n, K1)
    return _two(one, other, mul)


def _to_64(s: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    mul, a, y, other = _ends(s, at, n, K2)
    z = _two(y, other, mul)
    e, f = s.word(at + 16) * mul, s.word(at + 24)
    g, h = (y + s.word(at + n - 32)) * mul, (z + s.word(at + n - 24)) * mul
    return _two(_turn(e + f, 43) + _turn(g, 30) + h, e + _turn(f + a, 18) + g, mul)


def _weak(s: _Bytes, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w, x, y, z = (s.word(at + k) for k in (0, 8, 16, 24))
    a = a + w
    b, whole = _turn(b + a + z, 21), a + x + y
    return whole + z, b + _turn(whole, 44) + a


def _long(s: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    y = np.full(len(n), SEED * K1 + U(113))
    z = _shift(y * K2 + U(113)) * K2
    x = SEED * K2 + s.word(at)
    v0, v1, w0, w1 = (np.zeros(len(n), U) for _ in range(4))

    def step(x, y, z, v0, v1, w0, w1, p, mul, nine):
        x = _turn(x + y + v0 + s.word(p + 8), 37) * mul
        y = _turn(y + v1 + s.word(p + 48), 42) * mul
        x = x ^ w1 * nine
        y = y + v0 * nine + s.word(p + 40)
        z = _turn(z + w0, 33) * mul
        v0, v1 = _weak(s, p, v1 * mul, x + w0)
        w0, w1 = _weak(s, p + 32, z + w1, y + s.word(p + 16))
        return z, y, x, v0, v1, w0, w1

    state = [x, y, z, v0, v1, w0, w1]
    blocks = (n - 1) // 64
    for k in range(int(blocks.max())):
        on = np.flatnonzero(blocks > k)
        made = step(*(c[on] for c in state), at[on] + 64 * k, K1, U(1))
        for c, new in zip(state, made):
            c[on] = new
    x, y, z, v0, v1, w0, w1 = state
    mul = K1 + ((z & U(0xFF)) << U(1))
    w0 = w0 + ((n - 1) & 63).astype(U)
    v0 = v0 + w0
    w0 = w0 + v0
    x, y, z, v0, v1, w0, w1 = step(x, y, z, v0, v1, w0, w1, at + n - 64, mul, U(9))
    return _two(_two(v0, w0, mul) + _shift(y) * K0 + z, _two(v1, w1, mul) + x, mul)


_CLASSES = ((1, 3, _tiny), (4, 7, _to_7), (8, 16, _to_16), (17, 32, _to_32), (33, 64, _to_64), (65, None, _long))


def fingerprints(strings: pa.Array) -> pa.Array:
    """Signed 64-bit fingerprints of the UTF-8 bytes; null for null."""
    plain = strings.cast(pa.string()).fill_null("")
    _, offsets, data = plain.buffers()
    stops = np.frombuffer(offsets, np.int32)[plain.offset:plain.offset + len(plain) + 1].astype(np.int64) if len(plain) else np.zeros(1, np.int64)
    s, at, n = _Bytes(np.frombuffer(data or b"", np.uint8)), stops[:-1], np.diff(stops)
    out = np.full(len(n), K2)  # that of the empty string
    with np.errstate(over="ignore"):
        for least, most, rule in _CLASSES:
            on = np.flatnonzero((n >= least) & (n <= (most or n)))
            if on.size:
                out[on] = rule(s, at[on], n[on])
    return pa.array(out.view(np.int64), mask=np.asarray(strings.is_null()))


def farm_fingerprint(text: Column | str) -> Column:
    return F.arrow_udf(fingerprints, "bigint")(col(text))


def farm_bucket(text: Column | str, n: int = 20, signed: bool = False) -> Column:
    """Bucket 0 to n-1 by the fingerprint; ``signed`` keeps the sign of the remainder, as a warehouse's MOD does, which
    makes up to 2n-1 buckets."""
    fingerprint = farm_fingerprint(text)
    return (fingerprint % n if signed else F.pmod(fingerprint, F.lit(n))).cast("int")
