"""Keyed, reproducible random draws.

``draw(seed, salt, k1, k2, ...)`` is a pure function of its keys, so a task that
is re-run after an executor loss recomputes exactly the same values (``rand()``
would not). Two flavours:

* ``md5``    52-bit value from the first 13 hex digits of
  ``md5(concat_ws('|', seed, salt, keys...))``. DuckDB computes the same value,
  so queries built on it have an exact SQL oracle (``draw_sql``).
* ``xxhash`` Spark's ``xxhash64`` masked to 52 bits; several times cheaper,
  Spark only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MASK52 = (1 << 52) - 1


def _as_col(k) -> Column:
    if isinstance(k, Column):
        return k.cast("string")
    if isinstance(k, str) and k.startswith("@"):
        return F.col(k[1:]).cast("string")
    return F.lit(str(k))


def draw(seed, salt: str, *keys, method: str = "md5") -> Column:
    """Uniform 52-bit non-negative BIGINT keyed by (seed, salt, keys).

    Keys are Columns or literals; a string starting with ``@`` names a column.
    """
    parts = [_as_col(seed), F.lit(str(salt))] + [_as_col(k) for k in keys]
    if method == "md5":
        return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("bigint")
    if method == "xxhash":
        return F.xxhash64(*parts).bitwiseAND(F.lit(_MASK52))
    raise ValueError(f"unknown draw method {method!r}")


def draw_sql(seed, salt: str, *key_exprs: str) -> str:
    """DuckDB text computing the same value as ``draw(..., method='md5')``."""
    parts = [f"'{seed}'", f"'{salt}'"] + [f"CAST({k} AS VARCHAR)" for k in key_exprs]
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 13) AS BIGINT)"


def position_draws():
    """``draws(keys, sizes)``: for the positions ``0 .. size - 1`` of every key the draw
    ``md5(key|position)``, one key after the other, as in ``draw``. Keys of up to 34 bytes
    make messages of one MD5 block, which numpy mixes for thousands of positions at once.
    Nested, so that it is shipped by value."""
    import math

    turns = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
    sines = [int(abs(math.sin(i + 1)) * 2 ** 32) for i in range(64)]
    places = [(1, 0), (5, 1), (3, 5), (7, 0)]
    start = [0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476]
    longest, step = 35, 8192

    def mixed(words):
        import numpy as np

        a, b, c, d = (np.full(words.shape[1], x, dtype=np.uint32) for x in start)
        f, t = np.empty_like(a), np.empty_like(a)
        used = words.any(axis=1).tolist()
        for i in range(64):
            kind = i // 16
            if kind == 0:
                np.bitwise_xor(c, d, out=f), np.bitwise_and(f, b, out=f), np.bitwise_xor(f, d, out=f)
            elif kind == 1:
                np.bitwise_xor(b, c, out=f), np.bitwise_and(f, d, out=f), np.bitwise_xor(f, c, out=f)
            elif kind == 2:
                np.bitwise_xor(b, c, out=f), np.bitwise_xor(f, d, out=f)
            else:
                np.invert(d, out=f), np.bitwise_or(f, b, out=f), np.bitwise_xor(f, c, out=f)
            f += a
            f += np.uint32(sines[i])
            times, plus = places[kind]
            word = (times * i + plus) % 16
            if used[word]:
                f += words[word]
            turn = turns[kind][i % 4]
            np.left_shift(f, np.uint32(turn), out=t), np.right_shift(f, np.uint32(32 - turn), out=f)
            f |= t
            f += b
            a, b, c, d, f = d, f, b, c, a
        a += np.uint32(start[0])
        b += np.uint32(start[1])
        high, low = a.byteswap().astype(np.int64), b.byteswap().astype(np.int64)
        return high << 20 | low >> 12

    def tails(n):
        """The digits of 0 .. n - 1 and the byte behind them, as little-endian numbers, and how many digits."""
        import numpy as np

        place = np.arange(n, dtype=np.int64)
        digits = np.ones(n, dtype=np.int64)
        for power in range(1, 7):
            digits += place >= 10 ** power
        tail = np.uint64(0x80) << (digits * 8).astype(np.uint64)
        for back in range(7):
            at = digits - 1 - back
            has = at >= 0
            tail[has] |= (48 + place[has] // 10 ** back % 10).astype(np.uint64) << (at[has] * 8).astype(np.uint64)
        return tail, digits

    def draws(keys, sizes):
        from hashlib import md5

        import numpy as np

        heads = [key.encode() + b"|" for key in keys]
        sizes = np.asarray(sizes, dtype=np.int64)
        ends = np.cumsum(sizes)
        out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
        width = np.array([len(h) for h in heads], dtype=np.int64)
        alone = (width > longest) | (sizes > 10 ** 7)       # more than a block, or than seven digits
        for k in np.nonzero(alone)[0].tolist():
            out[ends[k] - sizes[k]:ends[k]] = [
                int.from_bytes(md5(heads[k] + b"%d" % p, usedforsecurity=False).digest()[:8], "big") >> 12 for p in range(sizes[k])]
        fit = np.nonzero(~alone)[0]
        if not len(fit):
            return out
        # keys of one length at a time: their position begins at one and the same byte
        for wide in np.unique(width[fit]).tolist():
            mine = fit[width[fit] == wide]
            blocks = np.array([heads[k] for k in mine.tolist()], dtype="S64").view("<u4").reshape(-1, 16)
            at, shift = wide // 4, np.uint64(wide % 4 * 8)
            upto = np.cumsum(sizes[mine])
            places = tails(int(sizes[mine].max(initial=0)))
            for begin in range(0, int(upto[-1]), step):
                spot = np.arange(begin, min(begin + step, int(upto[-1])))
                own = np.searchsorted(upto, spot, side="right")
                place = spot - upto[own] + sizes[mine[own]]
                words = np.zeros((16, len(spot)), dtype=np.uint32)
                for i in range(at + 1):
                    words[i] = blocks[own, i]
                tail, digits = places[0][place], places[1][place]
                low = tail << shift
                words[at] |= low.astype(np.uint32)
                words[at + 1] = (low >> np.uint64(32)).astype(np.uint32)
                if shift:
                    words[at + 2] = (tail >> (np.uint64(64) - shift)).astype(np.uint32)
                words[14] = (digits + wide) * 8
                out[ends[mine[own]] - sizes[mine[own]] + place] = mixed(words)
        return out

    return draws
