"""Compression of vectors to product-quantisation codes (operator 11).

Components become whole numbers ``floor(SCALE * x)``; a vector is cut into
``PARTS`` equal parts, each with its own codebook of up to ``ENTRIES`` entries,
started from the vectors of smallest ``vec_id``. ``ROUNDS`` times every part goes
to its nearest entry (squared Euclidean distance, ties to the lower index) and
every entry becomes the floored mean of its parts; then parts are assigned again.

Norm-of-sum bounds. Entries are taken in groups of ``GROUP``. Per part and group a
vector carries a lower bound of its distance to the group's entries (its own entry
left out) and the round in which that bound was made. The codebooks of all rounds
are kept, so a later round lowers the bound by the *net* displacement of the entries
since that round, the norm of the summed moves, which is at most the sum of their
norms that a running bound would lose. Only groups whose bound does not exceed the
exact distance to the vector's own entry are scanned again, exactly, and get a new
bound and stamp. Bounds are rounded down, displacements up, and a group is skipped
only if strictly farther, so every assignment, ties included, is the exact one.

State (parts, codes, bounds, stamps; a row per vector) is written after every round
and the one before it deleted. A task also writes the sums of its parts per entry,
which are added up on Spark; the driver holds codebooks only (``PARTS * ENTRIES``
entries a round, whatever the input).

Defined cases: rows whose vector is null or holds a null or non-finite component
are dropped; shorter vectors are filled up with zeros to the longest, and that to a
multiple of ``PARTS``; components beyond +-2**27 or so after scaling (the exact
limit keeps all sums of squares within 64 bits) are set to that limit; rows with
equal ``vec_id`` are ordered by their components, null ids come last; repeated
rows count each; fewer vectors than ``ENTRIES`` make smaller codebooks; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import broadcast_if_small, deleted, written
from textmill.operators.joins import hot_key_join

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
GROUP = 32
_CELLS = 2_000_000      # distances held at once
_DOWN, _UP = 1 - 1e-5, 1 + 1e-5   # beyond what 32-bit bounds and square roots lose


# ------------------------------------------------------------- task helpers

def _limit(width: int) -> int:
    """Largest component: ``width * (2 * limit) ** 2`` stays below 2**62."""
    return 1 << (60 - max(1, width).bit_length()) // 2


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows by entries)."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * (top + 1) ** 2 < 1 << 53:      # floats are exact, and much quicker
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    out = np.empty((len(x), len(entries)), dtype=np.int64)
    for j, e in enumerate(entries):
        out[:, j] = ((x - e) ** 2).sum(axis=1)
    return out


class Bounds:
    """Assignments of some parts with norm-of-sum bounds per group of entries."""

    def __init__(self, x, code=None, low=None, stamp=None):
        self.x, self.code, self.low, self.stamp = x, code, low, stamp
        self.scanned = 0            # (part, group) pairs whose entries were looked at

    def assign(self, history: list[np.ndarray]) -> np.ndarray:
        """Move to the nearest entries of ``history[-1]``; → exact squared distances."""
        entries, now = history[-1], len(history) - 1
        groups = -(-len(entries) // GROUP)
        fresh = self.code is None
        rows = np.arange(len(self.x))
        if fresh:
            self.code = np.full(len(self.x), -1, dtype=np.int64)
            self.low = np.zeros((len(self.x), groups), dtype=np.float32)
            self.stamp = np.zeros((len(self.x), groups), dtype=np.uint8)
            best = np.full(len(self.x), np.iinfo(np.int64).max)
            need = np.ones((len(self.x), groups), dtype=bool)
        else:
            best = ((self.x - entries[self.code]) ** 2).sum(axis=1)
            lowered = self._lowered(history)
            need = ~(lowered > np.sqrt(best.astype(np.float64))[:, None] * _UP)
        old, own, code = self.code, best.copy(), self.code.copy()
        found = []
        for g in range(groups):
            at = rows[need[:, g]]
            self.scanned += len(at)
            lo = g * GROUP
            d = distances(self.x[at], entries[lo:lo + GROUP])
            first = d.argmin(axis=1)
            least = d[np.arange(len(at)), first]
            d[np.arange(len(at)), first] = np.iinfo(np.int64).max
            second = d.min(axis=1)
            first = first + lo
            better = (least < best[at]) | ((least == best[at]) & (first < code[at]))
            best[at[better]], code[at[better]] = least[better], first[better]
            found.append((at, first, least, second))
        if not fresh:
            moved = code != old
            for g in range(groups):
                # the entry that was left joins the others of its group
                left = rows[moved & (old // GROUP == g) & ~need[:, g]]
                self.low[left, g] = np.minimum(lowered[left, g], np.sqrt(own[left].astype(np.float64))) * _DOWN
                self.stamp[left, g] = now
        for g, (at, first, least, second) in enumerate(found):
            other = np.where(first == code[at], second, least)
            self.low[at, g] = np.sqrt(other.astype(np.float64)) * _DOWN
            self.stamp[at, g] = now
        self.code = code
        return best

    def _lowered(self, history):
        """Bounds less the net displacement since their stamps."""
        entries, groups = history[-1], self.low.shape[1]
        out = np.empty(self.low.shape)
        rows = np.arange(len(self.x))
        pad = groups * GROUP - len(entries)
        for then in np.unique(self.stamp):
            net = np.sqrt(((entries - history[then]).astype(np.float64) ** 2).sum(axis=1)) * _UP
            net = np.append(net, np.zeros(pad)).reshape(groups, GROUP)
            first = net.argmax(axis=1)
            top = net.max(axis=1)
            net[np.arange(groups), first] = 0
            second = net.max(axis=1)
            lowered = self.low.astype(np.float64) - top
            own = self.code // GROUP
            mine = first[own] + own * GROUP == self.code     # the own entry is no concern of the bound
            lowered[rows[mine], own[mine]] = self.low[rows[mine], own[mine]] - second[own[mine]]
            at = self.stamp == then
            out[at] = lowered[at]
        return out


def _matrix(column, kind, width: int) -> np.ndarray:
    """A column of equally long binaries as a table of numbers."""
    if not len(column) or not width:
        return np.zeros((len(column), width), dtype=kind)
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), width)


def _binaries(table: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(table).tobytes()
    step = len(data) // len(table) if len(table) else 0
    return pa.array([data[i * step:(i + 1) * step] for i in range(len(table))], pa.binary())


def whole_numbers(column, dim: int, limit: int) -> np.ndarray:
    """Lists of finite numbers → ``floor(SCALE * x)``, filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.array(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    out = np.zeros((len(column), dim), dtype=np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, at] = np.clip(np.floor(flat * SCALE), -limit, limit).astype(np.int64)
    return out


# --------------------------------------------------------------- Spark stages

def usable(vectors: DataFrame) -> DataFrame:
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & ~bad)


def _sums(part, code, x, entries: int):
    """Rows (part, entry, count, sum) of the entries in use."""
    order = np.argsort(code, kind="stable")
    used, first, n = np.unique(code[order], return_index=True, return_counts=True)
    total = np.add.reduceat(x[order], first, axis=0) if len(used) else x[:0]
    return [(part, int(e), int(k), t) for e, k, t in zip(used, n, total)]


def compress(vectors: DataFrame, parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS, stats: list | None = None) -> DataFrame:
    """(vec_id, label, codes, error, codebooks): ``codes`` binary, a byte per part;
    ``codebooks`` the final entries as text. ``stats`` gets a row (groups scanned,
    groups) per assignment."""
    if not (0 < n_entries <= 256 and 0 < rounds < 256):
        raise ValueError("a code is a byte and so is a round stamp")
    kept = usable(vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")))
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = -(-longest // parts)
    dim, limit = width * parts, _limit(width)
    scaled = F.transform("embedding", lambda x: F.greatest(F.least(F.floor(x * SCALE).cast("double"), F.lit(float(limit))), F.lit(float(-limit))))
    filled = F.concat(scaled, F.array_repeat(F.lit(0.0), dim - F.size("embedding")))
    seeds = kept.select("vec_id", filled.alias("x")).orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(n_entries).collect()
    book = np.zeros((len(seeds), dim), dtype=np.int64)
    for i, r in enumerate(seeds):
        book[i] = r["x"]
    history = [[book[:, p * width:(p + 1) * width]] for p in range(parts)]
    groups = -(-len(seeds) // GROUP)
    kinds = {f: vectors.schema[f].dataType.simpleString() for f in ("vec_id", "label")}
    state_schema = (f"vec_id {kinds['vec_id']}, label {kinds['label']}, x binary, code binary, low binary, stamp binary, "
                    "part int, entry int, n long, total array<long>, scanned long")

    def step(first: bool, history):
        def run(batches):
            totals: dict = {}
            scanned = 0
            for b in batches:
                x = whole_numbers(b.column(2), dim, limit) if first else _matrix(b.column(2), "<i4", dim).astype(np.int64)
                old = None if first else _unpacked(b, 3, parts, groups)
                code, low, stamp = [], [], []
                for p in range(parts):
                    own = x[:, p * width:(p + 1) * width]
                    bounds = Bounds(own) if first else Bounds(own, *(o[:, p] for o in old))
                    bounds.assign(history[p])
                    scanned += bounds.scanned
                    code.append(bounds.code)
                    low.append(bounds.low)
                    stamp.append(bounds.stamp)
                    for _, e, k, t in _sums(p, bounds.code, own, n_entries):
                        have = totals.get((p, e))
                        totals[p, e] = (k, t) if have is None else (have[0] + k, have[1] + t)
                nothing = [pa.nulls(len(x), k) for k in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), _binaries(x.astype("<i4")), _binaries(np.stack(code, axis=1).astype(np.uint8)),
                     _binaries(np.stack(low, axis=1).reshape(len(x), -1)), _binaries(np.stack(stamp, axis=1).reshape(len(x), -1)), *nothing],
                    names)
            keys = list(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(keys), t) for t in types] + [pa.nulls(len(keys), pa.binary()) for _ in range(4)]
                + [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                   pa.array([totals[k][0] for k in keys], pa.int64()), pa.array([totals[k][1].tolist() for k in keys], pa.list_(pa.int64())),
                   pa.array([scanned] + [0] * (len(keys) - 1) if keys else [], pa.int64())], names)
        return run

    names = [f.split()[0] for f in state_schema.split(", ")]
    from pyspark.sql.pandas.types import to_arrow_type
    types = [to_arrow_type(vectors.schema[f].dataType) for f in ("vec_id", "label")]
    state = None
    for r in range(rounds):
        source = kept.select("vec_id", "label", "embedding") if state is None else state.where(F.col("part").isNull()).select(
            "vec_id", "label", "x", "code", "low", "stamp")
        nxt = written(source.mapInArrow(step(state is None, history), state_schema), "codes-state")
        if state is not None:
            deleted(state)
        state = nxt
        sums = state.where(F.col("part").isNotNull()).select("part", "entry", "n", "total", "scanned")
        if stats is not None:
            stats.append((sums.agg(F.sum("scanned")).first()[0] or 0, groups))
        history = _moved(history, sums, width)

    final = [h[-1] for h in history]
    text = ",".join(",".join(map(str, e.tolist())) for h in final for e in h)

    def last(batches):
        for b in batches:
            x = _matrix(b.column(2), "<i4", dim).astype(np.int64)
            old = _unpacked(b, 3, parts, groups)
            code, error = [], np.zeros(len(x), dtype=np.int64)
            for p in range(parts):
                bounds = Bounds(x[:, p * width:(p + 1) * width], *(o[:, p] for o in old))
                error += bounds.assign(history[p])
                code.append(bounds.code)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _binaries(np.stack(code, axis=1).astype(np.uint8)), pa.array(error)],
                                             ["vec_id", "label", "codes", "error"])
    coded = state.where(F.col("part").isNull()).select("vec_id", "label", "x", "code", "low", "stamp").mapInArrow(
        last, f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes binary, error long")
    coded = written(coded, "codes")
    deleted(state)
    return coded.withColumn("codebooks", F.lit(text))


def _unpacked(b, at: int, parts: int, groups: int):
    n = b.num_rows
    return (_matrix(b.column(at), np.uint8, parts).astype(np.int64),
            _matrix(b.column(at + 1), np.float32, parts * groups).reshape(n, parts, groups).copy(),
            _matrix(b.column(at + 2), np.uint8, parts * groups).reshape(n, parts, groups).copy())


def _moved(history, sums: DataFrame, width: int):
    """The history with the floored means as its next codebooks."""
    counts = {(r["part"], r["entry"]): r["n"] for r in sums.groupBy("part", "entry").agg(F.sum("n").alias("n")).collect()}
    cells = (sums.select("part", "entry", F.posexplode("total").alias("pos", "v"))
             .groupBy("part", "entry", "pos").agg(F.sum("v").alias("v")).toArrow())   # at most a codebook's components
    out = []
    for h in history:
        out.append([*h, h[-1].copy()])
    part, entry, pos, v = (cells[c].to_numpy() for c in ("part", "entry", "pos", "v"))
    for p in range(len(history)):
        own = part == p
        n = np.array([counts[p, e] for e in entry[own]], dtype=np.int64)
        out[p][-1][entry[own], pos[own]] = v[own] // n if len(n) else v[own]
    return out


def op11_vector_codes(vectors: DataFrame) -> DataFrame:
    coded = compress(vectors)
    keyed = coded.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    labels = written(keyed.groupBy("key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "codes-labels")
    out = hot_key_join(keyed, labels.select("key", "label_error"), "key", labels.select("key", "n"))
    return out.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
                      F.sha2(F.col("codebooks"), 256).alias("codebooks_sha256"))
