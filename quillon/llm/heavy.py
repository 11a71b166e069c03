"""Most frequent items among billions: code-based identification in bounded memory.

A 64-bit fingerprint of each value picks a group and is encoded as a codeword of
``LENGTH`` symbols (Reed–Solomon over 256 elements, systematic, parity by a Cauchy
matrix).  Every task counts symbols per (group, position) in one dense array of
fixed size; the arrays are summed over all tasks.  An item with at least the wanted
share carries its symbol over the threshold at every position of its group, so the
heavy symbols – at most 1/share per position over all groups – hold its codeword.
Decoding corrects symbols that another heavy item of the group overrides.  The
decoded candidates are then counted exactly, and the exact counts prove each group
complete; groups without that proof are spread anew by another hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.storage import Scratch

DATA, LENGTH = 8, 14
#: Turns of spreading ambiguous groups anew before their rows are simply counted.
TURNS = 6
#: Cells of a task's dense array (64 MB): as many groups as fit are counted in one reading of the rows.
DENSE = 1 << 23


@cache
def _field() -> tuple[np.ndarray, np.ndarray]:
    """Powers and logarithms of the generator 2 of GF(256) modulo x^8+x^4+x^3+x^2+1."""
    power, log, x = np.zeros(510, np.uint8), np.zeros(256, np.int32), 1
    for i in range(255):
        power[i] = power[i + 255] = x
        log[x] = i
        x = (x << 1) ^ (0x11D if x & 0x80 else 0)
    return power, log


def _times(a: int, b: int) -> int:
    power, log = _field()
    return int(power[log[a] + log[b]]) if a and b else 0


@cache
def _generator() -> np.ndarray:
    """DATA x LENGTH, any DATA columns of it invertible: identity and a Cauchy matrix."""
    power, log = _field()
    g = np.zeros((DATA, LENGTH), np.uint8)
    g[:, :DATA] = np.eye(DATA, dtype=np.uint8)
    for i in range(DATA):
        for j in range(LENGTH - DATA):
            g[i, DATA + j] = power[255 - log[i ^ (DATA + j)]]
    return g


@cache
def _tables() -> np.ndarray:
    """Products of every byte with every parity coefficient: [DATA, LENGTH - DATA, 256]."""
    g = _generator()
    return np.array([[[_times(int(g[i, DATA + j]), b) for b in range(256)] for j in range(LENGTH - DATA)] for i in range(DATA)], np.uint8)


def encode(fingerprints: np.ndarray) -> np.ndarray:
    """Codewords [n, LENGTH] of uint64 fingerprints."""
    data = np.ascontiguousarray(fingerprints.astype("<u8")).view(np.uint8).reshape(-1, DATA)
    parity, table = np.zeros((len(data), LENGTH - DATA), np.uint8), _tables()
    for i in range(DATA):
        parity ^= table[i][:, data[:, i]].T
    return np.hstack([data, parity])


@cache
def _inverses() -> dict[tuple[int, ...], np.ndarray]:
    return {}


def _solve(places: tuple[int, ...], symbols: np.ndarray) -> np.ndarray:
    """The data bytes whose codeword has ``symbols`` at the DATA ``places``."""
    known = _inverses()
    if places not in known:
        power, log = _field()
        m = np.hstack([_generator()[:, places].T, np.eye(DATA, dtype=np.uint8)]).astype(np.int32)
        for c in range(DATA):
            p = next(r for r in range(c, DATA) if m[r, c])
            m[[c, p]] = m[[p, c]]
            k = int(log[m[c, c]])
            m[c] = [int(power[(log[v] - k) % 255]) if v else 0 for v in m[c]]
            for r in range(DATA):
                if r != c and m[r, c]:
                    m[r] ^= np.array([_times(int(m[r, c]), int(v)) for v in m[c]], np.int32)
        known[places] = m[:, DATA:]
    out = np.zeros(DATA, np.uint8)
    for i, row in enumerate(known[places]):
        for a, b in zip(row, symbols):
            out[i] ^= _times(int(a), int(b))
    return out


def decode(word: np.ndarray) -> int | None:
    """The fingerprint whose codeword differs from ``word`` in at most 3 of 14 places, else None."""
    allowed = (LENGTH - DATA) // 2
    for places in combinations(range(LENGTH), DATA):
        data = _solve(places, word[list(places)])
        value = int(data.view("<u8")[0])
        if (encode(np.array([value], np.uint64))[0] != word).sum() <= allowed:
            return value
    return None


def _mix(x: np.ndarray, turn: int) -> np.ndarray:
    """A 64-bit hash of fingerprints for each turn (splitmix finaliser)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (2 * turn + 1)) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _groups(x: np.ndarray, turn: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (_mix(x, turn) % np.uint64(n)).astype(np.int64)


def _within(x: np.ndarray, before: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
    """Which fingerprints fell into groups left open in every earlier turn: (turn, number of groups, open groups)."""
    mask = np.ones(len(x), bool)
    for turn, n, kept in before:
        mask &= np.isin(_groups(x, turn, n), kept)
    return mask


def _sketch(turn: int, groups: int, before: list[tuple[int, int, np.ndarray]], first: int, last: int):
    """Counts per cell (group, position, symbol) of the groups from ``first`` to below ``last``: one array of fixed size a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((last - first) * LENGTH * 256, np.int64)
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            x = x[_within(x, before)]
            g = _groups(x, turn, groups)
            mine = (g >= first) & (g < last)
            x, g = x[mine], g[mine] - first
            # Repeated values are encoded once.
            x, at, n = np.unique(x, return_index=True, return_counts=True)
            cell = ((g[at][:, None] * LENGTH + np.arange(LENGTH)) * 256 + encode(x)).ravel()
            cells += np.bincount(cell, np.repeat(n, LENGTH), len(cells)).astype(np.int64)
        at = np.flatnonzero(cells)
        for k in range(0, len(at), 65536):
            yield pa.RecordBatch.from_arrays([pa.array(at[k : k + 65536] + first * LENGTH * 256), pa.array(cells[at[k : k + 65536]])], names=["cell", "n"])

    return run


def _candidates(heavy: list[tuple[int, int]], least: int) -> dict[int, set[int]]:
    """Decoded fingerprints by group from the heavy cells, strongest item first."""
    by: dict[int, np.ndarray] = {}
    for cell, n in heavy:
        by.setdefault(cell // (LENGTH * 256), np.zeros((LENGTH, 256), np.int64))[cell // 256 % LENGTH, cell % 256] = n
    found: dict[int, set[int]] = {}
    for group, counts in by.items():
        found[group] = set()
        while (counts.max(axis=1) >= least).all():
            value = decode(counts.argmax(axis=1).astype(np.uint8))
            if value is None or value in found[group]:
                break
            found[group].add(value)
            word = encode(np.array([value], np.uint64))[0]
            at = (np.arange(LENGTH), word)
            counts[at] -= counts[at].min()
    return found


def heavy_hitters(items: DataFrame, value: str, share: float, groups: int | None = None) -> DataFrame:
    """``(value, n, of)``: values that make up at least ``share`` of all rows, with exact counts.

    ``of`` is the number of rows, null values included; a null value is counted there
    but never reported.  Ties are all reported; an empty table gives an empty result;
    other columns are ignored.  The rows are read three times when no group is ambiguous
    and ``groups`` (by default about a quarter of 1/share) fit in one array.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    spark = items.sparkSession
    tmp = Scratch(spark, "heavy")
    rows = items.select(F.col(value).cast("string").alias("value"))
    prints = rows.where("value is not null").select(F.xxhash64("value").alias("h"))
    total = rows.count()
    least = max(1, int(np.ceil(share * total - 1e-9)))
    # Light values spread over 256 symbols and cannot come near the threshold; heavy ones of a group are peeled apart.
    groups = groups or max(16, 1 << int(np.ceil(np.log2(0.25 / share))))
    # Few large tasks add up their arrays before anything is shuffled.
    prints = prints.coalesce(2 * spark.sparkContext.defaultParallelism)
    done, before, exact = set(), [], None
    for turn in range(TURNS):
        heavy, step = [], max(1, DENSE // (LENGTH * 256))
        for a in range(0, groups, step):
            summed = prints.mapInArrow(_sketch(turn, groups, before, a, min(a + step, groups)), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
            # At most total/least cells a position are over the threshold: LENGTH/share rows.
            heavy += [(r.cell, r.n) for r in summed.where(F.col("n") >= least).collect()]
        found = _candidates(heavy, least)
        done |= {v for values in found.values() for v in values}
        signed = [v - 2**64 if v >= 2**63 else v for v in done]
        exact = tmp.put(
            rows.where(F.xxhash64("value").isin(signed)).groupBy("value").agg(F.count("*").alias("n"), F.xxhash64("value").alias("h"))
            if signed else rows.where("false").select("value", F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("h")),
            f"exact-{turn}",
        )
        # One row a candidate (two values may share a fingerprint, which is why values are counted).
        sizes = {r.h % 2**64: r.n for r in exact.groupBy("h").agg(F.sum("n").alias("n")).collect()}
        open_groups = _unproved(heavy, found, sizes, least, turn, groups, before, done)
        if not open_groups:
            break
        before = [*before, (turn, groups, np.array(sorted(open_groups)))]
        # Only rows of open groups are left, spread over more.
        groups *= 4
    else:
        # Still ambiguous after all turns: these few groups' values are counted plainly.
        keep = before

        def rest(batches):
            for batch in batches:
                x = batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
                mask = _within(x, keep)
                yield pa.RecordBatch.from_arrays([batch.column("value").filter(pa.array(mask))], names=["value"])

        left = rows.where("value is not null").select("value", F.xxhash64("value").alias("h")).mapInArrow(rest, "value string")
        exact = exact.select("value", "n").unionByName(left.groupBy("value").agg(F.count("*").alias("n"))).groupBy("value").agg(F.max("n").alias("n"))
    return exact.where(F.col("n") >= least).select("value", "n", F.lit(total).cast("bigint").alias("of"))


def _unproved(heavy, found, sizes, least, turn, groups, before, done) -> set[int]:
    """Groups in which a missed item is still possible: at every position some symbol stays heavy."""
    by: dict[int, np.ndarray] = {}
    for cell, n in heavy:
        by.setdefault(cell // (LENGTH * 256), np.zeros((LENGTH, 256), np.int64))[cell // 256 % LENGTH, cell % 256] = n
    values = np.array(sorted(done), np.uint64)
    if len(values):
        values = values[_within(values, before)]
        for v, g, word in zip(values.tolist(), _groups(values, turn, groups).tolist(), encode(values)):
            if g in by:
                by[g][np.arange(LENGTH), word] -= sizes.get(v, 0)
    return {g for g, counts in by.items() if (counts.max(axis=1) >= least).all()}
