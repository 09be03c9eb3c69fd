"""Vector codes: eight 16-entry codebooks, by exact integer products in limbs.

Components become integers (floor of 4096 x).  The nearest codebook entry of
a vector part is the least of |c|^2 - 2 x.c, the first among equals.  The
products x.c come from float64 matrix multiplication, which is exact as long
as every sum stays below 2^53; so integers are broken into limbs narrow enough
for that, limb pairs are multiplied, and the products are put together again
in int64 (in Python integers where a distance could pass 63 bits).

A round reads the vectors once: each task assigns its own and adds up a row
of sums per codebook entry; only entries (16 times the components of a vector)
come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ledgerlake.llm.store import land

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
SLICE_VALUES = 1 << 20      # components handled at once
LONG = 1 << 63

#: per vector length, per part: the entries' components as rows of integers
Books = dict[int, list[np.ndarray]]


def bounds(dim: int) -> list[tuple[int, int]]:
    """First and last (exclusive) position of each part."""
    return [(dim * k // PARTS, dim * (k + 1) // PARTS) for k in range(PARTS)]


def limbs(x: np.ndarray, width: int) -> list[np.ndarray]:
    """``x`` (int64) as float64 limbs, lowest first: the sum of limb k times
    2^(width k).  All are in [0, 2^width) but the last, which has the sign."""
    most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    count = max(1, -(-most.bit_length() // width))
    out = [((x >> (width * k)) & ((1 << width) - 1)).astype(np.float64) for k in range(count - 1)]
    return [*out, (x >> (width * (count - 1))).astype(np.float64)]


def products(x: np.ndarray, y: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """x @ y.T of integer matrices, exact; ``kind`` object for results of any size."""
    width = (53 - max(1, x.shape[1]).bit_length()) // 2
    right = limbs(y, width)
    out = np.zeros((len(x), len(y)), kind)
    for i, a in enumerate(limbs(x, width)):
        for j, b in enumerate(right):
            out += (a @ b.T).astype(np.int64).astype(kind) << (width * (i + j))
    return out


def assign(x: np.ndarray, book: np.ndarray, kind: type = np.int64) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row (the first among equals), and its squared distance."""
    own, entry = x.astype(kind), book.astype(kind)
    gaps = (entry * entry).sum(1)[None, :] - 2 * products(x, book, kind)
    first = gaps.argmin(1)
    return first, (own * own).sum(1) + gaps[np.arange(len(x)), first]


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """(length, integer matrix, rows) for slices of vectors of one length."""
    lengths = pc.list_value_length(batch.column("vector"))
    for dim in pc.unique(lengths).to_pylist():
        rows = batch.filter(pc.equal(lengths, dim))
        step = max(1, SLICE_VALUES // max(1, dim))
        for first in range(0, rows.num_rows, step):
            part = rows.slice(first, step)
            flat = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            yield dim, np.floor(flat * SCALE).astype(np.int64).reshape(part.num_rows, dim), part


def _sums(books: Books, kinds: dict[int, type]) -> Callable:
    """Per task: sums and counts of the parts assigned to each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], list] = {}
        for batch in batches:
            for dim, x, _ in _vectors(batch):
                for k, (a, b) in enumerate(bounds(dim)):
                    first, _ = assign(x[:, a:b], books[dim][k], kinds[dim])
                    for entry in np.unique(first).tolist():
                        chosen = x[first == entry, a:b].astype(kinds[dim])
                        held = total.setdefault((dim, k, entry), [np.zeros(b - a, object), 0])
                        held[0] = held[0] + chosen.sum(0).astype(object)
                        held[1] += len(chosen)
        rows = [(*key, at, str(value), n) for key, (sums, n) in total.items() for at, value in enumerate(sums)]
        columns = [list(c) for c in zip(*rows, strict=True)] or [[]] * 6
        kinds_out = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds_out, strict=True)],
                                         ["dim", "part", "entry", "at", "total", "n"])

    return run


def _codes(books: Books, kinds: dict[int, type], digests: dict[int, str]) -> Callable:
    """Per row: id, label, code, error and its codebooks' digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, x, rows in _vectors(batch):
                code, error = np.zeros((len(x), PARTS), np.uint8), np.zeros(len(x), kinds[dim])
                for k, (a, b) in enumerate(bounds(dim)):
                    code[:, k], far = assign(x[:, a:b], books[dim][k], kinds[dim])
                    error = error + far
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("label"), pa.array([c.tobytes().hex() for c in code], pa.string()),
                     pa.array([e if e < LONG else None for e in error.tolist()], pa.int64()), pa.array([digests[dim]] * len(x), pa.string())],
                    ["id", "label", "code", "error", "codebooks_sha256"])

    return run


def _first_books(rows: DataFrame) -> Books:
    """The parts of the vectors with the smallest ids, per vector length."""
    order = Window.partitionBy(F.size("vector")).orderBy(F.col("id").asc_nulls_last(), "vector")
    seeds = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= ENTRIES)
    by_length: dict[int, list[Row]] = {}
    for row in seeds.orderBy("r").collect():            # ENTRIES rows of each length
        by_length.setdefault(len(row.vector), []).append(row.vector)
    books = {}
    for dim, vectors in by_length.items():
        whole = np.floor(np.array(vectors, np.float64) * SCALE).astype(np.int64).reshape(len(vectors), dim)
        books[dim] = [whole[:, a:b] for a, b in bounds(dim)]
    return books


def _means(rows: DataFrame, books: Books, kinds: dict[int, type]) -> Books:
    """The codebooks after one more round."""
    sums = rows.mapInArrow(_sums(books, kinds), "dim int, part int, entry int, at int, total string, n bigint")
    merged = sums.groupBy("dim", "part", "entry", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out = {dim: [book.copy() for book in parts] for dim, parts in books.items()}
    for r in merged.collect():                          # a row per codebook component
        out[r.dim][r.part][r.entry, r.at] = int(r.total) // r.n
    return out


def digest(parts: list[np.ndarray]) -> str:
    """Hash of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for book in parts for v in book.ravel().tolist()).encode()).hexdigest()


def compress(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) per row of ``table``
    with a whole vector.

    A vector that is null or holds null or non-finite components takes no
    part.  A null key does, but is the last to seed a codebook; of equal keys
    the lesser vector comes first.  Repeated rows all stay and weigh in the
    means.  With fewer than 16 rows the codebooks are that much shorter.
    Vectors of different lengths have codebooks of their own; a length that 8
    doesn't divide makes some parts one position longer, and an empty vector
    codes as zeros with error 0.  Null labels form one label.  An error of
    2^63 or more is null; a component of 2^50 or more is refused (ValueError).
    An empty table gives no rows; other columns play no part.
    """
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    rows = land(rows.where(F.col("vector").isNotNull()).where(whole), "codes-vectors")
    peak = F.coalesce(F.array_max(F.transform("vector", lambda x: F.abs(x))), F.lit(0.0))
    kinds: dict[int, type] = {}
    for r in rows.groupBy(F.size("vector").alias("dim")).agg(F.max(peak).alias("peak")).collect():    # a row per vector length
        if r.peak >= 1 << 50:
            raise ValueError(f"{vector}: a component of {r.peak:g} is too large for an integer code")
        kinds[r.dim] = np.int64 if 4 * max(1, r.dim) * (int(r.peak * SCALE) + 1) ** 2 < LONG else object
    books = _first_books(rows)
    for _ in range(rounds):
        books = _means(rows, books, kinds)
    kind = rows.schema
    coded = rows.mapInArrow(_codes(books, kinds, {dim: digest(parts) for dim, parts in books.items()}),
                            f"id {kind['id'].dataType.simpleString()}, label {kind['label'].dataType.simpleString()}, code string, error bigint, codebooks_sha256 string")
    coded = land(coded, "codes")
    summed = (coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
              .select("of", F.expr("try_cast(total AS bigint)").alias("label_error")))
    return coded.join(summed, F.col("label").eqNullSafe(F.col("of"))).select(F.col("id").alias(key), "code", "error", "label_error", "codebooks_sha256")
