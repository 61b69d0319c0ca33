"""Short codes of vectors, with distances looked up by the values of each dimension.

Components are whole numbers and vectors are cut into parts; each part has a
codebook of a few entries, moved for some rounds to the mean of the parts that are
nearest to them. Vectors are kept in blocks, each dimension as a dictionary of the
different values of the block and a code per vector. For a codebook the squared
differences of every value to all entries are tabulated once, and the distances of
all parts of the block are gathers and adds over the dictionary codes, whatever the
number of vectors that share a value. All arithmetic is on whole numbers, so sums
do not depend on their order.

Blocks are packed where rows are read, so a value or a vector that most rows share
is no hot key; a round sends a sum per task, part, entry and position.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from postgrove.llm.stored import stored

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
# Vectors of a block: a code is then 16 bits.
ROWS = 1 << 14
# Labels are broadcast up to this number.
MOST_LABELS = 100_000

Batches = Iterator[pa.RecordBatch]


@dataclass
class Block:
    """Vectors by dimension: the different values in order, and for each vector which it has."""

    values: list[np.ndarray]
    codes: np.ndarray

    @classmethod
    def build(cls, rows: np.ndarray) -> Block:
        values, codes = [], np.zeros(rows.T.shape, np.uint16)
        for i, line in enumerate(rows.T):
            own, codes[i] = np.unique(line, return_inverse=True)
            values.append(own)
        return cls(values, codes)

    def nearest(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each part a line of the nearest entries and one of the squared distances."""
        parts, entries, width = books.shape
        nearest = np.zeros((parts, self.codes.shape[1]), np.int64)
        distance = np.zeros_like(nearest)
        for part, book in enumerate(books):
            total = np.zeros((self.codes.shape[1], entries), np.int64)
            for at in range(width):
                i = part * width + at
                total += ((self.values[i][:, None] - book[None, :, at]) ** 2)[self.codes[i]]
            # The lowest of equal entries.
            nearest[part] = total.argmin(axis=1)
            distance[part] = total[np.arange(len(total)), nearest[part]]
        return nearest, distance

    def sums(self, nearest: np.ndarray, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Of the parts at each entry the sum of every component, and how many there are."""
        parts, entries, width = shape
        total, count = np.zeros(shape, np.int64), np.zeros((parts, entries), np.int64)
        for part in range(parts):
            count[part] = np.bincount(nearest[part], minlength=entries)
            for at in range(width):
                i = part * width + at
                size = len(self.values[i])
                often = np.bincount(nearest[part] * size + self.codes[i], minlength=entries * size)
                total[part, :, at] = often.reshape(entries, size) @ self.values[i]
        return total, count


def _packer(scale: int, most: int) -> Callable[[Batches], Batches]:
    """A row per block: ids and labels as they came, dictionaries and codes."""

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        held = pa.Table.from_batches(batches).combine_chunks()
        vectors = held.column(2).combine_chunks()
        rows = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(held), -1)
        made = Block.build(np.floor(scale * rows).astype(np.int64))

        def one(column: pa.ChunkedArray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), column.combine_chunks())

        return pa.record_batch(
            [
                one(held.column(0)),
                one(held.column(1)),
                pa.array([[len(x) for x in made.values]], pa.list_(pa.int32())),
                pa.array([np.concatenate(made.values).tobytes()], pa.binary()),
                pa.array([made.codes.tobytes()], pa.binary()),
            ],
            names=["ids", "labels", "sizes", "values", "codes"],
        )

    def pack(batches: Batches) -> Batches:
        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, most - size)
                held, size, batch = [*held, part], size + part.num_rows, batch.slice(part.num_rows)
                if size == most:
                    yield block(held)
                    held, size = [], 0
        if held:
            yield block(held)

    return pack


def _blocks(batches: Batches) -> Iterator[tuple[pa.Array, pa.Array, Block]]:
    """Blocks as (ids, labels, block)."""
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        for i in range(batch.num_rows):
            sizes = np.array(columns["sizes"][i].as_py())
            values = np.split(np.frombuffer(columns["values"][i].as_py(), np.int64), np.cumsum(sizes)[:-1])
            codes = np.frombuffer(columns["codes"][i].as_py(), np.uint16).reshape(len(sizes), -1)
            yield columns["ids"][i].values, columns["labels"][i].values, Block(values, codes)


def _summing(books: np.ndarray) -> Callable[[Batches], Batches]:
    """Sums of a task: rows of (at, total, count), where ``at`` numbers the components of all entries."""
    plain = books.tolist()

    def run(batches: Batches) -> Batches:
        books = np.array(plain, np.int64)
        total, count = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for _, _, block in _blocks(batches):
            nearest, _ = block.nearest(books)
            for all, own in zip((total, count), block.sums(nearest, books.shape)):
                all += own
        yield pa.record_batch(
            [
                pa.array(np.arange(books.size, dtype=np.int32)),
                pa.array(total.ravel()),
                pa.array(np.repeat(count.ravel(), books.shape[2])),
            ],
            names=["at", "total", "count"],
        )

    return run


def moved(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry at the mean of the parts nearest to it, rounded down; one without parts stays."""
    found = blocks.mapInArrow(_summing(books), "at int, total bigint, count bigint").groupBy("at").agg(
        F.sum("total").alias("total"), F.sum("count").alias("count")
    )
    # A row per component of the codebooks.
    table = found.toArrow().sort_by("at")
    total, count = table["total"].to_numpy(), table["count"].to_numpy()
    mean = total // np.maximum(count, 1)
    return np.where(count > 0, mean, books.ravel()).reshape(books.shape)


def _coding(books: np.ndarray) -> Callable[[Batches], Batches]:
    plain = books.tolist()

    def run(batches: Batches) -> Batches:
        books = np.array(plain, np.int64)
        digits = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), "S2")
        for ids, labels, block in _blocks(batches):
            nearest, distance = block.nearest(books)
            code = np.ascontiguousarray(digits[nearest.T]).view(f"S{2 * len(books)}").ravel()
            yield pa.record_batch(
                [ids, labels, pa.array(code.astype(str), pa.string()), pa.array(distance.sum(axis=0))],
                names=["id", "label", "code", "error"],
            )

    return run


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    rows_at_once: int = ROWS,
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every row with a vector.

    A component x counts as floor(``scale`` x) and should stay below 2**25 in size, so that all
    sums fit 64 bits. A codebook begins as that part of the rows of the smallest ids, of
    equal ids those of the smallest vectors; with fewer rows than ``entries`` it has as
    many as there are. Of equally near entries the first counts. ``code`` has two hexadecimal digits for each part, ``error`` is
    the squared distance to what the code stands for, and ``label_error`` the sum of the
    errors of all rows of the same label, where NULL is one label.

    Vectors that are NULL or hold a NULL or non-finite component are left out, and
    so are those of another length than the vector of the smallest id. A row without an id is coded like
    any other, and comes after all with one for the first codebooks. Repeated rows come back as often as
    they came in. Other columns are not read; an empty table gives an empty result.
    """
    if not 0 < entries <= 256 or not 0 < rows_at_once <= 1 << 16:
        raise ValueError("at most 256 entries and 65,536 rows at once")
    spark = vectors.sparkSession
    value = F.col(vector).cast("array<double>")
    real = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.coalesce(real, F.lit(False))).select(
        F.col(id).alias("id"), F.col(label).alias("label"), value.alias("vector")
    )
    order = F.col("id").asc_nulls_last(), "vector"
    lead = rows.orderBy(*order).limit(1).select(F.size("vector")).collect()
    size = lead[0][0] if lead else 0
    if size % parts:
        raise ValueError(f"{size} components make no {parts} equal parts")
    rows = rows.where(F.size("vector") == size)
    first = np.array([row[0] for row in rows.orderBy(*order).limit(entries).select("vector").collect()])
    columns = {"id": rows.schema["id"].dataType, "label": rows.schema["label"].dataType}
    if not size:
        return spark.createDataFrame(
            [], T.StructType([T.StructField(id, columns["id"]), *T.StructType.fromDDL(
                "code string, error bigint, label_error bigint, codebooks_sha256 string").fields])
        )
    books = np.floor(scale * first).astype(np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    kept = T.StructType(
        [T.StructField("ids", T.ArrayType(columns["id"])), T.StructField("labels", T.ArrayType(columns["label"])),
         *T.StructType.fromDDL("sizes array<int>, values binary, codes binary").fields]
    )
    blocks = stored(rows.mapInArrow(_packer(scale, rows_at_once), kept), "blocks")
    for _ in range(rounds):
        books = moved(blocks, books)
    coded = T.StructType(
        [T.StructField(name, kind) for name, kind in columns.items()]
        + T.StructType.fromDDL("code string, error bigint").fields
    )
    done = stored(blocks.mapInArrow(_coding(books), coded), "codes")
    sums = stored(done.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "labels")
    if sums.count() <= MOST_LABELS:
        sums = F.broadcast(sums)
    return done.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("id").alias(id), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
