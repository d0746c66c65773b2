"""Product quantisation of integer vectors by per-dimension value dictionaries.

A vector is cut into equal parts, and each part is coded by the nearest of at most
64 entries of the codebook at its place. Components are small integers, so few
distinct values occur in one dimension however many vectors there are. A block of
rows is therefore turned into a dictionary for each dimension (its distinct values)
and codes into it. For every dimension the squared differences of all its values to
all entries are tabulated once; a part's distance to all entries is then the sum of
as many table rows as the part has dimensions, gathered by the codes. No difference
or product is taken for a vector. All numbers are integers, and results are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import batch_of
from assaylake.llm.vectors import SCALE, blocks, clipped, fits_long, integer_vectors, matrix
from assaylake.session import settled

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Rows that share a dictionary; a table then has at most so many rows.
BLOCK_ROWS = 8192
#: Labels whose sums are sent to all tasks; more are joined by a shuffle.
MOST_LABELS = 100_000


class Dictionaries:
    """The distinct values of each dimension of a block of rows, and the rows as codes."""

    def __init__(self, vectors: np.ndarray):
        self.most = int(np.abs(vectors).max(initial=0))
        self.values, self.codes = [], []
        for column in vectors.T:
            values, codes = np.unique(column, return_inverse=True)
            self.values.append(values)
            self.codes.append(codes.reshape(-1))

    def nearest(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each row's parts; of equal entries the first.

        ``books`` has the shape (parts, entries, dimensions of a part).
        """
        parts, entries, width = books.shape
        rows = len(self.codes[0]) if self.codes else 0
        most = 2 * max(self.most, int(np.abs(books).max(initial=0)))
        kind = np.int64 if fits_long(most, parts * width) else object
        chosen, errors = np.zeros((rows, parts), np.int64), np.zeros((rows, parts), kind)
        for p in range(parts):
            total = np.zeros((rows, entries), kind)
            for j in range(width):
                at = p * width + j
                table = self.values[at].astype(kind)[:, None] - books[p, :, j].astype(kind)[None, :]
                total += (table * table)[self.codes[at]]
            chosen[:, p] = total.argmin(1)
            errors[:, p] = total[np.arange(rows), chosen[:, p]]
        return chosen, errors


def _width(vectors: DataFrame) -> int | None:
    """Dimensions of a part: that of the longest vector, rounded up; None without rows."""
    longest = vectors.agg(F.max(F.size("v"))).first()[0]
    return None if longest is None else max(1, -(-longest // PARTS))


def first_books(vectors: DataFrame, width: int) -> np.ndarray:
    """The parts of the vectors of the least ids, as the entries' first values."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(ENTRIES).collect()
    padded = np.array([[*r["v"], *[0] * (PARTS * width - len(r["v"]))] for r in rows], np.int64)
    return padded.reshape(len(rows), PARTS, width).transpose(1, 0, 2)


def _refined(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry becomes the floor of the mean of its parts; unused ones stay."""
    parts, entries, width = books.shape
    held = vectors.sparkSession.sparkContext.broadcast(books)  # bounded by entries and dimensions
    schema = pa.schema([("at", pa.int32()), ("n", pa.int64()), ("total", pa.string())])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        n, total = np.zeros((parts, entries), np.int64), np.zeros(books.shape, object)
        for block in blocks(batches, BLOCK_ROWS):
            rows = matrix(block["v"].combine_chunks(), parts * width)
            words = Dictionaries(rows)
            chosen, _ = words.nearest(books)
            exact = words.most * len(rows) < 1 << 53
            for p in range(parts):
                n[p] += np.bincount(chosen[:, p], minlength=entries)
                for j in range(width):
                    column = rows[:, p * width + j]
                    if exact:
                        total[p, :, j] += np.bincount(chosen[:, p], column, entries).astype(np.int64)
                    else:
                        np.add.at(total[p, :, j], chosen[:, p], column.astype(object))
        p, e, j = np.nonzero(np.broadcast_to(n[:, :, None], books.shape))
        yield batch_of(schema, [
            ((p * entries + e) * width + j).astype(np.int32), n[p, e], [str(x) for x in total[p, e, j]],
        ])

    sums = vectors.select("v").mapInArrow(add, "at int, n long, total string")
    sums = sums.groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    books = books.reshape(-1).copy()
    for r in sums.collect():  # as many rows as the books have numbers, at the most
        books[r["at"]] = int(r["total"]) // r["n"]
    return books.reshape(parts, entries, width)


def trained_books(vectors: DataFrame, width: int, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after ``rounds`` rounds over all rows of ``vec_id, label, v``."""
    books = first_books(vectors, width)
    for _ in range(rounds):
        books = _refined(vectors, books)
    return books


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error``: two hex digits for each part, and the squared distance."""
    parts, _, width = books.shape
    held = vectors.sparkSession.sparkContext.broadcast(books)
    schema = pa.schema([
        ("vec_id", pa.int64()), ("label", pa.int64()), ("code", pa.string()), ("error", pa.int64()),
    ])

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, BLOCK_ROWS):
            rows = matrix(block["v"].combine_chunks(), parts * width)
            chosen, errors = Dictionaries(rows).nearest(held.value)
            yield batch_of(schema, [
                block["vec_id"].combine_chunks(), block["label"].combine_chunks(),
                [row.tobytes().hex() for row in chosen.astype(np.uint8)], clipped(errors.sum(1)),
            ])

    return vectors.select("vec_id", "label", "v").mapInArrow(
        code, "vec_id long, label long, code string, error long"
    )


def decode(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, code, approximate``: the entries that the code names, joined."""
    parts, _, _ = books.shape
    held = coded.sparkSession.sparkContext.broadcast(books)
    schema = pa.schema([("vec_id", pa.int64()), ("code", pa.string()), ("approximate", pa.list_(pa.int64()))])

    def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, part = held.value, np.arange(parts)
        for batch in batches:
            found = [books[part, list(bytes.fromhex(c))].reshape(-1) for c in batch["code"].to_pylist()]
            yield batch_of(schema, [batch["vec_id"], batch["code"], found])

    return coded.select("vec_id", "code").mapInArrow(look_up, "vec_id long, code string, approximate array<long>")


def compress(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of ``vec_id, embedding, label``.

    Rows without a vector, or with a null or non-finite component, are dropped. A
    component x counts as floor(scale * x), cut off at 2^53. Codebooks start from the vectors of the
    64 least ids (all, if fewer; equal ids by their components, null ids last) and are refined twice
    over all rows. Ties go to the entry of the lower index. Shorter vectors are
    continued with zeros to the length of the longest, and that to a multiple of 16. Repeated rows are
    coded each time. ``label_error`` adds up the errors of a label, null being
    one; errors and sums beyond a long are the greatest long. Other columns are not read.
    An empty table gives no rows.
    """
    vectors = settled(integer_vectors(rows, scale), "vectors")
    width = _width(vectors)
    if width is None:
        books, sha = np.zeros((PARTS, ENTRIES, 1), np.int64), ""
    else:
        books = trained_books(vectors, width)
        sha = books_sha256(books)
    coded = settled(encode(vectors, books), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)"))
    sums = settled(coded.groupBy(F.col("label").alias("__label")).agg(total.cast("long").alias("label_error")), "sums")
    if sums.count() <= MOST_LABELS:
        sums = F.broadcast(sums)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("__label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256")
    )
