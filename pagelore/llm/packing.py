"""Best-fit decreasing packing of tokenised documents into sequences of one length.

Documents of one length are alike to the packer, and so are open sequences with the same room.
The plan is therefore made for counts of lengths instead of single documents: it is the plan
that best-fit decreasing would make document by document, but its cost depends on the sequence
length only. Spark counts the lengths, ranks the documents of each length and looks up each
rank's place.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagelore.llm.storage import stage
from pagelore.llm.texthash import PART_BYTES, slices
from pagelore.llm.tokens import encoder

SEQUENCE_TOKENS = 1024
END_ID = 2
#: Rows of one key are ranked in so many parts, as a power of two.
SALT_BITS = 10


class RoomTree:
    """How many open sequences there are for each remaining capacity, as a segment tree."""

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._sums = [0] * (2 * self._leaves)

    def add(self, room: int, n: int) -> None:
        node = room + self._leaves
        while node:
            self._sums[node] += n
            node //= 2

    def tightest(self, need: int) -> int | None:
        """The smallest capacity of at least ``need`` that an open sequence has."""
        node = need + self._leaves
        while not self._sums[node]:
            while node & 1:  # a right child: what is right of it lies under another parent
                node //= 2
            if node == 0:
                return None
            node += 1
        while node < self._leaves:
            node *= 2
            if not self._sums[node]:
                node += 1
        return node - self._leaves


def best_fit_plan(lengths: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, rank, sequence, per, offset), ascending.

    Documents of a length with ranks from ``rank`` up to the next row's go to the sequences
    from ``sequence`` on, ``per`` into each, the first at ``offset``. There are at most
    3 * capacity runs of alike sequences and each length meets a run once, so the plan has no
    more than 3 * capacity ** 2 rows however many documents there are; usually a few for each
    length.
    """
    tree = RoomTree(capacity)
    open_runs: dict[int, list[tuple[int, int]]] = {}
    plan: list[tuple[int, int, int, int, int]] = []
    used = 0

    def leave(room: int, first: int, n: int) -> None:
        if n and room:
            open_runs.setdefault(room, []).append((first, n))
            tree.add(room, n)

    for length in sorted(lengths, reverse=True):
        left, rank = lengths[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first = capacity, used
                n = -(-left // (capacity // length))
                used += n
            else:
                first, n = open_runs[room].pop()
                tree.add(room, -n)
            per = room // length
            full = min(n, left // per)
            plan.append((length, rank, first, per, capacity - room))
            leave(room - per * length, first, full)
            rank, left = rank + full * per, left - full * per
            if full < n and left:  # the last sequence that documents of this length reach
                leave(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            leave(room, first + full, n - full)
    return np.array(sorted(plan), dtype=np.int64).reshape(-1, 5)


def encode_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = SEQUENCE_TOKENS, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, piece, start, length, ids): the ids of every text, as a plain call of the
    tokenizer gives them, with the end id behind.

    Only documents of more than ``capacity`` ids are cut: all pieces but the first have
    ``capacity`` ids. Null texts are empty and have the end id only. ``ids`` is little-endian
    32-bit binary. Columns other than doc_id and text are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, added=True)
        for batch in batches:
            for part in slices(batch, 1, PART_BYTES):
                ids, first = enc.encode(part.column(1))
                ids = np.insert(ids, first[1:], np.array(end_id, dtype=enc.dtype)).astype("<u4")
                first = first + np.arange(len(first))
                n = np.diff(first)
                head = (n - 1) % capacity + 1
                pieces = (n - head) // capacity + 1
                row = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = np.where(piece > 0, head[row] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head[row])
                edges = np.append(first[row] + start, first[-1])
                packed = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(row),
                    [None, pa.py_buffer(edges * 4), pa.py_buffer(ids.tobytes())],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)),
                        pa.array(start), pa.array(length), packed.cast(pa.binary()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    wanted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return wanted.mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids binary"
    )


def pack(items: DataFrame, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table with a column ``length`` (1 to capacity).

    Rows are packed as they are, equal ones too, each once. All other columns pass through;
    columns of the added names are replaced. The table is read twice, so hand in a staged one.
    Lengths outside of the range fail.
    """
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(length is None or not 1 <= length <= capacity for length in counts):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    plan = best_fit_plan(counts, capacity)
    names = [c for c in items.columns if c.lower() not in ("sequence_id", "offset")]
    # Columns go by their number on the way, whatever their names are.
    at = names.index("length")
    numbered = items.select(*(F.col(_quoted(c)).alias(f"column{i}") for i, c in enumerate(names)))
    passed = numbered.schema.fields
    ranked = rank_within(numbered, f"column{at}", "rank")
    keys = (plan[:, 0] << 44) | plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(at).cast(pa.int64()).to_numpy(zero_copy_only=False)
            rank = batch.column(len(names)).to_numpy(zero_copy_only=False)
            row = plan[np.searchsorted(keys, (length << 44) | rank, side="right") - 1]
            nth = rank - row[:, 1]
            sequence = row[:, 2] + nth // row[:, 3]
            offset = row[:, 4] + nth % row[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(sequence), pa.array(offset)],
                [*(f.name for f in passed), "sequence_id", "offset"],
            )

    out = StructType([*passed]).add("sequence_id", "long").add("offset", "long")
    placed = ranked.mapInArrow(place, out)
    return placed.select(
        *(F.col(f.name).alias(c) for f, c in zip(passed, names)), "sequence_id", "offset"
    )


def rank_within(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Number the rows of each key from 0, in any order. The key may be a struct; null is a key.

    Rows are numbered within a key and the top bits of the row's hash, and counts of lower top
    bits are added, so that a key with a third of all rows is spread over many tasks. The order
    is that of the hash, whatever the settings of the session, so repeated tasks and reruns
    agree. Columns may have any names.
    """
    hashed = F.xxhash64(*(F.col(_quoted(c)) for c in rows.columns))
    packed = rows.select(
        F.struct(*(F.col(_quoted(c)) for c in rows.columns)).alias("row"),
        F.struct(F.col(_quoted(key)).alias("key")).alias("key"), hashed.alias("tie"),
    )
    salted = packed.withColumn("salt", F.shiftrightunsigned("tie", 64 - SALT_BITS))
    counts = salted.groupBy(F.col("key").alias("of_key"), F.col("salt").alias("of_salt")).agg(
        F.count("*").alias("n")
    )
    earlier = Window.partitionBy("of_key").orderBy("of_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("of_key", "of_salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("key", "salt").orderBy("tie")) - 1
    joined = salted.withColumn("own", own).join(
        before, (F.col("key") == F.col("of_key")) & (F.col("salt") == F.col("of_salt"))
    )
    rank = (F.col("before") + F.col("own")).cast("long").alias(name)
    return joined.select(*(F.col("row")[c].alias(c) for c in rows.columns), rank)


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = SEQUENCE_TOKENS, end_id: int = END_ID
) -> DataFrame:
    """All pieces of all documents with their ids and their place in a sequence."""
    return pack(stage(encode_pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the finished sequences, ids as little-endian 32-bit binary."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(
        parts, F.lit(b"").cast("binary"), lambda done, p: F.concat(done, p["ids"])
    )
    return packed.groupBy("sequence_id").agg(whole.alias("ids"))
