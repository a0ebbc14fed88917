"""Binary token output: concatenated ids with Elias-Fano encoded document boundaries.

A shard file holds, one behind the other: the ids (2 or 4 bytes each, little-endian), the
boundaries, the document ids, and a footer of :data:`FOOTER` that says where each part lies.
Boundaries and document ids never fall, so both are stored as Elias-Fano sequences: about
2 + log2(largest / count) bits an entry. Shards hold ascending ranges of document ids.
"""

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelore.llm.storage import FileWriter, open_file, stage
from pagelore.llm.texthash import slices
from pagelore.llm.tokens import encoder
from pagelore.sources.staging import fresh_path

END_ID = 2
MAGIC = b"EFIDS001"
# magic, id width, ids, documents, documents without an id, smallest document id, size of both
# boundary parts
FOOTER = "<8sIqqqqqq"
_HEADER = "<qqI"
SAMPLE = 256


@dataclass
class EliasFano:
    """A non-decreasing sequence of integers from 0.

    The lowest ``low_bits`` of each value lie in an array of that width; value i sets bit
    ``(value >> low_bits) + i`` of the upper bits. Every 256th set bit's place is sampled, so
    one value is found by reading a few words.
    """

    count: int
    low_bits: int
    lows: np.ndarray
    uppers: np.ndarray
    samples: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        highs = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(highs[-1]) + 1 if n else 0, dtype=bool)
        bits[highs] = True
        lows = np.zeros((n, low_bits), dtype=bool)
        for b in range(low_bits):
            lows[:, b] = (values >> np.uint64(b)) & np.uint64(1)
        return cls(
            n, low_bits, np.packbits(lows.ravel(), bitorder="little"),
            np.packbits(bits, bitorder="little"), highs[::SAMPLE].astype("<i8"),
        )

    def to_bytes(self) -> bytes:
        head = struct.pack(_HEADER, self.count, len(self.uppers), self.low_bits)
        return b"".join([head, self.samples.tobytes(), self.lows.tobytes(), self.uppers.tobytes()])

    @classmethod
    def from_bytes(cls, raw: bytes) -> "EliasFano":
        n, upper_bytes, low_bits = struct.unpack_from(_HEADER, raw)
        at, parts = struct.calcsize(_HEADER), []
        sizes = (8 * -(-n // SAMPLE), -(-n * low_bits // 8), upper_bytes)
        for size, kind in zip(sizes, ("<i8", np.uint8, np.uint8)):
            parts.append(np.frombuffer(raw[at : at + size], dtype=kind))
            at += size
        return cls(n, low_bits, parts[1], parts[2], parts[0])

    def values(self) -> np.ndarray:
        """All values."""
        return self.selected(0, self.count)

    def select(self, i: int) -> int:
        """Value i, from the part between two samples that it lies in."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        return int(self.selected(i, i + 1)[0])

    def selected(self, first: int, last: int) -> np.ndarray:
        """Values ``first`` to ``last - 1``: the set bits behind the sample before the first,
        up to the sample behind the last, and their low bits. No other part is decoded."""
        last = min(last, self.count)
        if last <= first:
            return np.zeros(0, dtype=np.int64)
        sample, behind = first // SAMPLE, -(-last // SAMPLE)
        begin = int(self.samples[sample])
        end = int(self.samples[behind]) if behind < len(self.samples) else 8 * len(self.uppers)
        bits = np.unpackbits(self.uppers[begin // 8 : -(-end // 8)], bitorder="little")
        bits[: begin % 8] = 0
        skip = first - sample * SAMPLE
        places = np.flatnonzero(bits)[skip : skip + last - first] + begin // 8 * 8
        out = (places - np.arange(first, last)) << self.low_bits
        begin, end = first * self.low_bits, last * self.low_bits
        lows = np.unpackbits(self.lows[begin // 8 : -(-end // 8)], bitorder="little")[begin % 8 :]
        lows = lows[: end - begin].reshape(last - first, self.low_bits)
        for b in range(self.low_bits):
            out |= lows[:, b].astype(np.int64) << b
        return out


class ShardReader:
    """A shard file: its document ids, and the ids of any document or run of documents."""

    def __init__(self, folder: str, name: str):
        self._file = open_file(folder, name)
        size = self._file.size()
        tail = struct.calcsize(FOOTER)
        footer = struct.unpack(FOOTER, self._file.read_at(tail, size - tail))
        magic, width, self.ids, self.documents, self.nameless, self.lowest, a, b = footer
        if magic != MAGIC:
            raise ValueError(f"{name} is no token file")
        self._dtype = np.dtype(f"<u{width}")
        at = self.ids * width
        self.boundaries = EliasFano.from_bytes(self._file.read_at(a, at))
        self._names = EliasFano.from_bytes(self._file.read_at(b, at + a))

    def close(self) -> None:
        self._file.close()

    def doc_ids(self, first: int = 0, last: int | None = None) -> list[int | None]:
        """Ids of the documents from ``first`` to ``last - 1`` of the shard."""
        last = self.documents if last is None else last
        without = max(0, min(last, self.nameless) - first)
        named = self._names.selected(max(0, first - self.nameless), max(0, last - self.nameless))
        return [None] * without + (named + self.lowest).tolist()

    def runs(self) -> Iterator[tuple[int, np.ndarray]]:
        """Runs of documents with about a million ids or one long document, at most 1,024 of
        them: the first one's place, and where each begins and the last one ends. Found by
        select, run by run."""
        row = start = 0
        while row < self.documents:
            stops = self.boundaries.selected(row, row + 4 * SAMPLE)
            stops = stops[: max(1, int(np.searchsorted(stops, start + (1 << 20), "right")))]
            yield row, np.concatenate([[start], stops])
            row, start = row + len(stops), int(stops[-1])

    def between(self, start: int, stop: int) -> np.ndarray:
        width = self._dtype.itemsize
        raw = self._file.read_at((stop - start) * width, start * width)
        return np.frombuffer(raw, dtype=self._dtype)

    def document(self, i: int) -> np.ndarray:
        """Ids of document i of the shard, by two selects and one read."""
        start = self.boundaries.select(i - 1) if i else 0
        return self.between(start, self.boundaries.select(i))


def write_token_store(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID
) -> DataFrame:
    """Write all documents in ascending order of doc_id, null first; equal ids by their text's
    hash. Returns the catalogue (shard, file, documents, ids, start), one row a file.

    Ids are those of a plain call of the tokenizer, added tokens included. Null texts are empty
    and have the end id only. Other columns than doc_id and text are
    ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, added=True)
        shard = TaskContext.get().partitionId()
        out, names, stops, used, nameless = None, [], [], 0, 0
        for batch in batches:
            for part in slices(batch, 1):
                out = out or FileWriter(folder, f"shard-{shard:06d}")
                ids, first = enc.encode(part.column(1))
                ids = np.insert(ids, first[1:], np.array(end_id, dtype=enc.dtype))
                out.write(np.ascontiguousarray(ids).data)
                stops.append(used + first[1:] + np.arange(1, len(first)))
                used += len(ids)
                nameless += part.column(0).null_count
                names.append(part.column(0).drop_null().to_numpy())
        if out is None:
            return
        known = np.concatenate(names)
        ends = np.concatenate(stops)
        lowest = int(known[0]) if len(known) else 0
        offsets = (known.astype(np.int64) - lowest).view(np.uint64)
        parts = [EliasFano.of(ends).to_bytes(), EliasFano.of(offsets).to_bytes()]
        for part in parts:
            out.write(part)
        sizes = [len(part) for part in parts]
        head = (MAGIC, enc.dtype.itemsize, used, len(ends), nameless, lowest)
        out.write(struct.pack(FOOTER, *head, *sizes))
        out.close()
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([shard], pa.int32()), "file": [out.name],
                "documents": [len(ends)], "ids": [used],
            }
        )

    wanted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    ordered = wanted.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    files = ordered.mapInArrow(run, "shard int, file string, documents long, ids long")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("ids").over(before), F.lit(0))
    return stage(files, "token-shards").withColumn("start", start)


def read_token_store(catalogue: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; ids as little-endian 32-bit binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = ShardReader(folder, name)
                for row, edges in reader.runs():
                    documents = len(edges) - 1
                    ids = reader.between(int(edges[0]), int(edges[-1])).astype("<u4")
                    places = (edges - edges[0]) * 4
                    packed = pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), documents,
                        [None, pa.py_buffer(places), pa.py_buffer(ids.tobytes())],
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(reader.doc_ids(row, row + documents), pa.int64()),
                            pa.array(edges[:-1] + base), pa.array(np.diff(edges)),
                            packed.cast(pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )
                reader.close()

    # One task a shard: the number is given, as rows so small would all be put into one task.
    shards = catalogue.select("file", "start").repartition(max(1, catalogue.count()), "file")
    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def token_store_round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the documents, then read all of them back from the files."""
    folder = fresh_path(docs.sparkSession, "token-store")
    return read_token_store(write_token_store(docs, folder, tokenizer, end_id), folder)
