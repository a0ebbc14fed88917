"""Exact dedup by recipes of content-defined chunks.

Texts are cut where a rolling hash of their bytes says so, so equal texts have equal chunks. A
document's recipe is the ordered list of its chunks' identifiers; recipes, not texts, are
grouped. An identifier is a digest, and digests are verified: the bytes of chunks that share
one are compared, and where they differ the bytes themselves become the identifier. Only chunks
of documents whose recipe occurs more than once are moved for that, once.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelore.llm.storage import stage, temporaries
from pagelore.llm.texthash import BYTES, slices, text_bytes
from pagelore.operators.prefilter import MOST_BYTES, key_filter, maybe_in

#: Chunks have about 2**11 bytes, between these limits (the last one may be shorter).
MEAN_BITS = 11
LEAST, MOST = 256, 1 << 16
#: Bits of the filter of digests that different chunks share. There are none but by an accident
#: of 128 bits; were it full, more chunks would be named by their bytes, with the same results.
FILTER_BITS = 1 << 20
DIGEST_BYTES = 16
#: A task remembers so many bytes of chunks that it has already named.
SEEN_BYTES = 32 << 20
_REACH = 32
_GEAR = (BYTES >> np.uint64(32)).astype(np.uint32)


def cut_places(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text, its own end included; none for an empty text.

    The hash at a byte covers the 32 bytes up to it, in 32 bits.
    """
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    h = _GEAR[data]
    reach = 1
    while reach < _REACH:
        shifted = h[:-reach] << np.uint32(reach) if len(h) > reach else h[:0]
        h = h.copy()
        h[reach:] += shifted
        reach *= 2
    marks = np.flatnonzero(h >> np.uint32(32 - MEAN_BITS) == 0) + 1
    ends, last = [], 0
    for place in [*marks.tolist(), len(data)]:
        while place - last > MOST:
            last += MOST
            ends.append(last)
        if place - last >= LEAST or place == len(data):
            if place > last:
                ends.append(place)
            last = place
    return np.array(ends, dtype=np.int64)


def _chunks(data: np.ndarray) -> list[bytes]:
    raw, out, last = data.tobytes(), [], 0
    for end in cut_places(data).tolist():
        out.append(raw[last:end])
        last = end
    return out


def _digest(chunk: bytes, size: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=size).digest()


def _documents(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    data, offsets = text_bytes(part.column(1))
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield data[start:end], _chunks(data[start:end])


def _identifiers(chunks: list[bytes], size: int, doubtful: np.ndarray) -> list[bytes]:
    out = []
    for chunk in chunks:
        digest = _digest(chunk, size)
        out.append(b"c" + chunk if doubtful[_bit(digest)] else b"d" + digest)
    return out


def _bit(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little") % FILTER_BITS


def _recipe_hash(recipe: list[bytes]) -> int:
    whole = hashlib.blake2b(digest_size=8)
    for identifier in recipe:
        whole.update(len(identifier).to_bytes(8, "little") + identifier)
    return int.from_bytes(whole.digest(), "little", signed=True)


def _filter(bits: DataFrame) -> np.ndarray:
    """A column of bit numbers as a packed filter; at most FILTER_BITS small numbers travel."""
    marked = np.zeros(FILTER_BITS, dtype=bool)
    marked[bits.distinct().toArrow().column(0).to_numpy()] = True
    return np.packbits(marked)


def _no_bits() -> np.ndarray:
    return np.packbits(np.zeros(FILTER_BITS, dtype=bool))


def recipes(
    docs: DataFrame, digest_bytes: int = DIGEST_BYTES, doubtful: np.ndarray | None = None
) -> DataFrame:
    """(row, doc_id, text_hash, text_sha256, recipe, recipe_hash): a number for the row, hashes of
    the text, the identifiers of its chunks in order, and a hash of that list. Chunks whose
    digest the packed filter ``doubtful`` marks are identified by their bytes."""
    packed = _no_bits() if doubtful is None else doubtful

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        marked = np.unpackbits(packed).astype(bool)
        for batch in batches:
            for part in slices(batch, 1):
                shas, lists = [], []
                for data, chunks in _documents(part):
                    shas.append(hashlib.sha256(data).hexdigest())
                    lists.append(_identifiers(chunks, digest_bytes, marked))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + part.num_rows)), part.column(0),
                        part.column(2), pa.array(shas), pa.array(lists, pa.list_(pa.binary())),
                        pa.array([_recipe_hash(x) for x in lists], pa.int64()),
                    ],
                    ["row", "doc_id", "text_hash", "text_sha256", "recipe", "recipe_hash"],
                )
                row += part.num_rows

    return _wanted(docs).mapInArrow(
        run,
        "row long, doc_id long, text_hash long, text_sha256 string, recipe array<binary>,"
        " recipe_hash long",
    )


def _wanted(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text, F.xxhash64(text).alias("text_hash"))


def repeated_texts(found: DataFrame) -> DataFrame:
    """(text_hash) of the texts whose recipe occurs more than once. Copies are counted first, so
    only different texts of one recipe meet."""
    counted = found.groupBy("recipe_hash", "text_hash").agg(F.count("*").alias("n"))
    rows = F.sum("n").over(Window.partitionBy("recipe_hash"))
    return counted.select("text_hash", rows.alias("rows")).where("rows > 1").select("text_hash")


def shared_chunks(
    docs: DataFrame, found: DataFrame, digest_bytes: int = DIGEST_BYTES, most_bytes: int = MOST_BYTES
) -> DataFrame:
    """(digest, chunk) of the documents whose recipe occurs more than once.

    A filter of their texts' hashes, sized by their number up to ``most_bytes``, leaves the other
    documents out where they are read; what passes it by chance does no harm. A task leaves out a
    chunk that it has just named; what it remembers is bounded.
    """
    repeated = stage(repeated_texts(found), "repeated-texts")
    wanted = maybe_in(_wanted(docs), "text_hash", key_filter(repeated, "text_hash", most_bytes))
    nothing = np.zeros(FILTER_BITS, dtype=bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, bytes] = {}
        size = 0
        for batch in batches:
            for part in slices(batch, 1):
                digests, named = [], []
                for _, chunks in _documents(part):
                    for identifier, chunk in zip(_identifiers(chunks, digest_bytes, nothing), chunks):
                        if seen.get(identifier) != chunk:
                            digests.append(identifier[1:])
                            named.append(chunk)
                            seen[identifier] = chunk
                            size += len(chunk)
                    if size > SEEN_BYTES:
                        seen, size = {}, 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array(named, pa.binary())], ["digest", "chunk"]
                )

    return wanted.mapInArrow(run, "digest binary, chunk binary")


def verified_recipes(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """The rows of :func:`recipes`, where equal recipes mean equal texts."""
    found = stage(recipes(docs, digest_bytes), "recipes", keep=True)
    chunks = shared_chunks(docs, found, digest_bytes)
    verified = chunks.groupBy("digest").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    doubtful = stage(verified.where("least <> most").select("digest"), "doubtful-digests")
    if doubtful.isEmpty():
        return found
    first = F.reverse(F.substring(F.col("digest"), 1, 8))
    bits = _filter(doubtful.select(_long(first)))
    return stage(recipes(docs, digest_bytes, bits), "recipes", keep=True)


def _long(bigendian):
    """The lowest bits of an integer in up to eight bytes; FILTER_BITS is a power of two."""
    tail = F.substring(F.hex(bigendian), -(FILTER_BITS.bit_length() // 4 + 1), FILTER_BITS)
    return F.pmod(F.conv(tail, 16, 10).cast("long"), F.lit(FILTER_BITS)).cast("int")


def exact_duplicates(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """(doc_id, text_sha256, keep_id, group_size, kept), one row a document.

    Texts are compared byte by byte as they are; null counts as empty. Of equal texts the row
    with the largest doc_id is kept; a null id is smaller than any other, and of rows equal in
    id and text one is kept. Columns other than doc_id and text are ignored.
    """
    with temporaries(docs.sparkSession):
        found = verified_recipes(docs, digest_bytes)
    groups = stage(
        found.groupBy("recipe_hash", "recipe").agg(
            F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size")
        ).where("group_size > 1"),
        "copy-groups", keep=True,
    ).select(
        F.col("recipe_hash").alias("group_hash"), F.col("recipe").alias("group_recipe"), "best", "group_size"
    )
    joined = found.join(
        groups,
        (F.col("recipe_hash") == F.col("group_hash")) & (F.col("recipe") == F.col("group_recipe")),
        "left",
    )
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id", "text_sha256", F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("best.row"))).alias("kept"),
    )


#: SQL for the whole result on ``documents``.
SQL = """
SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256,
       max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
