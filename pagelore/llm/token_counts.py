"""Token counts of documents in flat token files that have no index.

A token file is nothing but ids, each document followed by the end id. The files are cut into
blocks of one size, every block is searched for end ids on its own, and a prefix scan over the
blocks' summaries gives the documents that cross block borders their length.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelore.llm.storage import FileWriter, open_file, stage
from pagelore.llm.texthash import slices
from pagelore.llm.tokens import encoder
from pagelore.sources.staging import fresh_path

END_OF_TEXT = 50256
BLOCK_IDS = 1 << 20
RUN_BLOCKS = 1024
TASK_BLOCKS = 64


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_OF_TEXT,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Write one flat file for each partition; null texts are empty documents.

    Returns (file, bytes, width, ordinal, id_column): which document stands where. The files
    themselves hold ids only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        shard = TaskContext.get().partitionId()
        out, keys = None, []
        for batch in batches:
            for part in slices(batch, 1):
                out = out or FileWriter(folder, f"tokens-{shard:06d}")
                ids, first = enc.encode(part.column(1))
                ids = np.insert(ids, first[1:], np.array(end_id, dtype=enc.dtype))
                out.write(np.ascontiguousarray(ids).data)
                keys.append(part.column(0))
        if out is None:
            return
        out.close()
        rows = sum(map(len, keys))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([out.name] * rows),
                pa.array(np.full(rows, out.size, dtype=np.int64)),
                pa.array(np.full(rows, enc.dtype.itemsize, dtype=np.int32)),
                pa.array(np.arange(rows, dtype=np.int64)),
                pa.concat_arrays(keys),
            ],
            ["file", "bytes", "width", "ordinal", id_column],
        )

    wanted = docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string"))
    return wanted.mapInArrow(
        run, f"file string, bytes long, width int, ordinal long, `{id_column}` long"
    )


def blocks_of(files: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(file, bytes, width) -> one row for each block of a file, dealt out evenly."""
    size = F.col("width") * F.lit(block_ids)
    count = F.ceil(F.col("bytes") / size)
    blocks = files.where("bytes > 0").select(
        "file", "bytes", "width", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("block")
    )
    # The number of tasks is given, as rows so small would all be put into one.
    total = files.agg(F.sum(F.ceil(F.col("bytes") / size))).first()[0] or 0
    least = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(max(least, -(-total // TASK_BLOCKS)), "file", "block")


def find_ends(blocks: DataFrame, folder: str, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(file, block, ids, ends): length of each block and the places of end ids in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, size, width, block in zip(*(batch.column(i).to_pylist() for i in range(4))):
                at = block * block_ids * width
                with open_file(folder, file) as f:
                    raw = f.read_at(min(size - at, block_ids * width), at)
                ids = np.frombuffer(raw, dtype=f"<u{width}")
                ends = np.flatnonzero(ids == end_id).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file]),
                        pa.array([block], pa.int64()),
                        pa.array([len(ids)], pa.int64()),
                        pa.ListArray.from_arrays(np.array([0, len(ends)], dtype=np.int32), pa.array(ends)),
                    ],
                    ["file", "block", "ids", "ends"],
                )

    return blocks.select("file", "bytes", "width", "block").mapInArrow(
        run, "file string, block long, ids long, ends array<long>"
    )


def stitch(found: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(file, block, ids, ends) -> (file, ordinal, start, n_tokens, ended), one row a document.

    The scan runs in two levels, first within runs of blocks and then over the runs, so that
    no task sees all blocks of a huge file. ``n_tokens`` counts the end id. Ids behind the last
    end id of a file make a document that has not ended.
    """
    base = F.col("block") * block_ids
    blocks = found.select(
        "file", "block", "ids", "ends", F.floor(F.col("block") / RUN_BLOCKS).alias("run"),
        F.size("ends").cast("long").alias("n"),
        F.when(F.size("ends") > 0, base + F.element_at("ends", -1) + 1).alias("after"),
    )
    runs = blocks.groupBy("file", "run").agg(F.sum("n").alias("n"), F.max("after").alias("after"))
    earlier = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    carried = runs.select(
        "file", "run",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("run_first"),
        F.coalesce(F.max("after").over(earlier), F.lit(0)).alias("run_start"),
        (F.row_number().over(Window.partitionBy("file").orderBy(F.desc("run"))) == 1).alias("last_run"),
    )
    within = Window.partitionBy("file", "run").orderBy("block")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    scanned = blocks.join(carried, ["file", "run"]).select(
        "file", "block", "ids", "ends",
        (F.col("run_first") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("first"),
        F.coalesce(F.max("after").over(before), F.col("run_start")).alias("open_at"),
        (F.col("last_run") & F.lead("block").over(within).isNull()).alias("last"),
    )
    return _documents(scanned, base)


def _documents(scanned: DataFrame, base: Column) -> DataFrame:
    stops = F.transform("ends", lambda p: p + base + 1)
    total = base + F.col("ids")
    still_open = F.col("last") & (F.coalesce(F.element_at(stops, -1), F.col("open_at")) < total)
    tail = F.when(still_open, F.array(total)).otherwise(F.array().cast("array<long>"))
    ends = F.concat(stops, tail)
    starts = F.slice(F.concat(F.array("open_at"), stops), 1, F.size(ends))
    pairs = F.arrays_zip(starts.alias("start"), ends.alias("stop"))
    parts = scanned.where((F.size("ends") > 0) | still_open).select(
        "file", "first", F.size("ends").alias("n"), F.posexplode(pairs).alias("k", "doc")
    )
    return parts.select(
        "file", (F.col("first") + F.col("k")).alias("ordinal"), F.col("doc.start").alias("start"),
        (F.col("doc.stop") - F.col("doc.start")).alias("n_tokens"),
        (F.col("k") < F.col("n")).alias("ended"),
    )


def token_counts(
    files: DataFrame, folder: str, end_id: int = END_OF_TEXT, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """Documents of flat files (file, bytes, width) under a folder: where they start, how long
    they are. Empty files have no documents; an end id right after another is a document of
    one id."""
    found = find_ends(blocks_of(files, block_ids), folder, end_id, block_ids)
    return stitch(stage(found, "ends"), block_ids)


def document_token_counts(
    docs: DataFrame, tokenizer: str, end_id: int = END_OF_TEXT, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """(doc_id, file, ordinal, start, n_tokens) by way of flat files.

    Null and empty texts have one id, the end id. Repeated rows and null doc_ids are documents
    of their own. Other columns are ignored.
    """
    folder = fresh_path(docs.sparkSession, "token-files")
    written = stage(write_token_files(docs, folder, tokenizer, end_id), "token-documents")
    files = written.where("ordinal = 0").select("file", "bytes", "width")
    counted = token_counts(files, folder, end_id, block_ids)
    names = written.select("doc_id", "file", "ordinal")
    return names.join(counted, ["file", "ordinal"]).select(
        "doc_id", "file", "ordinal", "start", "n_tokens"
    )
