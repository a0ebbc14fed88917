"""Reading by select: any run of values, any document, and the registered query."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelore.llm import queries, storage, token_store, tokens
from pagelore.llm.token_store import EliasFano, ShardReader


def test_any_run_of_values():
    rng = np.random.default_rng(2)
    for n in (1, 255, 256, 257, 1500):
        for top in (1, 300, 1 << 50):
            values = np.sort(rng.integers(0, top, n))
            coded = EliasFano.from_bytes(EliasFano.of(values).to_bytes())
            for first, last in rng.integers(0, n + 2, (60, 2)):
                assert coded.selected(first, last).tolist() == values[first:last].tolist()


def test_a_run_decodes_no_other_part():
    """Words before the sample in front of a run, and behind the one after it, may be gone."""
    values = np.arange(0, 30_000, 3)
    coded = EliasFano.of(values)
    begin, end = int(coded.samples[4]) // 8, int(coded.samples[6]) // 8 + 1
    coded.uppers[:begin] = 255
    coded.uppers[end:] = 255
    assert coded.selected(1030, 1500).tolist() == values[1030:1500].tolist()


def test_single_documents_of_a_written_store(spark, tmp_path):
    from tokenizers import Tokenizer

    path = tokens.default_tokenizer()
    plain = Tokenizer.from_file(path)
    text = F.when(F.col("id") % 7 != 0, F.repeat(F.lit("some words "), (F.col("id") % 50).cast("int")))
    docs = spark.range(0, 3000, 1, 3).select(F.expr("nullif(id, 5)").alias("doc_id"), text.alias("text"))
    folder = f"file://{tmp_path}/store"
    shards = token_store.write_token_store(docs, folder, path).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    seen = []
    for shard in shards:
        reader = ShardReader(folder, shard.file)
        names = reader.doc_ids()
        assert names[3:9] == reader.doc_ids(3, 9)
        assert [row for row, _ in reader.runs()][:1] == [0]
        for i in range(0, len(names), 97):
            ids = plain.encode(texts[names[i]], add_special_tokens=False).ids + [2]
            assert reader.document(i).tolist() == ids
        seen += names
        reader.close()
    assert seen[0] is None and seen[1:] == sorted(seen[1:]) and len(seen) == 3000


def test_registered_query(spark, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_tokenizer())
    rows = [(3, "Ünï\ncode"), (1, None), (2, ""), (9, "word " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op9_token_store"](spark, str(tmp_path))
    assert found.dtypes == [
        ("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint"),
    ]
    expected, start = [], 0
    for doc_id, text in sorted(rows):
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found.collect())) == expected


@pytest.mark.parametrize("scheme", ["s3", "s3a", "s3n"])
def test_addresses_of_spark_are_known_to_arrow(scheme, monkeypatch):
    asked = []
    monkeypatch.setattr(storage, "pafs", _Recorder(asked))
    storage.open_folder(f"{scheme}://bucket/a%20b/c")
    storage.open_folder("file:/tmp/x")
    assert asked == ["s3://bucket/a%20b/c", "file:/tmp/x"]


class _Recorder:
    def __init__(self, asked):
        self.FileSystem = type("FileSystem", (), {"from_uri": staticmethod(asked.append)})
