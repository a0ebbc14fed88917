"""The pipeline's stages on planted rows."""

import zlib

import corpus_pipeline as pipeline

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    previous = docs
    for name, function in pipeline.STAGES[:-1]:
        result = function(spark, previous, SF_DIR).select("*")
        assert result.columns == list(pipeline.COLUMNS), name
        ids = {r.doc_id for r in result.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in previous.select("doc_id").collect()}
        path = f"{spark.conf.get('spark.checkpoint.dir')}/{name.replace(' ', '-')}-test"
        result.write.mode("overwrite").parquet(path)
        previous = spark.read.parquet(path)
    packed = pipeline.STAGES[-1][1](spark, previous, SF_DIR)
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").isEmpty()
    assert packed.where("piece = 0").count() == previous.count()


def test_run_is_the_stages(spark):
    assert pipeline.run(spark, SF_DIR).count() > 0


def test_toxicity_stage_without_usable_labels(spark, tmp_path):
    """Labels that teach nothing reject no document."""
    docs = spark.createDataFrame(
        [(i, f"clean words {i}", "en", "s", 13) for i in range(8)] + [(None, None, None, None, None)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2]
    cases = {
        "empty": [], "null": [(i, None) for i in range(8)], "no id": [(None, 1)],
        "held out": [(i, 1) for i in held], "unknown": [(1000 + i, 1) for i in range(8)],
    }
    for name, labels in cases.items():
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
        left = pipeline.drop_toxic(spark, docs, folder)
        assert left.columns == list(pipeline.COLUMNS)
        assert sorted(map(str, left.collect())) == sorted(map(str, docs.select(*pipeline.COLUMNS).collect())), name


def test_line_stage_takes_passages_on_two_sites(spark):
    """Lines of over 50 words go from two sites on, shorter ones from three; none within one."""
    passage, limit = " ".join(f"w{i}" for i in range(51)), " ".join(f"v{i}" for i in range(50))
    inside, menu = " ".join(f"u{i}" for i in range(60)), "home about contact"
    rows = [
        (1, f"a\n{passage}\n{limit}\n{menu}", "s1"), (2, f"b\n \t{passage}\r\n{limit}\n{menu}", "s2"),
        (3, f"c\n{inside}\n{menu}", "s3"), (4, f"{inside}\nd", "s3"), (5, f"{passage}\ne", "s1"), (6, None, None),
    ]
    docs = spark.createDataFrame(
        [(i, t, "en", s, t and len(t)) for i, t, s in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    left = {r.doc_id: (r.text, r.n_chars) for r in pipeline.drop_boilerplate(spark, docs, SF_DIR).collect()}
    texts = {1: rows[0][1], 2: f"b\n{limit}", 3: f"c\n{inside}", 4: rows[3][1], 5: "e", 6: None}
    assert left == {i: (t, t and len(t)) for i, t in texts.items()}
