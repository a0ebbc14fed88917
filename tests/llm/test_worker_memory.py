"""What the pipeline's Python workers hold: little beside the rows they work on, one worker a task."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from pagelore.llm import mixing, ngram_join, packing, tokens, toxicity


@pytest.fixture
def traced():
    tracemalloc.start()
    yield
    tracemalloc.stop()


def test_known_pieces_take_few_bytes_each(traced):
    """200,000 different pieces are known afterwards, with a few numbers for each."""
    enc = tokens.Encoder(tokens.default_tokenizer(), added=True)
    enc.encode(pa.array(["what is imported at first use"]))
    before = tracemalloc.get_traced_memory()[0]
    words = [" ".join(f"w{i * 2000 + j}" for j in range(2000)) for i in range(100)]
    ids, first = enc.encode(pa.array(words))
    assert len(first) == 101
    expected = enc.encode(pa.array(words[:3]))
    assert np.array_equal(ids[: first[3]], expected[0]) and np.array_equal(first[:4], expected[1])
    del words, ids, first, expected
    assert tracemalloc.get_traced_memory()[0] - before < 64 * 200_000


def test_scores_hold_arrays_of_a_part_only(spark, traced, monkeypatch):
    """Neither scoring nor packing cuts up more than about a megabyte of text at a time."""
    seen = []
    for module in (toxicity, packing):
        slices = module.slices
        monkeypatch.setattr(
            module, "slices", lambda *args, f=slices: (seen.append(p) or p for p in f(*args))
        )
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(40)), "text": ["some words " * 20_000] * 40})
    run = {}

    class Rows:
        def __getattr__(self, name):
            return lambda *args, **kwargs: self

        def mapInArrow(self, function, schema):
            run["function"] = function
            return self

    frame = spark.range(1).selectExpr("id as doc_id", "'x' as text")
    monkeypatch.setattr(type(frame), "mapInArrow", Rows.mapInArrow)
    toxicity.with_score(frame, toxicity.Model(np.arange(3), np.ones(3), 0.0), keep=["doc_id"])
    scores = [x for b in run["function"]([batch]) for x in b.column(1).to_pylist()]
    assert len(scores) == 40
    packing.encode_pieces(frame, tokens.default_tokenizer())
    assert sum(b.num_rows for b in run["function"]([batch])) >= 40
    assert sum(p.num_rows for p in seen) == 80 and max(p.num_rows for p in seen) <= 5


def test_training_holds_its_state_and_the_batches(traced):
    """The state of 2**22 coordinates has 64 MB; rows and weights add no copies to it."""
    rng = np.random.default_rng(1)
    at = rng.integers(0, 1 << 22, 400 * 5000).astype(np.int32).reshape(400, 5000)
    at[:200, 0] = 7  # of all toxic rows
    label = np.array([1.0] * 200 + [0.0] * 200)
    lists = pa.ListArray.from_arrays(np.arange(0, 400 * 5000 + 1, 5000, dtype=np.int32), pa.array(at.ravel()))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(400)), pa.array(label), lists], ["doc_id", "label", "at"])
    state = toxicity.Ftrl((1 << 22) + 1)
    for _ in range(toxicity.PASSES):
        for row, y in zip(at, label):
            state.learn(np.append(row, np.int32(1 << 22)), y)
    weights = state.weights(slice(None))
    expected = np.flatnonzero(weights)
    del state
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    found = toxicity.learned(iter([batch]))
    assert tracemalloc.get_traced_memory()[1] - before < 96 << 20
    assert found[0].tolist() == expected.tolist() and 7 in found[0]
    assert found[1].tolist() == weights[expected].tolist()


def test_components_get_written_links(spark, monkeypatch):
    """No task verifies sets in one Python worker and thins their links in another one."""
    plans = []
    components = ngram_join.connected_components

    def noted(links):
        plans.append(links._jdf.queryExecution().toString())
        return components(links)

    monkeypatch.setattr(ngram_join, "connected_components", noted)
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, f"{text} x"), (3, "other words here")], "doc_id long, text string")
    found = ngram_join.similar_components(docs, ngram_join.Similarity(k=3, percent=90)).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 3}
    assert len(plans) == 2 and not any("MapInArrow" in p for p in plans)


def test_sources_are_numbered_without_python_rows(spark, monkeypatch, with_conf):
    """Weights follow the order of all sources, which lie in several partitions."""
    with_conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    names = sorted(f"s{i}" for i in range(49)) + [None]
    sizes = spark.createDataFrame([(name, 100) for name in names[::-1]], "source string, size long").repartition(5)
    monkeypatch.setattr(type(sizes), "rdd", property(lambda self: pytest.fail("rows go through Python")))
    found = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    weights = {name: i % 3 + 1 for i, name in enumerate(names)}
    each = 5000 / sum(weights.values())
    assert found == {name: pytest.approx(each * w) for name, w in weights.items()}
