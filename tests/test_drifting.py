import json

import pytest

from pagelore.plans.jobs import raw_pages_to_parquet
from pagelore.sources.readers import read_drifting_json

LINES = [
    {"url": "a", "n": 1, "tags": ["x"], "at": {"k": 1}, "none": None, "VOID": "OBJECT<"},
    {"url": "b", "n": "one", "tags": [2], "at": {"k": "2", "odd `name": 1}, "extra": {}},
    {"url": "c", "n": [True], "deep": [{"v": 1.5}, {"v": 2}]},
    {},
]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "lines").mkdir()

    def write(*lines):
        (tmp_path / "lines" / "part.json").write_text("\n".join(lines) + "\n")
        return str(tmp_path / "lines")

    return write


def as_json(df):
    return by_url(json.loads(line) for line in df.toJSON().collect())


def by_url(found):
    return sorted(found, key=lambda row: row.get("url", ""))


def without_nulls(value):
    if isinstance(value, dict):
        return {k: without_nulls(v) for k, v in value.items() if v is not None}
    return [without_nulls(v) for v in value] if isinstance(value, list) else value


def test_fields_that_change_their_kind(spark, folder):
    path = folder(*map(json.dumps, LINES), "", "  ")
    read = read_drifting_json(spark, path)
    kinds = dict(read.dtypes)
    assert kinds["url"] == kinds["none"] == kinds["VOID"] == "string"
    assert kinds["n"] == kinds["extra"] == "variant"
    assert kinds["tags"] == "array<variant>"
    assert as_json(read) == by_url(map(without_nulls, LINES))


def test_lines_that_are_no_objects(spark, folder):
    path = folder('{"url": "a"}', "{broken", "[1]", "null", "7", '{"url": "b"}')
    kept = read_drifting_json(spark, path, on_bad="drop")
    assert sorted(row.url for row in kept.collect()) == ["a", "b"]
    with pytest.raises(Exception, match="MALFORMED_RECORD|no JSON object"):
        read_drifting_json(spark, path).collect()
    with pytest.raises(Exception, match="no JSON object"):
        read_drifting_json(spark, folder("[1]")).collect()


def test_no_lines_and_no_fields(spark, folder):
    nothing = read_drifting_json(spark, folder(""))
    assert nothing.columns == [] and nothing.count() == 0
    without = read_drifting_json(spark, folder("{}", "{}"))
    assert without.columns == [] and without.count() == 2


def test_job_writes_such_fields(spark, folder, tmp_path):
    path = folder('{"url": "a", "n": 1}', '{"url": "b", "n": "x"}')
    raw_pages_to_parquet(spark, path, str(tmp_path / "out"), drifting=True)
    assert as_json(spark.read.parquet(str(tmp_path / "out"))) == [
        {"url": "a", "n": 1}, {"url": "b", "n": "x"},
    ]
