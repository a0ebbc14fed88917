import gzip
import random

import pytest

from pagelore.plans import jobs
from pagelore.sources.members import read_member_lines, write_member_lines
from tests.conftest import ordered, rows


def save(folder, name, *members):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(b"".join(gzip.compress(m) for m in members))


@pytest.fixture
def many(tmp_path):
    """One file of 1,000 members."""
    chance = random.Random(3)
    members = []
    for i in range(1000):
        lines = [b"%d %d " % (i, j) + chance.randbytes(30).hex().encode() for j in range(chance.randint(0, 9))]
        members.append(b"".join(line + b"\n" for line in lines) or b"\n")
    save(tmp_path / "in", "one.gz", *members)
    return str(tmp_path / "in"), [(line.decode(),) for m in members for line in m.splitlines()]


@pytest.mark.parametrize("bytes_per_task", [100, 10_000, 1 << 30])
def test_many_tasks_read_each_line_once(spark, many, bytes_per_task):
    path, expected = many
    read = read_member_lines(spark, path, bytes_per_task)
    assert rows(read) == ordered(expected)
    if bytes_per_task == 10_000:
        assert read.rdd.getNumPartitions() > 10


def test_as_the_text_reader_of_spark(spark, tmp_path):
    folder = tmp_path / "in"
    save(folder, "a.gz", b"one\r\ntwo\rthree\n\nfour\n", b"\n", b"", "fünf x\n".encode(), b"no break")
    save(folder, "b.gz", b"")
    save(folder, "_skipped.gz", b"hidden\n")
    (folder / "c.gz").write_bytes(gzip.compress(b"a\n") + b"\0" * 512 + gzip.compress(b"b\n") + b"\0")
    found = rows(read_member_lines(spark, str(folder), 40))
    expected = rows(spark.read.text(str(folder / "a.gz"))) + [("a",), ("b",)]
    assert found == ordered(expected)


def test_heads_inside_of_members_are_no_members(spark, tmp_path):
    """Stored blocks hold their text as it is, so that the range begins before a false head."""
    text = b"x" * 100 + b"\x1f\x8b\x08\x00" + b"y" * 100 + b"\n"
    (tmp_path / "s.gz").write_bytes(gzip.compress(text, 0) * 3)
    found = read_member_lines(spark, str(tmp_path / "s.gz"), 60).collect()
    assert [r.value for r in found] == [text[:-1].decode("utf-8", "replace")] * 3


def test_lines_longer_than_what_is_read_at_once(spark, tmp_path):
    long = b"ab" * 3_000_000
    save(tmp_path / "in", "l.gz", long + b"\nshort\n", b"end\n")
    found = read_member_lines(spark, str(tmp_path / "in"), 1000).collect()
    assert sorted(len(r.value) for r in found) == [3, 5, 6_000_000]


def test_broken_files_fail(spark, tmp_path):
    save(tmp_path / "in", "a.gz", b"a line that goes", b" on\n")
    with pytest.raises(Exception, match="ends within a line"):
        read_member_lines(spark, str(tmp_path / "in")).collect()
    whole = gzip.compress(b"some text\n" * 1000)
    (tmp_path / "cut.gz").write_bytes(whole[:-9])
    with pytest.raises(Exception, match="cut off"):
        read_member_lines(spark, str(tmp_path / "cut.gz")).collect()
    with pytest.raises(Exception, match="nowhere"):
        read_member_lines(spark, str(tmp_path / "nowhere")).collect()


def test_written_and_read_back(spark, table, tmp_path):
    lines = table("value", [("a",), (None,), ("ü",), ("",)] * 500)
    write_member_lines(lines.repartition(2), str(tmp_path / "out"), lines_per_member=7)
    files = list((tmp_path / "out").glob("*.gz"))
    assert len(files) == 2 and not list((tmp_path / "out").glob(".*.gz"))
    read = read_member_lines(spark, str(tmp_path / "out"), 500)
    assert rows(read) == ordered([("a",), ("",), ("ü",), ("",)] * 500)
    write_member_lines(lines.where("false"), str(tmp_path / "none"))
    assert read_member_lines(spark, str(tmp_path / "none")).count() == 0


def test_jobs_read_members(spark, tmp_path):
    save(tmp_path / "in", "a.gz", b"u\ta\tl\n", b"two\tfields\n", b"v\tb\tm\n")
    args = (spark, str(tmp_path / "in"), str(tmp_path / "out"), "drop")
    assert jobs.wiki_links_to_parquet(*args, members=True) == {"rows": 2, "bad_lines": 1}
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [("u", "a", "l"), ("v", "b", "m")]
