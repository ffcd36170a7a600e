"""Files with quoted line breaks read in ranges, against the csv module and Spark's own reader."""

import csv
import random

import pytest

from textlake.plans import queries
from textlake.sources import parallel_csv, readers

NAMES = ["id", "content", "domain"]


def written(path, rows, header=True, sep=",", end="\n", encoding="utf-8"):
    with open(path, "w", newline="", encoding=encoding) as file:
        writer = csv.writer(file, delimiter=sep, lineterminator=end)
        writer.writerows(([NAMES] if header else []) + rows)
    return str(path)


@pytest.fixture(scope="module")
def rows():
    random.seed(7)
    parts = ['"', "\n", "\n\n", ",", "\t", '""', "word", "é", "\r\n", " ", "x" * 30, "'"]
    return [[str(i), "".join(random.choices(parts, k=random.randint(1, 12))) + ".",
             "".join(random.choices(parts, k=2)) + "d"] for i in range(150)]


def read(spark, path, size, **options):
    ranged = parallel_csv.with_range_bytes(spark, size)
    df = readers.read_articles_csv(ranged, path, na_values=[], in_ranges=True, **options)
    return df, sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("size", [40, 97, 500, 5000, 1 << 20])
def test_equals_csv_module_for_any_ranges(spark, tmp_path, rows, size):
    path = written(tmp_path / "a.csv", rows)
    df, found = read(spark, path, size)
    assert df.columns == NAMES and found == sorted(map(tuple, rows))


def test_several_tasks_read_one_file_like_one_task(spark, tmp_path, rows):
    path = written(tmp_path / "a.csv", rows)
    ranged = parallel_csv.with_range_bytes(spark, 500)
    lines = parallel_csv._lines(ranged, [path])
    assert lines.rdd.getNumPartitions() >= 8
    states = parallel_csv.quote_parity(ranged, [path]).collect()
    assert len(states) >= 8 and {s["inside"] for s in states} == {True, False}
    one = readers.read_articles_csv(spark, path, na_values=[], in_ranges=False)
    assert one.rdd.getNumPartitions() == 1
    plain = [r for r in rows if "\r" not in r[1] + r[2]]
    path = written(tmp_path / "b.csv", plain)
    one = readers.read_articles_csv(spark, path, na_values=[], in_ranges=False)
    assert read(spark, path, 500)[1] == sorted(map(tuple, one.collect()))


@pytest.mark.parametrize("size", [60, 4000])
def test_line_ends_with_returns_and_several_files(spark, tmp_path, rows, size):
    written(tmp_path / "a.csv", rows[:60], end="\r\n")
    written(tmp_path / "b.csv", rows[60:])
    written(tmp_path / "c.csv", [])
    assert read(spark, str(tmp_path), size)[1] == sorted(map(tuple, rows))


@pytest.mark.parametrize("size", [50, 3000])
def test_odd_files(spark, tmp_path, size):
    path = str(tmp_path / "a.csv")
    with open(path, "w") as file:
        file.write('id,content,domain\n\n1,"a\n\nb",x\n2,,\n3,"",\n4\n"5","' + "long " * 300
                   + '\n",y\n6,"no end\nof quotes,z\n')
    want = [("1", "a\n\nb", "x"), ("2", None, None), ("3", None, None), ("4", None, None),
            ("5", "long " * 300 + "\n", "y"), ("6", "no end\nof quotes,z", None)]
    found = read(spark, path, size)[1]
    assert found[:5] == want[:5] and found[5][0] == "6" and found[5][1].startswith("no end\nof")
    empty = str(tmp_path / "b.csv")
    with open(empty, "w") as file:
        file.write("id,content,domain\n")
    assert read(spark, empty, size)[1] == []


def test_a_header_longer_than_a_range(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    with open(path, "w") as file:
        file.write('"a\nlong name of\na column",b\n' + "".join(f'"{i}\n",x\n' for i in range(20)))
    ranged = parallel_csv.with_range_bytes(spark, 8)
    found = parallel_csv.read_delimited(ranged, path, readers.string_schema(["a", "b"])).collect()
    assert sorted(map(tuple, found)) == sorted((f"{i}\n", "x") for i in range(20))


def test_bad_lines_and_columns(spark, tmp_path):
    path = written(tmp_path / "a.csv", [["1", "a\n,b", "c"], ["2", "x", "y", "z"], ["3", "p"]])
    df, found = read(spark, path, 16, columns=["id", "content"], skip_bad_lines=True)
    assert found == [("1", "a\n,b"), ("3", "p")]


def test_tsv_in_ranges(spark, tmp_path):
    rows = [[str(i), "true", f'tab\tand\n"quotes" {i}', "s"] for i in range(200)]
    path = written(tmp_path / "a.tsv", rows, header=False, sep="\t")
    ranged = parallel_csv.with_range_bytes(spark, 300)
    found = readers.read_statements_tsv(
        ranged, path, ["id", "label", "statement"], in_ranges=True).collect()
    assert sorted(map(tuple, found)) == sorted(tuple(r[:3]) for r in rows)


def test_other_cuts_are_an_error(spark, tmp_path, rows):
    path = written(tmp_path / "a.csv", rows)
    ranged = parallel_csv.with_range_bytes(spark, 700)
    df = parallel_csv.read_records(ranged, path)
    ranged.conf.set("spark.sql.files.maxPartitionBytes", "450")
    with pytest.raises(Exception, match="cut at other places"):
        df.count()


def test_only_large_files_are_read_in_ranges(spark, tmp_path, rows):
    path = written(tmp_path / "a.csv", rows)
    assert readers.has_large_files(spark, path, 1000)
    assert not readers.has_large_files(spark, path)


def test_files_of_several_layouts_below_one_path(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,content,domain\n1,"x\ny",d\n2,z,\n')
    (tmp_path / "b b.csv").write_text('domain,"odd, name",id\r\nd,o,3\r\n')
    (tmp_path / "c.csv").write_text("content,id\nw,4\n")
    (tmp_path / "d.csv").write_text("id,content,domain\n")
    (tmp_path / "e.csv").write_text("")
    layouts = readers.file_headers(spark, str(tmp_path))
    assert {k: len(v) for k, v in layouts.items()} == {
        ("id", "content", "domain"): 2, ("domain", "odd, name", "id"): 1, ("content", "id"): 1}
    for in_ranges in (False, True):
        df = readers.read_mixed_csv(spark, str(tmp_path), in_ranges=in_ranges)
        assert df.columns == ["id", "content", "domain", "odd, name"]
        assert sorted(map(tuple, df.collect())) == [
            ("1", "x\ny", "d", None), ("2", "z", None, None), ("3", None, "d", "o"),
            ("4", "w", None, None)]
    few = readers.read_mixed_csv(spark, str(tmp_path), ["content", "other", "id"])
    assert few.columns == ["content", "other", "id"] and few.count() == 4
    with pytest.raises(ValueError, match="no file with a header"):
        readers.read_mixed_csv(spark, str(tmp_path / "e.csv"))


@pytest.mark.parametrize("name", ["csv_parallel_scan", "tsv_parallel_scan"])
def test_larger_inputs_get_more_files_and_larger_ranges(spark, tmp_path, monkeypatch, name):
    """No task writes a file of more than FILE_BYTES, and a file has few ranges."""
    texts = [f'{i} "a"\n' + "x, \t" * 200 for i in range(300)]
    spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)],
                          "doc_id long, text string, source string").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 0, "user", t) for i, t in enumerate(texts)],
                          "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    ranges, cut = [], parallel_csv.with_range_bytes
    monkeypatch.setattr(queries, "FILE_BYTES", 1 << 16, raising=False)
    monkeypatch.setattr(queries, "scratch_path", lambda *_: str(tmp_path / "made"))
    monkeypatch.setattr(parallel_csv, "with_range_bytes", lambda spark, size: (
        ranges.append(size), cut(spark, size))[1])
    found = queries.QUERIES[name](spark, str(tmp_path)).collect()
    if name == "csv_parallel_scan":
        want = {(str(i), t + '\n"s", \t"" \r\n\n') for i, t in enumerate(texts)}
        assert {(r["id"], r["content"]) for r in found} == want
    else:
        assert {(r["id"], r["statement"]) for r in found} == {
            (f"{i}-0", t + '\t"\n') for i, t in enumerate(texts)}
    assert len(found) == len(texts)
    made = [f.stat().st_size for f in tmp_path.glob("made*/part-*")]
    assert len(made) > 2 and max(made) < 2 << 16
    assert max(made) <= 8 * ranges[0]


