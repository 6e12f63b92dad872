"""Quoted CSV over byte ranges against the reader that takes a whole file per task."""

import random

import pytest

from tallymill.sources import files, quoted

SCHEMA = "id long, text string, note string"


def _table(n, seed):
    draw = random.Random(seed)
    parts = ["line", 'a "quoted" word', "comma, comma", "\n", "\n\n", "ünï", '"', "", " x ", "\n\"\n", "word " * 40]
    return [(i, "".join(draw.choices(parts, k=draw.randrange(1, 9))).strip() or None, draw.choice(["n", "a\nb", None])) for i in range(n)]


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _key(rows):
    return sorted(((tuple(r)) for r in rows), key=repr)


@pytest.mark.parametrize("seed, n_files, header", [(1, 1, False), (2, 3, True)])
def test_rows_equal_those_of_whole_files(spark, tmp_path, small_ranges, seed, n_files, header):
    df = spark.createDataFrame(_table(400, seed), SCHEMA).coalesce(1).repartition(n_files)
    (df.write.option("escape", '"').option("header", header).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(str(tmp_path / "in")))
    path = str(tmp_path / "in")
    ours = quoted.read_quoted_csv(spark, path, SCHEMA, header=header).collect()
    theirs = files.read_corpus_csv(spark, path, SCHEMA, header=header).collect()
    assert _key(ours) == _key(theirs) == _key(df.collect())
    ranges = quoted.range_parity(quoted._lines(spark, path))
    assert ranges.where("inside").count() > 3 and ranges.where("NOT inside").count() > 3
    found = quoted.quoted_records(spark, path)
    assert found.rdd.getNumPartitions() > 5 and found.select("file", "block").distinct().count() > 10


def test_a_record_over_many_ranges_and_an_open_quote(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {i} of one field" for i in range(400))
    (tmp_path / "a.csv").write_text(f'1,"{long}",x\n2,y,z\n\n3,"a""b","c\n\nd"')
    rows = quoted.read_quoted_csv(spark, str(tmp_path / "a.csv"), SCHEMA).collect()
    assert _key(rows) == [(1, long, "x"), (2, "y", "z"), (3, 'a"b', "c\n\nd")]
    (tmp_path / "b.csv").write_text('1,a,b\n2,"never closed\n' + "3,c,d\n" * 300)
    records = quoted.quoted_records(spark, str(tmp_path / "b.csv")).orderBy("block", "at").collect()
    assert [r.record[:5] for r in records] == ["1,a,b", '2,"ne'] and records[1].record.count("3,c,d") == 300


def test_empty_and_windows_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    assert quoted.read_quoted_csv(spark, str(tmp_path / "e.csv"), SCHEMA).count() == 0
    (tmp_path / "w.csv").write_bytes(b'1,"a\r\nb",c\r\n2,d,e\r\n')
    rows = quoted.read_quoted_csv(spark, str(tmp_path / "w.csv"), SCHEMA).collect()
    assert _key(rows) == [(1, "a\nb", "c"), (2, "d", "e")]
