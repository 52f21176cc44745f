"""CSV records over splits: equal to a reader that parses each file as a whole."""

import csv
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import readers, records, schemas


def lines_of(table, rows):
    out = io.StringIO()
    csv.writer(out, delimiter=";", quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(rows)
    return out.getvalue()


def values(rng, n, width):
    odd = ["", "plain", 'say "x"', "two\nlines", 'a";"b', "\n", '""', "çã", "x" * 300, "with;sep", '"\n"', "end\r\nnext"]
    return [[odd[int(k)] for k in rng.integers(0, len(odd), width)] for _ in range(n)]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_records_over_splits(spark, tmp_path, small_splits):
    rng = np.random.default_rng(3)
    names = schemas.REGISTRY["empresa"][1].split()
    want = []
    for k in range(3):
        rows = values(rng, 150, len(names))
        want += rows
        (tmp_path / f"K{k}.EMPRECSV").write_bytes(lines_of("empresa", rows).encode("windows-1252"))
    df = readers.read_registry_csv(spark, str(tmp_path), "empresa")
    assert records._lines(spark, str(tmp_path), "windows-1252", "*").rdd.getNumPartitions() > 20
    got = [["" if v is None else v for v in r] for r in df.collect()]
    assert sorted(got) == sorted(want)


def test_rejected_records(spark, tmp_path, small_splits):
    names = schemas.REGISTRY["socio"][1].split()
    good = lines_of("socio", [["a\nb"] * len(names)] * 50)
    short, long_, open_ = lines_of("socio", [["x", "y\nz"]]), lines_of("socio", [["x"] * (len(names) + 1)]), '"never;closed\nmore\nlines\n'
    (tmp_path / "A.SOCIOCSV").write_text(good + short + "\n\n" + long_ + good)
    (tmp_path / "B.SOCIOCSV").write_text(good + open_)
    rows, bad = readers.registry_records(spark, str(tmp_path), "socio")
    assert rows.count() == 150
    assert {(r.file, r.reason): r.n for r in records.count_rejected(bad).collect()} == {("A.SOCIOCSV", "columns"): 2, ("B.SOCIOCSV", "unclosed"): 3}
    assert '"x";"y\nz"' in [r.value for r in bad.collect()]


def test_records_that_never_seem_to_end(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h\n"stray\n' + "1\n" * 50 + '2"\n3\n')
    found = records.csv_records(spark, str(tmp_path), "ISO-8859-1", header=True, longest=20).collect()
    assert sorted((r.value, r.closed) for r in found) == sorted([('"stray', False), *[("1", False)] * 50, ('2"', False), ("3", True)])


def test_side_files(spark, tmp_path, small_splits):
    names = schemas.CARRIERS.split()
    rng = np.random.default_rng(5)
    want = values(rng, 120, len(names))
    (tmp_path / "c.csv").write_bytes((";".join(f'"{n}"' for n in names) + "\n" + lines_of("", want)).encode("latin-1"))
    got = [["" if v is None else v for v in r] for r in readers.read_carriers_csv(spark, str(tmp_path / "c.csv")).collect()]
    assert sorted(got) == sorted(want)
    (tmp_path / "d.csv").write_text('"a\nb";"c"\n')  # a header alone, over two lines
    assert readers.side_records(spark, str(tmp_path / "d.csv"), "a b", ";")[0].count() == 0


def test_single_bytes_in_any_session(spark, tmp_path):
    data = bytes(i for i in range(1, 256) if chr(i) not in '\n\r"')
    (tmp_path / "a.csv").write_bytes(data + b"\n")
    before = spark.conf.get("spark.sql.legacy.javaCharsets")
    spark.conf.set("spark.sql.legacy.javaCharsets", "false")
    try:
        for encoding in ("windows-1252", "iso-8859-1"):
            assert [r.value for r in records.csv_records(spark, str(tmp_path), encoding).collect()] == [data.decode(encoding, "replace")]
    finally:
        spark.conf.set("spark.sql.legacy.javaCharsets", before)
    with pytest.raises(ValueError):
        records.csv_records(spark, str(tmp_path), "utf-16")


def test_plain_records_are_cut_as_the_parser_reads_them(spark):
    plain = ['"a";"b";"c"', '"";"";""', '" a ";"\t";" "', '"é";"#x";"\'"', '"a;b";";";"c"', '"x,y";"z\\";"\ud83d\ude00".'[:-1]]
    odd = ['a;b;c', '"a";b;', '"say ""x""";"b";"c"', '"two\nlines";"b";"c"', '"a\x1fb";"";"c"', '"a" ;"b";"c"', '"a";"b"', '"a";"b";"c";"d"', '"a";"b";"c"x']
    rows = spark.createDataFrame([(v, True) for v in plain + odd], "value string, closed boolean").selectExpr("'f' AS file", "value", "closed")
    good, bad = records.parse_records(rows, schemas.strings("a b c"), ";")
    read = lambda df: sorted(map(str, df.collect()))
    parser = dict(sep=";", quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="bad", multiLine="true")
    whole = rows.select("value", F.from_csv("value", "a string, b string, c string, bad string", parser).alias("r"))
    assert read(good) == read(whole.where("r.bad IS NULL").select("r.a", "r.b", "r.c"))
    assert sorted(r.value for r in bad.collect()) == sorted(r.value for r in whole.where("r.bad IS NOT NULL").collect())
    # the parser is named once in the filter and once for the values, and plain records reach neither
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") <= 2 and "RLIKE" in plan


def test_files_are_read_as_often_as_told(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"h";"i"\n"1";"2"\n')
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [value")
    assert scans(records.csv_records(spark, str(tmp_path), "ISO-8859-1", header=True)) == 1
    (tmp_path / "b.csv").write_text('"h";"i"\n"1\n";"2"\n')
    assert scans(records.csv_records(spark, str(tmp_path), "ISO-8859-1", header=True)) == 2
