import gzip
import json

import pytest
from pyspark.sql import functions as F

from stratamart.sources import scan


def texts(df, *paths):
    return df.select(*(F.variant_get("raw_data", p, "string") for p in paths), "file_row_number")


def test_array_file_gives_a_record_per_element(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1, "n": None}, {"id": 2}], indent=2))
    (tmp_path / "b.json").write_text('{"id": 3}')
    good, rejects = scan.scan_json(spark, str(tmp_path))
    assert rows(texts(good, "$.id")) == [("1", 1), ("2", 2), ("3", 1)]
    assert rejects.count() == 0
    kept = good.select(F.to_json("raw_data")).collect()
    assert '{"id":1,"n":null}' in [r[0] for r in kept]


def test_array_is_kept_whole_without_stripping(spark, tmp_path):
    (tmp_path / "a.json").write_text("[1, 2]")
    good, _ = scan.scan_json(spark, str(tmp_path), strip_outer_array=False)
    assert [r[0] for r in good.select(F.to_json("raw_data")).collect()] == ["[1,2]"]


@pytest.mark.parametrize("bad", ['{"id": 1', '{"id": 1, "id": 2}', '{"id": 1} {"id": 2}', '{"id": 1}, {"id": 2}', "x"])
def test_bad_document_is_quarantined_with_its_text(spark, tmp_path, rows, bad):
    (tmp_path / "bad.json").write_text(bad)
    (tmp_path / "good.json").write_text('[{"id": 7}]')
    good, rejects = scan.scan_json(spark, str(tmp_path))
    assert rows(texts(good, "$.id")) == [("7", 1)]
    assert rows(rejects, "filename", "raw_record") == [("bad.json", bad)]


def test_json_lines_numbers_and_rejects(spark, tmp_path, rows):
    (tmp_path / "l.json").write_text('{"id": 1}\nnope\n\n{"id": 3}\n')
    good, rejects = scan.scan_json(spark, str(tmp_path), multiline=False)
    assert rows(texts(good, "$.id")) == [("1", 1), ("3", 4)]
    assert rows(rejects, "file_row_number", "raw_record") == [(2, "nope")]


def test_csv_cells(spark, tmp_path, rows):
    (tmp_path / "c.csv").write_text('a,b,c\n 1 ,"x, ""y""",NULL\n2,null,\n')
    good, rejects = scan.scan_csv(spark, str(tmp_path), ["a", "b", "c"])
    assert rows(good, "a", "b", "c", "file_row_number") == [("1", 'x, "y"', None, 1), ("2", None, None, 2)]
    assert rejects.count() == 0


def test_csv_short_and_long_rows_are_rejected(spark, tmp_path, rows):
    (tmp_path / "c.csv").write_text("a,b\n1,2\n3\n4,5,6\n7,8\n")
    good, rejects = scan.scan_csv(spark, str(tmp_path), ["a", "b"])
    assert rows(good, "a", "file_row_number") == [("1", 1), ("7", 4)]
    assert rows(rejects, "file_row_number", "raw_record") == [(2, "3"), (3, "4,5,6")]
    # The check must hold when only one column is read.
    assert good.select("a").count() == 2


def test_line_breaks_inside_quotes_belong_to_the_value(spark, tmp_path, rows):
    (tmp_path / "c.csv").write_text('a,b\n1,"x\ny"\n2,z\n3,"p\r\nq, r"\n4\n')
    good, rejects = scan.scan_csv(spark, str(tmp_path), ["a", "b"])
    assert rows(good, "a", "b", "file_row_number") == [("1", "x\ny", 1), ("2", "z", 2), ("3", "p\r\nq, r", 3)]
    assert rows(rejects, "raw_record") == [("4",)]


def test_an_array_larger_than_one_variant_loads_every_record(spark, tmp_path):
    filler = "x" * 980
    with open(tmp_path / "large.json", "w") as f:
        f.write("[")
        f.writelines(f'{"," if i else ""}{{"id": {i}, "note": "{filler}"}}\n' for i in range(140_000))
        f.write("]")
    good, rejects = scan.scan_json(spark, str(tmp_path))
    ids = good.select(F.variant_get("raw_data", "$.id", "long").alias("id"), "file_row_number")
    assert ids.agg(F.count("id"), F.sum("id"), F.max("file_row_number")).first()[:] == (140_000, 140_000 * 139_999 // 2, 140_000)
    assert rejects.count() == 0


def test_no_header_and_lenient_pipe(spark, tmp_path, rows):
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "c.csv").write_text("1,2\n3,4\n")
    good, _ = scan.scan_csv(spark, str(tmp_path / "n"), ["a", "b"], scan.CSV_NO_HEADER)
    assert rows(good, "a", "b") == [("1", "2"), ("3", "4")]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "c.txt").write_text("a|b|c\n1|2|3\n4|5\n6|7|8|9\n")
    good, rejects = scan.scan_csv(spark, str(tmp_path / "p"), ["a", "b", "c"], scan.PIPE)
    assert rows(good, "a", "b", "c") == [("1", "2", "3"), ("4", "5", None), ("6", "7", "8")]
    assert rejects.count() == 0


def test_compressed_input_and_pattern(spark, tmp_path, rows):
    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write("a\n1\n2\n")
    (tmp_path / "other.csv").write_text("a\n9\n")
    good, _ = scan.scan_csv(spark, str(tmp_path), ["a"], pattern=r"z\.csv\.gz$")
    assert rows(good, "a", "filename", "file_row_number") == [("1", "z.csv.gz", 1), ("2", "z.csv.gz", 2)]


def test_row_numbers_over_many_splits(spark, tmp_path):
    for name in ("x", "y"):
        lines = "\n".join(f"{i},{'v' * (i % 37)}" for i in range(1, 4001))
        (tmp_path / f"{name}.csv").write_text(f"n,v\n{lines}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        records = scan.read_files(spark, str(tmp_path), scan.CSV_LINES, ["n", "v"])
        numbered = scan.with_record_numbers(records)
        assert records.rdd.getNumPartitions() > 8
        wrong = numbered.where(F.col("n").cast("long") != F.col("file_row_number")).count()
        assert (wrong, numbered.count()) == (0, 8000)
        assert numbered.agg(F.countDistinct("_batch_row"), F.max("_batch_row")).first()[:] == (8000, 8000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_changed_splits_stop_the_job(spark, tmp_path):
    (tmp_path / "x.csv").write_text("n\n" + "\n".join(str(i) for i in range(5000)) + "\n")
    numbered = scan.with_record_numbers(scan.read_files(spark, str(tmp_path), scan.CSV_LINES, ["n"]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        with pytest.raises(Exception, match="file blocks changed"):
            numbered.select("file_row_number").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert numbered.agg(F.max("file_row_number")).first()[0] == 5000
