import datetime

import pytest
from table_rows import rows
from tastegrid.sources import files


def test_csv_with_quotes_commas_and_line_breaks(spark, tmp_path):
    schema = files.SCHEMAS["movies_metadata"]
    columns = [c.split()[0] for c in schema.split(", ")]
    values = dict.fromkeys(columns)
    values.update(id="1", title='say "hi", twice', overview="two\nlines", revenue=1.5, vote_count=3,
                  release_date=datetime.date(1999, 1, 2), genres="""[{'id': 1, 'name': "O'Neil"}]""")
    df = spark.createDataFrame([tuple(values[c] for c in columns)], schema)
    path = str(tmp_path / "movies")
    files.write_csv(df, path)
    assert rows(files.read_table(spark, path, "movies_metadata")) == rows(df)


def test_csv_with_another_header_is_an_error(spark, tmp_path):
    path = str(tmp_path / "links")
    files.write_csv(spark.createDataFrame([(1, 2)], "a int, b int"), path)
    with pytest.raises(Exception):
        files.read_csv(spark, path, "x int, y int").collect()


def test_parquet_keeps_arrays_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a"], "x"), (2, [], "y")], "id int, k array<string>, part string")
    path = str(tmp_path / "t")
    files.write_parquet(df, path, ["part"])
    assert rows(spark.read.parquet(path), "id", "k", "part") == rows(df)


def test_load_tables(spark, sf_dir):
    tables = files.load_tables(spark, sf_dir, ["region", "nation"])
    assert tables["region"].count() == 5 and tables["nation"].count() == 25


def test_quarantine_holds_what_does_not_parse(spark, tmp_path):
    lines = ["userId,movieId,rating,timestamp", "1,2,3.5,10", "x,2,3.5,10", "1,2,n/a,late", "1,2", "1,2,3,4,5", ",,,", '"7","8","1.5","9"']
    path = tmp_path / "ratings.csv"
    path.write_text("\n".join(lines) + "\n")
    good, bad = files.read_table_checked(spark, str(path), "ratings")
    assert rows(good) == sorted([(1, 2, 3.5, 10), (None,) * 4, (7, 8, 1.5, 9)], key=repr)
    assert rows(bad) == [("1,2", "columns"), ("1,2,3,4,5", "columns"), ("1,2,n/a,late", "rating, timestamp"), ("x,2,3.5,10", "userId")]
    assert good.count() + bad.count() == len(lines) - 1


def test_credits_are_read_in_splits_and_stray_line_breaks_show(spark, tmp_path):
    values = [(f"[{{'name': \"O'Neil, {i}\"}}]", "[]", i) for i in range(2000)]
    path = str(tmp_path / "credits")
    files.write_csv(spark.createDataFrame(values, files.SCHEMAS["credits"]).coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        table = files.read_table(spark, path, "credits")
        assert table.rdd.getNumPartitions() > 1 and rows(table) == sorted(values, key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    broken = spark.createDataFrame([("a\nb", "c", 1), ("d", "e", 2)], files.SCHEMAS["credits"]).coalesce(1)
    files.write_csv(broken, path)
    assert rows(files.read_table_checked(spark, path, "credits")[1]) == [('"a', "columns")]
    good, bad = files.read_table_checked(spark, path, "credits", multiline=True)
    assert rows(good) == rows(broken) and bad.count() == 0
