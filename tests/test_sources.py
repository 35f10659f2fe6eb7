import random
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from reviewlens.fixtures import raw_reviews, sales_reviews
from reviewlens.schema import RAW_SCHEMA, CastSpec
from reviewlens.sources.readers import has_rows, read_parquet, read_raw_csv
from reviewlens.sources.scratch import scratch_path
from reviewlens.plans.cleaning import clean_to_parquet
from reviewlens import queries
from reviewlens.sources.sinks import cluster_reviews, export, export_one_csv, files_for, write_parquet


def test_csv_keeps_quotes_breaks_spaces_and_nulls(spark, tmp_path):
    values = ['say "hi"', "two\nlines", "back\\slash", " padded ", "", None, "a,b", '"', "tab\t", "cr\r\nlf", "\\", "é"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    path = str(tmp_path / "csv")
    export(df, path, "csv", null_value="\\N")
    back = read_raw_csv(spark, path, df.schema, null_value="\\N").orderBy("i").collect()
    assert [row.v for row in back] == values


def test_csv_single_lines_can_be_split(spark, tmp_path):
    raw = raw_reviews(spark, SMALL).drop("review")
    path = str(tmp_path / "csv")
    export(raw, path, "csv")
    back = read_raw_csv(spark, path, raw.schema, multiline=False)
    assert back.exceptAll(raw).isEmpty() and back.count() == 1000


@pytest.mark.parametrize("row", ["1", "1,2,3"])
def test_csv_rows_of_the_wrong_width_are_never_lost_silently(spark, tmp_path, row):
    path = tmp_path / "bad.csv"
    path.write_text(f"a,b\n1,2\n{row}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw_csv(spark, str(path), "a string, b string").select("a").collect()
    kept = read_raw_csv(spark, str(path), "a string, b string", corrupt="bad")
    assert [(r.a, r.bad) for r in kept.collect()] == [("1", None), ("1", row)]
    report = clean_to_parquet(kept, str(tmp_path / "clean"), CastSpec(integers=("a",)), unused=(), corrupt="bad")
    assert (report.rows_before, report.rows_after, report.corrupt_rows) == (2, 1, 1)
    aside = str(tmp_path / "aside")
    clean_to_parquet(kept, str(tmp_path / "again"), CastSpec(integers=("a",)), unused=(), corrupt="bad", quarantine=aside)
    assert [r.value for r in spark.read.text(aside).collect()] == [r.bad for r in kept.collect() if r.bad]
    with pytest.raises(ValueError):
        clean_to_parquet(kept, str(tmp_path / "never"), CastSpec(integers=("a",)), unused=(), quarantine=aside)
    assert spark.read.parquet(str(tmp_path / "clean")).columns == ["a", "b"]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = tmp_path / "in" / "one.csv"
    path.write_text("b,a\n1,2\n")
    assert read_raw_csv(spark, str(path), "a string, b string").collect() == [("2", "1")]
    for declared in ("a string, c string", "a string", "a string, b string, c string"):
        with pytest.raises(ValueError, match="header"):
            read_raw_csv(spark, str(path), declared)
    (tmp_path / "in" / "two.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, str(tmp_path / "in"), "a string, b string").collect()


def test_csv_with_its_own_line_ends(spark, tmp_path):
    path = tmp_path / "crlf.csv"
    path.write_bytes(b'a,b\r\n1,"x\ny"\r\n')
    read = read_raw_csv(spark, str(path), "a string, b string", multiline=False, line_sep="\r\n")
    assert read.collect() == [("1", "x\ny")]


def test_parquet_with_declared_schema(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw = raw_reviews(spark, SMALL)
    write_parquet(raw, path)
    assert read_parquet(spark, path, RAW_SCHEMA).schema == RAW_SCHEMA
    assert read_parquet(spark, [path, path]).count() == 2000
    assert sorted(read_parquet(spark, path).columns) == sorted(raw.columns)
    with pytest.raises(Exception):
        read_parquet(spark, str(tmp_path / "nothing"))


def test_file_counts(spark, tmp_path):
    df = spark.range(100).repartition(4)
    write_parquet(df, str(tmp_path / "one"), files=1)
    assert len(list((tmp_path / "one").glob("*.snappy.parquet"))) == 1
    write_parquet(df, str(tmp_path / "rows"), files=1, max_rows_per_file=30)
    assert len(list((tmp_path / "rows").glob("*.parquet"))) == 4
    write_parquet(df, str(tmp_path / "rows"))
    assert read_parquet(spark, str(tmp_path / "rows")).count() == 100
    with pytest.raises(ValueError):
        write_parquet(df, str(tmp_path / "none"), files=0)
    with pytest.raises(ValueError):
        export(df, str(tmp_path / "none"), "xlsx")


def test_clustering_splits_a_hot_product(spark):
    # Half of the rows are one product at one second: only the author's digest can split them.
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("game"),
        F.lit(dt.datetime(2024, 1, 1)).alias("timestamp_created"),
        F.col("id").cast("string").alias("author_steamid"),
    )
    sizes = [r["count"] for r in cluster_reviews(hot, 8).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8


def test_empty_check(spark):
    df = sales_reviews(spark, SMALL)
    assert has_rows(df) and not has_rows(df.where("votes_up < 0"))


def test_scratch_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(root + "/x-") and first != second


def test_scratch_folder_without_a_checkpoint_folder_is_in_the_warehouse(spark):
    class Unset:
        conf, _jvm, _jsc = None, spark._jvm, spark._jsc

        def get(self, name, default=None):
            return default if name == "spark.checkpoint.dir" else spark.conf.get(name)

    session = Unset()
    session.conf = session
    assert scratch_path(session, "x").startswith(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch/x-")


def test_files_follow_the_size(spark, tmp_path):
    write_parquet(spark.range(1000), str(tmp_path / "t"))
    assert files_for(spark, str(tmp_path / "t")) == 1
    assert files_for(spark, str(tmp_path / "t"), 100) > 10


def test_a_task_of_a_layout_gets_a_bounded_share(spark, tmp_path):
    with open(tmp_path / "table.parquet", "wb") as file:
        file.truncate(6 << 30)  # takes no space on disk
    assert (6 << 30) / files_for(spark, str(tmp_path)) <= 128 << 20


def test_one_csv_file_is_written_by_many_tasks(spark, tmp_path):
    values = ["plain", "a,b", 'q"x"y', "two\nlines", "", None, " sp ", "\\N", "é日", "#x", "x\r\ny", '"']
    rows = [(i, values[i % 12], values[i // 12 % 12]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, `a,1` string, b string").repartition(7).localCheckpoint()
    export(df.coalesce(1), str(tmp_path / "by-one"), "csv", null_value="\\N")
    export_one_csv(df, str(tmp_path / "new" / "one.csv"), null_value="\\N")
    assert (tmp_path / "new" / "one.csv").read_bytes() == next((tmp_path / "by-one").glob("part-*")).read_bytes()
    assert df.rdd.getNumPartitions() == 7
    export_one_csv(df.where("id < 0"), str(tmp_path / "none.csv"))
    assert (tmp_path / "none.csv").read_text() == 'id,"a,1",b\n'
    with pytest.raises(Exception, match="bytes at first"):
        export_one_csv(spark.range(2000).selectExpr("reflect('java.lang.Math', 'random') AS x"), str(tmp_path / "odd.csv"))


def test_no_task_of_the_one_file_query_takes_the_whole_table(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(queries, "export_one_csv", lambda df, path, **kw: plans.append(df) or export_one_csv(df, path, **kw))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
        assert queries.csv_one_file(spark, SMALL).count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
        assert plans[0].rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_quoted_file_is_read_in_byte_ranges(spark, tmp_path):
    """Equal to the one-task read however the file is cut, on values with line breaks, quotes, separators and nulls."""
    rng = random.Random(3)
    values = ["plain", "a,b", 'q"x"y', "two\nlines", "\n", '""', '"', "", None, "end\n", " sp ", "x\r\ny", '\n\n"\n', "long " + "w\n" * 30]
    rows = [(str(i), rng.choice(values), rng.choice(values)) for i in range(300)]
    schema, path = "id string, a string, b string", str(tmp_path / "one")
    export(spark.createDataFrame(rows, schema).coalesce(1), path, "csv", null_value="\\N")
    one = sorted(map(str, read_raw_csv(spark, path, schema, null_value="\\N").collect()))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in names]
    try:
        spark.conf.set(names[1], "1")
        for size, least in (("200", 20), ("3000", 3), ("128m", 1)):
            spark.conf.set(names[0], size)
            frame = read_raw_csv(spark, path, schema, null_value="\\N", split_quoted=True)
            assert sorted(map(str, frame.collect())) == one
            assert spark.read.text(path).rdd.getNumPartitions() >= least
        spark.conf.set(names[0], "20")
        bad = tmp_path / "bad.csv"
        bad.write_bytes(b'id,a,b\r\n1,2,3\r\n4,5\r\n6,"x\r\ny",7,8\r\n\r\n9,"p""q",\r\n')
        read = read_raw_csv(spark, str(bad), schema, corrupt="bad", split_quoted=True)
        assert [(r.id, r.a, r.b, r.bad) for r in sorted(read.collect(), key=lambda r: r.id)] == [
            ("1", "2", "3", None), ("4", "5", None, "4,5"), ("6", "x\r\ny", "7", '6,"x\r\ny",7,8'), ("9", 'p"q', None, None)
        ]
        with pytest.raises(Exception):
            read_raw_csv(spark, str(bad), schema, split_quoted=True).collect()
        other = tmp_path / "two"
        other.mkdir()
        (other / "a.csv").write_text("id,a,b\n1,2,3\n")
        (other / "b.csv").write_text("id,b,a\n1,2,3\n")
        with pytest.raises(Exception):
            read_raw_csv(spark, str(other), schema, split_quoted=True).collect()
        with pytest.raises(ValueError):
            read_raw_csv(spark, path, schema, multiline=False, split_quoted=True)
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)
