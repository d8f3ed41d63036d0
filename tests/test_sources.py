from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cinestar.operators import cast, films
from cinestar.session import scratch_path, shared_dir
from cinestar.sources import csv, tables


def write(tmp_path, text):
    path = tmp_path / "raw.csv"
    path.write_text(text)
    return str(path)


QUOTED = 'id,text,more\n1,"line one\nline two",\n2,"say ""hi"" now",""\n3,plain, x \n'


def test_multiline_quotes_and_nulls(spark, tmp_path):
    rows = csv.read_csv(spark, write(tmp_path, QUOTED), multiline=True)
    assert [tuple(r) for r in rows.collect()] == [
        ("1", "line one\nline two", None),
        ("2", 'say "hi" now', None),
        ("3", "plain", " x "),
    ]
    assert all(kind == "string" for _, kind in rows.dtypes)


def test_single_line_scan_breaks_a_quoted_newline(spark, tmp_path):
    assert csv.read_csv(spark, write(tmp_path, QUOTED)).count() == 4


def test_declared_header_is_checked(spark, tmp_path):
    path = write(tmp_path, "id,text\n1,a\n")
    assert csv.read_csv(spark, path, header=("id", "text")).collect()[0]["text"] == "a"
    with pytest.raises(Exception, match="(?i)header"):
        csv.read_csv(spark, path, header=("text", "id")).collect()
    with pytest.raises(ValueError, match="no column rating"):
        csv.read_csv(spark, path, require=("id", "rating"))


def test_export_reads_back_unchanged(spark, tmp_path):
    rows = [(" a ", 'q"uo\\te"'), ("x\ny\r\nz", "c,d"), (None, "\\"), ("'", '"')]
    frame = spark.createDataFrame(rows, "a string, b string")
    csv.export_csv(frame, str(tmp_path / "out"), rows_per_file=1)
    back = csv.read_csv(spark, str(tmp_path / "out"), header=("a", "b"), multiline=True)
    assert {tuple(r) for r in back.collect()} == set(rows)


def test_save_table_twice_and_bucketed_join(spark, tmp_path):
    tables.ensure_schema(spark, "films_test", str(tmp_path / "db"))
    tables.ensure_schema(spark, "films_test", str(tmp_path / "db"))
    one = spark.range(100).select(F.col("id").alias("film_id"), F.col("id").cast("string").alias("t"))
    for _ in range(2):
        a = tables.save_table(one, "films_test.DimA", str(tmp_path / "a"), "film_id", 4)
    b = tables.save_table(one, "films_test.DimB", str(tmp_path / "b"), "film_id", 4)
    assert spark.sql("select * from films_test.dima").count() == 100
    assert tables.read_table(spark, "FILMS_TEST.dimA").count() == 100
    joined = a.hint("merge").join(b, "film_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 100


def test_rerun_replaces_only_its_own_run(spark, tmp_path):
    path = str(tmp_path / "runs")

    def run(day, n):
        tables.overwrite_run(spark.range(n), path, {"run_date": day})
        counts = spark.read.parquet(path).groupBy("run_date").count().collect()
        return {str(r["run_date"]): r["count"] for r in counts}

    run("2024-01-01", 3)
    run("2024-01-02", 4)
    assert run("2024-01-02", 5) == {"2024-01-01": 3, "2024-01-02": 5}
    assert run("2024-01-02", 0) == {"2024-01-01": 3}  # a run without rows replaces as well


def test_overwrite_parquet_twice(spark, tmp_path):
    path = str(tmp_path / "stage")
    tables.overwrite_parquet(spark.range(5), path)
    assert tables.overwrite_parquet(spark.range(3), path).count() == 3


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


CREDITS = """cast,crew,id
"[{'cast_id': 14, 'character': 'Woody (voice)', 'credit_id': '52fe', 'gender': 2, 'id': 31, \
'name': 'Tom', 'order': 0, 'profile_path': None}, {'cast_id': 15, 'character': ""Buzz's None"", \
'credit_id': '52ff', 'gender': 2, 'id': 12898, 'name': 'Tim \\'T\\'', 'order': 1, \
'profile_path': '/x.jpg'}]",[],862
[],[],8844
"[{'cast_id': 1, 'character': 'cut",[],15602
""".replace("\\\n", "")

MOVIES = """adult,genres,id,imdb_id,overview,title
False,"[{'id': 16, 'name': 'Animation'}, {'id': 35, 'name': None}]",862,tt0114709,"Led by ""Woody"",
Andy's toys",Toy Story
False,[],1997-08-20,tt1,shifted,
False,"[{'id': 18, 'name': 'Drama'}]",2,,no outside id,X
False,"[{'id': 18, 'name': 'Drama'}]",3,0,denied,Y
"""


def test_exports_as_they_are_written(spark, tmp_path):
    """Doubled quotes around a cell with both kinds of quotes, line breaks, broken rows."""
    credits = csv.read_csv(spark, write(tmp_path, CREDITS), require=("id", "cast"))
    members = cast.dim_characters(cast.cast_members(credits)).orderBy("cast_member_id")
    assert [tuple(r)[1:] for r in members.collect()] == [
        (31, 862, "Woody (voice)"),
        (12898, 862, "Buzz's None"),
    ]
    names = cast.dim_cast(cast.cast_members(credits)).where("cast_member_id = 12898")
    assert names.first()["name"] == "Tim 'T'"

    path = write(tmp_path, MOVIES)
    columns = ("id", "imdb_id", "genres", "overview", "title")
    movies = films.accept_films(csv.read_csv(spark, path, multiline=True, require=columns))
    numbered, broken = films.split_numbered(movies)
    assert [r["id"] for r in broken.collect()] == ["1997-08-20"]
    assert [(r["id"], r["overview"]) for r in numbered.collect()] == [
        ("862", 'Led by "Woody",\nAndy\'s toys')
    ]
    genres = films.dim_genres(numbered).orderBy("id").collect()
    assert [tuple(r) for r in genres] == [(16, 862, "Animation"), (35, 862, None)]
