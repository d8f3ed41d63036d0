from __future__ import annotations

import csv
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cinestar.sources import records
from cinestar.sources.records import blocks_begun_inside, read_records

HEADER = ["id", "te xt", "c"]


@pytest.fixture(params=[(10_000_000, 1), (150, 40)])
def splits(spark, request):
    """Files cut into blocks of so many bytes."""
    conf = {
        "spark.sql.files.maxPartitionBytes": str(request.param[0]),
        "spark.sql.files.minPartitionNum": str(request.param[1]),
        "spark.sql.files.openCostInBytes": "1",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield request.param
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def write(path, rows, newline="\n", header=HEADER):
    with open(path, "w", newline="") as file:
        out = csv.writer(file, lineterminator=newline)
        out.writerow(header)
        out.writerows(rows)


def expected(rows):
    """An empty value reads as NULL."""
    return Counter(tuple(v or None for v in row) for row in rows)


def test_every_record_whole_however_the_files_are_cut(spark, tmp_path, splits):
    rng = random.Random(1)
    pieces = ["a", "b", '"', "\n", ",", "\r\n", " ", "''", '""', "é", "\\"]
    rows = [
        (str(k), "".join(rng.choices(pieces, k=rng.randint(0, 30))), rng.choice(["x", None, 'q"q', "", "\n"]))
        for k in range(60)
    ]
    # Values over many blocks, of line breaks, of quotes, and of what looks like records.
    long = [("900", "\n" * 700, "y"), ("901", '"\n,' * 150, "y"), ("902", 'z\n1,"2",3\n' * 60, "")]
    write(tmp_path / "a.csv", rows[:30] + long)
    write(tmp_path / "b.csv", long[1:] + rows[30:], newline="\r\n")
    write(tmp_path / "empty.csv", [])
    found = read_records(spark, str(tmp_path), HEADER)
    assert Counter(map(tuple, found.collect())) == expected(rows + long + long[1:])
    if splits[1] > 1:
        assert found.rdd.getNumPartitions() > 20


def test_quotes_within_unquoted_values(spark, tmp_path, splits):
    (tmp_path / "a.csv").write_text('id,te xt,c\n1,it"s,5"\n2,"a\n"" b",x"y"z\n\n3,,"p"\n4,"last, no\nline end",')
    found = read_records(spark, str(tmp_path), HEADER, require=("c", "id"))
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == [
        ('5"', "1"),
        ('x"y"z', "2"),
        ("p", "3"),
        (None, "4"),
    ]


def test_another_header_is_refused(spark, tmp_path):
    write(tmp_path / "a.csv", [("1", "x", "y")], header=["id", "text", "c"])
    with pytest.raises(Exception, match="the header is not id, te xt, c"):
        read_records(spark, str(tmp_path), HEADER).collect()
    with pytest.raises(ValueError, match="no column d"):
        read_records(spark, str(tmp_path), HEADER, require=("d",))


def test_states_follow_from_composed_maps(spark):
    """Blocks that keep, swap or set the state, in every order."""
    rng = random.Random(2)
    rows, inside = [], set()
    for file in range(60):
        state = 0
        for start in range(rng.randint(1, 9)):
            if state:
                inside.add((str(file), start))
            after = rng.choice([(0, 1), (1, 0), (0, 0), (1, 1)])
            rows.append((str(file), start, *after))
            state = after[state]
    maps = spark.createDataFrame(rows, "file string, start bigint, from_outside int, from_inside int")
    assert {tuple(r) for r in blocks_begun_inside(maps).collect()} == inside


def test_lines_are_read_by_their_start_state():
    after = records._line_map(",")
    assert after('1,"a', 0) == 1
    assert after('1,"a', 1) == 0
    assert after('a""', 1) == 1
    assert after('a"', 1) == 0
    assert after('a""",x', 1) == 0
    assert after('it"s,x', 0) == 0
    assert after('a","b', 1) == 1


def test_only_records_over_block_ends_are_shuffled(spark, tmp_path):
    write(tmp_path / "a.csv", [(str(k), "x\ny", "z") for k in range(10)])
    found = read_records(spark, str(tmp_path), HEADER).where(F.col("id") == "3")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # One branch of the union aggregates pieces; the other has neither aggregate nor window.
    assert plan.count("Aggregate") == 1 and plan.count("Window") == 1
