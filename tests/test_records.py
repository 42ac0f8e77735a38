"""Records of CSV files cut into ranges: the same rows as Spark's unsplit reader gives."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civitas.sources import records
from civitas.sources.csv import CORRUPT, read_csv_positional


@pytest.fixture
def small_ranges(spark):
    """Files are cut into ranges of some hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "400b", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def awkward_field(rng):
    kinds = ["", '""', "plain", "two words", '"quoted"', '"a, b"', '"new\nline"', '"crlf\r\ninside"', '"doubled "" quote"', '""""', '"\n\n"', '"""\n"""',
             'mid"dle', 'x""y', '"closed"tail', ' "blank first"', "é日本", '"long ' + "word " * 60 + '\nend"', "'", '"ends with quote"""']
    return rng.choice(kinds)


def awkward_file(path, seed, rows=50, end="\n", bad=True, well_formed=False):
    rng = random.Random(seed)
    lines = ["h1,h2,h3"]
    for _ in range(rows):
        fields = [awkward_field(rng) for _ in range(3)]
        if well_formed:
            fields = [f if f.startswith('"') and f.endswith('"') or '"' not in f else "z" for f in fields]
        n = rng.choice([3] * 9 + ([2, 4] if bad else [3]))
        lines.append(",".join((fields + ["extra"])[:n]))
        if rng.random() < 0.05:
            lines.append("")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(end.join(lines) + rng.choice(["", end]))


def test_transitions_follow_the_reader():
    rng = random.Random(1)
    lines = [",".join(awkward_field(rng).replace("\n", " ") for _ in range(3)) for _ in range(500)] + ["", '"', '""', '"""', 'a"', ',"', '",', '","']
    after = records.transitions(pa.array(lines))
    sliced = records.transitions(pa.array(["x"] + lines).slice(1))
    for h in (0, 1):
        want = [records.state_after(x.encode(), h) for x in lines]
        assert after[h].tolist() == want == sliced[h].tolist()


def test_states_from_either_start():
    rng = np.random.default_rng(0)
    for _ in range(50):
        after = [rng.integers(0, 2, 30).astype(np.int8) for _ in range(2)]
        for start in (0, 1):
            before, then = records.states(*after, start)
            state = start
            for i in range(30):
                assert before[i] == state
                state = int(after[state][i])
                assert then[i] == state


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2])
def test_split_reader_equals_multi_line_reader(small_ranges, scratch, seed, end):
    spark, columns = small_ranges, ["a", "b", "c"]
    os.makedirs(scratch)
    for i in range(2):
        awkward_file(f"{scratch}/f {i}.csv", seed * 10 + i, end=end)
    whole, whole_bad = read_csv_positional(spark, scratch, columns, on_bad="reject")
    good, bad = read_csv_positional(spark, scratch, columns, on_bad="reject", split=True, positions=True)
    noted = records.noted_lines(spark, scratch)
    assert noted.select("source_path", "start").distinct().count() > 4     # many ranges of two files
    assert sorted(map(str, good.select(columns).collect())) == sorted(map(str, whole.collect()))
    assert sorted(r[CORRUPT] for r in bad.collect()) == sorted(r[CORRUPT].rstrip("\r\n") for r in whole_bad.collect())
    for i in range(2):      # in the order of the file
        path = f"{scratch}/f {i}.csv"
        alone = [tuple(r) for r in read_csv_positional(spark, path, columns, on_bad="reject")[0].collect()]
        ordered = good.filter(F.col("source_path").endswith(f"f%20{i}.csv")).orderBy("record_no").select(columns)
        assert [tuple(r) for r in ordered.collect()] == alone


def test_one_field_over_many_ranges(small_ranges, scratch):
    """A quoted field that spans whole ranges, and a file whose last quote never closes."""
    os.makedirs(scratch)
    text = "\n".join(f"line {i}, with a comma" for i in range(200))
    with open(f"{scratch}/a.csv", "w") as f:
        f.write(f'h1,h2\n1,"{text}"\n2,x\n3,"{text}"\n4,y')
    got = [tuple(r) for r in read_csv_positional(small_ranges, scratch, ["k", "v"], split=True, positions=True).orderBy("record_no").select("k", "v").collect()]
    assert got == [("1", text), ("2", "x"), ("3", text), ("4", "y")]
    with open(f"{scratch}/a.csv", "a") as f:
        f.write(f'\n5,"{text}')
    last = records.csv_records(small_ranges, scratch).orderBy(F.desc("record_no")).first()
    assert last["record"] == f'5,"{text}' and last["record_no"] == 5


def test_empty_files(spark, scratch):
    os.makedirs(scratch)
    for name, text in (("empty", ""), ("header", "\n\nh1,h2\n\n"), ("blank", "\n\n")):
        with open(f"{scratch}/{name}.csv", "w") as f:
            f.write(text)
    assert read_csv_positional(spark, scratch, ["a", "b"], split=True).count() == 0
    assert [(r["record"], r["record_no"]) for r in records.csv_records(spark, scratch).collect()] == [("h1,h2", 0)]
