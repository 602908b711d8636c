"""CSV files cut into splits anywhere, also inside of cells, give the rows that a plain reader finds."""

import csv
import io
import random

import pytest

from contactloom.sources import files, quoted


def plain_ends_inside(line, inside):
    """The same by a machine of one character at a time."""
    state = "quoted" if inside else "begin"
    for i, c in enumerate(line):
        if state == "quoted":
            state = "quote" if c == '"' else "quoted"
        elif state == "quote":
            state = "quoted" if c == '"' else "begin" if c == "," else "plain"
        elif c == ",":
            state = "begin"
        else:
            state = "quoted" if state == "begin" and c == '"' else "plain"
    return state == "quoted"


def test_ends_of_lines():
    rng = random.Random(1)
    for _ in range(20_000):
        line, inside = "".join(rng.choice('",ab') for _ in range(rng.randrange(9))), rng.random() < 0.5
        assert quoted.ends_inside(line, inside) == plain_ends_inside(line, inside), (line, inside)


def table(rng, rows):
    cell = lambda: "".join(rng.choice(['"', ",", "\n", "\n\n", "a", "bc", " ", "é", "\n,\n", '"\n"']) for _ in range(rng.randrange(6)))
    return [[str(i), cell(), "x" * rng.randrange(40), cell()] for i in range(rows)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_file_cut_anywhere(spark, tmp_path, end):
    rng = random.Random(len(end))
    for n, split in enumerate((7, 50, 333, 5000)):
        rows = table(rng, 150)
        out = io.StringIO()
        csv.writer(out, lineterminator=end).writerows([["id", "b", "c", "d"], *rows])
        path = tmp_path / f"{n}.csv"
        path.write_bytes(out.getvalue().encode())
        read = files.read_csv(spark, str(path), split_bytes=split)
        got = [[r.id, r.b or "", r.c or "", r.d or ""] for r in read.orderBy("_pos").collect()]
        assert got == [[c.replace("\r\n", "\n") for c in r] for r in rows], split
        assert len({r._pos.split for r in read.collect()}) >= min(8, len(out.getvalue()) // split // 12)


def test_cells_over_many_splits_several_files_and_torn_ends(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    long = "line\n" * 400
    for n in range(3):
        with open(folder / f"{n}.csv", "w", newline="") as f:
            csv.writer(f).writerows([["k", "v"], [f"{n}a", "one"], [f"{n}b", long + '"q"'], [f"{n}c", ""], ["", ""], [f"{n}d", 'tail "x", y\n']])
    read = files.read_csv(spark, str(folder), split_bytes=100)
    assert [(r.k, r.v) for r in read.orderBy("_pos").collect()] == [(f"{n}{k}", v) for n in range(3) for k, v in (("a", "one"), ("b", long + '"q"'), ("c", None), ("d", 'tail "x", y\n'))]
    whole = read.groupBy().count().first()[0]
    assert whole == 12 and read.where("k like '%b'").select("_pos.split").distinct().count() >= 1
    (tmp_path / "torn.csv").write_text('k,v\n1,"a\nb"\n2,"never closed\n3,x\n')
    torn = files.read_csv(spark, str(tmp_path / "torn.csv"), split_bytes=6)
    assert [r.k for r in torn.orderBy("_pos").collect()] == ["1", "2"]


def test_no_task_has_the_whole_file(spark, tmp_path):
    """A file of one open cell in ten rows: at least eight splits with rows of their own."""
    path = tmp_path / "big.csv"
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([["k", "v"], *[[str(i), "two\nlines" if i % 10 == 0 else "one"] for i in range(5000)]])
    read = files.read_csv(spark, str(path), split_bytes=4096)
    counts = {r["split"]: r["count"] for r in read.groupBy("_pos.split").count().collect()}
    assert sum(counts.values()) == 5000 and len(counts) >= 8 and max(counts.values()) < 1000
    assert [r.v for r in read.orderBy("_pos").collect()] == ["two\nlines" if i % 10 == 0 else "one" for i in range(5000)]
