import random

import pytest

from assaysift.sources import records
from assaysift.sources.tables import read_text_table

CELLS = ["", "a", "b c", '"x"', '"two\nlines"', '"a ""q"" b"', '"\n"', '"\n\n, "', 'bare " quote', '5" disk', '"closed"tail', '"x" ', "é", '""', '"a\r\nb"', " padded "]


def by_one_task(spark, path, names):
    reader = spark.read.option("multiLine", True).option("escape", '"').option("header", True).schema(", ".join(f"`{n}` string" for n in names))
    return [tuple(None if c in ("", "NULL") else c for c in r) for r in reader.csv(str(path.parent)).collect()]


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    spark.conf.set(names[0], "97")
    spark.conf.set(names[1], "0")
    yield spark
    for name in names[:2]:
        spark.conf.unset(name)


@pytest.mark.parametrize("seed", range(4))
def test_many_splits_equal_one_task(small_splits, tmp_path, seed):
    rng = random.Random(seed)
    end = "\r\n" if seed == 3 else "\n"
    cells = [c for c in CELLS if seed != 3 or "\n" not in c or "\r\n" in c]
    lines = ["k,one,two,three"] + [f"{i}," + ",".join(rng.choice(cells) for _ in range(3)) for i in range(60)]
    path = tmp_path / ("t.csv" if seed < 2 else "a [b] {c} %d é.csv")
    path.write_bytes((end.join(lines) + (end if seed % 2 else "")).encode())
    spark = small_splits
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    got = read_text_table(spark, str(tmp_path)).orderBy("row_index").collect()
    assert [r.row_index for r in got] == list(range(60))
    # Line breaks inside cells stay as they are in the file; Spark's reader shortens them where lines end in two characters.
    plain = (lambda c: c and c.replace("\r\n", "\n")) if seed == 3 else (lambda c: c)
    assert [tuple(map(plain, tuple(r)[1:])) for r in got] == by_one_task(spark, path, ["k", "one", "two", "three"])


def test_a_cell_over_many_splits_and_one_never_closed(small_splits, tmp_path):
    long = "\n".join(f"line {i}, more" for i in range(100))
    (tmp_path / "t.csv").write_text(f'a,b\n1,"{long}"\n\n\n2,x\n3,"open {long}\nend')
    got = read_text_table(small_splits, str(tmp_path / "t.csv")).orderBy("row_index").collect()
    assert [(r.row_index, r.a) for r in got] == [(0, "1"), (1, "2"), (2, "3")]
    assert got[0].b == long
    assert got[2].b.replace('"', "") == f"open {long}\nend"


def test_files_of_different_headers_with_breaks(small_splits, tmp_path):
    (tmp_path / "1.csv").write_text('\n"he\nad",b\n' + "".join(f'"x\n{i}",{i}\n' for i in range(30)))
    (tmp_path / "2.csv").write_text("b,c\n" + "".join(f"{i},y{i}\n" for i in range(30)))
    (tmp_path / "3.csv").write_text("")
    (tmp_path / "4.csv").write_text('b,c\n7,"z\nz",surplus\n')
    with pytest.raises(Exception, match="more cells than headers"):
        read_text_table(small_splits, str(tmp_path)).collect()
    got = read_text_table(small_splits, str(tmp_path), surplus="keep", broadcast_blocks=0).orderBy("row_index").collect()
    assert [r.row_index for r in got] == list(range(61))
    assert [r["he\nad"] for r in got] == [f"x\n{i}" for i in range(30)] + [None] * 31
    assert [r.b for r in got] == [str(i) for i in range(30)] * 2 + ["7"]
    assert got[60].c == "z\nz"
    assert got[60].surplus_cells == '7,"z\nz",surplus'


def test_files_without_breaks_are_not_cut(spark, tmp_path, monkeypatch):
    (tmp_path / "t.csv").write_text('a,b\n1,"x, y"\n2,"q ""r"""\n')
    monkeypatch.setattr(records, "cut_records", None)
    got = read_text_table(spark, str(tmp_path / "t.csv")).orderBy("row_index").collect()
    assert [(r.a, r.b) for r in got] == [("1", "x, y"), ("2", 'q "r"')]


@pytest.mark.parametrize(("line", "outside", "inside"), [
    ("", False, True), ("a,b", False, True), ('"', True, False), ('"a', True, False), ('a"', False, False), ('x "y,z', False, True),
    ('"a","b', True, True), ('","', False, True), ('a""b', False, True), ('"a"" b', True, False), (',"', True, False),
])
def test_states_of_a_line(line, outside, inside):
    quotes = records.Quotes(",")
    naive = {}
    for begin in (False, True):
        state, at_start, i = begin, not begin, 0
        literal = False
        while i < len(line):
            c = line[i]
            if state:
                if c == '"':
                    if line[i + 1 : i + 2] == '"':
                        i += 1
                    else:
                        state, literal = False, True
            elif c == ",":
                at_start, literal = True, False
                i += 1
                continue
            elif c == '"' and at_start and not literal:
                state = True
            at_start = False
            i += 1
        naive[begin] = state
    assert (quotes.ends_inside(line, False), quotes.ends_inside(line, True)) == (naive[False], naive[True])


def test_composition_of_splits():
    pairs = [(0, 0, True, True, True), (0, 100, False, True, False), (0, 300, True, False, True), (1, 0, False, True, False)]
    states = records.open_ends(pairs)
    assert [records.begins_inside(states, 0, s) for s in (0, 50, 100, 200, 300, 400)] == [False, True, True, True, True, False]
    assert not records.begins_inside(states, 1, 50)
    assert not records.begins_inside(states, 2, 0)


def test_compressed_header(spark, tmp_path):
    import gzip

    (tmp_path / "t.csv.gz").write_bytes(gzip.compress(b'a,b\n1,"x\ny"\n'))
    got = read_text_table(spark, str(tmp_path / "t.csv.gz")).collect()
    assert (got[0].a, got[0].b) == ("1", "x\ny")
