import random

import pytest

from assaysift.operators import headers, slips


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def numbers(name):
    return "".join(c if c.isdigit() else " " for c in name).split()


def brute(names, limit):
    links = {n: {m for m in names if m != n and numbers(m) == numbers(n) and distance(n, m) <= limit} for n in names}
    classes = {}
    for n in names:
        seen, todo = {n}, [n]
        while todo:
            for m in links[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        classes[n] = (min(seen), len(links[n]))
    return classes


def table(spark, rows):
    return spark.createDataFrame(rows, "row_index bigint, n string, paper_id string, sample_id string, sample_name string")


@pytest.mark.parametrize("limit", [1, 2])
def test_classes_equal_brute_force(spark, limit):
    rng = random.Random(limit)
    names = {"hard carbon 700", "hard carbn 700", "hard carbon 701", "hard carbon", "é-carbon", "e-carbon", "abcd", "abc", "aaaa", "aaaaa", "xaaaa"}
    names |= {"".join(rng.choice("abc") for _ in range(rng.choice([4, 5, 6, 9]))) for _ in range(40)}
    names |= {"chain" + "x" * i for i in range(12)}  # linked step by step
    rows = [(i, "k", paper, "S", name) for i, (paper, name) in enumerate((p, n) for p in ("P1", " p1 ", "P2") for n in sorted(names))]
    rows += [(1000 + i, "k", "P1", "S", " ABCD ") for i in range(300)]
    rows += [(2000, "k", None, "S", "abce"), (2001, "k", "P1", "S", None), (2002, "k", "P3", "S", ""), (2003, None, "-", "S", "abce")]
    frame = table(spark, rows)
    expected = brute({n for n in names if len(n) >= 4}, limit)
    got = slips.name_classes(frame, ("row_index", "n"), distance=limit).collect()
    assert {r.paper_key for r in got} == {"p1", "p2"}
    assert len(got) == 2 * len(expected)
    assert all((r.component, r.n_links) == expected[r.name_key] for r in got)
    for broadcast in (0, 200_000):
        flagged = slips.name_slips(frame, ("row_index", "n"), distance=limit, broadcast_groups=broadcast).collect()
        linked = {n for n, (_, k) in expected.items() if k}
        assert sorted(r.row_index for r in flagged) == sorted(r[0] for r in rows if r[2] in ("P1", " p1 ", "P2") and (r[4] or "").strip().lower() in linked)


def test_odd_tables(spark):
    assert slips.name_slips(table(spark, [])).collect() == []
    assert slips.name_classes(spark.createDataFrame([(1, "x")], "row_index bigint, sample_id string")).collect() == []


def test_repeated_headers_are_numbered_on_until_free(spark):
    frame = spark.createDataFrame([(["a", "a", "a__duplicate_1", "a", "b", "b"],)], "h array<string>")
    got = frame.select(headers.free_names(frame["h"], "__duplicate_").alias("h")).first().h
    assert got == ["a", "a__duplicate_1", "a__duplicate_1__duplicate_1", "a__duplicate_2", "b", "b__duplicate_1"]
