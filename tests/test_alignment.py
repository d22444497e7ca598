"""Files by their coordinates: one behind the other, overlapping, disagreeing."""

import pytest

from rivulet.model import from_table
from rivulet.operators.alignment import Misaligned, align, conflicting_cells, coordinate_ranges, overlapping_ranges
from rivulet.plans.profile import Profile


def files(spark, rows):
    return from_table(spark.createDataFrame(rows, "file string, t int, x int, v double, w string"), ("t", "x"), file_key=("file",))


def test_files_one_behind_the_other(spark):
    data = files(spark, [("b", 3, 1, 3.0, None), ("b", 4, 1, None, "q"), ("a", 1, 1, 1.0, "p"), ("a", 2, 1, 2.0, None)])
    out = align(data, along="t")
    assert out.file_key == () and out.df.columns == ["t", "x", "v", "w"]
    assert sorted(map(tuple, out.df.collect())) == [(1, 1, 1.0, "p"), (2, 1, 2.0, None), (3, 1, 3.0, None), (4, 1, None, "q")]
    assert {(r.file, r["first"], r["last"], r.n) for r in coordinate_ranges(data, "t").collect()} == {("a", 1, 2, 2), ("b", 3, 4, 2)}


def test_overlaps_are_named(spark):
    data = files(spark, [("a", 1, 1, 1.0, None), ("a", 9, 1, 1.0, None), ("b", 2, 1, 1.0, None), ("b", 3, 1, 1.0, None), ("c", 4, 1, 1.0, None), ("d", 10, 1, 1.0, None)])
    found = {tuple(r) for r in overlapping_ranges(coordinate_ranges(data, "t"), ["file"]).collect()}
    assert found == {("b", "a", 2, 9), ("c", "a", 4, 9)}
    with pytest.raises(Misaligned, match="before a ends at 9"):
        align(data, along="t")
    assert align(data).df.count() == 6
    touching = files(spark, [("a", 1, 1, 1.0, None), ("a", 2, 1, 1.0, None), ("b", 2, 1, 1.0, None)])
    with pytest.raises(Misaligned, match="b begins at 2, before a ends at 2"):
        align(touching, along="t")


def test_cells_that_disagree(spark):
    rows = [("a", 1, 1, 1.0, "p"), ("b", 1, 1, 2.0, "p"), ("a", 1, 2, None, None), ("b", 1, 2, 5.0, "z"), ("c", 1, 2, 5.0, None)]
    data = files(spark, rows)
    assert [tuple(r) for r in conflicting_cells(data).collect()] == [(1, 1, "v", "1.0", "2.0", 2)]
    with pytest.raises(Misaligned, match=r"v at t=1, x=1: 1.0 and 2.0"):
        align(data)
    pick = lambda how: sorted(map(tuple, align(data, conflicts=how).df.collect()))
    assert pick("least") == [(1, 1, 1.0, "p"), (1, 2, 5.0, "z")] and pick("most") == [(1, 1, 2.0, "p"), (1, 2, 5.0, "z")]
    with pytest.raises(ValueError, match="not some"):
        align(data, conflicts="some")
    same = Profile.from_dict({"operations": [{"operation": "merge", "by_coordinates": True}]}).run(files(spark, [*rows[2:], *rows[2:]]))
    assert [tuple(r) for r in same.df.collect()] == [(1, 2, 5.0, "z")]
    assert align(files(spark, rows).with_df(data.df.limit(0))).df.collect() == []
