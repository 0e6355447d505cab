import pytest

from cinelake.operators.matrix import Matrix, wide, wide_blocks

CELL = "Customer_Key long, Content_Key long, Minutes double"


def test_contents_given_by_the_caller(spark):
    cells = spark.createDataFrame([(0, 1, 5.0), (0, 3, 2.0), (1, 2, 4.0)], CELL)
    out = wide(Matrix(cells, 2, 3, 3), bound=1, contents=[3, 1, 9])
    assert out.columns == ["Customer_Key", "3", "1", "9"]
    assert [tuple(r) for r in out.collect()] == [(0, 2.0, 5.0, 0.0), (1, 0.0, 0.0, 0.0)]


@pytest.mark.parametrize("width,columns", [(2, [["1", "2"], ["3", "40"], ["50"]]), (5, [["1", "2", "3", "40", "50"]])])
def test_blocks_hold_every_cell_and_user(spark, width, columns):
    cells = [(0, 1, 5.0), (0, 3, 2.0), (1, 2, 4.0), (1, 50, 0.0), (2, 40, 1.5), (0, 50, 7.0)]
    blocks = list(wide_blocks(Matrix(spark.createDataFrame(cells, CELL), 3, 5, 6), width))
    assert [b.columns[1:] for b in blocks] == columns
    known = {(u, str(i)): m for u, i, m in cells}
    for block in blocks:
        got = {r["Customer_Key"]: r.asDict() for r in block.collect()}
        assert sorted(got) == [0, 1, 2]
        for user, row in got.items():
            assert all(row[c] == known.get((user, c), 0.0) for c in block.columns[1:])


def test_more_contents_than_one_table_takes(spark):
    cells = spark.range(3000).selectExpr("id % 7 AS Customer_Key", "id * 3 AS Content_Key", "double(id + 1) AS Minutes")
    blocks = list(wide_blocks(Matrix(cells, 7, 3000, 3000)))
    assert [len(b.columns) - 1 for b in blocks] == [1000, 1000, 1000]
    sums = [sum(sum(r[1:]) for r in b.collect()) for b in blocks]
    assert sums == [500500.0, 1500500.0, 2500500.0]


def test_no_cells_give_no_block(spark):
    assert list(wide_blocks(Matrix(spark.createDataFrame([], CELL), 0, 0, 0))) == []
