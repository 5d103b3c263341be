"""Matrix invariants and sampled horizons."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import adapter as A
from loanshift.functions.states import STATES
from loanshift.operators import matrix


@pytest.fixture(scope="module")
def loans(spark, sf):
    return matrix.loan_matrices(A.matrix_rows(spark, sf).where("Loan_ID < 20"))


def as_arrays(df):
    return {r[0]: np.array(r["matrix"]).reshape(9, 9) for r in df.collect()}


def test_two_state_power(spark):
    rows = [("a", 0, 0, 0.9), ("a", 0, 7, 0.1)]
    one = matrix.loan_matrices(spark.createDataFrame(rows, "Loan_ID string, cur int, nxt int, p double"))
    two = as_arrays(matrix.matrix_power(one, 2))["a"]
    at = [STATES.index(0), STATES.index(7)]
    assert two[np.ix_(at, at)] == pytest.approx(np.array([[0.81, 0.19], [0, 1]]))


def test_rows_sum_to_one_and_ends_absorb(loans):
    for m in as_arrays(matrix.matrix_power(loans, 5)).values():
        assert m.sum(axis=1) == pytest.approx(np.ones(9))
        assert m[0].tolist() == np.eye(9)[0].tolist() and m[8].tolist() == np.eye(9)[8].tolist()


def test_powers_compose(loans):
    two, three, five = (as_arrays(matrix.matrix_power(loans, k)) for k in (2, 3, 5))
    one = as_arrays(loans)
    for loan in one:
        assert five[loan] == pytest.approx(two[loan] @ three[loan])
        assert as_arrays(matrix.matrix_power(loans, 1))[loan] == pytest.approx(one[loan])
        break


def test_sampled_paths_converge_to_the_power(loans):
    exact = {(r.Loan_ID, r.nxt): r.p for r in matrix.horizon(loans, 0, 3, "power").collect()}
    shares = {(r.Loan_ID, r.nxt): r.p for r in matrix.horizon(loans, 0, 3, "paths", paths=4000).collect()}
    assert max(abs(p - shares.get(k, 0.0)) for k, p in exact.items()) < 0.05


def test_sampled_paths_repeat_under_any_partitioning(loans):
    one = matrix.sampled_horizon(loans, 0, 2, 50)
    other = matrix.sampled_horizon(loans.repartition(5), 0, 2, 50)
    assert one.exceptAll(other).count() == 0


def test_unknown_method(loans):
    with pytest.raises(ValueError):
        matrix.horizon(loans, method="other")


def test_state_never_left_has_a_zero_row(spark):
    counts = spark.createDataFrame([(0, 0, 3), (0, 1, 1)], "cur int, nxt int, n bigint")
    found = matrix.transition_matrix(counts)
    assert found.count() == 81
    assert found.where("cur = 5").agg(F.sum("p")).first()[0] == 0.0
    assert found.where("cur = 0 and nxt = 0").first().p == 0.75


def plain_walks(cells, base, start, months, paths):
    """Where each walk of one loan ends, path by path and month by month; null where it meets a row with a null."""
    ends = []
    for path in range(paths):
        at = start
        for month in range(months):
            x = (base + (path * months + month) * matrix.GOLDEN) & matrix.MASK32
            for shift, factor in matrix.MIX_STEPS:
                x = (x ^ (x >> shift)) * factor & matrix.MASK32
            row = cells[at * 9 : at * 9 + 9]
            if None in row:
                at = None
                break
            upto = [sum(row[: i + 1]) for i in range(9)]
            at = sum(upto[i] <= x / 2**32 * upto[8] for i in range(8))
        ends.append(at if at is None else at - 1)
    return ends


@pytest.mark.parametrize("at_once", [1 << 14, 7])
def test_sampled_paths_equal_plain_walks(spark, loans, monkeypatch, at_once):
    monkeypatch.setattr(matrix, "WALKS_AT_ONCE", at_once)
    rows = [(r[0], list(r["matrix"])) for r in loans.limit(3).collect()]
    holed = list(rows[0][1])
    holed[9 * 2 + 4] = None
    rows += [(100, holed), (101, [None] * 81), (None, rows[1][1]), (102, rows[2][1]), (102, rows[2][1]), (103, [0.0] * 81), (104, [2 * x for x in rows[1][1]])]
    held = spark.createDataFrame(rows, "Loan_ID int, matrix array<double>").withColumn("base", matrix.path_base(F.col("Loan_ID"), 1))
    wanted = {}
    for loan, cells, base in held.select("Loan_ID", "matrix", "base").collect():
        for end in plain_walks(cells, base, 1, 4, 60):
            wanted[loan, end] = wanted.get((loan, end), 0) + 1
    found = matrix.sampled_horizon(held.drop("base"), 0, 4, 60).collect()
    assert {(r.Loan_ID, r.nxt): r.n for r in found} == wanted and len(found) == len(wanted)
    assert all(r.p == r.n / 60 for r in found)


def test_walks_never_become_rows(loans):
    plan = matrix.sampled_horizon(loans, 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan


def test_a_task_holds_a_bounded_number_of_loans(spark, sf, monkeypatch):
    monkeypatch.setattr(A, "LOANS_A_TASK", 5)
    assert A.matrix_rows(spark, sf).rdd.getNumPartitions() == -(-A.table(spark, sf, "customer").count() // 5)


def test_a_task_holds_a_bounded_number_of_records(spark, sf, monkeypatch):
    usual = sorted(A.records(spark, sf).collect(), key=str)
    monkeypatch.setattr(A, "RECORDS_A_TASK", 10)
    spread = A.records(spark, sf)
    parts = -(-A.table(spark, sf, "orders").count() // 10)
    assert "hashpartitioning(o_custkey#" in (plan := spread._jdf.queryExecution().executedPlan().toString())
    assert f", {parts}), REPARTITION_BY_NUM" in plan
    assert sorted(spread.collect(), key=str) == usual
