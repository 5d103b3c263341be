"""Text files in, stored transitions out."""

import pytest

from loanshift.functions.states import STATES
from loanshift.operators import clean, matrix
from loanshift.plans.build import Series, transition_table
from loanshift.sources import economics, layout, performance, tables

# Name, type, kept and the value written, in file order; None is filled per record.
FIELDS = [
    ("Pool_ID", "string", 0, ""), ("Loan_ID", "string", 1, None), ("Act_Period", "string", 1, None), ("Channel", "string", 1, "R"),
    ("Orig_Rate", "float64", 1, "6.0"), ("Curr_Rate", "float64", 1, "6.0"), ("Orig_UPB", "float64", 1, "200000"),
    ("Curr_UPB", "float64", 1, "150000"), ("Orig_Term", "float64", 1, "360"), ("Orig_Date", "string", 1, "062005"),
    ("First_Pay", "string", 1, "082005"), ("Loan_Age", "float64", 1, "36"), ("Rem_Months", "float64", 1, "324"),
    ("Adj_Rem_Months", "float64", 1, ""), ("Maturity_Date", "string", 1, "072035"), ("OLTV", "float64", 1, "80"),
    ("OCLTV", "float64", 1, "80"), ("Num_Bo", "float64", 1, "1"), ("DTI", "float64", 1, None), ("Cscore_B", "float64", 1, "700"),
    ("First_Flag", "string", 1, "N"), ("Purpose", "string", 1, "P"), ("Prop", "string", 1, "SF"), ("No_Units", "float64", 1, "1"),
    ("Occ_Stat", "string", 1, "P"), ("State", "string", 1, "NC"), ("MSA", "string", 1, "m1"), ("ZIP", "string", 1, "275"),
    ("Mi_Pct", "float64", 1, ""), ("Product", "string", 1, None), ("Interest_Only_Loan_Indicator", "string", 1, "N"),
    ("Current_Loan_Delinquency_Status", "string", 1, None), ("Mod_Flag", "string", 1, "N"), ("Zero_Balance_Code", "float64", 1, None),
    ("Mi_Type", "string", 1, ""), ("Serv_Ind", "string", 1, "N"), ("HomeReady_Program_Indicator", "string", 1, "7"),
    ("Relocation_Mortgage_Indicator", "string", 1, "N"),
]


def line(loan, month, status, zero="", dti="30", product="FRM"):
    own = {
        "Loan_ID": loan, "Act_Period": f"{month:02d}2008", "DTI": dti, "Product": product,
        "Current_Loan_Delinquency_Status": status, "Zero_Balance_Code": zero,
    }
    return "|".join(own.get(name, value) for name, _, _, value in FIELDS)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw")
    spec = ["ID,Name,Abbreviation,Indicator,dType"] + [f"{i},x,{n} ,{k},{t}" for i, (n, t, k, _) in enumerate(FIELDS)]
    (path / "layout.csv").write_text("\n".join(spec) + "\n")
    late = [line("a", 4, "01"), line("a", 5, "", "1"), line("b", 2, "00", product="ARM"), line("b", 3, "00", product="ARM")]
    early = [line("a", 1, "00"), line("a", 2, "00", dti=""), line("a", 3, "00", dti="40"), line("c", 1, "06"), line("c", 2, "06"), line("c", 3, "07")]
    (path / "2008Q1.csv").write_text("\n".join(early) + "\n")
    (path / "2008Q2.csv").write_text("\n".join(late) + "\n")
    (path / "files.csv").write_text("name\n2008Q1.csv\n2008Q2.csv\n")
    quarters = [(2005, 2, 100.0), (2008, 1, 80.0), (2008, 2, 75.0)]
    (path / "zip.csv").write_text("z,y,q,h\n" + "".join(f"275,{y},{q},{h}\n" for y, q, h in quarters))
    (path / "state.csv").write_text("s,y,q,h\nNC,2005,2,50\n")
    months = [(6, 2005), *((m, 2008) for m in range(1, 6))]
    (path / "rates.csv").write_text("d,a,b\n" + "".join(f"28/{m}/{y},5.0,4.5\n" for m, y in months))
    (path / "ur.csv").write_text("f,d,u,s\n" + "".join(f"37,{m}/1/{y},{4 + m},NC\n" for m, y in months))
    (path / "judicial.csv").write_text("s,f,j\nNC,North Carolina,0\n")
    (path / "spread.csv").write_text("d,s\n" + "".join(f"1/{m}/{y},1.5\n" for m, y in months))
    return path


def test_files_to_transitions(spark, folder, tmp_path):
    from loanshift.operators.lookups import split_unemployment

    spec = layout.read_layout(spark, str(folder / "layout.csv"))
    records = clean.parse_dates(performance.read_listed(spark, str(folder), str(folder / "files.csv"), spec))
    metro, state = split_unemployment(economics.read_unemployment(spark, str(folder / "ur.csv")))
    series = Series(
        zip_index=economics.read_hpi_zip(spark, str(folder / "zip.csv")),
        state_index=economics.read_hpi_state(spark, str(folder / "state.csv")),
        rates=economics.read_rates(spark, str(folder / "rates.csv")),
        metro_unemployment=metro,
        state_unemployment=state,
        judicial=economics.read_judicial(spark, str(folder / "judicial.csv")),
        spread=economics.read_spread(spark, str(folder / "spread.csv")),
    )
    built = transition_table(records, series, {s: 1.0 for s in STATES})
    tables.write_transitions(built, str(tmp_path / "out"), mode="overwrite")
    rows = tables.read_transitions(spark, str(tmp_path / "out")).orderBy("Loan_ID", "Act_Period").collect()
    moves = [(r.Loan_ID, r.Act_Period.month, r.Current_Status, r.Next_Status) for r in rows]
    assert moves == [("a", 2, 0, 0), ("a", 3, 0, 1), ("a", 4, 1, -1), ("c", 2, 6, 7)]
    first = rows[0]
    # Mean over the records kept: the adjustable-rate loan does not count.
    assert first.DTI == pytest.approx((30.0 * 6 + 40.0) / 7)
    assert first.HPI_Adjust_Factor == pytest.approx(0.8)
    assert first.MTMLTV == pytest.approx(150000 / (200000 / 80 * 0.8))
    assert first["Refinance Indicator"] == pytest.approx(120.0) and first.SATO == pytest.approx(1.0)
    assert first.URate_Change == pytest.approx(6 - 10.0)
    assert (first.Month_2, first.Month_3, first.Vintage_2005_2006, first.Mi_Pct, first.Mi_Type) == (1, 0, 1, 0.0, "0")
    assert first.HomeReady_Program_Indicator == "N" and first.Time_Stamp.month == 1
    assert rows[2].Time_Stamp.month == 4
    p = {(r.cur, r.nxt): r.p for r in matrix.transition_matrix(matrix.transition_counts(built)).collect()}
    assert p[0, 1] == 0.5 and p[6, 7] == 1.0
