from datetime import datetime as dt

import pytest

from monthglass.operators import clean, features
from monthglass.plans.stages import input_report


def test_attributes(spark):
    rows = [
        ("C1", "25_", "123-45-6789", "x", "A", "2023-01-01"),
        ("C2", "18", None, " _______ ", " Ann\t", "2023-01-01"),
        ("C3", "75.1", None, "x", "A", "2023-01-01"),
        ("C4", "75", "123-45-67890", "x", "A", "2023-01-01"),
        ("C5", "75", "123-45-6789", " Clerk ", "", "2023-01-01"),
        (None, "40", None, "x", "A", "2023-01-01"),
        ("C6", "17.9", None, "x", "A", "2023-01-01"),
    ]
    df = spark.createDataFrame(rows, "Customer_ID string, Age string, SSN string, Occupation string, Name string, snapshot_date string")
    got = {r.Customer_ID: r for r in clean.clean_attributes(df).collect()}
    assert set(got) == {"C2", "C5"}
    assert (got["C2"].Age, got["C2"].Occupation, got["C2"].Name) == (18.0, None, "Ann")
    assert (got["C5"].Occupation, got["C5"].Name, got["C5"].snapshot_date) == ("Clerk", None, dt(2023, 1, 1))


def test_bad_date_stops_the_job(spark):
    df = spark.createDataFrame([("C1", "20", "not a date")], "Customer_ID string, Age string, snapshot_date string")
    with pytest.raises(Exception, match="(?i)no date|not a date|USER_RAISED"):
        clean.clean_attributes(df).collect()


def test_financials(spark):
    rows = [
        ("C1", "1000_", "5 Years and 3 Months", " Good ", "!@9#%8"),
        ("C2", "_", "NA", "_", "x"),
        ("C3", "-5", None, "Good", "x"),
        ("C4", "10000001", None, "Good", "x"),
        ("C5", "10000000", "foo", "Good", "x"),
    ]
    df = spark.createDataFrame(
        rows, "Customer_ID string, Annual_Income string, Credit_History_Age string, Credit_Mix string, Payment_Behaviour string"
    )
    got = {r.Customer_ID: r for r in clean.clean_financials(df).collect()}
    assert set(got) == {"C1", "C2", "C5"}
    assert (got["C1"].Annual_Income, got["C1"].Credit_History_Age_Months, got["C1"].Credit_Mix, got["C1"].Payment_Behaviour) == (
        1000.0, 63, "Good", None,
    )
    assert (got["C2"].Annual_Income, got["C2"].Credit_History_Age_Months, got["C2"].Credit_Mix) == (None, None, None)
    assert got["C5"].Credit_History_Age_Months == 0


def test_loans(spark):
    rows = [
        ("L1", "C1", "2023-01-01", "0", "2022-12-01"),
        ("L1", "C1", "2023-02-01", "10", "2022-12-01"),
        ("L1", "C1", "2023-03-01", "0", "2022-12-01"),
        ("L1", "C1", "2023-04-01", "5", "2022-12-01"),
        ("L2", "C1", "2023-01-01", None, "2023-01-01"),
        (None, "C1", "2023-01-01", "5", "2023-01-01"),
    ]
    df = spark.createDataFrame(rows, "loan_id string, Customer_ID string, snapshot_date string, overdue_amt string, loan_start_date string")
    got = {(r.loan_id, r.snapshot_date.month): (r.mob, r.dpd) for r in clean.clean_loans(df).collect()}
    # Curing a loan does not reset the count.
    assert got == {("L1", 1): (1, 0), ("L1", 2): (2, 0), ("L1", 3): (3, 28), ("L1", 4): (4, 59), ("L2", 1): (0, 0)}


def test_installment_number_wins(spark):
    df = spark.createDataFrame([(3, dt(2023, 1, 1), dt(2022, 1, 1))], "installment_num int, snapshot_date timestamp, loan_start_date timestamp")
    assert clean.add_months_on_book(df).first().mob == 3


def test_engineered_columns_need_their_inputs(spark):
    df = spark.createDataFrame([(10.0, None, 3)], "Annual_Income double, Outstanding_Debt double, Num_of_Loan int")
    out = features.financial_features(df)
    assert out.columns[3:] == ["log_annual_income", "debt_to_income"]
    assert out.first().debt_to_income is None
    full = spark.createDataFrame([(None, 2, 3)], "Num_Bank_Accounts int, Num_Credit_Card int, Num_of_Loan int")
    row = features.financial_features(full).first()
    assert (row.total_financial_products, row.loans_per_credit_product) == (5.0, None)


def test_one_hot_and_target_encoding(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 0), (3, None, 1), (4, "c", 0)], "id int, k string, y int")
    hot = {r.id: (r.k_a, r.k_b) for r in features.one_hot(df, "k", ["a", "b"]).collect()}
    assert hot == {1: (1, 0), 2: (0, 1), 3: (0, 0), 4: (0, 0)}
    enc = {r.id: r.e for r in features.target_encode(df, df.where("id < 4"), "k", "y", "e").collect()}
    assert enc == {1: 1.0, 2: 0.0, 3: 1.0, 4: pytest.approx(2 / 3)}
    index = features.category_index(df, "k")
    assert sorted(r["index"] for r in index.collect()) == [0, 1, 2]
    places = {r.id: r.place for r in features.one_hot_sparse(df, "k", index, "place").collect()}
    assert places[3] is None and sorted(p for p in places.values() if p is not None) == [0, 1, 2]
    assert features.fill_category(df, ["k"], None).where("k IS NULL").count() == 1


def test_input_report(spark):
    rows = [("C1", "abc", "x"), ("C2", "80", "bad"), ("C3", "30", "bad"), ("C4", "40", "123-45-6789"), (None, "99", "x")]
    df = spark.createDataFrame(rows, "Customer_ID string, Age string, SSN string")
    got = {r.check_name: r for r in input_report(df, "attributes").collect()}
    # Text ages are gone by then, and numbers of people outside the age range are not looked at.
    assert got["range_check_Age"].details["violations"] == "1"
    assert (got["pattern_check_SSN"].passed, got["pattern_check_SSN"].details["violations"]) == (False, "1")
    clicks = spark.createDataFrame([("C1", "-2000", "1")], "Customer_ID string, fe_1 string, fe_2 string")
    assert [r.check_name for r in input_report(clicks, "clickstream").collect()] == ["range_check_fe_1"]
    assert input_report(clicks, "loans") is None
