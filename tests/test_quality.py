import datetime as dt

import pytest
from conftest import rows

from tradewind.operators import quality as q
from tradewind.plans import cleaning
from tradewind.sources import landing

DAY = dt.date(2026, 3, 12)
VALUE = "meat__pig__00001035__production__005510__tonnes"


def test_rules(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, 1.0), ("a", 1, -1.0), ("a", 2, None), (None, 3, 5.0), (None, 3, 6.0),
            (None, None, 7.0), (None, None, 8.0),
        ],
        "entity string, year int, v double",
    )
    checks = [
        q.NotNull("entity"), q.NotNull("v"), q.Between("v", low=0), q.Between("v", high=6),
        q.UniqueTogether(("entity", "year")),
    ]
    results = q.run_checks(df, checks)
    got = [(r["column"], r["unexpected_count"], r["element_count"], r["success"]) for r in results.collect()]
    # Rows of every repeated key count; rows without any key do not.
    assert got == [
        ("entity", 4, 7, False), ("v", 1, 7, False), ("v", 1, 7, False), ("v", 2, 7, False),
        ("N/A", 4, 7, False),
    ]
    message = q.suite_message(results, "f.csv").first()
    assert message["severity"] == "WARNING"
    assert message["message"] == (
        "⚠️ Validation failed for file f.csv: "
        "expect_column_values_to_not_be_null(entity): 4/7 failed; "
        "expect_column_values_to_not_be_null(v): 1/7 failed; "
        "expect_column_values_to_be_between(v): 1/7 failed; "
        "expect_column_values_to_be_between(v): 2/7 failed; "
        "expect_compound_columns_to_be_unique(N/A): 4/7 failed"
    )
    fine = q.suite_message(q.run_checks(df, [q.NotNull("v")]).where("success"), "f.csv").first()
    assert fine[:] == ("SUCCESS", "✅ File f.csv passed validation successfully.")


def test_empty_table(spark):
    df = spark.createDataFrame([], "entity string, year int")
    got = q.run_checks(df, [q.NotNull("entity"), q.UniqueTogether(("entity", "year"))])
    assert [r["unexpected_count"] for r in got.collect()] == [0, 0]


def test_types(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert q.columns_match(df, ["n", "s"])
    assert not q.columns_match(df, ["s", "n"])
    assert q.type_mismatches(df, {"n": "bigint", "s": "string", "z": "int"}) == {
        "n": "int", "z": "missing",
    }


def write(root, dataset, text):
    path = landing.landing_path(str(root), cleaning.YEARLY[dataset].landed, DAY)
    folder = root / cleaning.YEARLY[dataset].landed
    folder.mkdir(parents=True, exist_ok=True)
    open(path, "w").write(text)


def test_validation_of_landed_files(spark, tmp_path, database):
    log = f"{database}.validation_logs"
    for dataset in cleaning.CHECKED:
        header = ",".join(cleaning.expected_columns(dataset))
        write(tmp_path, dataset, f"{header}\nPoland,POL,2020,5.5\n")
    cleaning.validate_landed(spark, str(tmp_path), DAY, log)
    assert {r["severity"] for r in spark.table(log).collect()} == {"SUCCESS"}
    assert spark.table(log).count() == 3

    header = ",".join(cleaning.expected_columns("production"))
    write(tmp_path, "production", f"{header}\nPoland,POL,2020,-5\nPoland,,2020,6\n")
    cleaning.validate_landed(spark, str(tmp_path), DAY, log)
    warning = spark.table(log).where("severity = 'WARNING'").first()["message"]
    assert warning == (
        "⚠️ Validation failed for file pork_production_2026-03-12.csv: "
        "expect_column_values_to_not_be_null(code): 1/2 failed; "
        f"expect_column_values_to_be_between({VALUE}): 1/2 failed; "
        "expect_compound_columns_to_be_unique(N/A): 2/2 failed"
    )

    write(tmp_path, "import", "code,entity,year,x\nPOL,Poland,2020,1\n")
    with pytest.raises(q.ValidationStopped):
        cleaning.validate_landed(spark, str(tmp_path), DAY, log)
    assert spark.table(log).where("severity = 'ERROR'").count() == 1
    with pytest.raises(q.ValidationStopped):
        cleaning.validate_landed(spark, str(tmp_path / "nowhere"), DAY, log)
    assert "Error processing" in rows(spark.table(log).where("severity = 'ERROR'").select("message"))[1][0] + rows(
        spark.table(log).where("severity = 'ERROR'").select("message")
    )[0][0]
    assert [r["ingestion_date"] for r in spark.table(log).limit(1).collect()] == [DAY]
