"""Good and rejected rows: all rows are in one of them, with every reason, whatever the order of columns in a file."""

import pytest
from pyspark.sql import functions as F

from frames import bag
from starkit.operators import facts
from starkit.operators.facts import FillNull, RaiseTo
from starkit.sources import quarantine, read_by_header, read_csv, rejected_rows

SCHEMA = "id bigint not null, price double, day date, name string"
ROWS = [
    ("1", "2.5", "1/31/2024", "a"), ("x", "-1", "31/1/2024", "b"), (None, "", None, None), ("4", "1e3", " 2/1/2024 ", ""), (" 5 ", "oops", "2/30/2024", "c"),
    ("6", "-7", None, "d"), ("6", "-7", None, "d"), ("", "0", "1/1/2024", "é, \"q\""),
]


@pytest.fixture
def found(spark):
    raw = spark.createDataFrame(ROWS, "id string, price string, day string, name string").withColumn("extra", F.lit("e")).repartition(3)
    return quarantine(raw, SCHEMA, {"negative": F.col("price") < 0, "late": F.col("day") > F.lit("2024-12-31").cast("date")}, {"day": "M/d/yyyy"})


def test_rows_are_sorted_with_all_their_reasons(found):
    rejected = {tuple(r[c] for c in ("id", "price", "day", "name")): list(r["_reasons"]) for r in found.rejected.collect()}
    assert rejected == {
        ROWS[1]: ["not a bigint: id", "not a date: day", "negative"], ROWS[2]: ["missing id"], ROWS[4]: ["not a double: price", "not a date: day"],
        ROWS[5]: ["negative"], ROWS[7]: ["missing id"],
    }
    assert {(r["id"], r["price"], str(r["day"]), r["name"]) for r in found.good.collect()} == {(1, 2.5, "2024-01-31", "a"), (4, 1000.0, "2024-02-01", "")}
    assert found.rejected.columns == ["id", "price", "day", "name", "extra", "_reasons"]
    assert found.good.dtypes == [("id", "bigint"), ("price", "double"), ("day", "date"), ("name", "string")]


def test_no_row_is_lost_and_counts_are_those_of_the_rules(found):
    assert found.good.count() + found.rejected.count() == len(ROWS)
    assert {r["reason"]: r["rejected_rows"] for r in found.counts().collect()} == {
        "not a bigint: id": 1, "not a date: day": 2, "negative": 3, "missing id": 2, "not a double: price": 1,
    }


def test_counts_agree_with_cleaning_and_with_corrupt_rows(spark, tmp_path):
    lines = ["a,b", "1,2.5", "x,1", "3,-4", "4,", "5,zz"]
    with open(f"{tmp_path}/f.csv", "w") as file:
        file.write("\n".join(lines))
    sorted_ = quarantine(read_by_header(spark, [f"{tmp_path}/f.csv"], ["a", "b"]), "a int, b double", {"RaiseTo(b)": F.col("b") < 0, "FillNull(b)": F.col("b").isNull()})
    counts = {r["reason"]: r["rejected_rows"] for r in sorted_.counts().collect()}
    kept = read_csv(spark, f"{tmp_path}/f.csv", "a int, b double", keep_corrupt=True)
    bad_types = sorted_.rejected.where(F.exists("_reasons", lambda r: r.startswith("not a"))).count()
    assert bad_types == rejected_rows(kept).first()["rejected_rows"] == 2
    typed = kept.where("a IS NOT NULL OR b IS NOT NULL").select("a", "b")
    rules = {r["rule"]: r["touched_rows"] for r in facts.rule_counts(typed, [FillNull("b", 0), RaiseTo("b", 0)]).collect()}
    assert counts["RaiseTo(b)"] == rules["RaiseTo(b)"] == 1 and counts["FillNull(b)"] == rules["FillNull(b)"] == 2


def test_files_are_read_by_the_names_in_their_headers(spark, tmp_path):
    files = {"one": "id,name,day\n1,a,x\n2,b,y\n", "two": "day,id,other\nz,3,o\n", "three": "id,name,day\n4,d,w\n", "empty": "", "header": "name\n", "twice": "id,id\n1,2\n"}
    for name, text in files.items():
        with open(f"{tmp_path}/{name}.csv", "w") as file:
            file.write(text)
    paths = [f"{tmp_path}/{name}.csv" for name in files if name != "twice"]
    assert bag(read_by_header(spark, paths, ["id", "name", "day"])) == {("1", "a", "x"): 1, ("2", "b", "y"): 1, ("3", None, "z"): 1, ("4", "d", "w"): 1}
    assert read_by_header(spark, [], ["id"]).collect() == []
    with pytest.raises(ValueError, match="more than one column"):
        read_by_header(spark, [f"{tmp_path}/twice.csv"], ["id"])
