"""Lines that are no record: reasons, nothing lost, records of batch and lines agree."""

import pytest
from pyspark.sql import functions as F

from riskloom.catalog import FeatureCatalog, FeatureSpec
from riskloom.errors import CatalogMismatch
from riskloom.sources.lines import classify_lines, corrupt_records, line_records, read_lines

CATALOG = FeatureCatalog((FeatureSpec("x"), FeatureSpec("y")), label="label", key_cols=("id",))

JSON = {
    '{"id": "a", "x": 1, "y": 2.5}': None, '{"id": "b", "x": "3", "y": true, "more": {"z": [1]}}': None, '{"id": "c", "y": 1}': None,
    '{"id": "d", "x": "none", "y": null}': None, '  {"x": 1, "y": 1}  ': None, "{}": None,
    "": "empty", " \t ": "empty", '{"id": "e", "x": 1': "not_json", "id,x,y": "not_json", "[1, 2]": "not_an_object", '"text"': "not_an_object",
    "17": "not_an_object", "null": "not_an_object", '[{"x": 1, "y": 2}]': "not_an_object", "{'x': 1}": "not_json",
}
CSV = {
    "a,1,2.5": None, '"b",3,true': None, '"c, d",,1': None, 'e,none,': None, 'f "g",1,2': "ok", "": "empty", "a,1": "too_few_fields", "a": "too_few_fields",
    "a,1,2,3": "too_many_fields", '"a,1,2': "open_quote", '"h ""i""",1,2': None,
}


def test_json_lines(spark):
    lines = spark.createDataFrame([(i, s) for i, s in enumerate([*JSON, None])], "n int, line string")
    classified = classify_lines(lines, CATALOG)
    assert {r.line: r.reason for r in classified.collect()} == {**JSON, None: "empty"}
    records = {r.id: (r.x, r.y) for r in line_records(classified, CATALOG).collect()}
    assert records["a"] == (1.0, 2.5) and records["b"] == (3.0, 1.0) and records["c"] == (None, 1.0) and records["d"] == (None, None)
    bad = corrupt_records(classified)
    assert bad.columns == ["n", "line", "reason"]
    assert bad.count() + line_records(classified, CATALOG).count() == lines.count()


def test_csv_lines(spark):
    del_ok = {k: (None if v == "ok" else v) for k, v in CSV.items()}
    lines = spark.createDataFrame([(s,) for s in [*CSV, "id,x,y", None]], "line string")
    classified = classify_lines(lines, CATALOG, "csv", ["id", "x", "y"])
    assert {r.line: r.reason for r in classified.collect()} == {**del_ok, None: "empty"}
    records = {r.id: (r.x, r.y) for r in line_records(classified, CATALOG).collect()}
    assert records["a"] == (1.0, 2.5) and records["b"] == (3.0, 1.0) and records["c, d"] == (None, 1.0) and records['h "i"'] == (1.0, 2.0)


def test_files_and_names(spark, tmp_dir):
    spark.createDataFrame([("y,x", ), ("1,2", ), ("3", )], "line string").coalesce(1).write.text(f"{tmp_dir}/f")
    classified = classify_lines(read_lines(spark, f"{tmp_dir}/f"), CATALOG, "csv", ["y", "x"])
    assert [(r.line, r.reason) for r in corrupt_records(classified).collect()] == [("3", "too_few_fields")]
    assert corrupt_records(classified).filter(F.col("file").contains("/f/")).count() == 1
    assert [(r.x, r.y) for r in line_records(classified, CATALOG).collect()] == [(2.0, 1.0)]
    with pytest.raises(CatalogMismatch, match="y"):
        classify_lines(read_lines(spark, f"{tmp_dir}/f"), CATALOG, "csv", ["id", "x"])
