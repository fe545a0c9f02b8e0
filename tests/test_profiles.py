"""Measured types, sketches, and the stored table of seen keys."""

import uuid

from pyspark.sql import functions as F

from jobweave.operators import measured, schema_match, seen, sketches
from jobweave.sources.readers import load_variants


def types_of(df, **options):
    return {r["column"]: (r["type"], r["share"]) for r in measured.with_type(measured.measure(df, **options)).collect()}


def test_lattice(spark):
    ddl = "a string, b string, c string, d string, e string, f int, g double, h boolean"
    rows = [("1", "1", "true", "2024-02-29", None, 1, 0.5, True), ("-2", "2.5", "1", "", " ", None, None, None)]
    assert types_of(spark.createDataFrame(rows, ddl)) == {
        "a": ("int", 1.0), "b": ("double", 0.5), "c": ("string", 0.0), "d": ("date", 1.0), "e": ("null", None),
        "f": ("int", 1.0), "g": ("double", 1.0), "h": ("boolean", 1.0),
    }
    assert types_of(spark.createDataFrame([("2024-02-30",), ("1e400x",)], "d string")) == {"d": ("string", 1.0)}
    assert types_of(spark.createDataFrame([("12",)], "d string"), parse=False) == {"d": ("string", 1.0)}
    assert measured.measure(spark.createDataFrame([], "a string")).count() == 0


def test_measures_add_up(spark):
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(["1", "2.5", "x", None, "", "7", "true"])], "k int, v string")
    whole = measured.measure(df.drop("k")).collect()
    parts = [measured.measure(df.where(f"k = {k}").drop("k")) for k in range(3)]
    assert measured.merge_measures(*parts).collect() == whole
    assert measured.merge_measures(measured.measure(df, "k")).collect() == whole


def test_variants_keep_the_written_type(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"mức lương": 5, "x\\"y": true}\n{"mức lương": 2.5}\n{"mức lương": null, "x\\"y": [1]}\n')
    df = load_variants(spark, str(tmp_path / "a.json"), ["mức lương", 'x"y', "absent"])
    assert types_of(df) == {"mức lương": ("double", 0.5), 'x"y': ("string", 0.5), "absent": ("null", None)}


def test_sources_that_disagree_on_types(spark):
    def frame(value):
        return spark.createDataFrame([(1, value), (2, None)], "id int, v string").select("id", F.parse_json("v").alias("mức lương"))

    frames = {"joboko": frame('"x"'), "topcv": frame("5")}
    result = schema_match.analyze({s: df.drop("id") for s, df in frames.items()}, measured=True)
    row = result["fields"].where("field = 'salary'").first()
    assert row["consistency_score"] == 0.5 and row["all_types"] == ["int", "string"]
    assert "described" not in result


def test_sketches_merge_and_replace_days(spark, tmp_path):
    rows = spark.range(20_000).selectExpr(
        "IF(id % 3 = 0, 'hot', 'rest') AS source", "date_add(DATE'2024-01-01', CAST(id % 5 AS INT)) AS day", "id % 4000 AS user",
        "IF(id % 10 = 0, NULL, CAST(id AS DOUBLE)) AS value",
    )
    made = sketches.sketch(rows, ["source", "day"], ["user"], ["value"])
    path = str(tmp_path / "s")
    sketches.save_sketches(made, path)
    sketches.save_sketches(made.where("day < '2024-01-03'"), path)  # the same days once more
    stored = sketches.load_sketches(spark, path)
    told = sketches.estimates(sketches.merge(stored, []), {"low": 0.1, "median": 0.5}).first()
    assert told["rows"] == 20_000 and abs(told["unique_user"] - 4000) < 120
    assert abs(told["median_value"] - 10_000) < 600 and abs(told["low_value"] - 2000) < 600
    empty = spark.createDataFrame([("a", None, None)], "source string, user bigint, value double")
    row = sketches.estimates(sketches.sketch(empty, ["source"], ["user"], ["value"])).first()
    assert (row["rows"], row["unique_user"], row["median_value"]) == (1, 0, None)


def test_seen_side_is_not_shuffled(spark, tmp_path):
    name, key = f"seen_{uuid.uuid4().hex}", "user"
    known = seen.open_seen(spark, name, str(tmp_path / "seen"), key, "bigint", 16)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        first = spark.createDataFrame([(1, 5), (1, 4), (2, 6), (None, 7)], "user bigint, at int")
        rows = seen.fresh_rows(first, known, key, ["at"])
        assert sorted((r["user"] or 0, r["at"]) for r in rows.collect()) == [(0, 7), (1, 4), (2, 6)]
        seen.append_seen(rows, name, key)
        second = spark.createDataFrame([(2, 1), (3, 9), (3, 8)], "user bigint, at int")
        rows = seen.fresh_rows(second, spark.table(name), key, ["at"])
        plan = rows._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("SortMergeJoin") :].splitlines()[1:]
        old = "\n".join(line for line in below if not line.lstrip().startswith(":"))
        assert "Bucketed: true" in old and "Exchange" not in old
        assert [(r["user"], r["at"]) for r in rows.collect()] == [(3, 8)]
        seen.append_seen(rows, name, key)
        assert spark.table(name).count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql(f"DROP TABLE `{name}`")
