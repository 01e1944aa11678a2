"""Readers, writers and the catalog."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.queries import REGISTRY
from checks import fixture as fx
from txnlake.plans import views
from txnlake.schemas import BRONZE_COLS, CORRUPT
from txnlake.session import shared_dir
from txnlake.sources import catalog, files, tables


def test_malformed_csv_lines_are_kept_apart(spark, tmp_path):
    header = ",".join(BRONZE_COLS)
    good = ",".join(["1.5"] + ["0.25"] * 28 + ["9.99", "1"])
    bad = ",".join(["x"] + ["0.25"] * 28 + ["9.99", "1"])
    path = tmp_path / "a.csv"
    path.write_text("\n".join([header, good, bad]) + "\n")
    df = files.read_csv(spark, str(path)).cache()
    assert df.where(F.col(CORRUPT).isNull()).count() == 1
    assert df.where(F.col(CORRUPT).isNotNull()).first()[CORRUPT] == bad


def test_landing_verifies_lines(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("h\n1\n2\n")
    (tmp_path / "raw" / "b.csv").write_text("h\n3\n")
    rows = files.land_raw(spark, str(tmp_path / "raw"), str(tmp_path / "bronze")).collect()
    assert sorted((r["lines_read"], r["lines_landed"], r["verified"]) for r in rows) == [(2, 2, True), (3, 3, True)]
    assert all(r["source_bytes"] > 0 for r in rows)


def test_latest_snapshot(spark, tmp_path):
    root = str(tmp_path / "silver")
    assert files.latest_snapshot(spark, root) == f"{root}/current"
    df = spark.range(5)
    files.write_versioned(df, root, "1")
    files.write_versioned(df.limit(2), root, "2")
    newest = files.latest_snapshot(spark, root)
    assert newest.endswith("creditcard_sample_2")
    assert spark.read.parquet(newest).count() == 2 and newest.endswith(files.current_snapshot(spark, root))


def test_current_is_replaced_as_a_whole(spark, tmp_path):
    """Rows are written once; a reader of the old version goes on, also where a version is written again."""
    root = str(tmp_path / "silver")
    files.write_versioned(spark.range(5), root, "1")
    old = spark.read.parquet(files.current_snapshot(spark, root))
    for rows in (7, 9):
        files.write_versioned(spark.range(rows), root, "1")
        assert spark.read.parquet(files.current_snapshot(spark, root)).count() == rows
        assert old.count() == 5
    assert sorted(p.name for p in (tmp_path / "silver").iterdir() if not p.name.startswith(".")) == [
        "creditcard_sample_1", "creditcard_sample_1.2", "creditcard_sample_1.3", "current.json",
    ]


def test_fallback_to_csv(spark, tmp_path):
    (tmp_path / "b.csv").write_text(",".join(BRONZE_COLS) + "\n" + ",".join(["1"] * 31) + "\n")
    assert files.read_with_fallback(spark, str(tmp_path / "none"), str(tmp_path / "b.csv")).columns == BRONZE_COLS
    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert files.read_with_fallback(spark, str(tmp_path / "p"), str(tmp_path / "b.csv")).count() == 3


def test_positional_binding_checks_types(spark):
    df = spark.sql("SELECT 1L AS a, 2D AS b")
    schema = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.DoubleType())])
    assert files.bind_by_position(df, schema).columns == ["x", "y"]
    with pytest.raises(TypeError, match="b double"):
        files.bind_by_position(df, T.StructType([schema[0], T.StructField("y", T.StringType())]))
    with pytest.raises(ValueError):
        files.bind_by_position(df, T.StructType([schema[0]]))


def test_partition_overwrite_is_dynamic(spark, tmp_path):
    path = str(tmp_path / "gold")
    files.write_gold(spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(x, p)"), path, ["p"])
    files.write_gold(spark.sql("SELECT 9 AS x, 'b' AS p"), path, ["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("x", "p").collect()) == [(1, "a"), (9, "b")]


def test_catalog(spark, tmp_path):
    catalog.create_schemas(spark, str(tmp_path / "schemas"))
    catalog.create_schemas(spark, str(tmp_path / "schemas"))
    names = {r[0] for r in catalog.list_schemas(spark).collect()}
    assert set(catalog.SCHEMAS) <= names
    assert "spark_catalog" in {r[0] for r in catalog.list_catalogs(spark).collect()}
    df = spark.sql("SELECT 1 AS Class, 2D AS Amount")
    df.write.parquet(str(tmp_path / "t"))
    catalog.create_table(spark, "gold_ml.t_one", df.schema, str(tmp_path / "t"))
    catalog.create_table(spark, "gold_ml.t_one", df.schema, str(tmp_path / "t"))
    catalog.create_table(spark, "gold_ml.t_one", df.schema, str(tmp_path / "t"), replace=True)
    catalog.create_like(spark, "gold_ml.t_two", "gold_ml.t_one", str(tmp_path / "t"))
    assert spark.table("gold_ml.t_one").count() == spark.table("gold_ml.t_two").count() == 1
    (tmp_path / "raw" / "2024-01-01--05").mkdir(parents=True)
    (tmp_path / "raw" / "2024-01-01--05" / "x.json").write_text('{"a":1}\n{"a":2}\n')
    catalog.create_text_table(spark, "gold_streaming.raw_text", str(tmp_path / "raw"))
    assert spark.table("gold_streaming.raw_text").count() == 2
    catalog.register_views({"v_one": df})
    assert spark.sql("SELECT Amount FROM v_one").first()[0] == 2.0


def test_hour_folder_from_either_path_form(spark, tmp_path):
    for folder in ("2024-01-01--05", "hour_bucket=2024-01-01--06"):
        (tmp_path / "raw" / folder).mkdir(parents=True)
        (tmp_path / "raw" / folder / "x.json").write_text('{"amount":1.5,"fraud_class":1,"v1":0.5}\n')
    parsed = views.stream_parsed(files.read_json_text(spark, str(tmp_path / "raw"))).orderBy("hour_bucket").collect()
    assert [(r["hour_bucket"], r["amount"], r["class"], r["time"]) for r in parsed] == [
        ("2024-01-01--05", 1.5, 1, None), ("2024-01-01--06", 1.5, 1, None),
    ]


def test_inventory(spark, tmp_path):
    root = str(tmp_path / "lake")
    spark.range(5).coalesce(1).write.parquet(f"{root}/one")
    spark.range(5).repartition(3).write.parquet(f"{root}/two")
    inv = files.inventory(spark, root)
    total = files.inventory_total(inv).first()
    assert total["datasets"] == 2 and total["latest_dataset"] == "two" and total["total_mb"] > 0


def test_constraints_and_types_of_the_source_table(spark):
    df = spark.sql("SELECT 1L AS id, CAST(NULL AS BIGINT) AS time_stamp, 1.5 AS amount, 3 AS class")
    got = {r["rule"]: r["violations"] for r in tables.constraint_checks(df).collect()}
    assert got == {"time_stamp_not_null": 1, "amount_not_null": 0, "class_not_null": 0, "class_in_0_1": 1}


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


@pytest.mark.parametrize("name", ["an_batch_vs_realtime", "an_hourly_unified", "gold_retention"])
def test_date_filters_prune_folders(spark, sf_dir, capsys, name):
    REGISTRY[name](spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    scans = [x for x in plan.split("PartitionFilters: ")[1:] if x.startswith("[isnotnull(day")]
    assert len(scans) == (1 if name == "gold_retention" else 2)


def test_filters_and_columns_reach_the_scan(spark, sf_dir, capsys):
    current = fx.table(spark, sf_dir, "current")
    current.where("split = 'train' AND Amount > 100").select("id", "Amount").explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(split" in plan
    assert "GreaterThan(Amount,100.0)" in plan
    assert "ReadSchema: struct<id:bigint,Amount:double>" in plan
