"""Command line.

python -m txnlake run <bronze.csv> <lake> <version>     bronze to silver to gold
python -m txnlake list <lake>                           data sets with size and time
python -m txnlake analyze <parquet>                     profile of one data set
python -m txnlake validate <fraud|ml|risk|summary> <lake>
python -m txnlake report <lake>                         report over all gold tables
python -m txnlake register <lake>                       tables and views in the catalog, by name
python -m txnlake query <name> <lake>                   one of the analytic queries
python -m txnlake silver <lake>                         profile and rules of the newest silver table
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from txnlake.operators import profile, quality
from txnlake.plans import lake as lake_tables
from txnlake.plans import pipeline
from txnlake.session import BUILDER_OPTIONS, configure
from txnlake.sources import files

VALIDATE = {
    "fraud": (pipeline.HOURLY, profile.hourly),
    "ml": (pipeline.FEATURES, lambda df: profile.ml({"current": df})),
    "risk": (pipeline.RISK, profile.risk),
    "summary": (pipeline.SUMMARY, profile.summary),
}


def result(spark: SparkSession, args: list[str]) -> DataFrame | None:
    """The table a command shows, or None for unknown commands."""
    match args:
        case ["run", csv_path, lake, version]:
            pipeline.bronze_to_silver(spark, csv_path, lake, version)
            pipeline.silver_to_gold(spark, lake, version)
            return pipeline.gold_report(spark, lake)
        case ["list", lake]:
            return files.inventory(spark, f"{lake}/gold")
        case ["analyze", path]:
            return profile.dataset(spark.read.parquet(path))
        case ["validate", kind, lake] if kind in VALIDATE:
            name, check = VALIDATE[kind]
            return check(spark.read.parquet(f"{lake}/gold/{name}"))
        case ["report", lake]:
            return pipeline.gold_report(spark, lake)
        case ["register", lake]:
            return spark.createDataFrame([(n,) for n in lake_tables.register(spark, lake)], "name string")
        case ["query", name, lake] if name in lake_tables.QUERIES:
            return lake_tables.query(spark, lake, name)
        case ["silver", lake]:
            rows = spark.read.parquet(files.latest_snapshot(spark, f"{lake}/silver"))
            rules = quality.evaluate(rows, quality.silver_rules())
            return profile.gold_report({"quality": profile.silver_quality(rows), "rules": rules})
    return None


def main() -> int:
    builder = SparkSession.builder.appName("txnlake")
    for key, value in BUILDER_OPTIONS.items():
        builder = builder.config(key, value)
    out = result(configure(builder.getOrCreate()), sys.argv[1:])
    if out is None:
        print(__doc__)
        return 2
    out.show(1000, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
