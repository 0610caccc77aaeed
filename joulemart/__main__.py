"""Run the stages as jobs: ``spark-submit -m joulemart`` or ``python -m joulemart``.

    load    CSV_FOLDER RAW_PATH          land all-text CSV files, aligned by name
    build   RAW_PATH WAREHOUSE           stage and write the star schema
    check   RAW_PATH WAREHOUSE AS_OF     data checks; exit code 1 if one fails
    report  WAREHOUSE OUT [NAME ...]     write reports (all of them by default)
            [--boundaries GEOJSON]       with the district map
    train   WAREHOUSE MODEL [ROWS]       fit and save the forest, print its scores
    tune    WAREHOUSE MODEL [ROWS]       compare, search, refit and save boosted trees
    score   MODEL ROWS_PATH OUT          predict bands of feature rows
"""

from __future__ import annotations

import sys

from pyspark.sql import functions as F

from joulemart.operators.metrics import class_report, pair_counts
from joulemart.plans import band_features, band_models, checks, suite
from joulemart.plans.staging import lower_case_columns
from joulemart.session import build_session
from joulemart.sources.csv_landing import read_csv_by_name
from joulemart.sources.geojson import read_features
from joulemart.sources.tables import Warehouse


TRIALS = 30


def main(args: list[str]) -> int:
    if not args or args[0] not in {"load", "build", "check", "report", "train", "tune", "score"}:
        print(__doc__)
        return 2
    job, *rest = args
    spark = build_session(f"joulemart {job}")
    if job == "load":
        source, target = rest
        read_csv_by_name(spark, source).write.mode("overwrite").parquet(target)
        print(f"{spark.read.parquet(target).count():,} rows in {target}")
    elif job == "build":
        raw, root = rest
        Warehouse(spark, root).build(spark.read.parquet(raw)).row_counts().show(truncate=False)
    elif job == "check":
        raw, root, as_of = rest
        report = checks.quality_report(lower_case_columns(spark.read.parquet(raw)), Warehouse(spark, root).star(), as_of)
        rows = report.collect()  # one row per check
        for row in rows:
            print(f"{'pass' if row.passed else 'FAIL'}  {row.dataset}  {row.check}({row.column})  {row.n_failed}/{row.n_rows}")
        return 0 if all(row.passed for row in rows) else 1
    elif job == "report":
        features = None
        if "--boundaries" in rest:
            at = rest.index("--boundaries")
            features = read_features(spark, rest[at + 1])
            rest = rest[:at] + rest[at + 2 :]
        root, out, *names = rest
        warehouse = Warehouse(spark, root).pinned()
        outcome = suite.write_reports(warehouse.star(), warehouse.table("v_retrofit_priority"), out, names or None, features)
        outcome.show(100, truncate=False)
        return 1 if outcome.filter(F.col("error").isNotNull()).count() else 0
    elif job == "train":
        root, path, *size = rest
        n = int(size[0]) if size else band_features.SAMPLE_ROWS
        staged = Warehouse(spark, root).table("stg_certificates")
        rows = f"{path}-rows"
        band_features.split_features(band_features.sampled_features(staged, n)).write.mode("overwrite").parquet(rows)
        split = spark.read.parquet(rows)
        model = band_models.fit_forest(split.filter(~F.col("is_test")))
        band_models.save_model(model, path)
        scored = band_models.score_forest(model, split.filter("is_test"))
        class_report(pair_counts(scored, "target", "predicted")).show(100, truncate=False)
    elif job == "tune":
        root, path, *size = rest
        rows = f"{path}-rows"
        sampled = band_features.sampled_features(
            Warehouse(spark, root).table("stg_certificates"), int(size[0]) if size else band_features.SAMPLE_ROWS
        )
        band_features.split_features(sampled).write.mode("overwrite").parquet(rows)
        about = band_models.tune(spark.read.parquet(rows), path, band_features.TUNE_ROWS, TRIALS)
        print(f"accuracy {about['accuracy']:.4f}, macro F1 {about['macro_f1']:.4f}: {about['parameters']}")
    else:
        path, source, out = rest
        scored = band_models.score(band_models.load_model(path), spark.read.parquet(source))
        scored.write.mode("overwrite").parquet(out)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
