"""Every named query, bound to the stored tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.ml import checks, models, ranking, scoring, tuning, vectors
from tallyworks.operators import splits
from tallyworks.operators.words import word_count
from tallyworks.plans import ad_features, ads, arithmetic, passengers, sketches, staff, taxi
from tallyworks.sources import files, integers, tables
from tallyworks.sources.workspace import new_folder, written

Query = Callable[[SparkSession, str], DataFrame]

def over(plan: Callable[..., DataFrame], *sources, **options) -> Query:
    """The plan applied to views, or to stored tables given by name."""

    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        frames = [
            tables.stored(spark, data_dir, source) if isinstance(source, str) else source(spark, data_dir)
            for source in sources
        ]
        return plan(*frames, **options)

    return run


def order_keys(spark: SparkSession, data_dir: str) -> DataFrame:
    return integers.keys(tables.stored(spark, data_dir, "orders"), "o_orderkey")


def matching(condition: str) -> Query:
    return over(lambda employee: staff.count_matching(employee, F.expr(condition)), tables.employee)


def ctr_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    return ad_features.ad_features(tables.ads_data(spark, data_dir))


def ctr_files(spark: SparkSession, data_dir: str) -> dict[str, str]:
    return ad_features.training_files(tables.ads_data(spark, data_dir))


def ctr_parts(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    """Labelled train and test rows from the files of the feature job."""
    paths = ctr_files(spark, data_dir)
    train, test = (vectors.labelled(spark.read.parquet(paths[name])) for name in ("train", "test"))
    return train, test


def ctr_regression(family: str) -> Query:
    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        train, test = ctr_parts(spark, data_dir)
        return models.ctr_check(train, test, family, vectors.middle_columns(train))

    return run


def compare_regressors(spark: SparkSession, data_dir: str) -> DataFrame:
    train, test = ctr_parts(spark, data_dir)
    return models.compare_check(train, test, vectors.middle_columns(train))


def train_test_split(spark: SparkSession, data_dir: str) -> DataFrame:
    """The feature job, then a check of its two outputs against the ads of the events."""
    events = tables.ads_data(spark, data_dir)
    paths = ad_features.training_files(events)
    parts = {name: spark.read.parquet(path) for name, path in paths.items()}
    return splits.split_report(events.select("ad_id").distinct(), parts, ad_features.SHARES, "ad_id")


def seeded_split(spark: SparkSession, data_dir: str) -> DataFrame:
    """80/20 and 70/30 splits of the passengers, checked for loss, overlap and size."""
    rows = written(tables.passengers(spark, data_dir).select("PassengerId"), "passengers")
    reports = []
    for name, large in (("80/20", 0.8), ("70/30", 0.7)):
        shares = {"train": large, "test": 1 - large}
        parts = splits.seeded_parts(rows, shares, tuning.SEED)
        report = splits.split_report(rows, parts, shares, "PassengerId")
        reports.append(report.select(F.lit(name).alias("split"), "*"))
    return reports[0].unionByName(reports[1])


def hash_split(spark: SparkSession, data_dir: str) -> DataFrame:
    keyed = tables.ads_data(spark, data_dir).select("ad_id").distinct()
    return splits.hash_split(keyed, "ad_id")


def ctr_search_check(settings: dict[str, dict] | None = None) -> Query:
    """All families in one search over the full grid: labelled training and test rows, number of settings, and
    what is wrong with the choice."""

    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        train, test = ctr_parts(spark, data_dir)
        search = scoring.tune_jointly(train, settings, keep_models=True)
        faults = models.search_faults(search, train, train.columns, lambda s: checks.rmse_of(s, "ctr"), False)
        rows = train.unionByName(test)
        return models.one_row(rows, F.count(F.lit(1)).alias("rows"), settings=len(search.validationMetrics), **faults)

    return run


def search_report(settings: dict[str, dict] | None = None) -> Query:
    """Every setting of the joint search, whether its metric is not that of its sub-model, and whether its rank, over
    all or in its family, is wrong."""

    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        train, _ = ctr_parts(spark, data_dir)
        search = scoring.tune_jointly(train, settings, keep_models=True)
        return ranking.report_faults(ranking.search_report(search, train, "ctr"))

    return run


def best_family(settings: dict[str, dict] | None = None) -> Query:
    """Each family tuned on its own over the full grid: its labelled test rows, whether the reported test error is not
    that of its stored model, whether that model is not fitted as it says, and whether the stored winner is not the
    family with the least test error."""

    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        paths, folder, winner = ctr_files(spark, data_dir), new_folder(spark, "families"), new_folder(spark, "best-family")
        results = scoring.fit_best_family(spark, paths["train"], paths["test"], winner, settings, families_path=folder)
        train, test = (vectors.labelled(spark.read.parquet(paths[name])) for name in ("train", "test"))
        return family_faults(results, folder, winner, train, test)

    return run


def family_faults(results: list, folder: str, winner: str, train: DataFrame, test: DataFrame) -> DataFrame:
    stored = [PipelineModel.load(f"{folder}/{r.family}") for r in results]
    swapped = ranking.wrong_winner(PipelineModel.load(winner), stored, test, "ctr")
    entries = [
        F.struct(
            F.lit(r.family).alias("family"),
            F.lit(not checks.close(r.test_rmse, error)).alias("wrong_rmse"),
            F.lit(ranking.pipeline_faults(model, train, "ctr")).cast("bigint").alias("wrong_fit"),
            F.lit(swapped).alias("wrong_winner"),
        )
        for r, model, error in zip(results, stored, ranking.errors_together(stored, test, "ctr"), strict=True)
    ]
    counted = train.unionByName(test).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select("rows", F.inline(F.array(*entries)))


def ctr_train_job(settings: dict[str, dict] | None = None) -> Query:
    """The training job over the full grid: labelled rows, whether the reported test error is not that of the stored
    model, what is wrong with its fit, and whether another setting's sub-model has a smaller validation error."""

    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        paths, model_path = ctr_files(spark, data_dir), new_folder(spark, "ctr-model")
        search, report = scoring.searched_ctr_model(
            spark, paths["train"], paths["test"], model_path, settings, keep_models=True
        )
        train, test = (vectors.labelled(spark.read.parquet(paths[name])) for name in ("train", "test"))
        return job_faults(search, report, model_path, train, test)

    return run


def job_faults(search, report: DataFrame, model_path: str, train: DataFrame, test: DataFrame) -> DataFrame:
    told, stored = report.first(), PipelineModel.load(model_path)
    settings = ranking.search_report(search, train, "ctr")
    least = settings.agg(F.min("recomputed")).first()[0]
    same = settings.where((F.col("family") == told.family) & (F.col("params") == told.params)).first()
    rows = train.unionByName(test)
    return models.one_row(
        rows,
        F.count(F.lit(1)).alias("rows"),
        wrong_rmse=not checks.close(told.test_rmse, checks.rmse_of(stored.transform(test), "ctr")),
        wrong_fit=ranking.pipeline_faults(stored, train, "ctr"),
        wrong_winner=same is None or not checks.close(same.recomputed, least, 1e-6) or not is_setting(stored, told.params),
    )


def is_setting(model: PipelineModel, params: str) -> bool:
    """The last stage has the parameters, given as "name=value, ..."."""
    last = model.stages[-1]
    pairs = [p.split("=") for p in params.split(", ")]
    return all(str(last.getOrDefault(name)) == value for name, value in pairs)


def score_check(features: DataFrame) -> DataFrame:
    """The scoring job: rows, predictions that are missing, and those that the model in memory does not make."""
    stored, expected = scoring.scored_ads(features)
    both = expected.select("ad_id", F.col("prediction").alias("_expected")).join(stored, "ad_id", "left")
    return both.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("prediction").isNull()).alias("missing"),
        F.count_if(checks.apart(F.col("prediction"), F.col("_expected"))).alias("differences"),
    )


def held_out_check(passenger_rows: DataFrame) -> DataFrame:
    """The stored pipeline on its held-out rows: their number, whether accuracy and error add up, and whether it
    predicts at random or worse than always saying the more frequent value by over a tenth."""
    row = scoring.held_out_accuracy(passenger_rows).first()
    shares = hash_parts_share(passenger_rows)
    return models.one_row(
        splits.hash_split(passenger_rows, "PassengerId", 80).where("part = 'test'"),
        F.count(F.lit(1)).alias("rows"),
        scored=row["rows"],
        wrong_error=not checks.close(row["accuracy"] + row["error"], 1.0),
        poor=row["accuracy"] < shares - 0.1,
    )


def hash_parts_share(passenger_rows: DataFrame) -> float:
    """Share of the more frequent outcome among the held-out passengers."""
    test = splits.hash_split(passenger_rows, "PassengerId", 80).where("part = 'test'")
    survived = test.agg(F.avg("Survived")).first()[0]
    return max(survived, 1 - survived)


SOURCES: dict[str, Query] = {
    "scan_parquet": over(staff.count_rows, "lineitem"),
    "csv_header_scan": over(lambda df: passengers.typed(files.csv_text_scan(df)), tables.passengers),
    "csv_infer_scan": over(files.csv_typed_scan, tables.passengers),
    "csv_roundtrip": over(files.csv_type_check, tables.trips),
    "csv_one_file": over(lambda df: files.one_file_csv(ads.platform_view_share(df)), tables.ads_data),
    "json_roundtrip": over(files.json_round_trip, tables.employee),
    "parquet_roundtrip": over(files.parquet_round_trip, tables.employee),
    "text_roundtrip": over(lambda df: integers.key_summary(files.text_round_trip(df, "id")), order_keys),
    "table_scan": over(staff.named_table, tables.employee),
    "sql_view_filter": over(staff.with_small_ids, tables.employee),
    "range_filter_sum": over(integers.filter_map_sum, order_keys),
    "union_count": over(integers.union_count, order_keys),
    "repartition_report": over(integers.repartition_summary, "orders"),
    "tuples_source": over(integers.status_names, "orders"),
    "pandas_batches": over(integers.through_pandas, tables.employee),
    "labelled_union": over(
        lambda df: vectors.labelled_union(df, (0, 1)).select("vec_id", "kind", F.size("embedding").alias("length")),
        "embeddings",
    ),
    "partition_count": over(files.partition_count, tables.ads_data, column="date"),
    "first_rows": over(staff.first_by_id, tables.employee),
    "column_profile": over(files.column_profile, tables.passengers),
}

STAFF: dict[str, Query] = {
    "project_cols": over(staff.columns, tables.employee),
    "concat_names": over(staff.full_names, tables.employee),
    "first_char": over(staff.first_characters, tables.employee),
    "row_count": over(staff.count_rows, tables.employee),
    "salary_summary": over(staff.salary_summary, tables.employee),
    "filter_gt": matching("salary > 910"),
    "filter_and": matching("salary > 910 and salary < 950"),
    "filter_or": matching("salary >= 950 or salary <= 910"),
    "filter_eq": matching("name = 'red'"),
    "filter_in": matching("name in ('red', 'blue', 'new')"),
    "filter_like": matching("name like 'b%'"),
    "filter_like_len": matching("name like 'b___'"),
    "filter_length": matching("length(name) = 4"),
    "count_by_name": over(staff.name_counts, tables.employee),
    "having_count": over(staff.frequent_names, tables.employee),
    "top3_names": over(staff.top_names, tables.employee),
    "office_company": over(staff.offices_with_company, tables.office, tables.company),
    "office_company_distinct": over(staff.office_countries, tables.office, tables.company),
    "above_avg_salary": over(staff.above_average, tables.employee),
}

ADS: dict[str, Query] = {
    "daily_stats": over(ads.daily_stats, tables.ads_data),
    "daily_event_mix": over(ads.daily_event_mix, tables.ads_data),
    "daily_revenue": over(ads.daily_revenue, tables.ads_data),
    "date_keys": over(ads.date_keys, tables.ads_data),
    "ad_day_stats": over(ads.ad_day_stats, tables.ads_data),
    "ads_active_on_day": over(ads.ads_active_on_day, tables.ads_data),
    "spike_ads_ranked": over(ads.spike_ads_ranked, tables.ads_data),
    "top5_ads_daily": over(ads.top_spike_ads_daily, tables.ads_data),
    "spike_diagnosis": over(ads.spike_diagnosis, tables.ads_data),
    "ad_peak_day": over(ads.ad_peak_day, tables.ads_data),
    "array_ops": over(ads.array_ops, tables.ads_data),
    "ctr_by_ad": over(ads.ctr_by_ad_sql, tables.ads_data),
    "top10_ctr": over(ads.top_ctr, tables.ads_data),
    "ctr_by_video": over(ads.ctr_by, tables.ads_data, key="has_video"),
    "ctr_median_avg": over(ads.ctr_median_and_mean, tables.ads_data),
    "ctr_p95": over(ads.ctr_quantile_on_day, tables.ads_data),
    "platform_view_share": over(ads.platform_view_share, tables.ads_data),
    "platform_sets": over(ads.platform_sets, tables.ads_data),
    "android_views": over(ads.platform_views, tables.ads_data),
    "mobile_views": over(ads.mobile_views, tables.ads_data),
    "distinct_platforms": over(ads.distinct_platforms, tables.ads_data),
    "max_platforms_per_ad": over(ads.max_platforms_per_ad, tables.ads_data),
    "clicked_never_viewed": over(ads.clicked_never_viewed, tables.ads_data),
    "orphan_click_platforms": over(ads.orphan_platforms, tables.ads_data),
    "orphan_click_platforms_all": over(ads.orphan_platforms_all, tables.ads_data),
    "click_first_ads": over(ads.click_first_ads, tables.ads_data),
    "approx_click_first": over(ads.click_first_ads_check, tables.ads_data),
    "daily_ads_sketches": over(sketches.daily_ads, tables.ads_data),
    "merged_ads_sketches": over(sketches.merged_days, tables.ads_data),
    "trailing_ads_sketches": over(sketches.trailing_ads, tables.ads_data),
    "late_click_count": over(ads.late_changes, tables.ads_data),
    "clients_without_ads": over(ads.clients_without_ads, tables.ads_clients_data, tables.ads_data),
    "never_active_share": over(ads.never_active_share, tables.ads_clients_data, tables.ads_data),
    "ad_gap_rows": over(ads.client_gap_rows, tables.ads_clients_data, tables.ads_data),
    "first_ad_gap": over(ads.first_ad_gap, tables.ads_clients_data, tables.ads_data),
    "cost_type_onehot": over(ad_features.cost_type_onehot, tables.ads_data),
    "rename_agg": over(ad_features.renamed_view_days, tables.ads_data),
    "view_days_per_ad": over(ad_features.view_days_per_ad, tables.ads_data),
    "ad_features": over(ad_features.ad_features, tables.ads_data),
    "ad_features_event_grain": over(ad_features.event_features, tables.ads_data),
    "ad_features_bucketed": over(ad_features.bucketed_event_features, tables.ads_data),
    "ad_features_two_joins": over(ad_features.event_features_two_tables, tables.ads_data),
}

TAXI: dict[str, Query] = {
    "miles_total_corr": over(taxi.miles_total_corr, tables.trips),
    "miles_total_cov": over(taxi.miles_total_cov, tables.trips),
    "describe_trips": over(taxi.describe, tables.trips),
    "describe_passengers": over(
        taxi.describe_mixed, tables.passengers, columns=("Sex", "Age", "Fare", "Embarked", "Pclass")
    ),
    "least_common_payment": over(taxi.least_common_payment, tables.trips),
    "busiest_taxi": over(taxi.busiest_taxi, tables.trips),
    "cash_avg": over(taxi.cash_average, tables.trips),
    "taxis_over_miles": over(taxi.taxis_over_miles, tables.trips),
    "longest_trip_miles": over(taxi.longest_trip_miles, tables.trips),
    "avg_taxi_income": over(taxi.average_income, tables.trips),
    "trips_by_hour": over(taxi.trips_by_hour, tables.trips),
    "trips_by_local_hour": over(taxi.trips_by_local_hour, tables.trips),
    "second_quarter_trips": over(taxi.second_quarter_trips, tables.trips),
    "top_tip_dates": over(taxi.top_tip_dates, tables.trips),
    "top_trip_dates": over(taxi.top_trip_dates, tables.trips),
    "top_car_brand": over(taxi.top_brands, tables.cars),
    "top_car_model_trips": over(taxi.top_models_by_trips, tables.trips, tables.cars),
    "taxi_active_span": over(taxi.active_span, tables.trips),
    "filter_not_null": over(taxi.known_taxi_trips, tables.trips),
}

PASSENGERS: dict[str, Query] = {
    "family_size": over(passengers.family_sizes, tables.passengers),
    "alone_flag": over(passengers.alone_flag, tables.passengers),
    "sex_flags": over(passengers.sex_flags, tables.passengers),
    "drop_cols": over(passengers.drop_text_columns, tables.passengers),
    "fill_constant": over(passengers.filled_ports, tables.passengers),
    "fill_mean": over(passengers.filled_ages, tables.passengers),
    "fill_mean_rounded": over(passengers.filled_ages, tables.passengers, rounded=True),
    "filter_null": over(passengers.missing_ages, tables.passengers),
    "distinct_sex": over(passengers.distinct_sex, tables.passengers),
    "survival_counts": over(passengers.survival_counts, tables.passengers),
    "clean_passengers": over(passengers.clean, tables.passengers),
    "passenger_features": over(passengers.features, tables.passengers),
    "category_index": over(passengers.category_index, tables.passengers),
}

FLOWS: dict[str, Query] = {
    "word_count": over(word_count, "documents", text="text"),
    "calc_chain": over(arithmetic.chain, "events"),
    "calc_fanout": over(arithmetic.fan_out, "events"),
    "train_test_split": train_test_split,
    "seeded_split": seeded_split,
    "hash_split": hash_split,
}

MODELS: dict[str, Query] = {
    "assemble_features": over(vectors.assembled, ctr_rows),
    "grid_sizes": over(lambda features: tuning.grid_sizes(vectors.labelled(features)), ctr_rows),
    "linreg_simple": over(models.price_line, "lineitem"),
    "linreg_fit": over(models.price_check, "lineitem"),
    "linreg_summary": over(models.price_summary, "lineitem"),
    "dt_reg": ctr_regression("dt"),
    "rf_reg": ctr_regression("rf"),
    "gbt_reg": ctr_regression("gbt"),
    "compare_regressors": compare_regressors,
    "logreg": over(models.survival_check, tables.passengers, name="logistic"),
    "dt_cls": over(models.survival_check, tables.passengers, name="tree"),
    "rf_cls": over(models.survival_check, tables.passengers, name="forest"),
    "gbt_cls": over(models.survival_check, tables.passengers, name="boosted"),
    "port_classifiers": over(models.port_check, tables.passengers),
    "kmeans_assign": over(models.cluster_check, "embeddings"),
    "kmeans_silhouette": over(models.silhouette_check, "embeddings"),
    "rmse_metric": over(models.rmse_of_prices, "lineitem"),
    "accuracy_metric": over(models.accuracy_of_class_rule, tables.passengers),
    "tvs_best": over(models.port_search_check, tables.passengers),
    "tune_all_families": ctr_search_check(),
    "tuning_report": search_report(),
    "best_family": best_family(),
    "ctr_train_job": ctr_train_job(),
    "model_roundtrip": over(scoring.model_round_trip, tables.passengers),
    "pipeline_held_out": over(held_out_check, tables.passengers),
    "score_ads": over(score_check, ctr_rows),
    "embedding_classifier": over(models.embedding_check, "embeddings"),
}

QUERIES: dict[str, Query] = SOURCES | STAFF | ADS | TAXI | PASSENGERS | FLOWS | MODELS
