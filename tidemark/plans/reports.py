"""Run-time and benchmark reports, benchmark configurations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import name, names
from tidemark.operators.joins import exclude_listed, grid, insert_select_where_new, left_join_counts

# Cost units per hour of a warehouse size.
WAREHOUSE_UNITS = {
    "2x-small": 4, "x-small": 6, "small": 12, "medium": 24, "large": 40, "x-large": 80,
}


def run_stats(runs: DataFrame, by: Sequence[str | Column], minutes: Column) -> DataFrame:
    """Longest, shortest and average run and the number of runs per group."""
    groups = [name(b) if isinstance(b, str) else b for b in by]
    return runs.groupBy(*groups).agg(
        F.max(minutes).alias("max_exec_min"),
        F.min(minutes).alias("min_exec_min"),
        F.avg(minutes).alias("avg_exec_min"),
        F.count(F.lit(1)).alias("n_exec"),
    )


def run_type(label: str, marker: str = "run") -> Column:
    """Seven characters around ``marker`` in a run label: ``1st run`` of ``.. 1st run. ..``."""
    found = F.locate(marker, name(label), 4)
    return F.substring(name(label), found - F.lit(4), F.lit(7))


def run_report(runs: DataFrame, invocations: DataFrame, pattern: str = "%Test performance%") -> DataFrame:
    """Run statistics in minutes per run type and model of successful, matching runs."""
    base = (
        runs.where(F.col("status") == "success")
        .join(invocations.where(F.col("invocation_vars").like(pattern)), ["invocation_id"], "inner")
    )
    return run_stats(base, [run_type("invocation_vars").alias("run_type"), "name"], F.col("execution_time") / F.lit(60))


def avg_success(
    runs: DataFrame, by: Sequence[str], duration: str = "duration", status: str = "status", ok: object = "SUCCESS"
) -> DataFrame:
    """Average duration and number of successful runs per group."""
    return runs.where(name(status) == F.lit(ok)).groupBy(*names(by)).agg(
        F.avg(name(duration).cast("double")).alias("avg_duration"), F.count(F.lit(1)).alias("nr_of_runs")
    )


def conditional_pivot(
    df: DataFrame, by: Sequence[str], pivot: str, value: str, columns: Mapping[object, str], *extra: Column
) -> DataFrame:
    """One column per listed pivot value with the average of ``value``, in one aggregation."""
    cells = [
        F.avg(F.when(name(pivot) == F.lit(p), name(value))).alias(out) for p, out in columns.items()
    ]
    return df.groupBy(*names(by)).agg(*extra, *cells)


def collect_label(column: Column, separator: str = " / ") -> Column:
    """Distinct values of a group as one sorted text."""
    return F.array_join(F.array_sort(F.collect_set(column)), separator)


def cost_units(tech: Column, size: Column, workers: Column, photon: Column) -> Column:
    """Cost units of a configuration: by warehouse size, or by workers of a pipeline."""
    pairs = [F.lit(x) for item in WAREHOUSE_UNITS.items() for x in item]
    by_size = F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(size)), F.lit(0))
    return F.when(
        F.lower(tech) == "dlt", (workers + F.lit(1)) * F.when(photon, F.lit(5)).otherwise(F.lit(1))
    ).otherwise(by_size)


def benchmark_detail(use_cases: DataFrame, configs: DataFrame, log: DataFrame) -> DataFrame:
    """Log rows with technology, label and cost units of their configuration."""
    serverless, photon = F.col("dbt_sql_serverless").cast("boolean"), F.col("dlt_photon").cast("boolean")
    pipeline = F.col("run_type") == "DLT"
    size = F.lower("dbt_sql_cluster_size")
    cases = use_cases.select(F.col("id").alias("use_case_id"), "use_case")
    known = configs.withColumnRenamed("id", "config_id").join(cases, ["use_case_id"], "inner")
    described = known.select(
        "use_case",
        "config_id",
        F.lower("run_type").alias("tech"),
        F.when(pipeline, F.concat(F.lower("run_type"), F.when(photon, "-photon").otherwise("-no-photon")))
        .otherwise(F.concat(F.lower("run_type"), F.when(serverless, "-serverless").otherwise("-server-based")))
        .alias("subtech"),
        F.coalesce(size, F.lit("")).alias("dbt_sql_cluster_size"),
        F.when(
            pipeline,
            F.concat(
                F.col("dlt_nr_of_workers").cast("string"),
                F.when(photon, " worker(s) (photon)").otherwise(" worker(s) (no photon)"),
            ),
        )
        .otherwise(F.concat(size, F.when(serverless, " (serverless)").otherwise(" (server-based)")))
        .alias("config"),
        cost_units(F.col("run_type"), size, F.col("dlt_nr_of_workers"), photon).alias("dbu"),
    )
    runs = log.select(
        F.col("benchmark_run_config_id").alias("config_id"), "start_time", "end_time", "duration", "status"
    )
    return runs.join(described, ["config_id"], "inner")


def benchmark_report(
    use_cases: DataFrame,
    configs: DataFrame,
    log: DataFrame,
    same_use_case: Mapping[str, str] | None = None,
    left_out: Column | None = None,
) -> DataFrame:
    """Average duration per use case and cost unit, one column per technology.

    ``same_use_case`` reports a use case under another name, ``left_out`` is a condition on
    ``use_case`` and ``run_type`` for configurations not to report.
    """
    cases = use_cases
    if left_out is not None:
        pairs = configs.join(
            use_cases.select(F.col("id").alias("use_case_id"), "use_case"), ["use_case_id"], "inner"
        )
        configs = pairs.where(~F.coalesce(left_out, F.lit(False))).drop("use_case")
    if same_use_case:
        from tidemark.functions.keys import case_map

        cases = cases.withColumn("use_case", case_map(F.col("use_case"), same_use_case, F.col("use_case")))
    groups = ["use_case", "tech", "subtech", "dbt_sql_cluster_size", "config_id", "config", "dbu"]
    averages = avg_success(benchmark_detail(cases, configs, log), groups)
    label = F.when(F.col("tech") == "dlt", F.col("config")).otherwise(F.col("dbt_sql_cluster_size"))
    return conditional_pivot(
        averages, ["use_case", "dbu"], "subtech", "avg_duration",
        {
            "dbt-server-based": "dbt_server_based",
            "dbt-serverless": "dbt_serverless",
            "dlt-no-photon": "dlt_no_photon",
            "dlt-photon": "dlt_photon",
        },
        collect_label(label).alias("config"),
    )


def benchmark_grid(
    use_cases: DataFrame,
    dimensions: Mapping[str, Sequence[object]],
    excluded: Mapping[object, Sequence[str]] | None = None,
    excluded_dimension: str | None = None,
    use_case: str = "use_case",
    constants: Mapping[str, object] | None = None,
    existing: DataFrame | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Every use case with every combination of settings, minus the exclusions.

    ``excluded`` lists, per value of ``excluded_dimension``, the use cases it is not run
    for. With ``existing`` only configurations whose ``keys`` are new come out.
    """
    configs = grid(use_cases, dict(dimensions))
    if excluded and excluded_dimension:
        listing = None
        for value, cases in excluded.items():
            array = F.array(*[F.lit(c) for c in cases]).cast("array<string>")
            hit = name(excluded_dimension) == F.lit(value)
            listing = F.when(hit, array) if listing is None else listing.when(hit, array)
        configs = configs.withColumn("__excluded", listing.otherwise(F.array().cast("array<string>")))
        configs = exclude_listed(configs, use_case, "__excluded").drop("__excluded")
    configs = configs.withColumns({c: F.lit(v) for c, v in (constants or {}).items()})
    return configs if existing is None else insert_select_where_new(existing, configs, keys)


def benchmark_todo(configs: DataFrame, log: DataFrame, ok: str = "SUCCESS") -> DataFrame:
    """Configurations with successful runs still to do, and how many."""
    done = log.where(F.col("status") == F.lit(ok))
    return left_join_counts(configs, done, "id", "benchmark_run_config_id")

