"""Checks of staged and published tables; every check is a row of a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haltwise import schema as s

# fixed values
MIN_FILLED = (
    ("journey", "DVJId", 0.90),
    ("journey", "OperatingDate", 1.0),
    ("journey_call", "SequenceNumber", 1.0),
    ("journey_call", "DVJId", 0.90),
)
MAX_UNRESOLVED = 0.10
DATED = ("journey", "journey_call")


class PrepError(ValueError):
    """Staged rows that must not reach the tables."""


def _result(name, level, verdict, metric, threshold, details) -> Column:
    def col(v, kind):
        return (v if isinstance(v, Column) else F.lit(v)).cast(kind)

    return F.struct(
        col(name, "string").alias("check_name"),
        col(level, "int").alias("check_level"),
        col(verdict, "string").alias("result"),
        col(metric, "double").alias("metric_value"),
        col(threshold, "double").alias("threshold"),
        col(details, "string").alias("details"),
    )


def _rows(df: DataFrame, results: list[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*results)))


def missing_columns(columns: dict[str, Sequence[str]]) -> list[str]:
    """P3: what staged frames lack, by their columns before they are fitted to the schema."""
    out = []
    for what, ddl in (("journeys", s.STAGED_JOURNEY), ("calls", s.STAGED_CALL)):
        lacks = sorted(set(s.struct(ddl).names) - set(columns[what]))
        if lacks:
            out.append(f"P3: {what} lack {', '.join(lacks)}")
    return out


def staging_problems(
    journeys: DataFrame,
    calls: DataFrame,
    max_unresolved: float = MAX_UNRESOLVED,
    columns: dict[str, Sequence[str]] | None = None,
) -> list[str]:
    """What is wrong with staged rows. `columns` are those the frames had before they were
    saved under the staging schema, which fills in what is missing."""
    given = columns or {"journeys": journeys.columns, "calls": calls.columns}
    failed = staging_report(journeys, calls, max_unresolved).filter("result = 'FAIL'").collect()
    return missing_columns(given) + [
        f"{r['check_name']}: {r['details']} ({r['metric_value']:g}, limit {r['threshold']:g})"
        for r in failed
    ]


def require_sound_staging(
    journeys: DataFrame,
    calls: DataFrame,
    max_unresolved: float = MAX_UNRESOLVED,
    columns: dict[str, Sequence[str]] | None = None,
) -> None:
    problems = staging_problems(journeys, calls, max_unresolved, columns)
    if problems:
        raise PrepError("; ".join(problems))


def staging_report(
    journeys: DataFrame, calls: DataFrame, max_unresolved: float = MAX_UNRESOLVED
) -> DataFrame:
    """P1, P2, P4 and P5 of staged rows as check rows: one pass over each frame."""
    n = F.col("n")
    share = F.when(n > 0, F.round(F.col("no_id") / n, 4))
    j = journeys.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("DVJId").isNull()).alias("no_id"),
        F.count_if(F.col("OperatingDate").isNull()).alias("no_date"),
    )

    def ok(test: Column) -> Column:
        return F.when(test, "PASS").otherwise("FAIL")

    return _rows(
        j,
        [
            _result("P1", 0, ok(n > 0), n, 1, "journeys"),
            _result("P4", 0, ok(F.coalesce(F.col("no_id") / n, F.lit(0.0)) <= max_unresolved), share,
                    max_unresolved, "journeys without DVJId"),
            _result("P5", 0, ok(F.col("no_date") == 0), F.col("no_date"), 0,
                    "journeys without OperatingDate"),
        ],
    ).unionByName(
        _rows(
            calls.agg(F.count(F.lit(1)).alias("n")),
            [_result("P2", 0, ok(n > 0), n, 1, "calls")],
        )
    )


def table_checks(spark: SparkSession, tables: dict[str, DataFrame], names: list[str]) -> DataFrame:
    """Level 1 on structure: which tables are there, and with enough columns.

    One row per registered table, joined in its parts to what was found; tables that need
    position reports may be missing without failing the run.
    """
    registry = spark.createDataFrame(
        [
            (n, s.TABLES[n].group == "base", len(s.TABLES[n].columns), len(tables[n].columns) if n in tables else None)
            for n in names
        ],
        "name string, core boolean, want int, have int",
    )
    have, want = F.col("have"), F.col("want")
    each = registry.select(
        F.when(
            have.isNull(),
            _result(
                F.concat(F.lit("table_exists_"), "name"),
                1,
                F.when(F.col("core"), "FAIL").otherwise("WARN"),
                0,
                1,
                F.concat("name", F.lit(" has not been saved")),
            ),
        )
        .otherwise(
            _result(
                F.concat(F.lit("column_count_"), "name"),
                1,
                F.when(have >= want, "PASS").otherwise("WARN"),
                have,
                want,
                F.concat(F.lit("columns found: "), have),
            )
        )
        .alias("r")
    ).select("r.*")
    found = registry.agg(
        F.count("have").alias("found"),
        F.count("*").alias("all"),
        F.count_if(F.col("core") & have.isNotNull()).alias("core_found"),
        F.count_if("core").alias("core"),
    )
    total = _rows(
        found,
        [
            _result(
                "tables_exist_count",
                1,
                F.when(F.col("core_found") == F.col("core"), "PASS").otherwise("FAIL"),
                F.col("found"),
                F.col("all"),
                F.concat(F.lit("core tables found: "), "core_found", F.lit(" of "), "core"),
            )
        ],
    )
    return each.unionByName(total)


def content_checks(
    table: str, df: DataFrame, operating_date, unkeyed: DataFrame | None = None
) -> DataFrame:
    """Filled columns, rows for the date and unique keys of one table.

    Counts come from one pass, duplicate keys from one aggregation on the key.
    `unkeyed` are rows kept aside for lack of a key; they count as unfilled.
    """
    whole = df if unkeyed is None else df.unionByName(unkeyed, allowMissingColumns=True)
    on_day = F.col("OperatingDate") == F.lit(operating_date).cast("date")
    filled = [(c, limit) for t, c, limit in MIN_FILLED if t == table]
    counts = whole.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(on_day).alias("on_day"),
        *(F.count(c).alias(f"has_{c}") for c, _ in filled),
    )
    n, day = F.col("n"), F.col("on_day")
    results = []
    for c, limit in filled:
        rate = F.col(f"has_{c}") / n
        results.append(
            F.when(
                n > 0,
                _result(
                    f"not_null_{table}_{c}",
                    1,
                    F.when(rate >= limit, "PASS").otherwise("FAIL"),
                    F.round(rate, 4),
                    limit,
                    F.concat(F.col(f"has_{c}"), F.lit(" of "), n),
                ),
            )
        )
    results.append(
        _result(
            f"row_count_{table}",
            2,
            F.when(day > 0, "PASS").otherwise("FAIL"),
            day,
            1,
            F.concat(day, F.lit(f" rows for {operating_date}")),
        )
    )
    first = _rows(counts, results).filter("check_name IS NOT NULL")
    keys = list(s.TABLES[table].keys)
    if s.OWNER in df.columns:  # tells journeys apart that have no DVJId
        keys = [s.OWNER if k == "DVJId" else k for k in keys]
    doubled = (
        df.filter(on_day)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("k"))
        .agg(F.sum("k").alias("n"), F.sum(F.col("k") - 1).alias("extra"))
    )
    unique = _rows(
        doubled,
        [
            _result(
                f"uniqueness_{table}",
                3,
                F.when(F.col("extra") == 0, "PASS").otherwise("FAIL"),
                F.col("extra"),
                0,
                F.concat(F.col("extra"), F.lit(" rows repeat a key")),
            )
        ],
    ).filter("metric_value IS NOT NULL")
    return first.unionByName(unique)


def run_checks(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    operating_date,
    scope: str = "all",
    unkeyed: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """All checks of a scope as one DataFrame."""
    names = s.tables_in(scope)
    parts = [table_checks(spark, tables, names)]
    for t in DATED:
        if t in names and t in tables:
            parts.append(content_checks(t, tables[t], operating_date, (unkeyed or {}).get(t)))
    return reduce(DataFrame.unionByName, parts)


def tally(results: DataFrame) -> DataFrame:
    return results.groupBy("result").agg(F.count(F.lit(1)).alias("checks"))


class QualityError(RuntimeError):
    """At least one check failed."""


def keep(store, results: DataFrame) -> DataFrame:
    """Save the results of a run."""
    store.append(results.withColumn("run_timestamp", F.current_timestamp()), "quality_results")
    return results


def gate(store, results: DataFrame) -> DataFrame:
    """Save the results of a run, then fail if any check failed."""
    keep(store, results)
    failed = results.filter("result = 'FAIL'").select("check_name")
    names = [r[0] for r in failed.collect()]
    if names:
        raise QualityError(f"failed checks: {', '.join(sorted(names))}")
    return results
