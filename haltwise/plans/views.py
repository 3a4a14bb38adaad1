"""Join views: a base table with the extra columns of one extension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haltwise.schema import MANY_PER_KEY, OWNER, TABLES, VIEWS


def view(
    name: str, base: DataFrame, extension: DataFrame, hashed: bool = False
) -> DataFrame:
    """The view as a DataFrame: every base row, extension columns where keys match.

    Where both sides have the name of the journey, as saved tables do, they meet by
    it, so that calls without a dated journey are found too. `hashed` says that a task can hold its
    share of the extension, or of the base where the extension has many rows to one of the base:
    then that side is looked up, and neither side is sorted.
    """
    spec = VIEWS[name]
    extra = TABLES[spec.extension].extra_columns
    keys = list(spec.keys)
    if OWNER in base.columns and OWNER in extension.columns:
        keys = [OWNER if k == "DVJId" else k for k in keys]
    columns = [c for c in base.columns if c != OWNER]
    found = extension.select(*keys, *extra)
    if hashed and spec.extension in MANY_PER_KEY:
        base = base.hint("shuffle_hash")
    elif hashed:
        found = found.hint("shuffle_hash")
    return base.join(found, keys, "left").select(*columns, *extra)


def view_sql(name: str, prefix: str = "") -> str:
    """DDL of the view over saved tables, `prefix` being e.g. `catalog.schema.`."""
    spec = VIEWS[name]
    extra = "".join(f", e.`{c}`" for c in TABLES[spec.extension].extra_columns)
    on = " AND ".join(f"b.`{k}` = e.`{k}`" for k in spec.keys)
    return (
        f"CREATE OR REPLACE VIEW {prefix}{name} AS SELECT b.*{extra} "
        f"FROM {prefix}{spec.base} AS b LEFT JOIN {prefix}{spec.extension} AS e ON {on}"
    )


def create_views(
    spark: SparkSession, prefix: str = "", names: list[str] | None = None
) -> list[str]:
    """Create or replace the catalog views; returns the ones made."""
    made = []
    for name in names or list(VIEWS):
        spec = VIEWS[name]
        have = (spark.catalog.tableExists(f"{prefix}{t}") for t in (spec.base, spec.extension))
        if all(have):
            spark.sql(view_sql(name, prefix))
            made.append(name)
    return made


def temp_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Register every view whose two tables are given, under its own name."""
    out = {}
    for name, spec in VIEWS.items():
        if spec.base in tables and spec.extension in tables:
            out[name] = view(name, tables[spec.base], tables[spec.extension])
            out[name].createOrReplaceTempView(name)
    return out
