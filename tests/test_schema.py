"""Registry contract and conforming frames to it."""

from haltwise import schema as s
from haltwise.plans.views import create_views, temp_views, view_sql


def test_tables():
    assert len(s.TABLES) == 22 and len(s.VIEWS) == 14
    assert len(s.TABLES["journey"].columns) == 36
    assert len(s.TABLES["journey_call"].columns) == 67
    assert s.TABLES["journey_call"].columns[:36] == s.TABLES["journey"].columns
    assert s.TABLES["journey"].keys == ("DVJId", "OperatingDate")
    assert s.TABLES["journey_call_delay"].parent == "journey_call"
    assert [len(s.tables_in(g)) for g in ("base", "gps", "all")] == [16, 6, 22]
    for spec in s.TABLES.values():
        assert len(set(spec.columns)) == len(spec.columns)
        assert spec.kind == "independent" or set(spec.keys) <= set(spec.columns)
        assert "OperatingDate" in spec.storage_keys


def test_views_repeat_no_column():
    for v in s.VIEWS.values():
        base, extra = s.TABLES[v.base].columns, s.TABLES[v.extension].extra_columns
        assert not set(base) & set(extra), v.name


def test_view_ddl():
    sql = view_sql("v_journey_start_delay", "main.silver.")
    assert sql.startswith("CREATE OR REPLACE VIEW main.silver.v_journey_start_delay AS SELECT b.*")
    assert "LEFT JOIN main.silver.journey_start_delay AS e" in sql
    assert "b.`DVJId` = e.`DVJId` AND b.`OperatingDate` = e.`OperatingDate`" in sql


def test_conform_fills_with_typed_nulls(spark):
    df = spark.createDataFrame([("7", "x")], "OnboardCount string, junk string")
    out = s.publish(df, "journey_call_apc")
    assert out.schema == s.TABLES["journey_call_apc"].schema
    assert out.first()["OnboardCount"] == 7


def test_timestamps_become_contract_text(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-10 12:00:05' ObservedArrivalDateTime, "
        "timestamp'2024-01-10 12:00:00' TimetabledLatestArrivalDateTime"
    )
    row = s.publish(df, "journey_call").first()
    assert row["ObservedArrivalDateTime"] == "2024-01-10T12:00:05+00:00"
    assert row["TimetabledLatestArrivalDateTime"] == "2024-01-10 12:00:00"


def test_catalog_views(spark, rows):
    j = spark.createDataFrame([("a", "bus 1"), ("b", None)], "DVJId string, VehicleNumber string")
    j = j.selectExpr("*", "date'2024-01-10' AS OperatingDate")
    gone = j.filter("DVJId = 'a'").selectExpr("*", "'Cancelled' AS ReasonTypeName")
    tables = {"journey": s.publish(j, "journey"), "journey_missing": s.publish(gone, "journey_missing")}
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(f"default.{name}")
    assert create_views(spark, "default.") == ["v_journey_missing"]
    saved = spark.table("default.v_journey_missing")
    assert saved.columns == s.TABLES["journey"].columns + ["ReasonTypeName"]
    assert rows(saved, "DVJId", "ReasonTypeName") == [("a", "Cancelled"), ("b", None)]
    assert rows(temp_views(tables)["v_journey_missing"]) == rows(saved)
