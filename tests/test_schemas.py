from pyspark.sql.types import DateType, DoubleType, StringType, TimestampType

from meterlake.sources.schemas import MASTERS, event_schema


def test_seven_masters_with_their_files(spark):
    assert sorted(MASTERS) == [
        "billing_monthly", "customers_orgs", "marketing_touches", "nps_surveys",
        "resources", "support_tickets", "users",
    ]
    assert all(m.filename == f"{name}.csv" for name, m in MASTERS.items())


def test_keys_are_columns(spark):
    for master in MASTERS.values():
        assert set(master.keys) <= set(master.schema.names)
    assert MASTERS["nps_surveys"].keys == ("org_id", "survey_date")


def test_types_are_explicit(spark):
    billing = MASTERS["billing_monthly"].schema
    assert isinstance(billing["month"].dataType, DateType)
    assert isinstance(billing["exchange_rate_to_usd"].dataType, DoubleType)
    assert isinstance(MASTERS["marketing_touches"].schema["timestamp"].dataType, DateType)
    assert isinstance(MASTERS["resources"].schema["tags_json"].dataType, StringType)


def test_event_schema_covers_both_versions(spark):
    schema = event_schema()
    assert len(schema) == 13
    assert isinstance(schema["timestamp"].dataType, TimestampType)
    assert isinstance(schema["value"].dataType, DoubleType)
    assert schema["genai_tokens"].dataType.simpleString() == "bigint"
    assert all(schema[c].nullable for c in ("carbon_kg", "genai_tokens"))
