"""Sources and sinks: CSV missing-value rules, JSON, typed records, errors."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from riskspark.sources import files, records
from riskspark.sources.incidents import incidents


def test_csv_missing_values(spark, scratch):
    path = f"{scratch}/in.csv"
    spark.createDataFrame(
        [("1", " NA ", "2020", "NaN"), ("2", "Spain", "2021", "3.5")],
        "incident_id string, country string, year string, financial_loss_million string",
    ).coalesce(1).write.option("header", True).csv(path)
    schema = "incident_id bigint, country string, year int, financial_loss_million double"
    from pyspark.sql import types as T
    out = files.read_incidents_csv(spark, path, T._parse_datatype_string(schema)) \
        .orderBy("incident_id").collect()
    assert out[0]["country"] is None and out[0]["financial_loss_million"] is None
    assert out[1]["country"] == "Spain" and out[1]["financial_loss_million"] == 3.5


def test_missing_file_is_reported(spark, scratch):
    with pytest.raises(AnalysisException):
        files.read_incidents_csv(spark, f"{scratch}/does-not-exist").count()


def test_documented_requests_as_typed_records(spark):
    reqs = [
        dict(country="Australia", year=2024, attack_type="DDoS", target_industry="Banking",
             financial_loss_million=50.0, affected_users=100000, attack_source="Hacker Group",
             vulnerability_type="Social Engineering", defense_mechanism="AI-based Detection"),
        dict(country="Malaysia", year=2020, attack_type="Ransomware",
             target_industry="Healthcare", financial_loss_million=80.0, affected_users=500000,
             attack_source="Insider", vulnerability_type="Weak Passwords",
             defense_mechanism="Firewall"),
    ]
    df = records.records_frame(spark, reqs)
    assert dict(df.dtypes)["year"] == "int" and dict(df.dtypes)["affected_users"] == "bigint"
    assert [r["loss_per_user"] for r in df.orderBy("incident_id").collect()] == [500.0, 160.0]


def test_json_roundtrip(spark, scratch):
    df = incidents(spark, "/root/testdata/sf0.001").where("affected_users IS NOT NULL")
    df = df.withColumn("loss_per_user", df.financial_loss_million * 1e6 / df.affected_users)
    path = files.write_json(df, f"{scratch}/json")
    back = files.read_incidents_json(spark, path)
    assert back.count() == df.count()
    assert back.exceptAll(df.select(*back.columns)).count() == 0


def test_incidents_view_shape(spark):
    df = incidents(spark, "/root/testdata/sf0.001")
    assert df.count() == 1500
    assert df.select("incident_id").distinct().count() == 1500
    years = list(df.selectExpr("min(year)", "max(year)").collect()[0])
    assert 2015 <= years[0] <= years[1] <= 2030


HEADER = ("year,country,attack_type,target_industry,financial_loss_million,affected_users,attack_source,"
          "vulnerability_type,defense_mechanism,resolution_time_hours,cluster_id,risk_profile,extra")


def test_csv_by_header_name(spark, tmp_path):
    path = tmp_path / "table.csv"
    path.write_text(HEADER + """
2020,"Say ""Hi"", Land",DDoS,Banking,1.5,10,Insider,Weak,Firewall,3.0,2,Widespread,x
2021.0,Peru,DDoS,Banking,abc,20.0,Insider,Weak,Firewall,4,,,y
""")
    rows = files.read_incidents_csv(spark, str(path), keep_corrupt=True).orderBy("year").collect()
    assert rows[0].country == 'Say "Hi", Land' and rows[0].loss_per_user == 150_000.0
    assert (rows[0].cluster_id, rows[0].risk_profile, rows[0].incident_id) == (2, "Widespread", None)
    assert (rows[1].year, rows[1].affected_users, rows[1].financial_loss_million) == (2021, 20, None)
    assert rows[0]._corrupt_record is None and rows[1]._corrupt_record == "financial_loss_million=abc"
    assert "_corrupt_record" not in files.read_incidents_csv(spark, str(path)).columns


def test_csv_line_ends_in_quotes(spark, tmp_path):
    path = tmp_path / "table.csv"
    path.write_text(HEADER + '\n2020,"New\nLand",DDoS,Banking,1.5,10,Insider,Weak,Firewall,3.0,2,W,x\n')
    assert files.read_incidents_csv(spark, str(path), multi_line=True).first().country == "New\nLand"


def test_csv_without_a_needed_column(spark, tmp_path):
    path = tmp_path / "table.csv"
    path.write_text("year,country\n2020,Peru\n")
    with pytest.raises(ValueError, match="attack_type"):
        files.read_incidents_csv(spark, str(path))


def test_json_numbers_as_the_service_takes_them(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text("""{"year": "2024", "affected_users": 100000.0, "financial_loss_million": "1.5", "country": ""}
{"year": 2024.5, "affected_users": "many", "country": "Peru"}
{"year": 20
""")
    rows = records.read_requests(spark, str(path)).collect()
    assert (rows[0].year, rows[0].affected_users, rows[0].financial_loss_million, rows[0].country) == (2024, 100000, 1.5, "")
    assert rows[0]._corrupt_record is None
    assert rows[1].year is None and rows[1]._corrupt_record == "year=2024.5, affected_users=many"
    assert rows[2]._corrupt_record.startswith('{"year": 20')
