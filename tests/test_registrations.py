"""The ready-made rules on a small table with the full 29-column schema."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.drift import tag_sources
from tallyframe.operators.split import make_split
from tallyframe.plans import adversarial, prepare, registrations
from tallyframe.plans.benchmark import encode_pair


@pytest.fixture(scope="module")
def rows(spark):
    """A few hundred rows in which countries and agents fall on both sides of the 300-row threshold."""
    schema = T.StructType.fromDDL(registrations.SCHEMA)
    out = []
    for i in range(900):
        row = {
            f.name: ("Blu#e" if i % 2 else "blue") if isinstance(f.dataType, T.StringType)
            else float(i % 4) if isinstance(f.dataType, T.DoubleType) else i % 3
            for f in schema.fields
        }
        day = datetime.date(2015, 7, 1) + datetime.timedelta(days=i % 400)
        row |= {
            "Client_ID": i, "Dropped_Course": int(i % 5 < 2), "Course_Start_Date": day.isoformat(),
            "Origin_Country": ["PRT", "cn", "CHN"][i % 3] if i % 50 else "Fra", "Agent_ID": None if i % 4 == 0 else 9.0 if i % 4 < 3 else float(i),
            "Company_ID": 7.0 if i % 20 == 0 else None, "Practical_Hours": 10_000 if i == 5 else i % 3,
            "Students_Count": None if i == 7 else float(i % 4), "Requested_Lab_Config": "Mac OS" if i % 2 else None,
            "Assigned_Lab_Config": "mac os!",
        }
        out.append(tuple(row[f.name] for f in schema.fields))
    return spark.createDataFrame(out, schema).cache()


def test_roles(rows):
    spec = registrations.registration_spec(rows)
    assert len(rows.columns) == 29
    assert (len(spec.nums), len(spec.cats), len(spec.id_like)) == (15 - 1, 10, 2)


def test_chain_leaves_the_expected_columns(rows):
    spec = registrations.registration_spec(rows)
    out = prepare.prepare_from(rows, rows, spec, registrations.RULES)
    assert set(out.columns) == {
        "Client_ID", "Professionals_Count", "Students_Count", "Observers_Count", "Practical_Hours", "Theory_Hours",
        "Registration_Days_Before", "Origin_Country", "Catering_Package", "Prev_Course_Dropouts", "Prev_Course_Attended",
        "Pre_Course_Supports_Tickets", "Physical_Course_Kits", "Waiting_List_Days", "Registration_Changes",
        "Enrollment_Type", "Client_Category", "Submission_Source", "Agent_ID", "Payment_Terms", "Daily_Tuition_Cost",
        "Dropped_Course", "has_company_id", "Registration_Days_Before_missing", "Physical_Course_Kits_missing",
        "Daily_Tuition_Cost_missing", "Requested_Lab_Config_missing", "Payment_Terms_missing", "received_requested_lab",
    }
    assert {r[0] for r in out.select("Origin_Country").distinct().collect()} == {"chn", "other"}
    assert {r[0] for r in out.select("Agent_ID").distinct().collect()} == {"9", "missing", "other"}
    one = out.where("Client_ID = 5").first()
    assert (one["Practical_Hours"], one["received_requested_lab"]) == (8.0, 1)


def test_encoding_after_the_chain(rows):
    spec = registrations.registration_spec(rows)
    train, valid = make_split(rows, "random", spec.id, spec.target)
    fitted = prepare.fit_prepare(train, spec, registrations.RULES)
    encoder, a, b = encode_pair(prepare.prepare(train, fitted), prepare.prepare(valid, fitted), spec.id, spec.target, scale=True)
    assert a.first()["features"].size == len(encoder.names) and b.count() == 180


def test_source_preparation(rows):
    test = rows.drop("Dropped_Course").withColumn("Client_ID", F.col("Client_ID") + 10_000)
    prepared = adversarial.prepare_sources(tag_sources(rows, test), "Client_ID", registrations.SOURCE_LEAKS)
    assert "Course_Start_Date" not in prepared.columns and prepared.where("is_test = 1").count() == 900
    assert prepared.where("Students_Count is null or Requested_Lab_Config is null").count() == 0


def test_calendar_preparation(rows):
    out = prepare.prepare_calendar(rows, "Course_Start_Date", registrations.CALENDAR_FLAGS, {"Company_ID": "has_company_id"})
    assert len(out.columns) == 29 - 2 + 4 + 1 + 2
    assert out.where("Client_ID = 0").first()["Course_Start_Date_weekday"] == 2
