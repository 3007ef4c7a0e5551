"""Ready-made roles and rules for the labelled course-registration table.

Everything here is data for the generic operators; a different table needs its own spec and rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyframe.plans.prepare import PrepareRules
from tallyframe.spec import TableSpec

# Column names and types of the table, in file order.
SCHEMA = """
Client_ID bigint, Professionals_Count bigint, Students_Count double, Observers_Count bigint,
Course_Start_Date string, Practical_Hours bigint, Theory_Hours bigint, Registration_Days_Before double,
Origin_Country string, Catering_Package string, Welcome_Gift_Type string, Requested_Lab_Config string,
Assigned_Lab_Config string, Prev_Course_Dropouts bigint, Prev_Course_Attended bigint,
Pre_Course_Supports_Tickets bigint, Physical_Course_Kits double, Waiting_List_Days bigint,
Registration_Changes bigint, Enrollment_Type string, Lanyard_Color string, Client_Category string,
Submission_Source string, Returning_Client bigint, Agent_ID double, Company_ID double, Payment_Terms string,
Daily_Tuition_Cost double, Dropped_Course int
"""

ID, TARGET, DATE = "Client_ID", "Dropped_Course", "Course_Start_Date"
ID_LIKE = ("Agent_ID", "Company_ID")

# Flags, thresholds, aliases, dropped columns and caps of the preparation chain.
RULES = PrepareRules(
    presence={"Company_ID": "has_company_id"},
    missing_flags=(
        "Agent_ID", "Registration_Days_Before", "Physical_Course_Kits", "Daily_Tuition_Cost",
        "Requested_Lab_Config", "Payment_Terms",
    ),
    min_counts={"Agent_ID": 300, "Origin_Country": 300},
    aliases={"Origin_Country": {"cn": "chn"}},
    drop_reduced=("Company_ID", "Agent_ID_missing"),
    match=("received_requested_lab", "Requested_Lab_Config", "Assigned_Lab_Config"),
    drop_features=(
        "Assigned_Lab_Config", "Lanyard_Color", "Requested_Lab_Config", "Returning_Client", "Welcome_Gift_Type",
    ),
    caps={"Students_Count": (None, 3), "Practical_Hours": (0, 8), "Daily_Tuition_Cost": (None, 500)},
)

# Columns that reveal which file a row came from.
SOURCE_LEAKS = (TARGET, DATE)

# Flags of the earlier preparation.
CALENDAR_FLAGS = ("Agent_ID", "Registration_Days_Before", "Requested_Lab_Config", "Physical_Course_Kits")


def registration_spec(df: DataFrame) -> TableSpec:
    return TableSpec.infer(df, id=ID, target=TARGET, date=DATE, id_like=ID_LIKE)
