"""Names and types of the staging table and of the eleven output tables."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Staging column names, all delivered as nullable strings.
STAGE_COLUMNS = (
    "camis",
    "dba",
    "boro",
    "building",
    "street",
    "zipcode",
    "bin",
    "bbl",
    "nta",
    "latitude",
    "longitude",
    "census_tract",
    "community_board",
    "council_district",
    "phone",
    "cuisine_description",
    "inspection_date",
    "action",
    "inspection_type",
    "grade",
    "grade_date",
    "score",
    "critical_flag",
    "violation_code",
    "violation_description",
    "record_date",
)

STAGE_SCHEMA = StructType([StructField(name, StringType(), True) for name in STAGE_COLUMNS])

# Fixed value: type of latitude and longitude.
COORDINATE = "decimal(38,12)"

# Audit columns carried by every output table.
AUDIT_COLUMNS = ("INGESTION_DATE", "INGESTION_TIME")

# Output table names.
FOOD_PLACES = "Dim_NYC_Food_Places"
CUISINE = "Dim_NYC_Cuisine"
BOROUGH = "Dim_NYC_Borough"
ADDRESSES = "Dim_NYC_Addresses"
CRITICAL_FLAG = "Dim_NYC_Critical_Flag"
GRADES = "Dim_NYC_Inspection_Grades"
INSPECTION_TYPE = "Dim_NYC_Inspection_Type"
ACTIONS = "Dim_NYC_Inspection_Actions"
VIOLATION_CODES = "Dim_NYC_Violation_Codes"
INSPECTIONS = "FCT_NYC_Food_Inspections"
VIOLATIONS = "FCT_NYC_FoodInspection_Violations"

# Output column orders (audit columns follow), spelled as readers expect them.
INSPECTION_COLUMNS = (
    "INSPECTION_SK",
    "INSCPECTION_DATE",
    "FOOD_PLACES_SK",
    "BOROUGH_SK",
    "ADDRESS_SK",
    "PHONE",
    "CUISINE_DESCRIPTION_SK",
)
VIOLATION_COLUMNS = (
    "INSPECTION_VIOLATION_SK",
    "INSPECTION_SK",
    "INSPECTION_TYPE_SK",
    "ACTION_SK",
    "CRITICAL_FLAG_SK",
    "SCORE",
    "GRADE_SK",
    "VIOLATION_CODE_SK",
    "ADDRESS_SK",
    "BOROUGH_SK",
    "CUISINE_DESCRIPTION_SK",
    "FOOD_PLACES_SK",
    "INSCPECTION_DATE",
    "PHONE",
    "ACTION",
    "GRADE_DATE",
)
