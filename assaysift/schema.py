"""Record layouts and the fixed output vocabulary."""

from __future__ import annotations

from pyspark.sql import types as T

VERSION = "0.1.0"
TOOL = "assaysift"

# Risk levels in order of severity, and the three verdicts.
P0, P1, P2 = "P0", "P1", "P2"
RISK_LEVELS = (P0, P1, P2)
NOT_READY = "NOT_READY"
REVIEW_NEEDED = "REVIEW_NEEDED"
PASS_WITH_NOTES = "PASS_WITH_NOTES"

# Column names of the four record kinds, in output order.
FLAG_COLUMNS = ("row_index", "paper_id", "sample_id", "field", "value", "risk_level", "reason", "required_action")
CORRECTION_COLUMNS = (
    "row_index", "paper_id", "sample_id", "field", "original_value", "cleaned_value", "correction_type", "confidence",
    "reason",
)
AUDIT_COLUMNS = ("paper_id", "P0", "P1", "P2", "total_flags")

# A row is identified by these columns. Files get ``row_index``; tables with a natural key
# may pass their own key columns to every operator instead.
ROW_KEY = ("row_index",)

# Own additions behind the contract columns: a stable code per rule, the number behind a
# range flag, and the position of the check, which breaks ties in detection order.
FLAG_EXTRAS = ("rule_code", "value_num", "flag_seq")

# Checks are numbered in detection order. Rule positions start at 0.
SEQ_RECOMMENDED = 1000
SEQ_ENGINEERING = 2000
SEQ_DUPLICATE = 3000
SEQ_OUTLIER = 4000
SEQ_UNIT = 5000
SEQ_SLIP = 6000

FLAG = T.StructType(
    [T.StructField("row_index", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in FLAG_COLUMNS[1:]]
    + [
        T.StructField("rule_code", T.StringType()),
        T.StructField("value_num", T.DoubleType()),
        T.StructField("flag_seq", T.IntegerType()),
    ]
)
CORRECTION = T.StructType(
    [
        T.StructField(n, {"row_index": T.LongType(), "cleaned_value": T.DoubleType()}.get(n, T.StringType()))
        for n in CORRECTION_COLUMNS
    ]
)
AUDIT = T.StructType(
    [T.StructField(n, T.StringType() if n == "paper_id" else T.LongType()) for n in AUDIT_COLUMNS]
)
