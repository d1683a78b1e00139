"""Reference data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermill.functions import literal_frame
from ledgermill.schemas import RISK_MCC_CODES

# Merchant category codes with their risk weight in percent.
RISK_MCC_ROWS = [
    (5411, "Grocery", 15),
    (5812, "Restaurants", 20),
    (4111, "Transport", 25),
    (6011, "ATM Cash", 55),
    (6012, "Financial Institution", 40),
    (7995, "Gambling", 95),
    (7801, "Online Gaming", 85),
    (4829, "Wire Transfer", 75),
    (5944, "Jewelry", 60),
    (5732, "Electronics", 45),
]


def risk_mcc_codes(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, RISK_MCC_ROWS, RISK_MCC_CODES)
