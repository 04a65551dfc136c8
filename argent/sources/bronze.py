"""Bronze source registry and scan.

Thirteen source tables in three groups, captured from change logs (``log``) or,
for a source without one, by comparing full extracts (``compare``). Each bronze
table is at ``<root>/<group>/<table>``, a table that the ingest wrote
(``plans.pipeline.run_ingest``) or a plain Parquet folder, carrying the business
columns plus a sync time and a nullable soft-delete flag.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession

SYNCED = "_synced"
DELETED = "_deleted"


@dataclass(frozen=True)
class BronzeSource:
    group: str
    table: str
    key: str
    columns: tuple
    description: str = ""
    pii: tuple = ()                  # (column, PII class) tags written with the bronze table

    @property
    def capture(self) -> str:
        return "compare" if self.group == "marketing" else "log"

    @property
    def all_columns(self) -> list:
        return [self.key, *self.columns, SYNCED, DELETED]


# Source tables of the three groups (names are ours; columns as the sources declare them).
SOURCES = {s.table: s for s in [
    BronzeSource("erp", "order_headers", "ORDER_ID", ("CUSTOMER_ID", "ORDER_DATE", "TOTAL_AMOUNT", "ORDER_STATUS"), "Order headers"),
    BronzeSource("erp", "order_lines", "LINE_ID", ("ORDER_ID", "ITEM_ID", "QUANTITY", "UNIT_PRICE"), "Order lines"),
    BronzeSource("erp", "addresses", "ADDRESS_ID", ("CITY", "STATE"), "Addresses"),
    BronzeSource("erp", "city_tiers", "CITY_TIER_ID", ("CITY", "STATE", "TIER"), "City tier reference"),
    BronzeSource("erp", "items", "ITEM_ID", ("STATUS", "CATEGORY_ID", "BRAND_ID"), "Item master"),
    BronzeSource("erp", "categories", "CATEGORY_ID", ("CATEGORY_NAME",), "Product categories"),
    BronzeSource("erp", "brands", "BRAND_ID", ("BRAND_NAME",), "Product brands"),
    BronzeSource("crm", "customers", "CUSTOMER_ID", ("EMAIL", "PHONE", "FIRST_NAME", "LAST_NAME",
                                                     "REGISTRATION_DATE", "CUSTOMER_TYPE", "STATUS"), "Customer master",
                 (("EMAIL", "EMAIL"), ("PHONE", "PHONE"), ("FIRST_NAME", "FIRST_NAME"), ("LAST_NAME", "LAST_NAME"))),
    BronzeSource("crm", "registration_source", "REGISTRATION_ID", ("CUSTOMER_ID", "CHANNEL"), "Registration channel"),
    BronzeSource("crm", "incidents", "INCIDENT_ID", ("CUSTOMER_ID", "INCIDENT_DATE"), "Incidents"),
    BronzeSource("crm", "interactions", "INTERACTION_ID", ("CUSTOMER_ID", "INTERACTION_DATE"), "Interactions"),
    BronzeSource("crm", "surveys", "SURVEY_ID", ("CUSTOMER_ID", "NPS_SCORE", "CSAT_SCORE"), "Surveys"),
    BronzeSource("marketing", "campaigns", "CAMPAIGN_ID", ("CAMPAIGN_NAME", "TOTAL_SPEND", "CUSTOMERS_ACQUIRED"),
                 "Marketing campaigns"),
]}

GROUPS = {
    "erp": [s.table for s in SOURCES.values() if s.group == "erp"],
    "crm": [s.table for s in SOURCES.values() if s.group == "crm"],
    "marketing": [s.table for s in SOURCES.values() if s.group == "marketing"],
}


def source_path(root: str, source: str) -> str:
    s = SOURCES[source]
    return f"{root.rstrip('/')}/{s.group}/{s.table}"


def project_bronze(df: DataFrame, source: str, columns: Optional[Sequence[str]] = None) -> DataFrame:
    """Explicit projection of a bronze frame (Catalyst prunes the scan)."""
    return df.select(*(columns or SOURCES[source].all_columns))


def read_bronze(spark: SparkSession, root: str, source: str,
                columns: Optional[Sequence[str]] = None) -> DataFrame:
    """Scan one bronze table, reading only the listed columns."""
    from argent.sources.silver_table import read_table
    path = source_path(root, source)
    table = read_table(spark, path)
    return project_bronze(spark.read.parquet(path) if table is None else table, source, columns)
