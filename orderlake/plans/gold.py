"""C3 silver -> gold: customer and employee names, 10-column detailed sales."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.joins import add_customer, add_employee
from ..schemas import GOLD_COLUMNS


def to_gold(silver: DataFrame, customers: DataFrame, employees: DataFrame) -> DataFrame:
    """J2 -> J3 -> P1. Catalyst prunes the unused phone/email/address columns
    from both dimension scans, so only key, name and commission are read."""
    return add_employee(add_customer(silver, customers), employees).select(*GOLD_COLUMNS)
