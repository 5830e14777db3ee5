"""Masking of personal data and the delivery-time bucket."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

# Roles that see personal data in clear. Deployments pass their own names.
CLEAR_ROLES = frozenset({"ADMIN", "PII_ADMIN"})


def mask_email(c: Column, role: str, clear_roles: Collection[str] = CLEAR_ROLES) -> Column:
    """First character, five stars, then everything from the last '@'. Text without '@' is left as it is."""
    return c if role in clear_roles else F.regexp_replace(c, "(^.).*(@.*$)", "$1*****$2")


def mask_phone(c: Column, role: str, clear_roles: Collection[str] = CLEAR_ROLES) -> Column:
    return c if role in clear_roles else F.concat(F.lit("XXXXXX"), F.right(c, F.lit(4)))


def sla_bucket(estimated: Column, actual: Column) -> Column:
    return (
        F.when(actual.isNull(), "UNKNOWN")
        .when(actual <= estimated, "ON_TIME")
        .when(actual <= estimated + 10, "SLIGHT_DELAY")
        .otherwise("HEAVY_DELAY")
    )
