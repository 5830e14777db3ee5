"""Column masks and row rules that depend on the caller's role."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Roles that see every row. Deployments pass their own names.
ALL_ROWS_ROLES = frozenset({"ADMIN", "SYSADMIN"})

Mask = Callable[[Column, str], Column]


def apply_masks(df: DataFrame, masks: Mapping[str, Mask], role: str) -> DataFrame:
    return df.withColumns({c: mask(F.col(c), role) for c, mask in masks.items()})


def apply_row_access(
    df: DataFrame,
    access: DataFrame,
    role: str,
    *,
    city_col: str = "restaurant_city",
    id_col: str = "restaurant_id",
    all_rows_roles: Collection[str] = ALL_ROWS_ROLES,
) -> DataFrame:
    """Rows whose city or restaurant is mapped to the role. An unmapped role sees nothing, an admin role everything.

    The mapping is read when the result is, so a change of it holds from the next run on. Two equi-joins instead of one OR join;
    a role's few entries are broadcast.
    """
    if role in all_rows_roles:
        return df
    mine = access.filter(F.col("role_name") == role)
    by_city = mine.filter("access_type = 'CITY' and city is not null").select("city").distinct()
    by_id = mine.filter("access_type = 'RESTAURANT' and restaurant_id is not null").select("restaurant_id").distinct()

    city_hit = by_city.select(F.col("city").alias(city_col), F.lit(True).alias("_city_hit"))
    id_hit = by_id.select(F.col("restaurant_id").alias(id_col), F.lit(True).alias("_id_hit"))
    return (
        df.join(city_hit, city_col, "left")
        .join(id_hit, id_col, "left")
        .filter("_city_hit or _id_hit")
        .select(*df.columns)
    )
