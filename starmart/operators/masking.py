"""Role-based views: column masks and row filters per consumer role (T3-05).

A policy maps a role to column rules and a row predicate; the view is a
plain projection + filter, so Catalyst still prunes and pushes it down.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column rules: "keep", "drop", "null" (of the column's own type), "hash" (sha-256 with the policy salt),
# or ("prefix", n) to keep the first n characters.


@dataclass
class RolePolicy:
    columns: Mapping[str, object] = field(default_factory=dict)
    default: str = "keep"
    row_filter: Column | str | None = None  # Column or SQL predicate text
    salt: str = ""


def _apply(c: str, kind: T.DataType, rule, salt: str) -> Column | None:
    if rule == "keep":
        return F.col(c)
    if rule == "drop":
        return None
    if rule == "null":
        return F.lit(None).cast(kind).alias(c)
    if rule == "hash":
        return F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256).alias(c)
    if isinstance(rule, tuple) and rule[0] == "prefix":
        return F.substring(F.col(c).cast("string"), 1, int(rule[1])).alias(c)
    raise ValueError(f"unknown column rule {rule!r} for {c}")


def role_view(df: DataFrame, policies: Mapping[str, RolePolicy], role: str) -> DataFrame:
    """The view of ``df`` that ``role`` may read; an unknown role is refused."""
    if role not in policies:
        raise PermissionError(f"no policy for role {role!r}")
    p = policies[role]
    cols = [x for x in (_apply(f.name, f.dataType, p.columns.get(f.name, p.default), p.salt)
                         for f in df.schema)
            if x is not None]
    cond = F.expr(p.row_filter) if isinstance(p.row_filter, str) else p.row_filter
    out = df.where(cond) if cond is not None else df
    return out.select(*cols)


def rows_of_role(df: DataFrame, grants: DataFrame, role: str, on: Mapping[str, str],
                 role_col: str = "role") -> DataFrame:
    """The rows that a table of grants gives ``role``: a semi-join, so no grant is no row.

    ``on`` maps columns of ``df`` to columns of ``grants``.  A row covered by
    several grants comes once; NULL on either side grants nothing.
    """
    mine = grants.where(F.col(role_col) == F.lit(role)).select(
        *[F.col(g).alias(f"__g_{g}") for g in on.values()]).distinct()
    cond = F.lit(True)
    for c, g in on.items():
        cond = cond & (df[c] == F.col(f"__g_{g}"))
    return df.join(mine, cond, "left_semi")


def granted_view(df: DataFrame, policies: Mapping[str, RolePolicy], grants: DataFrame, role: str,
                 on: Mapping[str, str]) -> DataFrame:
    """Rows by the grants, then columns by the policy; a role without a policy sees no row
    and every column as NULL."""
    policy = policies.get(role, RolePolicy(default="null", row_filter="false"))
    return role_view(rows_of_role(df, grants, role, on), {role: policy}, role)
