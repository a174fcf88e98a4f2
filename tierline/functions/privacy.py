"""Masks of personal data, as columns: they keep the type of what they mask."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STARS = "***"


def mask_name(name: Column) -> Column:
    """First token and stars, and, of three tokens or more, the last token too; a single token shows its first letter."""
    parts = F.split(F.trim(name), r"\s+")
    first, last = F.get(parts, F.lit(0)), F.element_at(parts, -1)
    return (
        F.when(name.isNull(), F.lit(None).cast("string"))
        .when(F.size(parts) >= 3, F.concat_ws(" ", first, F.lit(STARS), last))
        .when(F.size(parts) == 2, F.concat_ws(" ", first, F.lit(STARS)))
        .otherwise(F.concat(F.substring(first, 1, 1), F.lit(STARS)))
    )


def mask_phone(phone: Column) -> Column:
    """The first three and last three digits; shorter ones vanish wholly."""
    return F.when(F.length(phone) >= 7, F.concat(F.substring(phone, 1, 3), F.lit("****"), F.substring(phone, -3, 3))).when(phone.isNotNull(), F.lit("****"))


def mask_email(email: Column) -> Column:
    """The first letter of the local part, and the domain."""
    masked = F.concat(F.substring(email, 1, 1), F.lit(STARS), F.lit("@"), F.substring_index(email, "@", -1))
    return F.when(F.instr(email, "@") > 1, masked).when(email.isNotNull(), F.lit(STARS))


def join_hash(value: Column, salt: str) -> Column:
    """Equal values have equal hashes, so masked tables still join."""
    return F.sha2(F.concat(value.cast("string"), F.lit(salt)), 256)


def decade(age: Column) -> Column:
    return (F.floor(age / 10) * 10).cast("int")


def first_token(name: Column) -> Column:
    return F.concat(F.get(F.split(name, " "), F.lit(0)), F.lit(" **"))


#: Masks by name, for policies.
MASKS: dict[str, Callable[[Column], Column]] = {
    "last4": lambda c: F.concat(F.lit("****"), F.right(c, F.lit(4))),
    "first_letter": lambda c: F.concat(F.substring(c, 1, 1), F.lit("****")),
    "year": lambda c: F.trunc(c, "year"),
    "null": lambda c: F.lit(None),
    "redacted": lambda c: F.when(c.isNotNull(), F.lit("REDACTED")),
    "name": mask_name,
    "phone": mask_phone,
    "email": mask_email,
}


def apply_masks(df: DataFrame, policy: Mapping[str, str]) -> DataFrame:
    """df with the columns of the policy masked; types and order stay. A column that df lacks is an error."""
    missing = set(policy) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.select(*[MASKS[policy[f.name]](F.col(f.name)).cast(f.dataType).alias(f.name) if f.name in policy else F.col(f.name) for f in df.schema])


def policy_for(roles: Mapping[str, tuple[str | None, Mapping[str, str]]], role: str) -> dict[str, str]:
    """A role's masks with those it inherits; its own win. roles: role to (parent, masks)."""
    parent, own = roles[role]
    return (policy_for(roles, parent) if parent else {}) | dict(own)


def masked_copy(df: DataFrame, keep: list[str], policy: Mapping[str, str]) -> DataFrame:
    """Only the columns in keep (an allow-list), masked."""
    return apply_masks(df.select(*keep), {c: m for c, m in policy.items() if c in keep})
