"""Rule-driven record validation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import texts

# Fixed value: what counts as a well-formed email address.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


@dataclass(frozen=True)
class Rule:
    """``field`` is bad, for the reason ``message``, wherever ``ok`` is not true."""

    field: str
    message: str
    ok: Column


def validate(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into valid rows and failures.

    Failures carry the record's columns plus ``error_field`` and ``error_message``,
    one row per broken rule. Both sides are plain filters on complementary conditions:
    no shuffle, and simple rules reach the Parquet scan of the valid side.
    """
    sound = [F.coalesce(rule.ok, F.lit(False)) for rule in rules]
    valid = df
    for rule in rules:
        valid = valid.where(rule.ok)
    failures = F.array(*[
        F.when(~ok, F.struct(F.lit(rule.field).alias("error_field"), F.lit(rule.message).alias("error_message")))
        for rule, ok in zip(rules, sound)
    ])
    invalid = (
        df.where(~reduce(lambda a, b: a & b, sound))
        .select("*", F.explode(failures).alias("_failure"))
        .where(F.col("_failure").isNotNull())
        .select(*df.columns, "_failure.*")
    )
    return valid, invalid


def product_rules() -> list[Rule]:
    """Products need a name, a price above 0 and no negative stock."""
    return [
        Rule("product_name", texts.MSG_MIN_LENGTH_1, F.length(F.trim("product_name")) >= 1),
        Rule("price", texts.MSG_GT_0, F.col("price") > 0),
        Rule("stock", texts.MSG_GE_0, F.col("stock") >= 0),
    ]


def user_rules() -> list[Rule]:
    """Users need an age of 0 or more, a well-formed email and a score from 0 to 100."""
    email, score = F.col("email"), F.col("profile.score")
    return [
        Rule("age", texts.MSG_GE_0, F.col("age") >= 0),
        Rule("email", texts.MSG_MISSING, email.isNotNull()),
        Rule("email", texts.MSG_EMAIL, email.isNull() | email.rlike(EMAIL_PATTERN)),
        Rule("profile.score", texts.MSG_GE_0, score >= 0),
        Rule("profile.score", texts.MSG_LE_100, score <= 100),
    ]


def attach_action(invalid: DataFrame, actions: dict[str, str]) -> DataFrame:
    """Add the ``recommended_action`` for each failed field."""
    pairs = [F.lit(x) for pair in actions.items() for x in pair]
    return invalid.withColumn("recommended_action", F.create_map(*pairs)[F.col("error_field")])


def shown_name(name: str = "product_name") -> Column:
    """The name, or the stand-in text where it is blank."""
    return F.coalesce(F.nullif(F.trim(F.col(name)), F.lit("")), F.lit(texts.MISSING_NAME))


def validate_products(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid products, and the list of those to repair."""
    valid, failed = validate(products, product_rules())
    listed = attach_action(failed, texts.PRODUCT_ACTIONS).select(
        "product_id", shown_name().alias("product_name"),
        "error_field", "error_message", "recommended_action",
    )
    return valid, listed
