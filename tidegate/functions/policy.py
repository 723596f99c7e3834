"""Message-attribute filter policies compiled to one boolean column."""

from __future__ import annotations

import json
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F


class PolicyError(ValueError):
    """The policy text cannot be used."""


class NumberText(str):
    """A number literal that keeps its source text."""


COMPARISONS = {
    "=": lambda a, b: a == b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def parse_policy(text: str | None) -> dict[str, list]:
    """Read a policy strictly; null or blank text is the empty policy."""
    if text is None or not text.strip():
        return {}
    try:
        policy = json.loads(text, parse_int=NumberText, parse_float=NumberText)
    except ValueError as error:
        raise PolicyError(f"policy is not JSON: {error}") from error
    if not isinstance(policy, dict):
        raise PolicyError("policy must be a JSON object")
    for name, conditions in policy.items():
        if not isinstance(conditions, list):
            raise PolicyError(f"conditions of {name!r} must be an array")
        for condition in conditions:
            if isinstance(condition, list) or (isinstance(condition, dict) and len(condition) != 1):
                raise PolicyError(f"condition of {name!r} must be a value or a one-key object")
    return policy


def number_of(text: Column) -> Column:
    """Text as a double, null when it is none. Only the spellings ``NaN`` and
    ``Infinity`` name special values."""
    number = text.try_cast("double")
    special = F.isnan(number) | (F.abs(number) == float("inf"))
    spelled = F.trim(text).rlike(r"^[+-]?(NaN|Infinity)$") | text.rlike(r"[0-9]")
    return F.when(special & ~spelled, F.lit(None).cast("double")).otherwise(number)


def numeric_condition(text: Column, spec) -> Column | None:
    """``[op, x, op, x, ...]``: every pair must hold."""
    if not isinstance(spec, list) or len(spec) < 2 or len(spec) % 2:
        return None
    number = number_of(text)
    tests = []
    for sign, bound in zip(spec[::2], spec[1::2]):
        if not isinstance(bound, NumberText):
            return None
        if sign not in COMPARISONS:
            return F.lit(False)
        test = COMPARISONS[sign](number, F.lit(float(bound)))
        # NaN is unequal to everything, itself included, and has no order.
        tests.append(F.when(F.isnan(number), F.lit(sign == "!=")).otherwise(test))
    return reduce(and_, tests)


class Attribute:
    """Presence and text of one user attribute, from the map or from a promoted column.

    Rows of files that were written without the column have no presence there and are
    answered by the map, unless ``stored_only`` says that there are none of those."""

    def __init__(self, name: str, attributes: Column, promoted: tuple[str, ...], stored_only: bool):
        entry = F.try_element_at(attributes, F.lit(name))
        self.present, self.text = entry.isNotNull(), entry["string_value"]
        if name in promoted:
            stored = F.col("promoted")[name]
            if stored_only:
                self.present, self.text = stored["present"], stored["text"]
            else:
                self.text = F.when(stored["present"].isNull(), self.text).otherwise(stored["text"])
                self.present = F.coalesce(stored["present"], self.present)


def one_condition(attribute: Attribute, condition) -> Column | None:
    """The column of one condition, or None for a kind that is not known."""
    text = attribute.text
    if isinstance(condition, str):
        return text == F.lit(str(condition))
    if not isinstance(condition, dict):
        return None
    ((kind, spec),) = condition.items()
    kind = kind.lower()
    if kind == "exists":
        return attribute.present if spec is True else ~attribute.present
    if kind == "prefix" and isinstance(spec, str) and not isinstance(spec, NumberText):
        return F.startswith(text, F.lit(spec))
    if kind == "numeric":
        return numeric_condition(text, spec)
    return None


def policy_condition(
    text: str | None,
    attributes: Column | None = None,
    promoted: tuple[str, ...] = (),
    stored_only: bool = False,
) -> Column:
    """AND over attributes of OR over conditions; an attribute without a usable
    condition matches nothing. Unknown counts as no, as in any ``where``: nothing
    is negated. With ``stored_only`` bare comparisons can reach the file scan."""
    attributes = F.col("message_attributes") if attributes is None else attributes
    rules = []
    for name, conditions in parse_policy(text).items():
        attribute = Attribute(name, attributes, promoted, stored_only)
        tests = [one_condition(attribute, c) for c in conditions]
        tests = [t for t in tests if t is not None]
        rules.append(reduce(or_, tests) if tests else F.lit(False))
    return reduce(and_, rules) if rules else F.lit(True)


def compile_policy(
    text: str | None, attributes: Column | None = None, promoted: tuple[str, ...] = ()
) -> Column:
    """The same as a flag that is never null."""
    return F.coalesce(policy_condition(text, attributes, promoted), F.lit(False))
