"""Label maps and copy levels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reuselens.functions._cols import as_col

# Category ids, binary label and level names.
CATEGORY_IDS = {"non": 0, "heavy": 1, "light": 2, "cut": 3, "orig": -1}
CUT = "cut / near copy"
LIGHT = "light plagiarism"
HEAVY = "heavy plagiarism"
NON = "non-plagiarised"
LEVELS = [NON, CUT, LIGHT, HEAVY]
TRUTH_LEVELS = {"cut": CUT, "light": LIGHT, "heavy": HEAVY, "non": NON, "orig": NON}
DEFAULT_THRESHOLDS = (0.85, 0.60, 0.35)
CLASS_NAMES = {0: "non", 1: "heavy", 2: "light", 3: "cut"}


def _lookup(c: Column, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr  # no match (and NULL) -> NULL


def category_id(category) -> Column:
    """Category -> id; unknown or NULL -> NULL."""
    return _lookup(as_col(category), CATEGORY_IDS).cast("int")


def plag_label(category) -> Column:
    """Non -> 0, orig -> -1, anything else (NULL included) -> 1."""
    c = as_col(category)
    return (F.when(c == "non", F.lit(0)).when(c == "orig", F.lit(-1))
            .otherwise(F.lit(1))).cast("int")


def truth_level(category) -> Column:
    """Category -> true copy level; non and orig are both not copied."""
    return _lookup(as_col(category), TRUTH_LEVELS)


def copy_level(sim, t_cut=DEFAULT_THRESHOLDS[0], t_light=DEFAULT_THRESHOLDS[1],
               t_heavy=DEFAULT_THRESHOLDS[2]) -> Column:
    """Similarity -> level with strict '>' tested high to low.

    Thresholds may be numbers or columns (for grid search).
    """
    s = as_col(sim)

    def lit(t):
        return t if isinstance(t, Column) else F.lit(float(t))

    return (F.when(s > lit(t_cut), F.lit(CUT))
            .when(s > lit(t_light), F.lit(LIGHT))
            .when(s > lit(t_heavy), F.lit(HEAVY))
            .otherwise(F.lit(NON)))


def class_name(class_id) -> Column:
    """Class id -> name; unknown -> NULL."""
    return _lookup(as_col(class_id), CLASS_NAMES)
