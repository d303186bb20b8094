"""Keyword predicates and ordered keyword rules as native column expressions."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from jangbu import rules
from jangbu.functions.text import base_name

def contains(col: Column, word: str) -> Column:
    """Literal containment; a missing text contains nothing."""
    return F.coalesce(col.contains(word), F.lit(False))


def has_any(col: Column, words) -> Column:
    """Contains one of the words; NULL for a missing text.

    For filters and CASE branches, where NULL counts as false: in this form the test reaches the table scan.
    """
    words = list(words)
    if not words:
        return F.lit(False)
    return reduce(or_, (col.contains(w) for w in words))


def contains_any(col: Column, words) -> Column:
    return F.coalesce(has_any(col, words), F.lit(False))


def matches_any(col: Column, words) -> Column:
    """The same test written as one pattern of alternatives; no words match nothing."""
    words = list(words)
    if not words:
        return F.lit(False)
    return F.coalesce(col.rlike("|".join(re.escape(w) for w in words)), F.lit(False))


def include_exclude(col: Column, include=rules.TITLE_INCLUDE, exclude=rules.TITLE_EXCLUDE) -> Column:
    return ~contains_any(col, exclude) & contains_any(col, include)


def first_rule(col: Column, ordered_rules, default: str) -> Column:
    """Label of the first rule with a contained keyword."""
    chain = None
    for label, words in ordered_rules:
        hit = has_any(col, words)
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return F.lit(default) if chain is None else chain.otherwise(default)


def category_of(item_name: Column, ordered_rules=rules.CATEGORY_RULES, default: str = rules.OTHER_CATEGORY) -> Column:
    return first_rule(base_name(item_name), ordered_rules, default)


def group_labels(col: Column, groups: dict[str, str]) -> Column:
    """Array of every group whose keyword the text contains."""
    return F.array_compact(F.array(*[F.when(col.contains(word), label) for label, word in groups.items()]))
