"""Ordered rule lists compiled to one lazy ``CASE`` expression each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions import lexicon as lx
from tagloom.functions.bind import let, literal_list
from tagloom.functions.lexicon import AnyOf, Condition, Matches, Rule, StartsWith
from tagloom.functions.text import clean_title, contains_any, strip


def _has_case(token: str) -> bool:
    return token.lower() != token or token.upper() != token


def condition_column(text: Column, condition: Condition) -> Column:
    if isinstance(condition, AnyOf):
        tokens = condition.tokens
        if condition.ignore_case and any(_has_case(t) for t in tokens):
            return contains_any(F.lower(text), tuple(t.lower() for t in tokens))
        return contains_any(text, tokens)
    if isinstance(condition, StartsWith):
        return text.startswith(condition.prefix)
    if condition.needs:
        return contains_any(text, condition.needs) & text.rlike(condition.pattern)
    return text.rlike(condition.pattern)


def first_rule(text: Column, rules: Sequence[Rule]) -> Column:
    """Label of the first rule that holds for ``text``; NULL when none does.

    One ``CASE`` in rule order: a text is tested no further than its rule.
    """
    found = None
    for rule in rules:
        test = condition_column(text, rule.conditions[0])
        for condition in rule.conditions[1:]:
            test = test & condition_column(text, condition)
        label = F.lit(rule.label)
        found = F.when(test, label) if found is None else found.when(test, label)
    return F.lit(None).cast("string") if found is None else found


def rule_cascade(cleaned: Column, rules: Sequence[Rule] = lx.TITLE_RULES) -> Column:
    """The ordered rules on already cleaned text; NULL when none holds."""
    return first_rule(cleaned, rules)


def classify_strict(text: Column, rules: Sequence[Rule] = lx.TITLE_RULES) -> Column:
    """Rule label of a text, or NULL when it is blank or no rule holds."""
    return let(clean_title(text), lambda cleaned: rule_cascade(cleaned, rules))


def classify_general(text: Column, rules: Sequence[Rule] = lx.TITLE_RULES) -> Column:
    """Rule label of a text, with the simple-reaction label where no rule holds."""
    return F.coalesce(classify_strict(text, rules), F.lit(lx.SIMPLE))


def classify_title(title: Column) -> Column:
    return classify_strict(title)


def first_label_in(text: Column, labels: Sequence[str] = lx.CATEGORIES) -> Column:
    """The domain label that occurs first in the text, NULL when there is none."""
    places = F.filter(
        F.transform(
            literal_list(labels),
            lambda label: F.struct(F.instr(text, label).alias("at"), label.alias("label")),
        ),
        lambda place: place["at"] > 0,
    )
    return F.array_min(places)["label"]


def normalise_label(text: Column) -> Column:
    """Map any model answer to a domain label.

    A text that names several labels takes the one named first; the retired
    label wins over that, and everything unknown is a simple reaction.
    """
    return let(F.coalesce(strip(text.cast("string")), F.lit("")), _normalised)


def _normalised(value: Column) -> Column:
    return (
        F.when(value.isin(*lx.CATEGORIES), value)
        .when((value == "") | value.contains(lx.RETIRED_LABEL), F.lit(lx.SIMPLE))
        .otherwise(
            F.coalesce(
                F.when(value.contains(lx.LABEL_PREFIX), first_label_in(value)),
                first_rule(value, lx.ANSWER_RULES),
                F.lit(lx.SIMPLE),
            )
        )
    )


def is_label(value: Column) -> Column:
    return F.coalesce(value.isin(*lx.CATEGORIES), F.lit(False))


def is_weak(label: Column) -> Column:
    """Labels that a stronger tier may replace; NULL is not weak."""
    return F.coalesce(label.isin(*lx.WEAK_CATEGORIES), F.lit(False))
