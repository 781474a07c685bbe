"""Dictionary normalizers and the ordered keyword classifier.

Dictionaries given as Python mappings are small by construction and become literals inside the
expression, so nothing is shuffled or broadcast. For a dictionary held in a table use
``operators.joins.lookup_join``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adstrata.functions.text import contains_any, fold, is_empty


def invert(spellings: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """{standard: [spelling, ...]} to {spelling: standard}, order kept."""
    return {s: standard for standard, group in spellings.items() for s in group}


def map_lookup(key: Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Value of ``key`` in a literal map, or ``default``."""
    entries = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(entries, key)
    return found if default is None else F.coalesce(found, F.lit(default))


def first_class_containing(
    folded: Column, classes: Mapping[str, Sequence[str]], default: str | None = None
) -> Column:
    """First class, in mapping order, one of whose keywords is a substring of ``folded``."""
    chain = None
    for name, keywords in classes.items():
        hit = contains_any(folded, keywords)
        chain = F.when(hit, F.lit(name)) if chain is None else chain.when(hit, F.lit(name))
    return chain if default is None else chain.otherwise(F.lit(default))


def classify(
    raw: Column,
    classes: Mapping[str, Sequence[str]],
    default: str,
    folded: Column | None = None,
) -> Column:
    """Ordered keyword classifier over raw text; null, empty or no hit gives ``default``.

    The order of the classes decides; keyword length does not. ``folded`` takes the folded text
    from a column that already holds it, so that the branches do not each fold it again.
    """
    folded = fold(raw) if folded is None else folded
    return F.coalesce(first_class_containing(folded, classes), F.lit(default))


def normalise_exact(
    raw: Column,
    spellings: Mapping[str, Sequence[str]],
    missing: str,
    other: str,
    folded: Column | None = None,
) -> Column:
    """Whole-value dictionary match: null/empty gives ``missing``, no match gives ``other``."""
    hit = map_lookup(fold(raw) if folded is None else folded, invert(spellings), other)
    return F.when(is_empty(raw), F.lit(missing)).otherwise(hit)


def normalise_with_fallback(
    raw: Column,
    spellings: Mapping[str, Sequence[str]],
    missing: str,
    other: str,
    folded: Column | None = None,
) -> Column:
    """Whole-value match first, then the first spelling in dictionary order found inside.

    Spellings of one standard value are adjacent in the dictionary, so testing a group at a
    time keeps the dictionary order.
    """
    folded = fold(raw) if folded is None else folded
    hit = F.coalesce(
        map_lookup(folded, invert(spellings)),
        first_class_containing(folded, spellings),
        F.lit(other),
    )
    return F.when(is_empty(raw), F.lit(missing)).otherwise(hit)
