"""DNA strings: normalisation, reverse complement, canonical forms and their hashes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def normalized(sequence: Column) -> Column:
    """Upper case, or null if the string is empty or has letters other than A, C, G and T."""
    upper = F.upper(sequence)
    return F.when(upper.rlike("^[ACGT]+$"), upper)


def reverse_complement(sequence: Column) -> Column:
    return F.reverse(F.translate(sequence, "ACGT", "TGCA"))


def least_rotation(s: str) -> str:
    """The rotation of a string that sorts first, in linear time.

    Two candidate starts i and j are compared k letters deep; the one that loses at letter k can be neither at any of the
    k + 1 starts from it on, for the other candidate's shifted copies beat them all.
    """
    n, i, j, k = len(s), 0, 1, 0
    while i < n and j < n and k < n:
        a, b = s[(i + k) % n], s[(j + k) % n]
        if a == b:
            k += 1
            continue
        if a > b:
            i += k + 1
        else:
            j += k + 1
        j += i == j
        k = 0
    start = min(i, j)
    return s[start:] + s[:start]


@F.pandas_udf(T.StringType())
def minimal_rotation(sequence: pd.Series) -> pd.Series:
    return sequence.map(lambda s: None if s is None else least_rotation(s))


def canonical(sequence: Column, topology: Column) -> Column:
    """The least of a molecule's forms: either strand and, if it is circular, any rotation."""
    circular = F.lower(F.trim(topology)) == "circular"
    linear = F.least(sequence, reverse_complement(sequence))
    return F.when(circular, F.least(minimal_rotation(F.when(circular, sequence)), minimal_rotation(F.when(circular, reverse_complement(sequence))))).otherwise(linear)


def component_hash(sequence: Column, topology: Column) -> Column:
    return F.sha2(canonical(sequence, topology), 256)
