"""Parts of a page between two kinds of rows, told by labels: as conditions over rows, and over many texts inside a task."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from wagebook.functions.text import label

#: A kind of rows: alternatives, each of labels that a row's normalised text contains; '^' before one: begins with, '!': lacks.
Kind = list[list[str]]


@dataclass(frozen=True)
class Span:
    begins: Kind
    ends: Kind


def said(kind: Kind) -> Column:
    """Whether a row with norm is of that kind."""
    norm = F.col("norm")
    one = lambda t: norm.startswith(label(t)) if t[0] == "^" else ~norm.contains(label(t)) if t[0] == "!" else norm.contains(label(t))
    return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, map(one, labels)) for labels in kind])


def _are(norm: pa.StringArray, kind: Kind) -> np.ndarray:
    """said of many normalised texts at once."""
    one = lambda t: pc.starts_with(norm, label(t)) if t[0] == "^" else pc.invert(pc.match_substring(norm, label(t))) if t[0] == "!" else pc.match_substring(norm, label(t))
    return reduce(pc.or_, [reduce(pc.and_, map(one, labels)) for labels in kind]).to_numpy(zero_copy_only=False)


def near(norm: pa.StringArray, first: np.ndarray, span: Span) -> np.ndarray:
    """For each row, of pages that begin where first is true: whether it lies from the page's first row that begins to the first
    after it that ends, these two included. All rows of a page without a beginning do, as who reads them may have other means."""
    n, at = np.arange(len(norm)), np.flatnonzero(first)
    if not len(n):
        return np.zeros(0, dtype=bool)
    page, none = np.cumsum(first) - 1, len(n)
    begin = np.minimum.reduceat(np.where(_are(norm, span.begins), n, none), at)[page]
    end = np.minimum.reduceat(np.where(_are(norm, span.ends) & (n > begin), n, none), at)[page]
    return (begin == none) | ((n >= begin) & (n <= end))
