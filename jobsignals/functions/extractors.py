"""The extraction functions by column, one call per result, as a job uses them.

For several lists of one text, :func:`jobsignals.operators.postings.extract`
scans it once instead of once per list.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, functions as F

from jobsignals.functions import matching as m
from jobsignals.functions.salary import USD_RATE, salary_bins
from jobsignals.functions.text import join_texts
from jobsignals.functions.vocabulary import KNOWLEDGE_LABELS

ColumnOrName = Column | str


def _column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _terms(vocabulary: m.Vocabulary, description: ColumnOrName, requirements: ColumnOrName) -> Column:
    return m.match_terms(join_texts(_column(description), _column(requirements)), vocabulary)


def extract_framework_plattform(description: ColumnOrName, requirements: ColumnOrName) -> Column:
    return _terms(m.FRAMEWORKS, description, requirements)


def extract_language(description: ColumnOrName, requirements: ColumnOrName) -> Column:
    return _terms(m.LANGUAGES, description, requirements)


def extract_design_pattern(description: ColumnOrName, requirements: ColumnOrName) -> Column:
    return _terms(m.DESIGN_PATTERNS, description, requirements)


def extract_knowledge(description: ColumnOrName, requirements: ColumnOrName) -> Column:
    return _terms(m.KNOWLEDGES, description, requirements)


def normalize_salary(benefits: ColumnOrName, usd_rate: float = USD_RATE) -> Column:
    return salary_bins(_column(benefits), usd_rate)


def labeling_knowledge(term: ColumnOrName) -> Column:
    """Category of a knowledge term, NULL if it has none."""
    labels = F.from_json(F.lit(json.dumps(KNOWLEDGE_LABELS)), "map<string,string>")
    return F.try_element_at(labels, _column(term))
