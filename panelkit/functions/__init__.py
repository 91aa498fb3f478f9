"""Column-level rules. Everything is a built-in Spark expression."""

from .aggregates import any3, count_present, n_rows, sum_lenient, sum_strict
from .dates import day_in_year, year_between
from .missing import default, if_else, is_in, is_present, not_in, same
from .numbers import comma_label, log10, number_label, share, to_number
from .text import first_case, matches_any, name_key, term_pattern

__all__ = [
    "any3", "comma_label", "count_present", "day_in_year", "default", "first_case",
    "if_else", "is_in", "is_present", "log10", "matches_any", "n_rows", "name_key",
    "not_in", "number_label", "same", "share", "sum_lenient", "sum_strict",
    "term_pattern", "to_number", "year_between",
]
