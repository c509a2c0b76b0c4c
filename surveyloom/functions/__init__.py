"""Column-in, column-out rules. They work the same in batch and streaming queries."""

from surveyloom.functions import options, predicates, rules, scoring, text  # noqa: F401
