"""Every operator run over the whole given tables, next to an independent SQL statement."""

from checks import reports, rules, selection, structure, texts  # noqa: F401
from checks.registry import CHECKS  # noqa: F401
