"""Schemas of the survey entities. Every table also carries ``seq``, the input order."""

from __future__ import annotations

SCALE = "struct<min:int,max:int,labels:array<string>>"
REQUIREMENTS = "struct<question_count:int,categories:array<string>,difficulty_range:array<double>>"

# Elements of one bank document. ``options`` has several shapes there, so it is kept as raw text.
BANK_QUESTION = (
    "id bigint, question_text string, question_type string, options string, difficulty double, "
    "category string, tags array<string>, usage_count bigint"
)
BANK_QUESTIONNAIRE = (
    "id bigint, title string, description string, target_audience string, "
    f"requirements {REQUIREMENTS}, question_ids array<bigint>, status string"
)
BANK_USER = "id bigint, username string, email string, role string"
RESPONSE = (
    "user_id bigint, question_id bigint, answer string, effective boolean, "
    "question_type string, category string"
)


def _struct(fields: str) -> str:
    return "struct<" + ", ".join(f.strip().replace(" ", ":", 1) for f in _split_top(fields)) + ">"


def _split_top(fields: str) -> list[str]:
    """Split a field list at the commas outside angle brackets."""
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(fields):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(fields[start:i])
            start = i + 1
    return [*parts, fields[start:]]


BANK_DOCUMENT = (
    f"questions array<{_struct(BANK_QUESTION)}>, "
    f"questionnaires array<{_struct(BANK_QUESTIONNAIRE)}>, "
    f"users array<{_struct(BANK_USER)}>"
)
RESPONSE_DOCUMENT = f"responses array<{_struct(RESPONSE)}>"

BANK_QUESTION_TABLE = (
    "id bigint, seq bigint, question_text string, question_type string, options_raw string, "
    f"options array<string>, scale {SCALE}, difficulty double, category string, "
    "tags array<string>, usage_count bigint"
)

CRAWLED_QUESTION = (
    "question_text string, options_text string, question_type string, category string, "
    "language string, source_url string, source_name string"
)
