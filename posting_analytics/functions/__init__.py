"""Column builders: each returns a native Spark ``Column`` expression."""

from .match import (category, first_listed, keyword_tags, ordered_label, phrase_flag,
                    presence_flag, regex_first)
from .money import amount_range, amounts, canonical_digits, digits_only, group_thousands, money_format
from .numeric import percent
from .text import (anchor_text, decode_entities, element_text, first_tag_text, hrefs,
                   html_to_text, normalize_ws, parse_date, strip_tags)

__all__ = [
    "amount_range", "amounts", "anchor_text", "canonical_digits", "category", "decode_entities",
    "digits_only", "element_text", "first_listed", "first_tag_text", "group_thousands", "hrefs",
    "html_to_text", "keyword_tags", "money_format", "normalize_ws", "ordered_label", "parse_date",
    "percent",
    "phrase_flag", "presence_flag", "regex_first", "strip_tags",
]
