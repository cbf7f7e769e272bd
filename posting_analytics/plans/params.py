"""Parameters that bind the operators to the driver's test tables.

The driver tables hold no job postings, so each operator runs on the table
and columns listed in its query, with word lists and sentinels chosen for
that data.  The posting defaults live in ``vocab``.
"""

from __future__ import annotations

RUN_DATE = "2026-06-13"
RUN_TS = "2026-06-13T08:00:00"

# documents: ordered word lists for the dictionary matchers
DOC_FIRST_WORDS = ["apache", "license", "token", "mail", "der", "que", "the"]
DOC_TAG_WORDS = ["MIT", "Apache", "License", "token", "mail", "example", "der", "und", "que",
                 "les", "the", "and"]
DOC_LABELS = [
    ("license", "Licensed text"),
    ("token", "Contains a token"),
    ("@", "Contains an address"),
    ("und", "German prose"),
    ("que", "Romance prose"),
    ("the", "English prose"),
]
DOC_FLAG_PHRASE = "license"
DOC_FLAG_LABEL = "Licensed"
DOC_REF_PATTERN = r"MIT|Apache|BSD|GPL|[0-9]{4}-[0-9]{2}"
DOC_AMOUNT_PATTERN = r"[0-9][0-9.]*(?:,[0-9]+)?"
# digit-led tokens, of which some are numbers and some are not
DOC_LONG_NUMBER = r"[0-9][0-9A-Za-z]{3,}"
DOC_LOWER_PATTERN = r"(?:the|der|les|los) [a-z]+"     # on lower-cased text
DOC_CASE_PATTERN = r"The|Der|Les|Los|And|MIT"         # case-sensitive

# pages: links whose href contains this substring, and patterns found in their text
PAGE_HREF = "/th"
PAGE_LINK_CAP = 10
PAGE_PHRASE = "that"
PAGE_LOWER_PATTERN = r"(?:the|der|les|los) [a-z]{4,}"
PAGE_CASE_PATTERN = r"Released|Licensed|Thth|Erre|Ouan|Nicht|The|Der"
PAGE_AMOUNT_PATTERN = r"[0-9][0-9.() -]*[0-9]"
PAGE_REJECT_EVERY = 7      # pages with such ids stand in for pages that came without HTML

# orders: the natural "not stated" value and a status used as a sentinel
PRIORITY_SENTINEL = "4-NOT SPECIFIED"
STATUS_SENTINEL = "P"
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

# part: category rules on p_name
PART_RULES = [("bolt", "Bolt"), ("gear", "Gear"), ("widget", "Widget"), ("small", "Small")]
PART_DEFAULT = "Other"
PART_SIZE_CUT = 25
PART_PRICE_CUT = 950.0

# orders: a place on a line per priority; the second gap is far larger than the first
PRIORITY_PLACES = {"1-URGENT": 0.0, "2-HIGH": 0.0, "3-MEDIUM": 100.0, "4-NOT SPECIFIED": 100.0, "5-LOW": 10_000.0}
