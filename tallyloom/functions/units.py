"""Unit words, one list for all that looks for them."""

from __future__ import annotations

import re

#: Words that make a number a quantity; plurals stand before singulars, so that the longer one is found.
UNIT_WORDS = [
    "Nos", "No", "Pcs", "Pc", "Pieces", "Piece", "Sets", "Set", "Jobs", "Job", "Lots", "Lot", "Units", "Unit", "Each", "EA", "Kgs", "Kg", "Grams", "Gram", "mg",
    "Ltrs", "Ltr", "Liters", "Liter", "L", "Meters", "Meter", "Met", "Mtrs", "Mtr", "MM", "CM", "KM", "Sqm", "Sq.m", "Sqft", "Sq ft", "Sq.ft", "Sq. ft", "Tons", "Ton",
    "Hours", "Hour", "Hrs", "Hr", "Days", "Day", "Months", "Month", "Years", "Year",
]
#: Units of work.
WORK_WORDS = ["Man-days", "Man-day", "Mandays", "Manday", "MDY", "Visits", "Visit"]


def any_of(words: list[str]) -> str:
    """A pattern of one of the words, spaces within them of any width."""
    return "(?:" + "|".join(re.escape(w).replace(r"\ ", r"\s*") for w in words) + ")"
