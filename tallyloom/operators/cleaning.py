"""Cleaning of extracted texts before they are parsed: characters, page marks, repeated letterheads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.similarity import nfkc
from tallyloom.functions.text import clean_text


def clean_extracted(c: Column) -> Column:
    """NFKC, no control characters but line ends, one form of page marks, no empty pages, single blanks; numbers and symbols stay."""
    c = F.regexp_replace(nfkc(c), r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}]", "")
    c = F.regexp_replace(c, r"(?im)^[ \t]*(?:---|===|\[)\s*PAGE\s*(\d+)\s*(?:---|===|\])[ \t]*$", "--- PAGE $1 ---")
    c = F.regexp_replace(c, r"(?m)^--- PAGE \d+ ---\s*(?=^--- PAGE \d+ ---|\z)", "")
    return clean_text(c)


def tolerant(message: str) -> str:
    """A pattern for a known message that allows any dash, any spacing and glued dashes."""
    words = message.split()
    out = []
    for w in words:
        out.append("".join(r"\s*[-‐‑‒–—]\s*" if ch in "-–—" else ("[0Oo]" if ch in "0Oo" else "[1Il]" if ch in "1Il" else "\\" + ch if not ch.isalnum() else ch) for ch in w))
    out = "".join(x if x.startswith(r"\s*[-") and x.endswith(r"]\s*") else x + r"\s+" for x in out)
    return r"(?i)" + out.replace(r"\s+\s*[-", r"\s*[-").removesuffix(r"\s+")


def without_messages(c: Column, messages: list[str]) -> Column:
    """``c`` without known repeated messages, longest first."""
    for m in sorted(messages, key=len, reverse=True):
        c = F.regexp_replace(c, tolerant(m), "")
    return clean_text(c)
