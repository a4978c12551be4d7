"""The two sets of text patterns.

``documented`` does what the text views are described to do and is the default. ``literal`` keeps the
double-escaped patterns (a class of backslash, ``w`` and quote instead of word characters, and so on)
for users who must reproduce tables made with them.
"""

from __future__ import annotations

from dataclasses import dataclass

# Unicode whitespace, spelt out because the regex engine's own class is ASCII only.
WHITESPACE_CLASS = r"\s\x0b\x1c-\x1f\x85\p{Z}"
# The same set as single characters, for trimming.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(code) for code in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

URL = rf"https?://[^{WHITESPACE_CLASS}]+"
HANDLE_TAG = r"<HANDLE>@([A-Za-z0-9_.]+)</HANDLE>"
# Possessive: a repeated group would otherwise take a stack frame per word.
PHRASE = r"[A-Z][a-z]++(?: [A-Z][a-z]++)*+"
TERM = r"[\p{L}\p{N}_]{2,}"


@dataclass(frozen=True)
class TextRules:
    handle: str
    inline_tag: str
    token: str
    punct_only: str
    digits_only: str
    space_run: str


# Pattern sets.
RULES = {
    "documented": TextRules(
        handle=r"@([A-Za-z0-9_.]+)",
        inline_tag=r"#[\p{L}\p{N}_]+",
        token=r"[\p{L}\p{N}_']+",
        punct_only=r"^[^\p{L}\p{N}]+$",
        digits_only=r"^\p{Nd}+$",
        space_run=rf"[{WHITESPACE_CLASS}]+",
    ),
    "literal": TextRules(
        handle=r"@([A-Za-z0-9_\\.]+)",
        inline_tag=r"#(\\w+)",
        token=r"[\\w']+",
        punct_only=r"^[\\W_]+$",
        digits_only=r"^\\d+$",
        space_run=r"\\s+",
    ),
}
