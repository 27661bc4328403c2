"""Regex building blocks shared by every expression.

Patterns are written so that Java regex (Spark) and RE2 give the same
matches: no back-references, no look-around, explicit character classes
instead of ``\\s``/``\\w`` (whose meaning differs between engines).
"""

# Python's str.isspace() set, written as an explicit class.
WS_CHARS = (r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS = f"[{WS_CHARS}]"
NON_WS = f"[^{WS_CHARS}]"
# Unicode word character (Python's \w on str).
WORD = r"[\p{L}\p{N}_]"
STRIP = rf"\A{WS}+|{WS}+\z"

# The same set as a plain string, for ``trim(col, chars)``, which strips only
# the ends and never scans the middle of the text.  Built from the rule
# (``str.isspace``) rather than listed.
WS_STRING = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
