"""Character classes, written so that Java and RE2 regular expressions agree on them."""

# Bodies of bracket expressions.
# White space as str.split() and re's \s see it.
WS = r"\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
# The same characters one by one, without the space itself.
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) != " ")
# Word characters as re's \w sees them.
WORD = r"\p{L}\p{N}_"
# Unicode White_Space (no U+001C..U+001F).
UWS = r"\t-\r\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
# Unicode word characters in the UTS 18 sense.
UWORD = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{24B6}-\x{24E9}\x{200C}\x{200D}"
# ASCII and Unicode punctuation.
PUNCT = r"\p{P}$+<=>\^`|~"
# The 32 ASCII punctuation characters.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def literal(text: str) -> str:
    """`text` as a regular expression that matches only itself, in Java and RE2 alike."""
    return "".join(c if c.isalnum() or c.isspace() or ord(c) > 127 else "\\" + c for c in text)
