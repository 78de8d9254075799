"""Character classes that give Java regexes the Unicode meaning of Python's.

Java's own ``\\w``, ``\\s`` and ``\\b`` are ASCII-only, and its Unicode mode still
differs on combining marks, superscript digits and ``\\x1c``-``\\x1f``.
"""

# The contents of a character class for Python's \w and \s.
WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"

# A look-behind for one character sees half of a letter beyond U+FFFF only; one
# for up to two sees it whole.
NOT_AFTER_WORD = f"(?<![{WORD}]{{1,2}})"
NOT_BEFORE_WORD = f"(?![{WORD}])"

# Every line break Python's str.splitlines knows, "\r\n" counted once.
LINE_BREAK = r"\r\n|[\n-\r\x1c-\x1e\x85\u2028\u2029]"
