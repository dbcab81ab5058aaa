"""Python's notion of white space, as text for Spark expressions."""

from __future__ import annotations

import sys

# Every character Python's str.strip() removes: derived from the interpreter's own
# str.isspace() rule (29 code points), so trimming matches the original job exactly.
PY_WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())
