"""Text expressions, and the keys and JSON fields read from text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a NULL counts as inside a surrogate key, so that it
# differs from an empty string.
NULL_KEY_TEXT = "_null_"

# The regular expression flags that are known.
REGEXP_FLAGS = "icnmspwq"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_text(*parts: Column | str) -> Column:
    """Join as text; NULLs are skipped."""
    return F.concat_ws("", *[_col(p).cast("string") for p in parts])


def hash_text(value: Column | str) -> Column:
    """MD5 as lower-case hex."""
    return F.md5(_col(value).cast("string"))


def surrogate_key(*columns: Column | str) -> Column:
    """One text key for several columns."""
    return F.md5(F.concat_ws("-", *[F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_TEXT)) for c in columns]))


def position(needle: str, value: Column | str) -> Column:
    """1-based place of the first match, 0 if there is none."""
    return F.locate(needle, _col(value))


def split_part(value: Column | str, delimiter: str, n: int) -> Column:
    """The n-th piece, counted from 1 (or from the end if negative); '' if there is none."""
    return F.split_part(_col(value), F.lit(delimiter), F.lit(n))


def regexp_instr(value: Column | str, pattern: str, start: int = 1, occurrence: int = 1, flags: str = "") -> Column:
    """Where the n-th match of ``pattern`` begins at or after ``start``; 0 if nowhere.

    Without flags a dot matches a line end too, and ^ and $ match only at the
    ends of the text. The flags change that: i ignores case (c minds it), n or
    m make dots stop and anchors match at line ends, p only the former, w only
    the latter, s neither, and q takes the pattern as plain text.

    For a later start or occurrence one pattern runs over the whole text, so that
    anchors and look-behind see what lies before ``start``: the earlier matches
    are atomic steps, and the length of what lies before the wanted match is
    the answer. No list of matches is built. Back-references are moved by the
    groups set around the pattern, and named groups become numbered ones.
    """
    if start < 1 or occurrence < 1:
        raise ValueError("start and occurrence count from 1")
    unknown = set(flags) - set(REGEXP_FLAGS)
    if unknown:
        raise ValueError(f"unknown regular expression flags: {''.join(sorted(unknown))}")
    if "q" in flags:
        pattern = "\\Q" + pattern + "\\E"
    letters = "" if set(flags) & set("nmp") else "s"
    letters += "m" if set(flags) & set("nmw") else ""
    letters += "i" if "i" in flags else ""
    inline = f"(?{letters})" if letters else ""
    column = _col(value)
    if start == 1 and occurrence == 1:
        return F.regexp_instr(column, F.lit(inline + pattern)).cast("int")
    groups = 0 if "q" in flags else group_count(pattern)
    moved = (lambda by: pattern) if "q" in flags else (lambda by: moved_references(pattern, by))
    # Group 1 is what lies before the match; the steps' groups follow, then those of the match itself.
    steps = f"(?:(?>[\\s\\S]*?(?:{moved(1)}))){{{occurrence - 1}}}" if occurrence > 1 else ""
    last = moved(1 + (groups if occurrence > 1 else 0))
    whole = f"{inline}\\A([\\s\\S]{{{start - 1}}}{steps}[\\s\\S]*?)(?:{last})"
    hit = F.length(F.regexp_extract(column, whole, 1)) + 1
    return F.when(F.regexp_like(column, F.lit(whole)), hit).when(column.isNotNull(), 0).cast("int")


# An escape, a character class, or the opening of a group.
PATTERN_PARTS = re.compile(
    r"\\Q.*?(?:\\E|$)|\\k<(?P<named>[A-Za-z][A-Za-z0-9]*)>|\\(?P<number>[1-9])|\\.|\[\^?\]?(?:\\.|[^\]\\])*\]"
    r"|\(\?<(?P<name>[A-Za-z][A-Za-z0-9]*)>|(?P<group>\((?!\?))",
    re.DOTALL,
)


def group_count(pattern: str) -> int:
    return sum(bool(m["name"] or m["group"]) for m in PATTERN_PARTS.finditer(pattern))


def moved_references(pattern: str, by: int) -> str:
    """``pattern`` with its back-references pointing ``by`` groups further.

    Named groups become numbered ones, so that the pattern can stand in another twice.
    """
    openings = [m["name"] for m in PATTERN_PARTS.finditer(pattern) if m["name"] or m["group"]]

    def moved(m: re.Match) -> str:
        if m["name"]:
            return "("
        if m["named"] and m["named"] in openings:
            return f"(?:\\{openings.index(m['named']) + 1 + by})"
        return f"(?:\\{int(m['number']) + by})" if m["number"] else m[0]

    return PATTERN_PARTS.sub(moved, pattern)


def json_field(value: Column | str, path: str, kind: str = "string") -> Column:
    """One field of a JSON text; NULL where it is missing or not of that type."""
    return F.get_json_object(_col(value), path).try_cast(kind)


def matches_flag(value: Column | str, pattern: str) -> Column:
    """True where a LIKE pattern matches, else false, NULL too."""
    return F.coalesce(_col(value).like(pattern), F.lit(False))


def equals_flag(value: Column | str, wanted: str) -> Column:
    """A one-letter flag as a boolean; NULL is false."""
    return F.coalesce(_col(value) == wanted, F.lit(False))
