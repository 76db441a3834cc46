"""Text rules: cleaning of query scripts, references found in them, qualified names.

Words follow Unicode: a letter, digit or underscore in any script belongs to one. Patterns are
written so that they act on the whole text in one pass inside the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
_START, _END = rf"(?<!{WORD})", rf"(?!{WORD})"

# What is cut from a script, in this order. (?d) lets only \n end a line.
SCRUB_PATTERNS = [
    (r"(?md)--.*$", ""),
    (r"(?s)/\*.*?\*/", ""),
    (rf"(?id)SET\s+{WORD}+.*?;", ""),
    (r"(?id)WHENEVER\s+.*?;", ""),
    (r"(?id)SPOOL\s+.*?;", ""),
    (r"(?id)PROMPT\s+.*?;", ""),
    (r"\n\s*\n", "\n"),
]
# The characters that are cut from both ends afterwards.
BLANKS = " \t\n\x0b\f\r"

# Script names that are never run.
IGNORED_NAMES = [r"^test.*\.sql$", r".*_test\.sql$", r"^backup.*\.sql$", r".*_backup\.sql$", r".*\.bak\.sql$"]
SCRIPT_SUFFIXES = [".sql"]


def _cut_up_to_last(column: Column, mark: str, patterns: Sequence[tuple[str, str]]) -> Column:
    """Replace patterns that end in `mark`, in the text up to its last mark.

    Nothing behind the last mark can match. Left out, it cannot make every beginning that is never closed search
    to the end of the text: each beginning that is looked at finds its mark, and the next search goes on behind it.
    """
    def cut(text: Column) -> Column:
        rest = F.substring_index(text, mark, -1)
        closed = F.substr(text, F.lit(1), F.char_length(text) - F.char_length(rest))
        for pattern, replacement in patterns:
            closed = F.regexp_replace(closed, pattern, replacement)
        return F.concat(closed, rest)

    # One element of an array: the text is computed once, though it is used three times.
    return F.transform(F.array(column), cut)[0]


def uncommented(text: Column | str) -> Column:
    """Script text without line and block comments, in time proportional to its length."""
    column = F.col(text) if isinstance(text, str) else text
    line, block = SCRUB_PATTERNS[:2]
    return _cut_up_to_last(F.regexp_replace(column, *line), "*/", [block])


def scrubbed(text: Column | str) -> Column:
    """Script text without comments, client commands and blank lines, trimmed."""
    *commands, blank_lines = SCRUB_PATTERNS[2:]
    column = _cut_up_to_last(uncommented(text), ";", commands)
    return F.btrim(F.regexp_replace(column, *blank_lines), F.lit(BLANKS))


def contains_word(text: Column | str, word: str) -> Column:
    """Whether the word occurs, in any case."""
    column = F.col(text) if isinstance(text, str) else text
    return column.rlike(rf"(?iu){_START}{re.escape(word)}{_END}")


def qualified_names(text: Column | str, owner: str, names: Sequence[str]) -> Column:
    """Prefix every name of the list with its owner where it has none yet (case-sensitive)."""
    column = F.col(text) if isinstance(text, str) else text
    listed = "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True))
    return F.regexp_replace(column, rf"{_START}(?<!{re.escape(owner)}\.)({listed}){_END}", rf"{owner}.$1")


def qualified_tables(text: Column | str, owner: str, names: Sequence[str]) -> Column:
    """Prefix listed tables with their owner where they follow FROM or JOIN (any case)."""
    column = F.col(text) if isinstance(text, str) else text
    listed = "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True))
    return F.regexp_replace(column, rf"(?iu){_START}(FROM|JOIN)\s+({listed}){_END}", rf"$1 {owner}.$2")


def reference_patterns(owner: str) -> dict[str, list[str]]:
    """Patterns for the objects of an owner in script text, per kind of object."""
    name = rf"{re.escape(owner)}\.([A-Z_][A-Z0-9_]*)"
    return {
        "tables": [rf"(?i)(?:FROM|JOIN|UPDATE|INSERT\s+INTO)\s+{name}"],
        "functions": [rf"(?i){name}\s*\("],
    }


def selected_name(name: Column | str, suffixes: Sequence[str] = SCRIPT_SUFFIXES,
                  ignored: Sequence[str] = IGNORED_NAMES) -> Column:
    """Whether a file name has one of the suffixes and none of the ignored patterns (any case)."""
    column = F.col(name) if isinstance(name, str) else name
    wanted = F.lit(False)
    for suffix in suffixes:
        wanted = wanted | column.endswith(suffix)
    for pattern in ignored:
        wanted = wanted & ~column.rlike(f"(?i){pattern}")
    return wanted


def target_name(path: Column | str, prefix: str = "", suffix: str = "") -> Column:
    """Table a script is loaded into: prefix + file name without extension + suffix, lower case."""
    column = F.col(path) if isinstance(path, str) else path
    file_name = F.regexp_extract(column, r"([^/]*)/*$", 1)
    return F.lower(F.concat(F.lit(prefix), F.regexp_replace(file_name, r"^(.+)\.[^.]+$", "$1"), F.lit(suffix)))
