"""Text rendering of numbers, dates and names, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.constants import MARKUP_CHARS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def br_number_text(c: str | Column, decimals: int = 2) -> Column:
    """1234567.891 -> '1.234.567,89' (thousands '.', decimal ',')."""
    return F.translate(F.format_number(_col(c), decimals), ",.", ".,")


def format_brl(c: str | Column) -> Column:
    """Money text: 'R$ 1.234,56'."""
    return F.concat(F.lit("R$ "), br_number_text(c, 2))


def format_int_br(c: str | Column) -> Column:
    """Count text without decimals: 1234 -> '1.234'."""
    return br_number_text(c, 0)


def format_date_br(c: str | Column) -> Column:
    """ISO date -> 'dd/MM/yyyy'."""
    return F.date_format(_col(c), "dd/MM/yyyy")


def column_title(name: str) -> str:
    """'faturamento_total' -> 'Faturamento Total' (plan-time, column names)."""
    return name.replace("_", " ").title()


def strip_markup(c: str | Column) -> Column:
    """Remove markdown characters before speech or plain-text output."""
    return F.translate(_col(c), MARKUP_CHARS, "")


def sanitize_text(c: str | Column, sep: str = ";") -> Column:
    """Delimited-export cell: separator -> ',', CR/LF -> space, NULL -> ''."""
    # one character map, no regex: separator -> ',', CR and LF -> ' '
    return F.coalesce(F.translate(_col(c).cast("string"), sep + "\r\n", ",  "), F.lit(""))


# Word-boundary pattern shared by Spark (Java regex) and the SQL oracle (RE2):
# a keyword matches when it is not preceded/followed by a letter, mark, digit
# or underscore. Explicit classes keep both engines identical on accents.
_WORD = r"[\p{L}\p{M}\p{N}_]"


_META = set(r".^$*+?()[]{}|\-/")


def regex_escape(text: str) -> str:
    """Escape regex metacharacters only (spaces stay as they are, which both
    Java regex and RE2 accept)."""
    return "".join("\\" + ch if ch in _META else ch for ch in text)


def word_pattern(keyword: str) -> str:
    return rf"(^|[^\p{{L}}\p{{M}}\p{{N}}_]){regex_escape(keyword)}([^\p{{L}}\p{{M}}\p{{N}}_]|$)"


def word_match(text: str | Column, keyword: str) -> Column:
    return _col(text).rlike(word_pattern(keyword))


def word_pattern_col(keyword: Column) -> Column:
    """Per-row pattern for a keyword column (used after an equi-join has
    narrowed the candidates, so the per-row regex cost stays small)."""
    return F.concat(F.lit(r"(^|[^\p{L}\p{M}\p{N}_])\Q"), keyword,
                    F.lit(r"\E([^\p{L}\p{M}\p{N}_]|$)"))


def _template_parts(template: str):
    """'a {x} b' -> ['a ', ('x',), ' b'] (placeholders as 1-tuples)."""
    import re as _re
    parts, pos = [], 0
    for m in _re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(template[pos:m.start()])
        parts.append((m.group(1),))
        pos = m.end()
    if pos < len(template):
        parts.append(template[pos:])
    return parts


def fill(template: str, **cols) -> Column:
    """Fill ``{name}`` placeholders of a fixed text with columns (concat)."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else _col(cols[p[0]])
                      for p in _template_parts(template)])


def fill_sql(template: str, **exprs) -> str:
    """SQL form of :func:`fill` (``||`` concatenation)."""
    out = []
    for p in _template_parts(template):
        out.append("'" + p.replace("'", "''") + "'" if isinstance(p, str) else f"({exprs[p[0]]})")
    return "(" + " || ".join(out) + ")"
