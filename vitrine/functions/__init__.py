"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from vitrine.functions.parsing import (money_br, rating_br, to_boolean, to_int,
                                       money_br_raw)
from vitrine.functions.formatting import (format_brl, format_int_br, format_date_br,
                                          column_title, strip_markup, sanitize_text,
                                          br_number_text, word_match)

__all__ = ["money_br", "money_br_raw", "rating_br", "to_boolean", "to_int", "format_brl",
           "format_int_br", "format_date_br", "column_title", "strip_markup",
           "sanitize_text", "br_number_text", "word_match"]
