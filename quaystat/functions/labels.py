"""Display helpers as column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fallback text and separator of the line label.
UNNAMED_LINE = "Unnamed line"
LABEL_SEPARATOR = " — "


def _present(c: Column) -> Column:
    """NULL for missing or empty text."""
    return F.nullif(c, F.lit(""))


def line_label(code: Column | str, name: Column | str, mode: Column | str) -> Column:
    """``code — name (Mode)``; code alone if the name is missing or equal to it;
    otherwise name, otherwise "Unnamed line". Empty strings count as missing.

    Mode is title-cased with ``initcap`` (``on-demand bus`` -> ``On-demand Bus``,
    which differs from Python's ``str.title`` on hyphens).
    """
    code_c = _present(F.col(code) if isinstance(code, str) else code)
    name_c = _present(F.col(name) if isinstance(name, str) else name)
    mode_c = F.col(mode) if isinstance(mode, str) else mode
    identity = (
        F.when(
            code_c.isNotNull() & name_c.isNotNull() & (name_c != code_c),
            F.concat(code_c, F.lit(LABEL_SEPARATOR), name_c),
        )
        .otherwise(F.coalesce(code_c, name_c, F.lit(UNNAMED_LINE)))
    )
    return F.concat(identity, F.lit(" ("), F.initcap(mode_c), F.lit(")"))
