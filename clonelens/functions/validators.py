"""Column functions that check and reshape annotated-read fields; a value that fails its check becomes null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

REGION_NAMES = ["v_start", "cdr1_start", "cdr1_end", "cdr2_start", "cdr2_end", "cdr3_start", "v_end", "d_start", "d_end", "j_start", "cdr3_end", "j_end"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nucleotides(c) -> Column:
    """Lower-case sequence over a, c, g, t, n, gap and dot."""
    low = F.lower(_c(c))
    return F.when(low.rlike(r"^[actgn.\-]*$"), low)


def amino_acids(c) -> Column:
    up = F.upper(_c(c))
    return F.when(up.rlike(r"^[ACDEFGHIKLMNPQRSTVWYX*\-#.]*$"), up)


def integer(c) -> Column:
    """Digits with sign, surrounding blanks and single underscores between digits, as int."""
    c = _c(c)
    return F.when(c.rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"), F.replace(F.trim(c), F.lit("_")).try_cast("int"))


def floating(c) -> Column:
    c = _c(c)
    return F.when(c.rlike(r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?\s*$|^\s*[+-]?(nan|inf|infinity)\s*$"), F.trim(c).try_cast("double"))


def boolean(c) -> Column:
    x = F.lower(F.trim(_c(c)))
    return F.when(x.isin("t", "true"), True).when(x.isin("f", "false"), False)


def gene(c, prefix: str) -> Column:
    """The first blank-separated token that starts with ``prefix`` in any case, without commas."""
    tokens = F.filter(F.split(_c(c), " "), lambda x: F.upper(F.substring(x, 1, len(prefix))) == prefix)
    return F.replace(F.get(tokens, F.lit(0)), F.lit(","))


def strip_allele(c) -> Column:
    return F.substring_index(_c(c), "*", 1)


def strip_gaps(c) -> Column:
    return F.replace(_c(c), F.lit("."))


def normalise_cdr3(c) -> Column:
    return F.translate(_c(c), "#", ".")


def joined(columns: list, gaps: bool = True) -> Column:
    """Concatenation with null read as empty; without ``gaps`` dots are removed."""
    text = F.concat(*[F.coalesce(_c(c), F.lit("")) for c in columns])
    return text if gaps else strip_gaps(text)


def filled(c) -> Column:
    """Neither null nor empty."""
    return _c(c).isNotNull() & (_c(c).cast("string") != "")


def all_filled(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [filled(c) for c in columns], F.lit(True))


def region_offset(position, start) -> Column:
    """Position counted from ``start``; either counts as 1 where it is no integer."""
    return F.coalesce(_c(position), F.lit(1)) - F.coalesce(_c(start), F.lit(1)) + 1


def running_maximum(positions: list) -> list[Column]:
    """Each position raised to the largest before it, from 1 on."""
    out: list[Column] = []
    for p in positions:
        out.append(F.greatest(out[-1] if out else F.lit(1), F.coalesce(_c(p), F.lit(1))))
    return out


def back_filled(positions: list) -> list[Column]:
    """A missing position takes the valid one before it, from 1 on."""
    out: list[Column] = []
    for p in positions:
        out.append(F.coalesce(_c(p), out[-1] if out else F.lit(1)))
    return out


def general_format(c) -> Column:
    """Six significant digits, trailing zeros dropped, exponent where it is shorter."""

    @F.pandas_udf("string")
    def fmt(x):
        return x.map(lambda v: None if v is None or v != v else f"{v:g}")

    return fmt(_c(c).cast("double"))


def share_format(c) -> Column:
    """Two decimals, or scientific with two decimals below 0.01."""

    @F.pandas_udf("string")
    def fmt(x):
        return x.map(lambda v: None if v is None or v != v else f"{v:.2e}" if v < 0.01 else str(round(v, 2)))

    return fmt(_c(c).cast("double"))


def integer_option(value: str | int, default: int) -> int | None:
    """A count given as text: "all" is no limit (None), anything unreadable the default."""
    if value == "all":
        return None
    try:
        return int(value)
    except (TypeError, ValueError):
        return default
