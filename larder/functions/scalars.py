"""Scalar expressions on loosely typed product fields; all are built-in Column expressions."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = "[0-9](_?[0-9])*"
NUMBER = rf"^[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"
SPECIAL = "^[+-]?(nan|inf|infinity)$"
#: The characters of Unicode white space.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

#: Severities in rising order (fixed values).
SEVERITIES = ["info", "completeness", "warning", "error", "bug"]


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.trim(c, F.lit(WHITE_SPACE))


def apart(c: Column) -> Column:
    """The same column by a list function, which keeps the columns selected with it out of the one method that Spark makes of plain
    steps: with many of them it is larger than the JVM compiles."""
    return F.get(F.transform(F.array(c), lambda x: x), F.lit(0))


def as_number(c: Column) -> Column:
    """Text to double by the grammar of a Python float literal, null where it is none."""
    t = strip(c)
    plain = F.when(t.rlike(NUMBER), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))
    return plain.when(F.lower(t).rlike(SPECIAL), F.regexp_replace(F.lower(t), "^[+]", "").try_cast("double"))


def number_of(c: Column, kind: str) -> Column:
    """:func:`as_number` of a column of this type; whole numbers and doubles need no detour by text."""
    return c.cast("double") if kind in ("tinyint", "smallint", "int", "bigint", "double") else as_number(c.cast("string"))


def is_blank(c: Column, kind: str) -> Column:
    """Null, white space only, or an empty array or map; 0 and false are not blank."""
    if kind == "string":
        return F.coalesce(strip(c) == "", F.lit(True))
    if kind in ("array", "object"):
        return F.coalesce(F.size(c) <= 0, F.lit(True)) | c.isNull()
    return c.isNull()


def split_tags(c: Column, is_array: bool = False) -> Column:
    """Comma-joined text or a list to stripped, non-empty tags; null gives an empty list."""
    parts = c if is_array else F.split(c, ",")
    kept = F.filter(F.transform(parts, strip), lambda x: x != "")
    return F.coalesce(kept, F.array().cast("array<string>"))


def optional_text(c: Column) -> Column:
    return F.nullif(strip(c.cast("string")), F.lit(""))


def lowered_text(c: Column) -> Column:
    return F.lower(optional_text(c))


def nutrient_unit(name: Column) -> Column:
    return F.when(name == "energy-kcal", "kcal").when(name.isin("energy", "energy-kj"), "kJ").otherwise("g")


def set_id(source: Column, preparation: Column, per: Column) -> Column:
    """Name of a nutrition set: parts or unknown-*, lower case, other characters than a-z and 0-9 to one dash."""
    part = lambda c, name: F.coalesce(F.nullif(c, F.lit("")), F.lit(f"unknown-{name}"))
    raw = F.concat_ws("-", F.lit("nutrition"), part(source, "source"), part(preparation, "preparation"), part(per, "per"))
    return F.regexp_replace(F.regexp_replace(F.lower(raw), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def nutrient(nutrients: Column, name: str, field: str = "value") -> Column:
    return F.try_element_at(nutrients, F.lit(name)).getField(field)


def severity_rank(c: Column) -> Column:
    return functools.reduce(lambda acc, p: acc.when(c == p[1], p[0]), enumerate(SEVERITIES[1:], 1), F.when(c == SEVERITIES[0], 0))


def round2(x: Column) -> Column:
    """Round to two places on the exact binary value, halves to even, at any magnitude.

    From 2**52 on a double has no fraction.  From 2**37 on its whole part is rounded apart: a
    hundred times it is even, so the fraction alone decides a half.
    """

    def rounded(x: Column) -> Column:
        a = F.abs(x)
        below = a < F.lit(2.0**37)
        rest = a - F.floor(F.least(a, F.lit(2.0**52))).cast("double")
        large = F.floor(F.least(a, F.lit(2.0**52))).cast("double") + _cents(F.when(below | (a >= F.lit(2.0**52)), 0.0).otherwise(rest)) / 100.0
        near = F.when(below, _cents(F.when(below, a).otherwise(0.0)) / 100.0).otherwise(large)
        return F.when((a >= F.lit(2.0**52)) | F.isnan(x), x).otherwise(F.signum(x) * near)

    return F.transform(F.array(x), rounded)[0]  # x is evaluated once


def _cents(a: Column) -> Column:
    """Hundredths of a double in [0, 2**37) as a double, halves to even.

    A hundred times the double is off by less than 0.01, so only close to a half exact digits are needed.
    """
    hundred = a * F.lit(100.0)
    clear = F.abs(hundred - F.floor(hundred) - F.lit(0.5)) >= F.lit(0.01)
    return F.when(clear, F.rint(hundred)).otherwise(_exact_cents(a))


def _exact_cents(a: Column) -> Column:
    """The same in decimals of 38 digits."""
    whole = lambda v: F.lit(str(v)).cast("decimal(38,0)")
    hi = F.floor(a * F.lit(2.0**26))
    lo = F.floor((a * F.lit(2.0**26) - hi) * F.lit(2.0**40))
    n = ((hi.cast("decimal(38,0)") * whole(2**40)).cast("decimal(38,0)") + lo.cast("decimal(38,0)")).cast("decimal(38,0)")
    scaled = (n * whole(100)).cast("decimal(38,0)")
    q = F.call_function("div", scaled, whole(2**66))
    r = (scaled - (q.cast("decimal(38,0)") * whole(2**66)).cast("decimal(38,0)")).cast("decimal(38,0)")
    up = (r > whole(2**65)) | ((r == whole(2**65)) & (q % 2 == 1))
    return (q + F.when(up, 1).otherwise(0)).cast("double")


PLACEHOLDER = r"\$\{([A-Za-z_]\w*)\}"


def placeholders(template: Column) -> Column:
    return F.regexp_extract_all(template, F.lit(PLACEHOLDER), F.lit(1))


def template_key(template: Column) -> Column:
    return F.regexp_replace(template, PLACEHOLDER, r"\$\{*\}")


def template_pattern(template: str) -> str:
    """Whole-match pattern of a template: a placeholder is one or more characters without colon and white space."""
    import re

    out, at = [], 0
    for m in re.finditer(PLACEHOLDER, template):
        out += [r"\Q" + template[at : m.start()] + r"\E" if m.start() > at else "", r"[^:\s\p{Z}]+"]
        at = m.end()
    out.append(r"\Q" + template[at:] + r"\E" if at < len(template) else "")
    return r"\A" + "".join(out) + r"\z"


def template_match(code: Column, template: str) -> Column:
    """Whether the code is one of the template's; its literal ends are compared first, as a pattern costs far more."""
    import re

    ends = re.split(r"\$\{[A-Za-z_]\w*\}", template)
    return F.coalesce(F.startswith(code, F.lit(ends[0])) & F.endswith(code, F.lit(ends[-1])) & code.rlike(template_pattern(template)), F.lit(False))
