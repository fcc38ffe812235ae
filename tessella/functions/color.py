"""Colour expressions: short hex for opaque colours, alpha composed into the others."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Two alphas closer than this are one alpha written twice.
SAME_ALPHA = 1e-3


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it occurs there."""
    return F.get(F.transform(F.array(value), use), 0)


def _arguments(value: Column) -> Column:
    """The arguments of a call of rgb or rgba, in order; an empty array for any other text."""
    inside = F.regexp_extract(value, r"^rgba?\((.*)\)$", 1)
    return F.when(inside != "", F.split(inside, r",\s*")).otherwise(F.array().cast("array<string>"))


def _channels(value: Column) -> Column:
    """Red, green and blue as texts of numbers from 0 to 255, of any syntax known; else null.

    The three of a call are whole numbers or shares in percent, a fourth is a plain number; after a number sign
    there are three hex digits, or six.
    """
    return _once(_arguments(value), lambda args: _known_channels(value, args))


def _known_channels(value: Column, args: Column) -> Column:
    three, fourth = F.slice(args, 1, 3), F.coalesce(F.get(args, 3), F.lit("0"))
    call = F.size(args).between(3, 4) & fourth.rlike("^[0-9.]+$")
    whole = F.forall(three, lambda c: c.rlike("^[0-9]+$"))
    share = F.forall(three, lambda c: c.rlike(r"^[0-9]+(\.[0-9]+)?%$"))
    byte = lambda c: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(F.rtrim(c, F.lit("%")).try_cast("double") * 2.55 + 0.5))).cast("string")
    digits = F.upper(F.substring(value, 2, 6))
    sixfold = F.when(F.length(value) == 4, F.regexp_replace(digits, "(.)", "$1$1")).otherwise(digits)
    of_hex = F.array(*[F.conv(F.substring(sixfold, i, 2), 16, 10) for i in (1, 3, 5)])
    return F.when(call & whole, three).when(call & share, F.transform(three, byte)).when(_is_hex(value, 3) | _is_hex(value, 6), of_hex)


def _is_hex(value: Column, n: int) -> Column:
    """Whether a text is a number sign and ``n`` hex digits."""
    return (F.length(value) == n + 1) & value.rlike("^#[0-9A-Fa-f]+$")


def _is_opaque_call(value: Column) -> Column:
    """Whether a text is a call of rgba with whole numbers and an alpha written as 1."""
    args = _arguments(value)
    return value.startswith("rgba") & (F.size(args) == 4) & (F.get(args, 3) == "1") & F.forall(F.slice(args, 1, 3), lambda c: c.rlike("^[0-9]+$"))


def short_color(text: Column) -> Column:
    """An opaque call of rgba as ``#rrggbb``; anything else unchanged."""
    value = F.trim(text)
    digits = lambda c: F.lower(F.hex(c.try_cast("long")))
    padded = lambda c: F.when(F.length(digits(c)) == 1, F.concat(F.lit("0"), digits(c))).otherwise(digits(c))
    return F.when(_is_opaque_call(value), F.concat(F.lit("#"), F.array_join(F.transform(_channels(value), padded), ""))).otherwise(text)


def _number(x: Column) -> Column:
    """A number as JavaScript prints it: four decimals at most, no trailing zeros."""
    text = F.format_string("%.4f", x)
    return F.regexp_replace(F.regexp_replace(text, r"0+$", ""), r"\.$", "")


def effective_alpha(color_alpha: Column, layer_opacity: Column, fill_opacity: Column) -> Column:
    """Alpha of colour, layer and fill together; a fill opacity that repeats the colour's counts once."""
    fill = F.when(F.abs(fill_opacity - color_alpha) > SAME_ALPHA, fill_opacity).otherwise(F.lit(1.0))
    return color_alpha * layer_opacity * fill


def composed_color(text: Column, alpha: Column) -> Column:
    """``text`` with ``alpha`` composed in; unknown syntaxes pass unchanged."""
    written = lambda parts: F.when(parts.isNotNull(), F.concat(F.lit("rgba("), F.array_join(parts, ","), F.lit(")"))).otherwise(text)
    translucent = _once(F.concat(_channels(F.trim(text)), F.array(_number(alpha))), written)
    return F.when(alpha >= 1, short_color(text)).otherwise(translucent)


def is_opaque_solid(text: Column) -> Column:
    """Whether a fill hides what lies under it: six hex digits, or a call with an alpha of 1."""
    return F.coalesce(_is_hex(text, 6) | _is_opaque_call(text), F.lit(False))
