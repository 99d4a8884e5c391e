r"""Message <-> (log type, variables) as Column expressions.

A message is tiled left to right into pairs *(fixed text, token)*. A token is a
maximal run of ``A-Za-z0-9+-._\`` that either holds a digit or follows ``=``; all
other text is fixed. Each token is one of

* ``i``  an integer with a canonical spelling,
* ``f``  a decimal number, kept exactly as unscaled integer and scale,
* ``d``  any other token with a letter or digit, kept as text,
* fixed text after all, when it has neither letter nor digit.

The log type is the message with every variable replaced by ``<i>``, ``<f>`` or
``<d>``; ``&`` and ``<`` of the fixed text are written ``&amp;`` and ``&lt;``, so a
``<`` always opens a placeholder. One regex pass per half of the pair finds only
the variables, so prose with few variables yields short arrays.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom import schema as S

# Token alphabet and the spellings of integers and decimals.
# Characters are listed one by one: Java tests such a class by table lookup.
TOKEN_CHARS = string.ascii_letters + string.digits + r"+\-._\\"
INTEGER = r"^(0|-?[1-9][0-9]{0,17})$"
DECIMAL = r"^-?(0|[1-9][0-9]{0,7})\.[0-9]{1,8}$"
NEGATIVE_ZERO = r"^-0\.0+$"
MAX_SCALE = 8

# Group 1 is fixed text: a run without digits and "=", closed by "=" or by the end of the
# message, or cut back to the start of the token that holds the next digit. Group 2 is
# the token.
PIECE = rf"([^{string.digits}=]*(?:=|\z|(?<![{TOKEN_CHARS}])))([{TOKEN_CHARS}]*+)"

INT32_MIN, INT32_MAX = -2147483648, 2147483647


def fixed_parts(message: Column) -> Column:
    return F.regexp_extract_all(message, F.lit(PIECE), F.lit(1))


def tokens(message: Column) -> Column:
    return F.regexp_extract_all(message, F.lit(PIECE), F.lit(2))


def _check_width(width: int) -> None:
    if width not in (4, 8):
        raise ValueError(f"width must be 4 or 8, not {width}")


def _unscaled(token: Column) -> Column:
    return F.replace(token, F.lit("."), F.lit("")).try_cast("bigint")


def _fits(number: Column, width: int) -> Column:
    return F.lit(True) if width == 8 else number.between(INT32_MIN, INT32_MAX)


def token_kind(token: Column, width: int) -> Column:
    """``i``, ``f``, ``d`` or null for fixed text."""
    _check_width(width)
    return (
        F.when(token.rlike(INTEGER) & _fits(token.try_cast("bigint"), width), F.lit("i"))
        .when(
            F.contains(token, F.lit("."))
            & token.rlike(DECIMAL)
            & ~token.rlike(NEGATIVE_ZERO)
            & _fits(_unscaled(token), width),
            F.lit("f"),
        )
        .when(token.rlike("[A-Za-z0-9]"), F.lit("d"))
    )


def escape_fixed(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape_fixed(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def logtype_of(fixed: Column, toks: Column, width: int) -> Column:
    def piece(text: Column, token: Column) -> Column:
        placeholder = F.concat(F.lit("<"), token_kind(token, width), F.lit(">"))
        return F.concat(escape_fixed(text), F.coalesce(placeholder, token))

    return F.array_join(F.zip_with(fixed, toks, piece), "")


def vars_of(toks: Column, width: int) -> Column:
    """``array<struct<k,num,scale,dict>>`` of the variables in message order."""

    def with_kind(token: Column) -> Column:
        return F.struct(token_kind(token, width).alias("k"), token.alias("t"))

    def typed(kt: Column) -> Column:
        k, t = kt["k"], kt["t"]
        return F.struct(
            k.alias("k"),
            F.when(k == "i", t.try_cast("bigint")).when(k == "f", _unscaled(t)).alias("num"),
            F.when(k == "f", F.length(t) - F.instr(t, ".")).cast("int").alias("scale"),
            F.when(k == "d", t).alias("dict"),
        )

    found = F.filter(F.transform(toks, with_kind), lambda kt: kt["k"].isNotNull())
    return F.transform(found, typed).cast(S.T.ArrayType(S.VAR))


def render_var(v: Column) -> Column:
    """The token text of one variable."""
    size = F.abs(v["num"])
    unit = F.get(F.array(*[F.lit(10**n) for n in range(MAX_SCALE + 1)]), v["scale"])
    decimal = F.concat(
        F.when(v["num"] < 0, "-").otherwise(""),
        F.call_function("div", size, unit).cast("string"),
        F.lit("."),
        F.lpad((size % unit).cast("string"), v["scale"], F.lit("0")),
    )
    return (
        F.when(v["k"] == "i", v["num"].cast("string")).when(v["k"] == "f", decimal).when(v["k"] == "d", v["dict"])
    )


def template_kinds(logtype: Column) -> Column:
    """The placeholder letters of a log type, in order, as one string."""
    return F.regexp_replace(logtype, F.lit(r"[^<]*+(?:<([ifd])>)?"), F.lit("$1"))


def var_kinds(variables: Column) -> Column:
    return F.array_join(F.transform(variables, lambda v: v["k"]), "")


def message_of(logtype: Column, variables: Column) -> Column:
    """Put a message back together; callers check :func:`is_decodable` first."""
    # Cut at "<", every text starts with the rest of its placeholder, "k>"; the first
    # one gets such a start as well and an empty variable.
    texts = F.split(F.concat(F.lit("i>"), logtype), "<", -1)
    rendered = F.concat(F.array(F.lit("")), F.transform(variables, render_var))

    def piece(text: Column, var_text: Column) -> Column:
        return F.concat(var_text, unescape_fixed(F.substring(text, 3, 2**31 - 1)))

    return F.array_join(F.zip_with(texts, rendered, piece), "")


def is_decodable(logtype: Column, variables: Column) -> Column:
    """Placeholders and variables agree in number and kind, and values are present."""
    complete = F.forall(
        variables,
        lambda v: F.when(v["k"] == "d", v["dict"].isNotNull())
        .when(v["k"] == "i", v["num"].isNotNull())
        .otherwise(v["num"].isNotNull() & F.coalesce(v["scale"].between(1, MAX_SCALE), F.lit(False))),
    )
    same = F.coalesce(template_kinds(logtype) == var_kinds(variables), F.lit(False))
    return same & F.coalesce(complete, F.lit(False))
