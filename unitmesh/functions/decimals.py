"""Numeric text <-> decimal helpers for values stored as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DECIMAL = "decimal(38,10)"


def to_decimal(c: Column, mode: str = "ansi") -> Column:
    """Text to decimal(38,10). ``ansi`` fails the job on non-numeric text (as the
    reference's ``value::numeric`` does); ``try`` turns it into NULL instead. Neither
    depends on the session's ANSI setting."""
    value = c.try_cast(DECIMAL)
    if mode == "try":
        return value
    if mode != "ansi":
        raise ValueError(f"unknown cast mode {mode!r}")
    return F.when(c.isNotNull() & value.isNull(), F.raise_error(F.concat(F.lit("not a number: "), c)).cast(DECIMAL)).otherwise(value)


def decimal_text(c: Column) -> Column:
    """Canonical text of a decimal: trailing fractional zeros, then a bare '.', removed.

    ``1.50 + 2`` gives ``3.5``; ``30.0000000000`` gives ``30``; zero gives ``0``. Formatted by
    a pattern, as a decimal's own text may use an exponent. The same text comes from DuckDB, which the oracle relies on.
    """
    d = c.cast(DECIMAL)
    digits = F.trim(F.to_char(F.abs(d), F.lit("9" * 27 + "0." + "0" * 10)))
    text = F.concat(F.when(d < 0, F.lit("-")).otherwise(F.lit("")), digits)
    return F.regexp_replace(F.regexp_replace(text, "0+$", ""), "[.]$", "")


# Exact numbers of any size the text values hold: signed limbs of 18 digits, four before the
# point and two after it, highest first. Sums of limbs fit in decimal(38,0) for 10^20 rows.
LIMB = 18
WHOLE_LIMBS, FRACTION_LIMBS = 4, 2
LIMBS = WHOLE_LIMBS + FRACTION_LIMBS
AVG_DIGITS = 10
_NUMBER = r"^([+-]?)([0-9]*)[.]?([0-9]*)(?:[eE]([+-]?[0-9]{1,4}))?$"
_WIDE = "decimal(38,0)"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def to_limbs(c: Column) -> Column:
    """struct(``state``, ``limbs``) of numeric text: state ``ok`` with its limbs, ``text``
    for what is not a number, ``long`` for more digits than the limbs hold, NULL for NULL.
    White space around a number, a sign, a missing zero and exponents are read."""
    none = F.lit(None).cast("array<bigint>")

    def result(state, limbs=none):
        return F.struct(F.lit(state).cast("string").alias("state"), limbs.alias("limbs"))

    def read(text):
        group = lambda i: F.regexp_extract(text, _NUMBER, i)
        parts = F.struct((group(1) == "-").alias("minus"), F.concat(group(2), group(3)).alias("digits"),
                         (F.length(group(2)) + F.coalesce(group(4).try_cast("int"), F.lit(0))).alias("point"))
        return F.when(text.rlike(_NUMBER) & text.rlike("^[+-]?[.]?[0-9]"), _let(parts, placed)).otherwise(result("text"))

    def placed(p):  # digits before and after the point, without the zeros that don't count
        whole = F.when(p["point"] <= 0, "").otherwise(F.rpad(F.substring(p["digits"], F.lit(1), p["point"]), p["point"], "0"))
        fraction = (F.when(p["point"] < 0, F.concat(F.repeat(F.lit("0"), -p["point"]), p["digits"]))
                    .otherwise(F.substring(p["digits"], p["point"] + 1, F.length(p["digits"]))))
        both = F.struct(p["minus"].alias("minus"), F.regexp_replace(whole, "^0+", "").alias("whole"), F.regexp_replace(fraction, "0+$", "").alias("fraction"))
        return _let(both, lambda v: F.when(
            (F.length(v["whole"]) <= LIMB * WHOLE_LIMBS) & (F.length(v["fraction"]) <= LIMB * FRACTION_LIMBS),
            _let(F.concat(F.lpad(v["whole"], LIMB * WHOLE_LIMBS, "0"), F.rpad(v["fraction"], LIMB * FRACTION_LIMBS, "0")), lambda digits: result("ok", F.transform(
                F.sequence(F.lit(0), F.lit(LIMBS - 1)), lambda k: F.substring(digits, k * LIMB + 1, F.lit(LIMB)).cast("long") * F.when(v["minus"], -1).otherwise(1)))))
            .otherwise(result("long")))

    # a whole number of one limb, as most are, needs no more than a cast
    plain = F.array(*[c.cast("long") if k == WHOLE_LIMBS - 1 else F.lit(0).cast("long") for k in range(LIMBS)])
    return (F.when(c.rlike(f"^[+-]?[0-9]{{1,{LIMB}}}\\z"), result("ok", plain))
            .when(c.isNotNull(), _let(F.regexp_replace(c, r"^[\s\x00-\x20]+|[\s\x00-\x20]+$", ""), read)).otherwise(result(None)))


def sum_limbs(limbs: Column) -> list[Column]:
    """Sums of each limb, to be carried by :func:`carried`."""
    return [F.sum(limbs[k].cast(_WIDE)) for k in range(LIMBS)]


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of a decimal that is not negative by a positive one."""
    return ((a - F.pmod(a, b)) / b).cast(_WIDE)


def carried(sums: Column) -> Column:
    """struct(``negative``, ``limbs``): an array of limb sums as one number, every limb
    between 0 and 10^18 - 1 (the highest: as large as the sum needs)."""
    base = F.lit(10 ** LIMB).cast(_WIDE)

    def step(acc, x):  # from the lowest limb up: acc.carry + x = carry * base + limb
        def put(total):
            return _let(F.pmod(total, base).cast(_WIDE), lambda limb: F.struct(
                ((total - limb) / base).cast(_WIDE).alias("carry"), F.concat(F.array(limb), acc["limbs"]).alias("limbs")))
        return _let((acc["carry"] + x).cast(_WIDE), put)

    def normal(values):
        start = F.struct(F.lit(0).cast(_WIDE).alias("carry"), F.array().cast(f"array<{_WIDE}>").alias("limbs"))
        return F.aggregate(F.reverse(values), start, step)

    def signed(number):
        return F.concat(F.array(number["carry"]), number["limbs"])

    def both(values):
        return _let(normal(values), lambda plus: F.when(plus["carry"] < 0, F.struct(F.lit(True).alias("negative"), _let(
            normal(F.transform(values, lambda x: (-x).cast(_WIDE))), signed).alias("limbs"))).otherwise(
            F.struct(F.lit(False).alias("negative"), signed(plus).alias("limbs"))))

    return F.when(F.forall(sums, lambda x: x.isNotNull()), _let(sums, both))


def divided(number: Column, n: Column) -> Column:
    """A carried number divided by a count, rounded half away from zero to ``AVG_DIGITS``
    digits after the point."""
    base, by, zero = F.lit(10 ** LIMB).cast(_WIDE), n.cast(_WIDE), F.lit(0).cast(_WIDE)

    def step(acc, x):
        return _let((acc["rest"] * base + x).cast(_WIDE), lambda have: F.struct(
            F.pmod(have, by).cast(_WIDE).alias("rest"), F.concat(acc["limbs"], F.array(_div(have, by))).alias("limbs")))

    unit = F.lit(10 ** (LIMB - AVG_DIGITS)).cast(_WIDE)

    def rounded(exact):  # by the first limb after the point; may carry into those above
        first = F.element_at(exact, -FRACTION_LIMBS)
        kept = ((_div(first, unit) + F.when(F.pmod(first, unit) * 2 >= unit, 1).otherwise(0)) * unit).cast(_WIDE)
        return F.concat(F.slice(exact, 2, LIMBS - FRACTION_LIMBS), F.array(kept), F.array_repeat(zero, FRACTION_LIMBS - 1))

    def put(exact):
        return _let(carried(rounded(exact)), lambda again: F.concat(
            F.array((F.element_at(exact, 1) + F.element_at(again["limbs"], 1)).cast(_WIDE)), F.slice(again["limbs"], 2, LIMBS)))

    start = F.struct(zero.alias("rest"), F.array().cast(f"array<{_WIDE}>").alias("limbs"))
    return _let(number, lambda v: F.struct(v["negative"].alias("negative"), _let(F.aggregate(v["limbs"], start, step)["limbs"], put).alias("limbs")))


def limbs_text(number: Column) -> Column:
    """Canonical text of a carried number, as :func:`decimal_text` writes it."""
    def put(v):
        return _let(F.array_join(F.transform(v["limbs"], lambda x: F.lpad(x.cast("string"), LIMB, "0")), ""), lambda digits: _let(F.concat(
            F.regexp_replace(F.substring(digits, F.lit(1), F.length(digits) - LIMB * FRACTION_LIMBS), "^0+(?=.)", ""),
            F.regexp_replace(F.concat(F.lit("."), F.right(digits, F.lit(LIMB * FRACTION_LIMBS))), "[.]?0*$", "")),
            lambda text: F.when(v["negative"] & (text != "0"), F.concat(F.lit("-"), text)).otherwise(text)))
    return F.when(number.isNotNull(), _let(number, put))
