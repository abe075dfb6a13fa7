"""Sums and averages that do not depend on the order in which rows arrive.

A sum of doubles changes in its last digits with the order of its terms, and that order changes
with every shuffle and every retried task. So amounts are added up as whole numbers:

* a number of whole thousandths (as good as all amounts of a log) is one bigint, its units;
* any other number is cut, digit by digit of the decimal that Spark writes it as, into `limbs` of nine digits,
  and added up per `bin`, which says where its lowest limb stands: limb i of bin b counts 10^(9(b+i)).

Partial sums are bigints, so merging them in any order, over any number of steps, gives the same state.
`odd_total` carries the limbs over and reads the digits as one number: the result is the exact sum, rounded
once to the nearest double.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from couchlog.functions.columns import half_up

# The expressions below are SQL text: a plan of a few hundred of them is built in one call each.

_LARGEST = 9_007_199_254_740  # thousandths up to here are exact in a double
_DIGITS = 9
_BASE = 10**_DIGITS


@dataclass(frozen=True)
class Amount:
    """SQL of a column taken apart: `units` (null where there are none), `odd` (whether `bin` and `limbs` count), both of them."""

    value: str
    units: str
    odd: str
    bin: str
    limbs: list[str]


def amount(df: DataFrame, name: str, value: str = "value") -> Amount:
    """The parts of a column: `value` reads it, all other parts are written over a column named as `value` says.

    Text counts as the number it reads as, or as null. NaN is null. Infinite values raise.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.DecimalType, T.IntegralType)):
        digits, scale = (dtype.precision, dtype.scale) if isinstance(dtype, T.DecimalType) else (19, 0)
        read = f"CAST(`{name}` AS decimal({digits},{scale}))"
        scaled = f"try_cast({value} * 1000BD AS bigint)"
        usual = f"abs({value}) <= {_LARGEST} AND CAST({scaled} AS decimal(38,6)) = CAST({value} AS decimal(38,9)) * 1000BD"
    else:
        digits = 17
        read = f"nanvl(try_cast(`{name}` AS double), CAST(NULL AS double))"
        scaled = f"CAST(CASE WHEN abs({value}) <= {_LARGEST} THEN round({value} * 1000) END AS bigint)"
        usual = f"CAST({scaled} AS double) / 1000 = {value}"
    # as text a number is digits with a point and perhaps a power of ten: 1234.5, 1.2E-19
    text = f"CAST(abs({value}) AS string)"
    mantissa, power = f"split_part({text}, 'E', 1)", f"split_part({text}, 'E', 2)"
    last = f"(coalesce(try_cast({power} AS int), 0) - length(split_part({mantissa}, '.', 2)))"  # power of ten of the last digit
    infinite = f"CAST(raise_error(concat('{name} out of range: ', {text})) AS int)"
    count = -(-(digits + _DIGITS - 1) // _DIGITS)
    padded = f"lpad(concat(ltrim('0', replace({mantissa}, '.', '')), repeat('0', pmod({last}, {_DIGITS}))), {count * _DIGITS}, '0')"
    return Amount(
        read,
        f"CASE WHEN {usual} THEN {scaled} END",
        f"({value} IS NOT NULL AND NOT coalesce({usual}, false))",
        f"CASE WHEN {text} = 'Infinity' THEN {infinite} ELSE CAST(floor({last} / {_DIGITS}) AS int) END",
        [f"try_cast(substr({padded}, {(count - 1 - i) * _DIGITS + 1}, {_DIGITS}) AS bigint) * CAST(sign({value}) AS int)" for i in range(count)],
    )


def checked_sum(value: str) -> Column:
    """Sum of whole numbers, null counting as 0, of at least one row; raises where it leaves bigint, in any session."""
    return F.expr(f"coalesce(try_sum(coalesce({value}, 0L)), CAST(raise_error('sum out of range') AS bigint))")


def total(units: str) -> str:
    """A sum of units as a double."""
    return f"CAST({units} AS double) / 1000"


def _let(name: str, value: str, body: str) -> str:
    """`body` over a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _carried(sums: str) -> str:
    """(digits, carry) of sums by place, lowest first: limbs from 0 up to the base, and what is left above them."""
    base, zero = f"CAST({_BASE} AS decimal(38,0))", "CAST(0 AS decimal(38,0))"
    rest = f"CAST(pmod(both, {base}) AS decimal(38,0))"
    cut = f"named_struct('digits', concat(s.digits, array(CAST({rest} AS bigint))), 'carry', CAST((both - {rest}) / {base} AS decimal(38,0)))"
    start = f"named_struct('digits', CAST(array() AS array<bigint>), 'carry', {zero})"
    return f"aggregate({sums}, {start}, (s, v) -> {_let('both', 'CAST(v + s.carry AS decimal(38,0))', cut)})"


def odd_total(units: str, entries: str) -> str:
    """A sum as a double: units, and an array of structs (bin, limbs array), in which odd values were added up.

    Sums of limbs may be negative; the sign of the whole is that of what is carried out at the top.
    """
    zero = "CAST(0 AS decimal(38,0))"
    whole = f"CAST((CAST({units} AS decimal(20,0)) - {units} % 1000) / 1000BD AS bigint)"
    # bin -1 counts 10^-9
    own = f"array(named_struct('bin', -1, 'limbs', array(({units} % 1000) * {_BASE // 1000}L, {whole})))"
    limb = "coalesce(CAST(CASE WHEN p >= e.bin THEN get(e.limbs, p - e.bin) END AS decimal(38,0)), CAST(0 AS decimal(38,0)))"
    at_place = f"aggregate(transform(every, e -> {limb}), {zero}, (a, b) -> CAST(a + b AS decimal(38,0)))"
    low, high = "array_min(transform(every, e -> e.bin))", "array_max(transform(every, e -> e.bin + size(e.limbs)))"
    by_place = f"named_struct('low', {low}, 'sums', transform(sequence({low}, {high}), p -> {at_place}))"

    def read(sign: str, carried: str) -> str:
        digits = f"array_join(transform(reverse({carried}.digits), d -> lpad(CAST(d AS string), {_DIGITS}, '0')), '')"
        return f"CAST(concat('{sign}', CAST({carried}.carry AS string), {digits}, 'E', CAST(placed.low * {_DIGITS} AS string)) AS double)"

    opposite = _let("other", _carried("transform(placed.sums, v -> CAST(-v AS decimal(38,0)))"), read("-", "other"))
    signed = _let("plain", _carried("placed.sums"), f"CASE WHEN plain.carry >= 0 THEN {read('', 'plain')} ELSE {opposite} END")
    checked = "CASE WHEN abs(x) = double('Infinity') THEN CAST(raise_error('sum out of range') AS double) ELSE x END"
    return _let("x", _let("placed", _let("every", f"concat({entries}, {own})", by_place), signed), checked)


def exact_sum(col: Column) -> Column:
    """Sum of a profile column (double) as an exact decimal, returned as double."""
    return F.sum(col.cast("decimal(28,6)")).cast("double")


def exact_avg(col: Column, digits: int) -> Column:
    """Average of the non-null values, rounded half up; null if there is none."""
    return half_up(F.try_divide(exact_sum(col), F.count(col).cast("double")), digits)
