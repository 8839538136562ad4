"""Sums of doubles that are exact, whatever the order, partitioning or retries.

A double is split, without error, into whole numbers of at most 23 bits: one for each
of BINS bins, whose units are powers of two that lie 24 bits apart. Bins are added as
64-bit whole numbers, on the map side first, like any sum. The bins' totals are the
exact sum; it is rounded once, to the nearest double, half to even. So the result is
that of ``math.fsum`` over the same values.

The bins reach from 2^-112 to 2^103, and hold 2^40 values each. Values of 1e-18 or more
in size are held whole. What lies below the lowest unit, and values from 2^103 (1e31)
on, infinite or no number, is added as doubles besides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 24
BINS = 9
#: The unit of the lowest bin, as a power of two.
LOWEST = -112

_MASK = 2**WIDTH - 1
_SUMS = "_sums"


def _power(exponent: int) -> str:
    return f"{2.0**exponent!r}D"


def held(value: Column) -> Column:
    """A value that the bins hold: 0 instead of what is too large, infinite or no number."""
    inside = F.abs(value) < F.lit(2.0 ** (LOWEST + WIDTH * BINS - 1))
    return F.when(inside, value).when(value.isNotNull(), F.lit(0.0))


def bins(value: str, held: str) -> list[str]:
    """SQL for the whole numbers of a held column by bin, lowest first, and last what of the value no bin holds."""
    # Rounded to each bin's unit; two neighbours differ by what the lower bin holds.
    steps = [f"rint({held} * {_power(-(LOWEST + WIDTH * k))})" for k in range(BINS)]
    whole = [f"{low} - {high} * {_power(WIDTH)}" for low, high in zip(steps, steps[1:])] + steps[-1:]
    # floor turns a whole number into a long without the tests of a cast.
    return [*(f"floor({each})" for each in whole), f"{value} - {steps[0]} * {_power(LOWEST)}"]


def _rounded(totals: str) -> str:
    """SQL for the double nearest to the exact sum that an array of bin totals stands for; NULL if they are.

    One pass from the lowest bin carries over, so that each digit is from 0 to 2^24 - 1,
    and notes the highest and lowest digits that count. Two empty bins on top take the
    carry, which then is 0, or -1 below zero, where digits are complements. The first 55
    to 62 bits become one whole number, whose last bit also says whether anything
    follows: turning that into a double rounds it as the number itself.
    """
    digit, place = f"((held.carry + total) & {_MASK}L)", "size(held.digits)"
    step = f"""named_struct(
        'carry', shiftright(held.carry + total, {WIDTH}),
        'digits', array_append(held.digits, {digit}),
        'top', if({digit} <> 0, {place}, held.top),
        'top_below', if({digit} <> {_MASK}, {place}, held.top_below),
        'bottom', coalesce(held.bottom, if({digit} <> 0, {place}, NULL)))"""
    start = """named_struct('carry', 0L, 'digits', cast(array() AS array<bigint>),
        'top', cast(NULL AS int), 'top_below', cast(NULL AS int), 'bottom', cast(NULL AS int))"""
    # The first four digits of the absolute value, the place of the first, and whether any digit lies below.
    first = "if(r.carry < 0, greatest(r.top_below, r.bottom), r.top)"
    own = "coalesce(get(r.digits, p.at - n), 0L)"
    turned = f"CASE WHEN p.at - n = r.bottom THEN {_MASK + 1}L - {own} WHEN p.at - n > r.bottom THEN {_MASK}L - {own} ELSE 0L END"
    cut = {
        38: ("(shiftleft(d[0], 38) | shiftleft(d[1], 14) | shiftright(d[2], 10))", "(d[2] & 1023L) <> 0 OR d[3] <> 0"),
        46: ("(shiftleft(d[0], 46) | shiftleft(d[1], 22) | shiftright(d[2], 2))", "(d[2] & 3L) <> 0 OR d[3] <> 0"),
        54: (
            "(shiftleft(d[0], 54) | shiftleft(d[1], 30) | shiftleft(d[2], 6) | shiftright(d[3], 18))",
            "(d[3] & 262143L) <> 0",
        ),
    }
    size = {
        up: f"cast({kept} | if({lost} OR r.bottom < p.at - 3, 1L, 0L) AS double) * pow(2D, p.at * {WIDTH} + {LOWEST - up})"
        for up, (kept, lost) in cut.items()
    }
    nearest = f"CASE WHEN d[0] >= 65536 THEN {size[38]} WHEN d[0] >= 256 THEN {size[46]} ELSE {size[54]} END"
    signed = f"if(r.carry < 0, -1D, 1D) * {nearest}"
    digits = f"transform(array(0, 1, 2, 3), n -> if(r.carry < 0, {turned}, {own}))"
    finish = f"""if(r.bottom IS NULL, 0D, get(transform(
        array(named_struct('at', {first})), p -> get(transform(array({digits}), d -> {signed}), 0)), 0))"""
    return f"aggregate(concat({totals}, array(0L, 0L)), {start}, (held, total) -> {step}, r -> {finish})"


class Sums:
    """Exact sums of one aggregation.

    Ask for sums first, then aggregate, then select from the result::

        sums = Sums()
        shown = [sums.of(F.col("cost")).alias("cost")]
        sums.by(df, "service").select("service", *shown)
    """

    def __init__(self) -> None:
        self._values: list[Column] = []
        self._known: dict[tuple[str, str], Column] = {}

    def of(self, value: Column, when: Column | None = None) -> Column:
        """The sum of doubles, of the rows that ``when`` holds for; NULL if no value is present."""
        value = value.cast("double")
        self._values.append(value if when is None else F.when(when, value))
        return F.get(F.col(_SUMS), F.lit(len(self._values) - 1))

    def total(self, name: str, when: Column | None = None) -> Column:
        """The sum of a column; asked for twice it is added up once."""
        key = name, str(when)
        if key not in self._known:
            self._known[key] = self.of(F.col(name), when)
        return self._known[key]

    def mean(self, name: str) -> tuple[Column, Column]:
        """The mean of a column's values, and the count to aggregate for it."""
        count = f"_n_{name}"
        return F.try_divide(self.total(name), F.col(count).cast("double")), F.count(F.col(name)).alias(count)

    def by(self, df: DataFrame, *keys: Column | str, also: Sequence[Column] = (), rollup: bool = False) -> DataFrame:
        """Rows of keys, of the aggregates in ``also``, and of what the sums are read from."""
        names = [f"_v{n}" for n in range(len(self._values))]
        # A projection of its own, so that each value is worked out once.
        valued = df.withColumns(dict(zip(names, self._values)))
        valued = valued.withColumns({f"{name}_held": held(F.col(name)) for name in names})
        groups = valued.rollup(*keys) if rollup else valued.groupBy(*keys)
        parts = [[f"{name}_{k}" for k in range(BINS + 1)] for name in names]
        whole = [F.sum(F.expr(sql)).alias(part) for name, own in zip(names, parts) for sql, part in zip(bins(name, f"{name}_held"), own)]
        added = groups.agg(*also, *whole)
        # One expression for all sums, so that planning does not grow with their number.
        totals = ", ".join(f"array({', '.join(own[:-1])})" for own in parts)
        rests = ", ".join(own[-1] for own in parts)
        every = F.expr(f"zip_with(transform(array({totals}), t -> {_rounded('t')}), array({rests}), (s, rest) -> s + rest)")
        kept = [F.col(f"`{c}`") for c in added.columns[: len(added.columns) - len(whole)]]
        return added.select(*kept, every.alias(_SUMS))


def exact_sums(df: DataFrame, *keys: Column | str, also: Sequence[Column] = (), **values: Column) -> DataFrame:
    """Rows of keys, other aggregates, and exact sums of doubles by name."""
    sums = Sums()
    shown = [sums.of(value).alias(name) for name, value in values.items()]
    added = sums.by(df, *keys, also=also)
    return added.select(*[F.col(f"`{c}`") for c in added.columns if c != _SUMS], *shown)
