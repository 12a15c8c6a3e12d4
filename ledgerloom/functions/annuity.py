"""Level-payment arithmetic, rounded to cents as exact arithmetic would round it.

The payment on principal P at rate r over n periods is P * r * q / (q - 1) with q = (1 + r)**n. Exact
half cents do occur (10 % over two periods, say), so the quotient is rounded by integer division of
whole numbers, which cannot miss a tie. Where q or the product outgrows 38 digits the payment is
P * r / (1 - v) with v = (1 + r)**-n <= 1, which keeps 18 digits however long the term. A rate of
zero divides the principal evenly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.arith import let

RATE = "decimal(14,8)"
GROWTH = "decimal(22,16)"
DECAY = "decimal(30,28)"
FACTOR = "decimal(22,18)"


def _whole(value: int) -> Column:
    return F.lit(value).cast(f"decimal({len(str(value))},0)")


def _growth_base(rate: Column) -> Column:
    return (F.lit(1) + rate.cast(RATE)).try_cast("decimal(9,8)")


def _decay_base(rate: Column) -> Column:
    base = (F.lit(1) + rate.cast(RATE)).cast("decimal(15,8)")
    return (F.lit(1).cast("decimal(20,18)") / base).cast(DECAY)


def _power(base: Column, n: Column, kind: str) -> Column:
    """base**n for n >= 1 by squaring along the bits of n; NULL when it outgrows ``kind``."""
    bits = F.sequence(F.length(F.bin(n)) - 1, F.lit(0), F.lit(-1))

    def step(acc: Column, k: Column) -> Column:
        odd = F.call_function("shiftright", n, k).bitwiseAND(F.lit(1)) == 1
        return let(
            (acc * acc).try_cast(kind),
            lambda square: F.when(odd, (square * base).try_cast(kind)).otherwise(square),
        )

    return F.aggregate(bits, F.lit(1).cast(kind), step)


def _exact_cents(principal: Column, rate: Column, growth: Column) -> Column:
    """Payment in cents, half a cent rounding up; NULL when the digits do not fit."""
    amount = (principal * 100).cast("decimal(16,0)")
    per = (rate.cast(RATE) * _whole(10**8)).cast("decimal(14,0)")
    shifted = (growth * _whole(10**8)).cast("decimal(24,8)") * _whole(10**8)

    def divide(grown: Column) -> Column:
        top = F.try_multiply(F.try_multiply(F.try_multiply(amount, per), grown), _whole(2))
        half = (grown - _whole(10**16)) * _whole(10**8)
        # a growth of one to sixteen digits has nothing to divide by
        return F.when(grown > _whole(10**16), F.call_function("div", F.try_add(top, half), half * _whole(2)))

    return let(shifted.cast("decimal(24,0)"), divide)


def _factor(rate: Column, decay: Column) -> Column:
    """Payment per unit of principal; NULL when the rate is zero."""
    per = rate.cast("decimal(9,8)")
    return F.when(
        rate != 0, let((F.lit(1) - decay).cast("decimal(21,19)"), lambda rest: F.try_divide(per, rest).cast(FACTOR))
    )


def annuity(principal: Column, rate: Column, n: Column) -> Column:
    """Level payment per period at ``rate``, a fraction per period, over ``n`` periods.

    0.00 when nothing is owed or no period is left.
    """
    periods = F.greatest(n.cast("int"), F.lit(1))
    growth = let(_growth_base(rate), lambda base: _power(base, periods, GROWTH))
    decay = let(_decay_base(rate), lambda base: _power(base, periods, DECAY))
    principal = principal.cast("decimal(14,2)")
    exact = _exact_cents(principal, rate, growth).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")
    long_term = F.round(principal * _factor(rate, decay), 2)
    even = F.round(principal / F.nullif(n, F.lit(0)), 2)
    payment = F.when(rate == 0, even).otherwise(F.coalesce(exact, long_term))
    return F.when((n > 0) & (principal > 0), payment).otherwise(F.lit(0)).cast("decimal(14,2)")
