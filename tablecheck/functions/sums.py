"""Sums of integers that cannot overflow."""

from __future__ import annotations

PIECE_BITS = 21


def exact_sum_sql(value: str, bits: int = 64) -> str:
    """SQL for the sum of a signed integer expression of ``bits`` bits, as decimal(38,0).

    The value is cut into pieces that are summed as longs, which stay exact for 2**42 rows,
    and put together once per group.  Summing decimals instead would cost an object per row.
    """
    pieces, shift = [], 0
    while bits - shift > PIECE_BITS + 1:
        low = f"shiftright({value}, {shift})" if shift else value
        pieces.append((f"({low}) & {2**PIECE_BITS - 1}L", shift))
        shift += PIECE_BITS
    pieces.append((f"shiftright({value}, {shift})" if shift else value, shift))
    parts = [
        f"cast(sum({piece}) as decimal(19,0)) * cast({2**shift}L as decimal(19,0))"
        for piece, shift in pieces
    ]
    return f"cast({' + '.join(parts)} as decimal(38,0))"


# Digits of the widest decimal, and of a piece of it.
DECIMAL_DIGITS, DIGITS_BITS, PIECE_DIGITS = 38, 45, 13


def decimal_sum_sql(value: str, precision: int, scale: int) -> str:
    """SQL for the exact sum of a decimal column, as text where it may need more than 38 digits.

    A type of at most 28 digits is summed in decimal(38, scale), which leaves ten digits for the
    number of rows.  Wider values are cut by their digits into three pieces that are summed as
    integers; the total is written out with as many digits as it has.
    """
    if precision <= DECIMAL_DIGITS - 10:
        return f"cast(sum(cast({value} as decimal({DECIMAL_DIGITS - 10},{scale}))) as string)"
    width = 3 * PIECE_DIGITS
    # By the text: absolute value and negation keep 34 digits only.
    text = f"cast({value} as string)"
    digits = f"lpad(translate({text}, '-.', ''), {width}, '0')"
    pieces = [
        f"cast(substring({digits}, {1 + i * PIECE_DIGITS}, {PIECE_DIGITS}) as bigint) * if(startswith({text}, '-'), -1L, 1L)"
        for i in range(3)
    ]
    totals = ", ".join(f"{exact_sum_sql(f'({p})', DIGITS_BITS)} as t{i}" for i, p in enumerate(pieces))
    base = f"cast({10**PIECE_DIGITS}L as decimal(14,0))"

    def carried(sign: str) -> str:
        # From the lowest piece up: what is over a piece's digits goes to the next one.
        low, mid, top = (f"cast({sign}x.t{i} as decimal(38,0))" for i in (2, 1, 0))
        up_mid = f"({mid} + (({low} - pmod({low}, {base})) div {base}))"
        up_top = f"({top} + (({up_mid} - pmod({up_mid}, {base})) div {base}))"
        parts = [f"cast({up_top} as decimal(38,0))", f"pmod({up_mid}, {base})", f"pmod({low}, {base})"]
        return parts[0], f"concat(cast({parts[0]} as string), " + ", ".join(
            f"lpad(cast(cast({p} as decimal(14,0)) as string), {PIECE_DIGITS}, '0')" for p in parts[1:]
        ) + ")"

    top, positive = carried("")
    _, negative = carried("-")
    shown = (
        f"concat(if({top} < 0, '-', ''), regexp_replace(concat('{'0' * (scale + 1)}', if({top} < 0, {negative}, {positive})), '^0+(?=[0-9]{{{scale + 1}}})', ''))"
    )
    if scale:
        shown = f"regexp_replace({shown}, '([0-9]{{{scale}}})$', '.$1')"
    return f"transform(array(struct({totals})), x -> {shown})[0]"


# A floating point value is hi * 2**e + mid * 2**(e - 18) + lo * 2**(e - 36), up to a common factor, with
# integers of at most 20 bits: 2**43 rows add up exactly as longs.
FLOAT_PIECE_BITS = 18


def float_pieces_sql(value: str) -> dict[str, str]:
    """SQL for the exponent and the three integer pieces of a finite double, nothing lost.

    The exponent comes from a logarithm and may be one off, which the pieces have room for.  Values
    near the smallest doubles are scaled up first.
    """
    tiny = f"abs({value}) < 1e-250D"
    big = f"if({tiny}, {value} * {2.0**200!r}D, {value})"
    exponent = f"cast(floor(log2(abs({big}))) as int)"
    scaled = f"({big} * if({exponent} > 900, power(2D, -1000D) * power(2D, {1000 + FLOAT_PIECE_BITS}D - {exponent}), power(2D, {FLOAT_PIECE_BITS}D - {exponent})))"
    step = float(2**FLOAT_PIECE_BITS)
    hi = f"floor({scaled})"
    rest = f"(({scaled} - {hi}) * {step!r}D)"
    mid = f"floor({rest})"
    low = f"(({rest} - {mid}) * {step!r}D)"
    return {
        "e": f"if({value} = 0, 0, {exponent} - if({tiny}, 200, 0))",
        **{name: f"if({value} = 0, 0L, cast({x} as bigint))" for name, x in (("hi", hi), ("mid", mid), ("lo", low))},
    }


def float_total_sql(pieces: str, start: str = "0D") -> str:
    """SQL for the double that an array of (e, hi, mid, lo) sums stands for, added to ``start``.

    The array is put in order first, so that the result does not depend on that of the rows.
    """
    def part(piece: str, shift: int) -> str:
        # In two steps, as the power alone may be below the smallest double.
        return f"cast(x.{piece} as double) * power(2D, floor((x.e - {shift}) / 2D)) * power(2D, x.e - {shift} - floor((x.e - {shift}) / 2D))"

    terms = " + ".join(part(p, FLOAT_PIECE_BITS * (i + 1)) for i, p in reversed(list(enumerate(("hi", "mid", "lo")))))
    return f"aggregate(array_sort({pieces}), {start}, (total, x) -> total + ({terms}))"


# Most values are whole multiples of 2**-60 below 2**36: these need no exponent, as pieces of 24 bits at fixed
# places hold them.  2**39 rows add up exactly as longs.
GRID_PIECES = 4
_GRID_BITS, _GRID_TOP = 24, 36


def _power(exponent: int) -> str:
    return f"{2.0**exponent!r}D"


def on_grid_sql(value: str) -> str:
    """SQL for whether the fixed pieces hold a double whole; null for a null."""
    scaled = f"{value} * {_power(GRID_PIECES * _GRID_BITS - _GRID_TOP)}"
    return f"(abs({value}) < {_power(_GRID_TOP)} and rint({scaled}) = {scaled})"


def grid_steps(value: str, name: str) -> list[dict[str, str]]:
    """Projections, one after the other, that cut ``value`` into ``{name}p0`` to ``{name}p3``, nothing lost.

    Each goes on from the columns of the one before; ``{name}x`` is what is left to cut.
    """
    steps = [{f"{name}x": f"{value} * {_power(_GRID_BITS - _GRID_TOP)}"}]
    for i in range(GRID_PIECES):
        # Cut towards zero, so that what is left has no more digits than the value.
        steps.append({f"{name}p{i}": f"cast({name}x as bigint)"})
        steps.append({f"{name}x": f"({name}x - cast({name}p{i} as double)) * {_power(_GRID_BITS)}"})
    return steps[:-1]


def grid_total_sql(sums: list[str]) -> str:
    """SQL for the double that the sums of the fixed pieces stand for."""
    parts = [f"cast({s} as double) * {_power(_GRID_TOP - _GRID_BITS * (i + 1))}" for i, s in enumerate(sums)]
    return " + ".join(reversed(parts))
