"""Sums of doubles that are exact at every magnitude and do not depend on the order of rows.

A double stands for its decimal text, as Spark writes it. Its digits, a whole number of at most 26 digits, count in units of a power of 10^9, the bin. Sums of one bin are
decimals and exact; rows are combined by group and bin before the shuffle. What is left, one row for each group and combination of bins, is combined
once more: the bins of a group are carried into one another like digits of base 10^9, and the total is rounded once. Ordinary
values (below 10^17, at most nine decimal places) are all in one bin, so for them the second step has one row a group.
"""  # noqa: E501

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMB = 9
#: an ordinary value as it is; 10^10 rows more fit the sum
PART = "decimal(26,9)"
WHOLE = "decimal(38,0)"
_ORDINARY = -1
#: bins above the highest one that carries can reach: a sum has 36 digits at most
_ROOM = 5
#: limbs that are read for the rounding: 28 digits or more, and a mark for what lies below
_READ = 4
INFINITY = float("inf")
#: places of the values that are added as whole numbers, and the bits of the lower half of those
_PLACES, _HALF = 6, 24
_BASE, _UNIT = "1000000000BD", "0.000000001BD"


def number(value: Column) -> Column:
    """A double, NaN being no number."""
    double = value.cast("double")
    return F.when(~F.isnan(double), double)


# the expressions below are SQL text: one call builds what would be hundreds of calls to the JVM


def _let(name: str, value: str, body: str) -> str:
    """`body` with `name` for a value that is worked out once, however often it is named."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _binned(value: str) -> str:
    """Bin and part of a double: it is part * 10^(9 * (bin + 1)). Null and infinities have no part and are in the ordinary bin."""
    x = "x"
    plain = f"try_cast(CASE WHEN abs({x}) < double('Infinity') THEN {x} END AS {PART})"
    other = f"abs({x}) < double('Infinity') AND NOT coalesce(CAST({plain} AS DOUBLE) = {x}, false)"
    text = f"CAST(abs({x}) AS STRING)"
    head, power = f"substring_index({text}, 'E', 1)", f"CASE WHEN contains({text}, 'E') THEN CAST(substring_index({text}, 'E', -1) AS INT) ELSE 0 END"
    places = f"substring_index({head}, '.', -1)"
    last = f"({power} - length({places}))"
    place = f"CAST(floor({last} / {LIMB}) AS INT)"
    digits = f"concat(substring_index({head}, '.', 1), {places}, repeat('0', {last} - {place} * {LIMB}))"
    part = f"CAST(sign({x}) * 1 AS DECIMAL(1,0)) * CAST({digits} AS DECIMAL(26,0)) * {_UNIT}"
    bin_, part = f"CASE WHEN {other} THEN {place} ELSE {_ORDINARY} END", f"CASE WHEN {other} THEN CAST({part} AS {PART}) ELSE {plain} END"
    return _let(x, value, f"named_struct('bin', {bin_}, 'part', {part})")


def _millionths(x: str) -> str:
    """A double below 10^9 of at most six decimal places as a whole number of millionths; null for any other.

    It has 15 digits at most, so no other decimal of 15 digits is nearer to the double than this one: it is the text of the double.
    """
    unit = f"1E{_PLACES}D"
    return f"CASE WHEN abs({x}) < 1E9D AND rint({x} * {unit}) / {unit} = {x} THEN CAST(rint({x} * {unit}) AS BIGINT) END"


def _with_millionths(part: str, high: str, low: str) -> str:
    """The total of a bin: the sum of its parts and, where there are any, of the halves of its millionths."""
    wide = "DECIMAL(20,0)"
    total = f"(CAST({high} AS {wide}) * CAST({1 << _HALF} AS DECIMAL(8,0)) + CAST({low} AS {wide})) * 0.{'1'.rjust(_PLACES, '0')}BD"
    total = f"CAST({total} AS DECIMAL(35,9))"
    return f"CASE WHEN {high} IS NULL THEN {part} WHEN {part} IS NULL THEN {total} ELSE CAST({part} + {total} AS DECIMAL(36,9)) END"


def _carried(limbs: str) -> str:
    """carry, limbs: the same total with limbs from 0 to 10^9 - 1; the carry out of the last is 0, or -1 where the total is negative."""
    up = f"named_struct('carry', CAST((now - rest) * {_UNIT} AS {WHOLE}), 'limbs', concat(s.limbs, array(rest)))"
    step = _let("now", f"CAST(s.carry + x AS {WHOLE})", _let("rest", f"CAST(pmod(now, {_BASE}) AS DECIMAL(10,0))", up))
    return f"aggregate({limbs}, named_struct('carry', CAST(0 AS {WHOLE}), 'limbs', CAST(array() AS ARRAY<DECIMAL(10,0)>)), (s, x) -> {step})"


def _rounded(bins: str) -> str:
    """The double nearest to the total of an array of (bin, total); null for none."""
    total = f"aggregate(known, CAST(0 AS {{0}}), (a, y) -> CAST(a + y.total AS {{0}}))"
    plain = f"CAST({total.format('DECIMAL(38,9)')} AS DOUBLE)"
    limb = f"aggregate(filter(known, y -> y.bin = place), CAST(0 AS {WHOLE}), (a, y) -> CAST(a + CAST(y.total * {_BASE} AS {WHOLE}) AS {WHOLE}))"
    limbs = f"transform(sequence(low, array_max(transform(known, y -> y.bin)) + {_ROOM}), place -> {limb})"
    # from the greatest place whose limb is not 0 downwards; whatever is not read is told by one more digit
    read = f"array_join(transform(sequence(0, {_READ - 1}), i -> lpad(CAST(coalesce(get(falling, i), 0) AS STRING), {LIMB}, '0')), '')"
    below = f"CASE WHEN exists(slice(falling, {_READ + 1}, greatest(size(falling), 1)), y -> y != 0) THEN '1' ELSE '0' END"
    power = f"CAST((low + top - {_READ - 1}) * {LIMB} - 1 AS STRING)"
    nearest = f"CASE WHEN top IS NULL THEN 0D ELSE {_let('falling', 'reverse(slice(digits, 1, coalesce(top, 0) + 1))', f'CAST(concat({read}, {below}, chr(69), {power}) AS DOUBLE)')} END"
    nearest = _let("top", "array_max(transform(digits, (y, i) -> CASE WHEN y != 0 THEN i END))", nearest)
    digits = _carried(f"transform(limbs, y -> CASE WHEN negative THEN CAST(-y AS {WHOLE}) ELSE y END)") + ".limbs"
    signed = f"CASE WHEN negative THEN -1D ELSE 1D END * {_let('digits', digits, nearest)}"
    far = _let("limbs", limbs, _let("negative", f"{_carried('limbs')}.carry < 0", signed))
    far = _let("low", "array_min(transform(known, y -> y.bin))", far)
    chosen = f"CASE WHEN size(known) = 0 THEN CAST(NULL AS DOUBLE) WHEN forall(known, y -> y.bin = {_ORDINARY}) THEN {plain} ELSE {far} END"
    return _let("known", f"filter({bins}, y -> y.total IS NOT NULL)", chosen)


def exact_totals(
    df: DataFrame,
    keys: list[str],
    sums: dict[str, Column],
    wholes: dict[str, Column] | None = None,
    sets: list[list[str]] | None = None,
    kept: dict[str, Column] | None = None,
) -> DataFrame:
    """One row for each group: the `keys`, of every sum its total and `<name>_count`, and the totals of the `wholes`.

    `sums` are doubles of any size. Null and NaN are left out of total and count alike; a total with an infinity is that infinity, with both NaN; one
    without numbers is null. `wholes` are whole numbers, added as such. Without keys there is one row, also of an empty table.

    With `sets`, several groupings come from the one pass over the rows: each names the keys it groups by, the others are null in its rows, and
    `grouping_bits` tells which were left out, the last key being the lowest bit. `kept` are values of any row of a group, for groups whose rows agree.
    """  # noqa: E501
    wholes, kept = wholes or {}, kept or {}
    columns = {f"_k{i}": F.col(k) for i, k in enumerate(keys)}
    columns |= {f"_v{i}": number(value) for i, value in enumerate(sums.values())}
    columns |= {f"_w{i}": value for i, value in enumerate(wholes.values())}
    columns |= {f"_a{i}": value for i, value in enumerate(kept.values())}
    rows = df.select(*[c.alias(name) for name, c in columns.items()])
    rows = rows.withColumns({f"_s{i}": F.expr(_millionths(f"_v{i}")) for i in range(len(sums))}) if sums else rows
    # others than millionths are worked out by a function of their own: in line, their code is too long for the JVM to compile what holds it
    others = {f"_o{i}": F.expr(f"CASE WHEN _v{i} IS NOT NULL AND _s{i} IS NULL THEN {_binned(f'_v{i}')} END") for i in range(len(sums))}
    rows = rows.withColumns(others) if sums else rows
    places = {f"_b{i}": F.coalesce(f"_o{i}.bin", F.lit(_ORDINARY)) for i in range(len(sums))}
    rows = rows.withColumns(places | {f"_p{i}": F.col(f"_o{i}.part") for i in range(len(sums))}) if sums else rows
    own, bins, n = [f"_k{i}" for i in range(len(keys))], [f"_b{i}" for i in range(len(sums))], range(len(sums))
    bits = []
    if sets is None:
        grouped = rows.groupBy(*own, *bins)
    else:
        named = dict(zip(keys, own, strict=True))
        grouped = rows.groupingSets([[*(named[k] for k in one), *bins] for one in sets], *own, *bins)
        bits = [F.shiftright(F.grouping_id(), len(bins)).cast("int").alias("_g")]
    by_bin = grouped.agg(
        *bits,
        F.count("*").alias("_n"),
        *[F.sum(f"_p{i}").alias(f"_p{i}") for i in n],
        *[F.sum(F.shiftright(f"_s{i}", _HALF)).alias(f"_h{i}") for i in n],
        *[F.sum(F.col(f"_s{i}").bitwiseAND((1 << _HALF) - 1)).alias(f"_l{i}") for i in n],
        *[F.count(f"_v{i}").alias(f"_c{i}") for i in n],
        *[F.count_if(F.col(f"_v{i}") == INFINITY).alias(f"_u{i}") for i in n],
        *[F.count_if(F.col(f"_v{i}") == -INFINITY).alias(f"_d{i}") for i in n],
        *[F.sum(f"_w{i}").alias(f"_w{i}") for i in range(len(wholes))],
        *[F.any_value(f"_a{i}").alias(f"_a{i}") for i in range(len(kept))],
    )
    by_bin = by_bin.withColumns({f"_p{i}": F.expr(_with_millionths(f"_p{i}", f"_h{i}", f"_l{i}")) for i in n}) if sums else by_bin
    by_group = by_bin.groupBy(*own, *(["_g"] if bits else [])).agg(
        *[F.collect_list(F.struct(F.col(f"_b{i}").alias("bin"), F.col(f"_p{i}").alias("total"))).alias(f"_p{i}") for i in n],
        *[F.coalesce(F.sum(f"_{x}{i}"), F.lit(0)).alias(f"_{x}{i}") for i in n for x in "cud"],
        *[F.sum(f"_w{i}").alias(f"_w{i}") for i in range(len(wholes))],
        *[F.any_value(f"_a{i}").alias(f"_a{i}") for i in range(len(kept))],
    )
    # one expression rounds all totals
    every = ", ".join(f"_p{i}" for i in n)
    rounded = by_group.withColumn("_r", F.expr(f"transform(array({every}), bins -> {_rounded('bins')})")) if sums else by_group
    out = [F.col(k).alias(name) for k, name in zip(own, keys, strict=True)]
    for i, name in enumerate(sums):
        up, down = F.col(f"_u{i}") > 0, F.col(f"_d{i}") > 0
        total = F.when(up & down, float("nan")).when(up, INFINITY).when(down, -INFINITY).otherwise(F.col("_r")[i])
        out += [total.alias(name), F.col(f"_c{i}").alias(f"{name}_count")]
    out += [F.col(f"_w{i}").alias(name) for i, name in enumerate(wholes)] + [F.col(f"_a{i}").alias(name) for i, name in enumerate(kept)]
    return rounded.select(*out, *([F.col("_g").alias("grouping_bits")] if bits else []))


def mean_of(name: str, digits: int | None = None) -> Column:
    """The mean of a sum of `exact_totals`; null without numbers."""
    mean = F.try_divide(F.col(name), F.col(f"{name}_count").cast("double"))
    return mean if digits is None else F.round(mean, digits)
