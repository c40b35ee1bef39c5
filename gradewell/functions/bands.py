"""Fold band and pattern tables into native CASE expressions.

Columns are given by name. The CASE is handed over as one expression: built from Column objects, a dozen
rules cost thousands of calls to the JVM before a query starts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from gradewell.params import Band, ScoreParams


def _inside(band: Band, value: str, scale: str | None) -> str:
    unit = "" if scale is None else f"{scale} * "
    tests = []
    if band.low is not None:
        tests.append(f"{value} {'>=' if band.closed in ('both', 'left') else '>'} {unit}{band.low}")
    if band.high is not None:
        tests.append(f"{value} {'<=' if band.closed in ('both', 'right') else '<'} {unit}{band.high}")
    return " and ".join(tests)


def _case(branches: Iterable[tuple[str, int | str]], otherwise: int | None = None) -> Column:
    whens = " ".join(f"when {test} then {result}" for test, result in branches)
    last = "" if otherwise is None else f"else {otherwise}"
    return F.expr(f"case {whens} {last} end")


def _level(params: ScoreParams, name: str | None) -> int | None:
    return None if name is None else params.level(name)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def band_points(bands: Iterable[Band], value: str, params: ScoreParams, scale: str | None = None,
                null_test: str | None = None, otherwise: str | None = None) -> Column:
    """Points of the first band that holds `value`; `null_test` is what `or_null` bands look at."""
    branches = []
    for band in bands:
        test = _inside(band, value, scale)
        if band.or_null:
            test = f"({test}) or {null_test or value} is null"
        branches.append((test, params.level(band.level)))
    return _case(branches, _level(params, otherwise))


def pattern_points(patterns: Iterable[tuple[str, str]], text: str, params: ScoreParams,
                   otherwise: str | None = None) -> Column:
    """Points of the first LIKE pattern that the lower-cased text matches."""
    branches = [(f"lower({text}) like {_text(pattern)}", params.level(level)) for pattern, level in patterns]
    return _case(branches, _level(params, otherwise))


def grade_points(grade: str, sub_grade: str, levels: dict[str, str], params: ScoreParams,
                 otherwise: str | None = None) -> Column:
    """Points of a lender grade, given only where the sub-grade belongs to it: the letter and 1 to 5."""
    branches = []
    for letter, level in levels.items():
        steps = ", ".join(f"'{letter}{step}'" for step in range(1, 6))
        branches.append((f"{grade} = '{letter}' and {sub_grade} in ({steps})", params.level(level)))
    return _case(branches, _level(params, otherwise))


def letter_grade(total: str, params: ScoreParams, half_open: bool = True) -> Column:
    """A+ to F from the total. Closed bands end one point below the next cut and leave a gap for fractions."""
    cuts = [
        ("B", params.good_grade, params.very_good_grade),
        ("C", params.bad_grade, params.good_grade),
        ("D", params.very_bad_grade, params.bad_grade),
        ("E", params.unacceptable_grade, params.very_bad_grade),
    ]
    branches = [(f"{total} >= {params.very_good_grade}", "'A+'")]
    for letter, low, high in cuts:
        upper = f"{total} < {high}" if half_open else f"{total} <= {high - 1}"
        branches.append((f"{total} >= {low} and {upper}", f"'{letter}'"))
    branches.append((f"{total} < {params.unacceptable_grade}", "'F'"))
    return _case(branches)
