"""Association measures from published definitions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def log_dice(f_xy: Column, f_x: Column, f_y: Column) -> Column:
    """14 + log2 of the Dice coefficient (Rychlý 2008)."""
    return F.lit(14.0) + F.log2(F.lit(2.0) * f_xy / (f_x + f_y))


def mutual_information(f_xy: Column, f_x: Column, f_y: Column, n: Column) -> Column:
    """log2 of observed over expected (Church & Hanks 1990)."""
    return F.log2(f_xy * n.cast("double") / (f_x.cast("double") * f_y))


def t_score(f_xy: Column, f_x: Column, f_y: Column, n: Column) -> Column:
    return (f_xy - f_x.cast("double") * f_y / n) / F.sqrt(f_xy.cast("double"))


def log_likelihood(f_xy: Column, f_x: Column, f_y: Column, n: Column) -> Column:
    """Dunning (1993) over the 2x2 table; a cell that is not positive adds nothing.

    With a span wider than one token, pairs can outnumber hits.
    """
    x, y, total = f_x.cast("double"), f_y.cast("double"), n.cast("double")
    cells = [
        (f_xy.cast("double"), x * y / total),
        (x - f_xy, x * (total - y) / total),
        (y - f_xy, (total - x) * y / total),
        (total - x - y + f_xy, (total - x) * (total - y) / total),
    ]
    terms = [
        F.when((o > 0) & (e > 0), o * F.ln(o / e)).otherwise(F.lit(0.0)) for o, e in cells
    ]
    return F.lit(2.0) * (terms[0] + terms[1] + terms[2] + terms[3])


def simple_maths(fpm_focus: Column, fpm_reference: Column, k: float) -> Column:
    """Keyness ratio (Kilgarriff 2009)."""
    return (fpm_focus + k) / (fpm_reference + k)
