"""Label column functions: return class, class phrase, fuzzy prediction, matches.

All are plain Spark column expressions (JVM side, inside whole-stage codegen).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from mktpanel.functions import fixed


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bin_label(ret) -> Column:
    """Return -> ``U0..U5``, ``U5+``, ``D1..D5``, ``D5+``.

    Up when ``ret >= 0``; magnitude ``ceil(|100 * ret|)``.  NULL, NaN and
    infinite returns give NULL (Spark would call NaN >= 0 true and ceil(NaN) 0,
    so they are guarded first).
    """
    r = _c(ret)
    valid = r.isNotNull() & ~F.isnan(r) & (F.abs(r) != F.lit(float("inf")))
    mag = F.ceil(F.abs(F.lit(100.0) * r))
    direction = F.when(r >= 0, F.lit("U")).otherwise(F.lit("D"))
    size = F.when(mag <= fixed.BIN_CAP, mag.cast("string")).otherwise(F.lit(f"{fixed.BIN_CAP}+"))
    return F.when(valid, F.concat(direction, size))


def bin_phrase(label, variant: str = "v1") -> Column:
    """Class -> phrase (C2).  ``v1``: the correct mapping (``U2`` -> ``up by 1-2%``).
    ``v2``: the chained replacements, kept literally (``U2`` -> ``Up by 0-1%-2%``)."""
    lb = _c(label)
    if variant == "v1":
        table = F.create_map(*[F.lit(x) for kv in fixed.BIN_PHRASE_V1.items() for x in kv])
        return F.element_at(table, lb)
    if variant == "v2":
        return reduce(lambda acc, step: F.replace(acc, F.lit(step[0]), F.lit(step[1])),
                      fixed.BIN_PHRASE_V2_STEPS, lb)
    raise ValueError(f"unknown variant {variant!r}")


def predicted_label(text, strict: bool = False) -> Column:
    """Free-text answer -> class.

    Default (fuzzy) rules: lower-cased substring search for an up word, else a
    down word, else NULL; magnitude from the first ``a-b%`` (lower bound), else
    the first ``a%``, else 1; ``>= 5`` -> ``5+``, else the floor.

    ``strict=True`` reads the ``Prediction: Up|Down by ...`` line the prompt asks
    for and takes the upper bound of a range, rounded up, so it agrees with how
    realised returns are classed.
    """
    t = _c(text)
    if strict:
        line = r"(?i)prediction:\s*(up|down)\s+by\s+(more than 5%|(\d+(\.\d+)?)\s*-\s*(\d+(\.\d+)?)%|(\d+(\.\d+)?)%)"
        word = F.lower(F.regexp_extract(t, line, 1))
        upper = F.coalesce(F.nullif(F.regexp_extract(t, line, 5), F.lit("")),
                           F.nullif(F.regexp_extract(t, line, 7), F.lit(""))).cast("double")
        more = F.lower(F.regexp_extract(t, line, 2)) == F.lit("more than 5%")
        mag = (F.when(more | (upper > fixed.BIN_CAP), F.lit(f"{fixed.BIN_CAP}+"))
                .otherwise(F.ceil(upper).cast("string")))
        d = F.when(word == "up", F.lit("U")).when(word == "down", F.lit("D"))
        return F.when(d.isNotNull() & mag.isNotNull(), F.concat(d, mag))
    low = F.lower(t)
    up = reduce(lambda a, b: a | b, [low.contains(w) for w in fixed.UP_WORDS])
    down = reduce(lambda a, b: a | b, [low.contains(w) for w in fixed.DOWN_WORDS])
    direction = F.when(up, F.lit("U")).when(down, F.lit("D"))
    rng = F.regexp_extract(t, fixed.RANGE_PERCENT, 1)
    single = F.regexp_extract(t, fixed.SINGLE_PERCENT, 1)
    bound = F.when(rng != "", rng).when(single != "", single).cast("double")
    mag = (F.when(bound.isNull(), F.lit(fixed.DEFAULT_MAGNITUDE))
            .when(bound >= fixed.BIN_CAP, F.lit(f"{fixed.BIN_CAP}+"))
            .otherwise(F.floor(bound).cast("string")))
    return F.when(t.isNotNull() & direction.isNotNull(), F.concat(direction, mag))


def direction_match(truth, pred) -> Column:
    """Same first character; NULL on either side is false (C20)."""
    return F.coalesce(F.left(_c(truth), F.lit(1)) == F.left(_c(pred), F.lit(1)), F.lit(False))


def exact_match(truth, pred) -> Column:
    """Equal labels; NULL on either side is false."""
    return F.coalesce(_c(truth) == _c(pred), F.lit(False))
