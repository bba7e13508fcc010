"""Edit distance with adjacent transposition (restricted / optimal string
alignment, Damerau 1964), in code points, as a Spark SQL expression.

The DP runs row by row in nested ``aggregate`` calls over character arrays
(computed once per pair), so it stays JVM-side. It is only evaluated on
pairs that survive the cheap prefilter of ``fuzzy``: equal length bucket and
``levenshtein(a, b, 2d) >= 0`` (transposition distance <= d implies plain
Levenshtein <= 2d).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BIG = 1_000_000


def chars(col: Column) -> Column:
    """Code points of a string as ARRAY<STRING>."""
    return F.regexp_extract_all(col, F.lit("(?s)."), 0)


def osa_distance(ca: str, cb: str) -> Column:
    """Distance between two character arrays held in columns ``ca``, ``cb``
    (both non-empty)."""
    expr = f"""
    aggregate(
      sequence(1, size({ca})),
      named_struct('p2', cast(array() as array<int>), 'p1', sequence(0, size({cb}))),
      (st, i) -> named_struct(
        'p2', st.p1,
        'p1', aggregate(
          sequence(1, size({cb})),
          array(i),
          (cur, j) -> concat(cur, array(least(
            st.p1[j] + 1,
            cur[j - 1] + 1,
            st.p1[j - 1] + IF({ca}[i - 1] = {cb}[j - 1], 0, 1),
            IF(i > 1 AND j > 1,
               IF({ca}[i - 1] = {cb}[j - 2] AND {ca}[i - 2] = {cb}[j - 1], st.p2[j - 2] + 1, {_BIG}),
               {_BIG})
          )))
        )
      ),
      st -> st.p1[size({cb})]
    )"""
    return F.expr(expr)
