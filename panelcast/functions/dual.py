"""One expression text, two engines.

Numeric kernels (normal equations, Cholesky, HAC sums, ARMA recursions)
are written once as SQL expression text over a relation:

* ``SparkRel`` applies them to a DataFrame with ``F.expr`` (ordinary
  Catalyst expressions and windows, one projection per stage);
* ``SqlRel`` nests the same text for DuckDB, which is the correctness oracle.

Only the few spellings that differ between the engines go through
``dialect``.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.linalg import Stage, div, sweeper, swept, swept_path  # noqa: F401  (div: for the operators)



class _TextRel:
    dialect = ""

    def _new(self, sql: str):
        raise NotImplementedError

    def stages(self, stages: Sequence[Stage]):
        q = self.body
        for st in stages:
            q = f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in st)} FROM ({q})"
        return self._new(q)

    def filter(self, cond: str):
        return self._new(f"SELECT * FROM ({self.body}) WHERE {cond}")

    def select(self, cols: Sequence[tuple[str, str]]):
        from panelcast.plans.sqlbits import rewrite_round
        return self._new(f"SELECT {', '.join(f'{rewrite_round(e)} AS {n}' for n, e in cols)} FROM ({self.body})")

    def group(self, keys: Sequence[str], aggs: Sequence[tuple[str, str]]):
        sel = ", ".join(list(keys) + [f"{e} AS {n}" for n, e in aggs])
        gb = f" GROUP BY {', '.join(keys)}" if keys else ""
        return self._new(f"SELECT {sel} FROM ({self.body}){gb}")

    def join(self, other, on: Sequence[str], how: str = "inner"):
        kind = {"inner": "JOIN", "left": "LEFT JOIN", "full": "FULL OUTER JOIN"}[how]
        return self._new(f"SELECT * FROM ({self.body}) {kind} ({other.body}) USING ({', '.join(on)})", other)

    def union_all(self, others: Sequence):
        q = " UNION ALL ".join(f"SELECT * FROM ({r.body})" for r in [self, *others])
        out = self
        for o in others:
            out = out._new(out.body, o)
        return out._new(q)


class SparkRel:
    """Applies expression text to a DataFrame, one projection per stage.

    (Building one nested ``spark.sql`` text instead was measured slower:
    the parser and analyzer struggle with hundreds of nested sub-selects.)
    """
    dialect = "spark"

    def __init__(self, df: DataFrame):
        self.df = df

    def stages(self, stages: Sequence[Stage]) -> "SparkRel":
        # one selectExpr per stage: the JVM parses all expressions of the
        # stage in one call (F.expr per expression costs a Py4J round trip)
        df = self.df
        for st in stages:
            new = {n for n, _ in st}
            keep = [f"`{c}`" for c in df.columns if c not in new]
            df = df.selectExpr(*keep, *[f"{e} AS `{n}`" for n, e in st])
        return SparkRel(df)

    def filter(self, cond: str) -> "SparkRel":
        return SparkRel(self.df.filter(cond))

    def drop(self, names: Sequence[str]) -> "SparkRel":
        gone = set(names)
        return SparkRel(self.df.select(*[f"`{c}`" for c in self.df.columns if c not in gone]))

    def replace(self, gone: Sequence[str], new: Sequence[tuple[str, str]]) -> "SparkRel":
        """One projection that computes columns and lets go of those they used up."""
        gone = {*gone, *(n for n, _ in new)}
        return SparkRel(self.df.selectExpr(*[f"`{c}`" for c in self.df.columns if c not in gone], *[f"{e} AS `{n}`" for n, e in new]))

    def select(self, cols: Sequence[tuple[str, str]]) -> "SparkRel":
        from panelcast.plans.sqlbits import rewrite_round
        return SparkRel(self.df.selectExpr(*[f"{rewrite_round(e)} AS `{n}`" for n, e in cols]))

    def group(self, keys: Sequence[str], aggs: Sequence[tuple[str, str]]) -> "SparkRel":
        # all aggregates in one expression text: the JVM parses them in one call
        fields = ", ".join(f"'{n}', {e}" for n, e in aggs)
        grouped = self.df.groupBy(*keys).agg(F.expr(f"named_struct({fields})").alias("_g"))
        return SparkRel(grouped.select(*keys, "_g.*"))

    def swept(self, a: str, out: str, pivots: int, n: int, kept: Sequence[int] = ()) -> "SparkRel":
        """The packed systems ``a`` give way to ``out``: swept, batch by batch; with ``kept``, those places after each
        pivot in one array. A system with nulls takes the expression, which carries them along."""
        text = swept(a, pivots, n)
        if kept:
            names = {f"k{i}": at for i, at in enumerate(kept)}
            text = f"flatten(transform({swept_path(a, pivots, n, names)}, z -> array({', '.join(f'z.{x}' for x in names)})))"
        raw = f"{out}_batch"
        df = self.df.withColumn(raw, sweeper(pivots, n, tuple(kept))(a))
        return SparkRel(df).replace([a, raw], [(out, f"CASE WHEN exists({a}, v -> v IS NULL) THEN {text} ELSE {raw} END")])

    def explode(self, name: str, array_expr: str) -> "SparkRel":
        return SparkRel(self.df.withColumn(name, F.explode(F.expr(array_expr))))

    def join(self, other: "SparkRel", on: Sequence[str], how: str = "inner") -> "SparkRel":
        return SparkRel(self.df.join(other.df, on=list(on), how=how))

    def union_all(self, others: Sequence["SparkRel"]) -> "SparkRel":
        out = self.df
        for o in others:
            out = out.unionByName(o.df)
        return SparkRel(out)

    def int_range(self, lo: int, hi: int) -> str:
        """Array literal lo..hi inclusive."""
        return f"sequence({int(lo)}, {int(hi)})"

    def share(self) -> "SparkRel":
        """A relation that is read twice: Spark reuses its exchange."""
        return self


class SqlRel(_TextRel):
    """Nested SELECT text; relations that are read twice are named once (``share``)."""
    dialect = "duckdb"
    _names = itertools.count()

    def __init__(self, body: str, shared: tuple[tuple[str, str], ...] = ()):
        self.body, self.shared = body, shared

    @property
    def sql(self) -> str:
        named = ", ".join(f"{n} AS MATERIALIZED ({q})" for n, q in self.shared)
        return f"WITH {named} {self.body}" if named else self.body

    def _new(self, sql: str, other=None) -> "SqlRel":
        more = other.shared if other is not None else ()
        return SqlRel(sql, tuple(dict([*self.shared, *more]).items()))

    def share(self) -> "SqlRel":
        name = f"shared_{next(self._names)}"
        return SqlRel(f"SELECT * FROM {name}", (*self.shared, (name, self.body)))

    def explode(self, name: str, array_expr: str) -> "SqlRel":
        return self._new(f"SELECT *, unnest({array_expr}) AS {name} FROM ({self.body})")

    def drop(self, names: Sequence[str]) -> "SqlRel":
        return self._new(f"SELECT * EXCLUDE ({', '.join(names)}) FROM ({self.body})")

    def int_range(self, lo: int, hi: int) -> str:
        return f"range({int(lo)}, {int(hi) + 1})"


def win(keys: Sequence[str], order: str | None = None, frame: str = "") -> str:
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    o = f" ORDER BY {order}" if order else ""
    return f"OVER ({part}{o} {frame})".replace("  ", " ")
