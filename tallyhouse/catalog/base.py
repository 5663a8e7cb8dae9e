"""A query, its SQL twin and the column types both are compared in."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.session import configure

# code -> (Spark type, SQL type); r<n> is a double rounded to n digits
_TYPES = {
    "i": ("bigint", "BIGINT"),
    "d": ("double", "DOUBLE"),
    "s": ("string", "VARCHAR"),
    "b": ("boolean", "BOOLEAN"),
}


@dataclass(frozen=True)
class Query:
    """``columns`` declares the output: ``"name:code name:code ..."``.

    Codes: i whole number, d double, s text (dates too), b flag, r<n> double
    rounded to n digits.
    """

    name: str
    run: Callable[[SparkSession, str], DataFrame]
    columns: str
    sql: str | None = None

    def declared(self) -> list[tuple[str, str]]:
        return [tuple(c.split(":")) for c in self.columns.split()]

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.run(configure(spark), sf_dir)
        out = []
        for name, code in self.declared():
            c = F.col(f"`{name}`")
            if code[0] == "r":
                c = F.round(c.cast("double"), int(code[1:]))
            else:
                c = c.cast(_TYPES[code][0])
            out.append(c.alias(name))
        return df.select(*out)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        out = []
        for name, code in self.declared():
            if code[0] == "r":
                c = f"ROUND(CAST({name} AS DOUBLE), {code[1:]})"
            else:
                c = f"CAST({name} AS {_TYPES[code][1]})"
            out.append(f"{c} AS {name}")
        return f"SELECT {', '.join(out)} FROM (\n{self.sql.strip()}\n) AS q"
