"""S9 and §2.9: SQL over the registered views with bound parameters.

Values reach Spark as parameters of the statement and never as its text, so
they stay values whatever they hold. Lists become one named marker per value,
which keeps `IN` a plain predicate that is pushed into scans and prunes
partitions.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def run_sql(spark: SparkSession, statement: str, **parameters) -> DataFrame:
    """`statement` with its `:name` markers bound to `parameters`; a list parameter stands for a list `(:name)`,
    an empty one for a list that holds nothing."""
    args: dict[str, object] = {}
    for name, value in parameters.items():
        if not isinstance(value, (list, tuple, set, frozenset)):
            args[name] = value
            continue
        values = list(value)
        markers = [f"{name}__{i}" for i in range(len(values))]
        args |= dict(zip(markers, values, strict=True))
        inside = ", ".join(f":{m}" for m in markers) or "SELECT NULL WHERE FALSE"
        statement, n = re.subn(rf"\(\s*:{name}\s*\)", f"({inside})", statement)
        if not n:
            raise ValueError(f"a list parameter needs a place of the form (:{name})")
    return spark.sql(statement, args=args)


def select_where(spark: SparkSession, view: str, columns: Sequence[str] | None = None, equal: Mapping[str, object] | None = None,
                 among: Mapping[str, Sequence] | None = None, like: Mapping[str, str] | None = None) -> DataFrame:
    """F4-F6, F10 as SQL over a view: rows of `view` where every column of `equal` has its value, every one of `among`
    one of its values (an empty list filters nothing) and every one of `like` matches its regular expression, in any case.

    Names are checked to be identifiers; all values are bound.
    """
    tests, parameters = [], {}
    for i, (column, value) in enumerate((equal or {}).items()):
        tests.append(f"{_identifier(column)} <=> :equal{i}")
        parameters[f"equal{i}"] = value
    for i, (column, values) in enumerate((among or {}).items()):
        if list(values):
            tests.append(f"{_identifier(column)} IN (:among{i})")
            parameters[f"among{i}"] = list(values)
    for i, (column, pattern) in enumerate((like or {}).items()):
        if pattern:
            tests.append(f"{_identifier(column)} RLIKE concat('(?iu)', :like{i})")
            parameters[f"like{i}"] = pattern
    listed = ", ".join(_identifier(c) for c in columns) if columns else "*"
    where = f" WHERE {' AND '.join(tests)}" if tests else ""
    return run_sql(spark, f"SELECT {listed} FROM {_identifier(view)}{where}", **parameters)


def _identifier(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"not the name of a column or view: {name!r}")
    return f"`{name}`"
