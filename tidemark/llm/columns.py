"""Operators that carry a caller's columns along, whatever their names."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame


def set_aside(names: list[str]) -> dict[str, str]:
    """Other names for columns that might clash with an operator's own: those that begin with an underscore, or hold a dot or a quote."""
    taken = {name.lower() for name in names}
    odd = [name for name in names if name.startswith("_") or "." in name or "`" in name]
    free = (f"aside_{n}" for n in range(len(names) + len(odd)))
    return dict(zip(odd, (name for name in free if name not in taken)))


def carries_columns(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators that return the columns of their first argument beside their own.

    An operator's working columns begin with an underscore.  Columns of the
    caller that do so too, or whose names need quoting, have other names while
    it works and come back under their own.
    """

    @wraps(operator)
    def run(docs: DataFrame, *args, keep: list[str] | None = None, **more) -> DataFrame:
        aside = set_aside(docs.columns)
        if keep is not None:
            more["keep"] = [aside.get(name, name) for name in keep]
        if not aside:
            return operator(docs, *args, **more)
        out = operator(docs.toDF(*[aside.get(name, name) for name in docs.columns]), *args, **more)
        back = {other: name for name, other in aside.items()}
        return out.toDF(*[back.get(name, name) for name in out.columns])

    return run
