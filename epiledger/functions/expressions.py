"""Metrics that a user writes as arithmetic over columns."""

from __future__ import annotations

import ast
import math
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONGEST = 1000  # characters of an expression


def _ratio(a: Column, b: Column) -> Column:
    return a / F.when(b != 0, b)


_BINARY: dict[type, Callable[[Column, Column], Column]] = {
    ast.Add: lambda a, b: a + b,
    ast.Sub: lambda a, b: a - b,
    ast.Mult: lambda a, b: a * b,
    ast.Div: _ratio,
}

# name: least and most arguments, function.
_CALLS: dict[str, tuple[int, int, Callable[..., Column]]] = {
    "abs": (1, 1, F.abs),
    "sqrt": (1, 1, lambda a: F.sqrt(F.when(a >= 0, a))),
    "ln": (1, 1, lambda a: F.ln(F.when(a > 0, a))),
    "coalesce": (1, 20, F.coalesce),
    "least": (2, 20, F.least),
    "greatest": (2, 20, F.greatest),
}


def metric_expression(text: str, columns: Iterable[str]) -> Column:
    """The expression as a double column.

    Allowed are names of ``columns``, finite numbers, ``+ - * /``, signs, brackets, and the functions ``abs``,
    ``sqrt``, ``ln``, ``coalesce``, ``least`` and ``greatest``; anything else is a ``ValueError``, raised before
    a job starts.  Division by zero, the root of a negative and the logarithm of what is not positive
    are null; a null operand makes a result null, but ``coalesce``, ``least`` and ``greatest`` pass over nulls.
    """
    if len(text) > LONGEST:
        raise ValueError(f"an expression has at most {LONGEST} characters")
    try:
        tree = ast.parse(text.strip(), mode="eval")
    except (SyntaxError, ValueError, RecursionError, MemoryError) as broken:
        raise ValueError(f"not an expression: {text!r}") from broken
    known = set(columns)

    def column(node: ast.AST) -> Column:
        match node:
            case ast.Constant(value=bool()):
                raise ValueError(f"not a number: {node.value!r}")
            case ast.Constant(value=int() | float() as value) if abs(value) < 1e300:
                return F.lit(float(value))
            case ast.Name(id=name):
                if name not in known:
                    raise ValueError(f"unknown column {name!r}; there are {sorted(known)}")
                return F.col(f"`{name}`").cast("double")
            case ast.UnaryOp(op=ast.USub(), operand=inner):
                return -column(inner)
            case ast.UnaryOp(op=ast.UAdd(), operand=inner):
                return column(inner)
            case ast.BinOp(left=left, op=op, right=right) if type(op) in _BINARY:
                return _BINARY[type(op)](column(left), column(right))
            case ast.Call(func=ast.Name(id=name), args=args, keywords=[]) if name in _CALLS:
                least, most, function = _CALLS[name]
                if not least <= len(args) <= most:
                    raise ValueError(f"{name} takes {least} to {most} arguments")
                return function(*[column(a) for a in args])
        raise ValueError(f"not allowed in a metric: {ast.unparse(node)!r}")

    return column(tree.body)


def with_metric(df: DataFrame, name: str, text: str) -> DataFrame:
    """The frame with one more column computed by :func:`metric_expression`; results that are no number are null."""
    value = metric_expression(text, df.columns)
    finite = ~F.isnan(value) & (F.abs(value) < F.lit(math.inf))
    return df.withColumn(name, F.when(finite, value))
