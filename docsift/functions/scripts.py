"""Scripts: inline Spark SQL expressions with parameters, and named scripts.

A script is a SQL expression string.  ``params.<name>`` is replaced by a literal,
and special variables (``_score``, ``_value``, ``doc``-free field names) are
bound to Columns by the caller.  Named (stored) scripts live in a registry;
their body is a SQL string or a Python callable returning a Column.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any, Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_REGISTRY: dict[str, Any] = {}


def register_script(name: str, body: "str | Callable[..., Column]") -> None:
    _REGISTRY[name] = body


def _sql_literal(v: Any) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    if v is None:
        return "NULL"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Script:
    source: str | None = None
    params: dict = field(default_factory=dict)
    id: str | None = None
    lang: str = "sql"

    def body(self):
        if self.id is not None:
            if self.id not in _REGISTRY:
                raise KeyError(f"unknown stored script {self.id}")
            return _REGISTRY[self.id]
        return self.source

    def sql(self) -> str:
        src = self.body()
        if not isinstance(src, str):
            raise TypeError("script body is a callable")
        return re.sub(r"\bparams\.([A-Za-z_][A-Za-z0-9_]*)", lambda m: _sql_literal(self.params[m.group(1)]), src)

    def over_elements(self, array: str) -> Column:
        """The script applied to each element of the array column ``array`` (as ``_value``)."""
        src = self.body()
        if callable(src):
            return F.transform(F.col(array), lambda x: src(x, **self.params))
        return F.expr(f"transform(`{array}`, _value -> ({self.sql()}))")

    def column(self, bindings: dict[str, str] | None = None) -> Column:
        """Column of the script.  ``bindings`` renames variables (``_score``) to column names."""
        src = self.body()
        if callable(src):
            return src(**self.params)
        s = self.sql()
        for k, v in (bindings or {}).items():
            s = re.sub(r"(?<![A-Za-z0-9_`])" + re.escape(k) + r"(?![A-Za-z0-9_])", f"`{v}`", s)
        return F.expr(s)


def as_script(v: Any) -> Script:
    if isinstance(v, Script):
        return v
    return Script(source=v)
