"""Named queries over the given tables, each with SQL that checks it where SQL can express it."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from . import views

QUERIES: dict[str, "Query"] = {}
DERIVED: dict[str, tuple[str, tuple[str, ...]]] = {}


class Inputs:
    """The given tables and views of one folder, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        return self.once(name, lambda: views.view(self.spark, self.sf_dir, name))

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A plan that several parts of a query share, built once."""
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Inputs], DataFrame]
    sql: str | None
    needs: tuple[str, ...]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Inputs(spark, sf_dir))

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        parts = with_parts(self.needs)
        head = ",\n".join(f"{name} as ({text})" for name, text in parts)
        text = self.sql.strip()
        if not parts:
            return text
        if text.startswith("with "):
            return f"with {head},\n{text[len('with '):]}"
        return f"with {head}\n{text}"


def with_parts(needs) -> list[tuple[str, str]]:
    """CTEs in dependency order: reshaped inputs first, then derived tables."""
    out: dict[str, str] = {}

    def add(name: str) -> None:
        if name in out:
            return
        if name in DERIVED:
            text, inner = DERIVED[name]
            for other in inner:
                add(other)
            out[name] = text
        else:
            out.update({k: v for k, v in views.oracle_views(name) if k not in out})

    for name in needs:
        add(name)
    return list(out.items())


def derived(name: str, text: str, *needs: str) -> None:
    """A table in the checking SQL, built from `needs`."""
    DERIVED[name] = (text, needs)


def query(name: str, sql: str | None = None, needs: tuple[str, ...] | list[str] = ()):
    def register(build):
        QUERIES[name] = Query(name, build, sql, tuple(needs))
        return build

    return register


def rounded(expr: str, places: int) -> str:
    """Half-up rounding of a double's shortest decimal text, the way Spark rounds doubles."""
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38, 18)), {places}) as double)"
