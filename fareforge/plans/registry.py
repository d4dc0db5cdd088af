"""Query registry: a name, a Spark plan over (spark, sf_dir), and the SQL that must give the same rows."""
from .oracle_views import BASE

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = f"WITH {BASE}\n{sql.strip()}"
        return fn
    return register


def rnd(expr: str, digits: int = 4) -> str:
    return f"floor(({expr}) * 1e{digits} + 0.500001) / 1e{digits}"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def pct(part: str, whole: str, digits: int = 4) -> str:
    return f"coalesce({rnd(f'({part}) * 100.0 / nullif({whole}, 0)', digits)}, 0.0)"
