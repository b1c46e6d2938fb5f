"""The same results as plain SQL over the given tables, for checking."""

from peerbench.oracle.base import statement
from peerbench.oracle.statements import QUERIES


def sql_by_key() -> dict[str, str]:
    """One self-contained statement per query key."""
    return {key: statement(body) for key, body in QUERIES.items()}
