"""Registered queries over the given tables, and the SQL that checks them."""


def load_all() -> None:
    """Import every module that registers queries."""
    from tapeworks.catalog import aggregates, formulas, late, ordered, seconds, serving, storage, streams  # noqa: F401
