"""Queries over the test tables, each with the SQL that must give the same rows."""

from importlib import import_module

MODULES = ("intervals", "reads", "alignment", "counting", "files", "awkward")


def load():
    """All registered queries by name."""
    for module in MODULES:
        import_module(f".{module}", __name__)
    return dict(import_module(".catalog", __name__).QUERIES)
