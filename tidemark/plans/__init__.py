"""Input views, registered queries and their SQL."""

from importlib import import_module
from pkgutil import iter_modules


def load() -> None:
    """Import every module of queries, so that it registers them."""
    for module in iter_modules(__path__):
        if module.name.startswith("q_"):
            import_module(f"{__name__}.{module.name}")
