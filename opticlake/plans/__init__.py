from importlib import import_module

MODULES = ["collection", "extraction", "values", "relations", "trends", "storage", "streams", "runs"]


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
