"""Every operator run over the given tables, each with its SQL where SQL can say it."""

import importlib
import pkgutil


def load():
    """Import all catalog modules and return the registry."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    return importlib.import_module(f"{__name__}.registry")
