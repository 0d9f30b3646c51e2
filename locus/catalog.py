"""All queries by name, and their DuckDB SQL where SQL can express them: a plan NAME of a module has its SQL in the constant NAME."""

from __future__ import annotations

from .plans import content, documents, entities, listings, menus, merging, reports, texts

QUERIES = {}
ORACLES = {"place_dedupe": merging.PLACE_DEDUPE_SQL}
for _module in (reports, entities, documents, menus, listings, merging, content, texts):
    for _name, _plan in list(vars(_module).items()):
        if callable(_plan) and getattr(_plan, "__module__", "") == _module.__name__ and not _name.startswith("_"):
            QUERIES[_name] = _plan
            if isinstance(getattr(_module, _name.upper(), None), str):
                ORACLES[_name] = getattr(_module, _name.upper())
