"""All queries by name."""

import importlib

MODULES = ["panel_queries", "audit_queries", "cleaning_queries", "run_queries", "page_queries", "job_queries", "store_queries"]


def _merged(part: str) -> dict:
    merged = {}
    for name in MODULES:
        found = getattr(importlib.import_module(f"workload.{name}"), part)
        clash = merged.keys() & found.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        merged.update(found)
    return merged


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLES")
