"""All registered queries."""

from __future__ import annotations


def all_queries():
    _load()
    from warcloom.queries.catalog import QUERIES

    return dict(QUERIES)


def all_oracles():
    _load()
    from warcloom.queries.catalog import ORACLES

    return dict(ORACLES)


def _load():
    from warcloom.queries import graph_queries, page_queries, record_queries, run_queries, table_queries, text_queries  # noqa: F401
