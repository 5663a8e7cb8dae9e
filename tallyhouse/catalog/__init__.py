"""Named queries: each a Spark job with, where SQL can say it, a SQL twin."""

from tallyhouse.catalog.base import Query


def all_queries() -> list[Query]:
    from tallyhouse.catalog import cleaning, loads, quality, relational, reports, scans

    out: list[Query] = []
    for module in (reports, relational, cleaning, loads, scans, quality):
        out.extend(module.QUERIES)
    names = [q.name for q in out]
    assert len(names) == len(set(names)), "query names must be unique"
    return out
