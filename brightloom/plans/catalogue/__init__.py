"""Every operator bound to the given tables, with the SQL that must give the same rows."""

from brightloom.plans.catalogue import clusters, messages, metrics, sentiment, streams, tables, texts
from brightloom.plans.catalogue.registry import Query

QUERIES: dict[str, Query] = {}
for module in (texts, tables, metrics, sentiment, clusters, messages, streams):
    for name, query in module.register.items():
        if name in QUERIES:
            raise ValueError(f"query {name} is defined twice")
        QUERIES[name] = query
