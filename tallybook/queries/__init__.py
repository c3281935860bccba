"""Every operator as a query on the given tables, with equivalent SQL."""

from tallybook.queries import bars, changes, measures, pages, passes, sinks, statements, streams

_MODULES = (changes, measures, bars, pages, sinks, streams, statements, passes)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
