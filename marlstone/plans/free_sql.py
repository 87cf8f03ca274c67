"""Free SQL under row rules: every name of a dataset means the rows its reader may see.

The datasets stand before the text as common table expressions over their
filtered rows, so a name means the same in joins, subqueries, set operations
and the text's own table expressions, under any alias.  Which relations a text
names is read from the plan that Spark parses out of it, before anything runs;
a relation that is neither a dataset nor one of the text's own is refused, and
so are paths, names of a catalog, and anything that is no query.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from .request import Dataset, RequestError

_COMMENT = re.compile(r"\s*(?:--[^\n]*(?:\n|$)|/\*.*?\*/)", re.DOTALL)
_WITH = re.compile(r"\s*WITH(?:\s+(RECURSIVE))?\b", re.IGNORECASE)
#: Names that are made while the text is analysed, and programs run beside it.
_HIDDEN = ("UnresolvedIdentifier", "ScriptTransformation")


def relations(spark: SparkSession, text: str) -> tuple[set[str], set[str]]:
    """Names that a query reads, and names of the table expressions that it makes.

    Both come from what Spark explains.  A text literal that is written like a
    relation counts as one; it can make a query refused, never let one through.
    """
    try:
        # Only a query can stand in parentheses.
        explained = spark.sql(f"EXPLAIN EXTENDED SELECT * FROM (\n{text}\n)").first()[0]
    except ParseException as error:
        raise RequestError("only a query can be run") from error
    if "== Parsed Logical Plan ==" not in explained:
        raise RequestError("the query cannot be read")
    if any(h in explained for h in _HIDDEN):
        raise RequestError("relations have to be named in the text")

    def names(pattern: str) -> set[str]:
        return {n.strip().lower() for n in re.findall(pattern, explained)}

    made = {n.strip() for listed in names(r"CTE \[([^\]]*)\]") for n in listed.split(",")}
    return names(r"UnresolvedRelation \[([^\]]*)\]"), made


def run_free_sql(spark: SparkSession, text: str, datasets: Mapping[str, Dataset]) -> DataFrame:
    """Run one query over ``datasets`` by name, each with the rows that its rules and roles leave.

    Names are those of ``datasets``, in any case.  Refused are other relations,
    names given by a catalog, paths, statements that are no queries, and table
    expressions that take the name of a dataset or of a table that is there
    already: outside of its scope such a name would mean the table.
    """
    body = text.strip().rstrip(";").strip()
    while match := _COMMENT.match(body):
        body = body[match.end() :].lstrip()
    known = {n.lower() for n in datasets}
    read, made = relations(spark, body)
    unknown = read - made - known
    if unknown:
        raise RequestError(f"unknown relations: {', '.join(sorted(unknown))}")
    taken = (made & known) | {n for n in made if n.isidentifier() and spark.catalog.tableExists(n)}
    if taken:
        raise RequestError(f"names are taken: {', '.join(sorted(taken))}")
    named = {f"rows_{i}": d.df for i, d in enumerate(datasets.values())}
    heads = ", ".join(f"`{n}` AS (SELECT * FROM {{{p}}})" for n, p in zip(datasets, named))
    rest = body.replace("{", "{{").replace("}", "}}")
    own = _WITH.match(rest)
    head = f"WITH {own.group(1) or ''} {heads}, {rest[own.end() :]}" if own else f"WITH {heads} {rest}"
    return spark.sql(head, **named)
