"""The registered queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from diffloom.llm import queries as Q
from diffloom.llm.oracles import ORACLES

QUERIES = {name: query for name, query in vars(Q).items() if name.startswith("op")}


def queries():
    return dict(sorted(QUERIES.items(), key=lambda item: int(item[0][2:].split("_")[0])))


def oracle_sql():
    return dict(ORACLES)
