"""The operators run over the shared test tables, with equivalent SQL for checking."""

from gondola.workload import lake, prices, records

QUERIES = {**prices.QUERIES, **records.QUERIES, **lake.QUERIES}
SQL = {**prices.SQL, **records.SQL, **lake.SQL}
