"""Table-name quoting per source dialect, as a Python helper and as a column expression.

Dotted names (``schema.table``) are passed through unchanged; Oracle names are upper-cased and
double-quoted; MySQL / MariaDB names get backticks; all other dialects use the bare name.
Column names are quoted by Spark's own JDBC dialects, so only the ``dbtable`` string is built here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablelift.sources.drivers import canonical_driver


def quote_table_name(table: str, driver: str) -> str:
    kind = canonical_driver(driver)
    if "." in table or table.lstrip().startswith("("):  # dotted names and derived tables pass through
        return table
    if kind == "oracle":
        return '"' + table.upper() + '"'
    if kind == "mysql":
        return "`" + table + "`"
    return table


def quote_table_name_col(table: Column, driver: str) -> Column:
    kind = canonical_driver(driver)
    if kind == "oracle":
        quoted = F.concat(F.lit('"'), F.upper(table), F.lit('"'))
    elif kind == "mysql":
        quoted = F.concat(F.lit("`"), table, F.lit("`"))
    else:
        quoted = table
    return F.when(F.instr(table, ".") > 0, table).otherwise(quoted)


def target_name(table: str) -> str:
    """Output file stem for a source table: last dotted part, lower case (``system.T`` -> ``t``)."""
    return table.rsplit(".", 1)[-1].strip('"`[]').lower()
