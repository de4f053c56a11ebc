"""Driver names and their aliases (both the documented and the sample-config spellings)."""

from __future__ import annotations

# fixed values: accepted driver spellings -> canonical driver kind
DRIVER_ALIASES = {
    "postgres": "postgres",
    "postgresql": "postgres",
    "pgx": "postgres",
    "mysql": "mysql",
    "mariadb": "mysql",
    "sqlite": "sqlite",
    "sqlite3": "sqlite",
    "oracle": "oracle",
    "go-ora": "oracle",
    "mssql": "mssql",
    "sqlserver": "mssql",
    # file-backed sources: a directory of Parquet tables, or tables of the Spark catalog
    "parquet": "parquet",
    "catalog": "catalog",
}

JDBC_KINDS = ("postgres", "mysql", "oracle", "mssql")


def canonical_driver(driver: str) -> str:
    key = (driver or "").strip().lower()
    if key not in DRIVER_ALIASES:
        raise ValueError(f"E002 unsupported driver {driver!r}")
    return DRIVER_ALIASES[key]
