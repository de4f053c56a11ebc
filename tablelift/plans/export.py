"""Export jobs: spec, checks, and the runner that turns each table into one Spark job.

One table export is one Catalyst plan with no shuffle: scan (partitioned) -> conform (one
projection) -> write (one file per task) into a staging directory, then an atomic swap. Rows and
reject counts come from ``observe`` on that same job. Tables run concurrently as separate Spark
jobs submitted from ``workers`` driver threads; a failing table is reported and skipped, and
publishes nothing. A connection that fails before any export aborts the run (E002).

Error codes: E001 job spec, E002 connection, E003 SQL / read, E004 type mapping, E005 write,
E006 other task failure.
"""

from __future__ import annotations

import copy
import hashlib
import json
import re
import threading
import time
import tomllib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.functions.quoting import target_name
from tablelift.functions.types import sql_type_name
from tablelift.operators.conform import conform
from tablelift.sinks.parquet import write_parquet
from tablelift.sinks.publish import Publisher, VersionedPublisher, resolve_output
from tablelift.sources.arrow_ipc import write_arrow
from tablelift.sources.drivers import DRIVER_ALIASES, JDBC_KINDS, canonical_driver
from tablelift.streaming.batches import batch_options, fetch_rows

FORMATS = {"parquet": ".parquet", "arrow": ".arrow"}

REPORT_SCHEMA = (
    "task string, db string, table_name string, target string, format string, status string, "
    "rows long, seconds double, error_code string, error string, rejects map<string,long>, finished_at string, "
    "scan_partitions int, published string, unit_key string, source_key string, output_stamp long"
)
PUBLISH_MODES = ("swap", "versioned")
RESUME_MODES = ("off", "unchanged", "done")


class JobSpecError(ValueError):
    """E001: the job spec is invalid; raised before any Spark job runs."""


@dataclass
class GlobalSpec:
    workers: int = 4
    batch_size: int = 10000
    default_format: str = "parquet"
    output_dir: str = "./output"
    overwrite: bool = False
    max_rows_per_file: int | None = None  # Parquet: roll output files within a task (bounds file size)
    narrow: str = "null"  # integer narrowing: "null" (overflow -> NULL, counted) or "wrap" (two's complement)
    publish: str = "swap"  # "swap" (rename staging over the target) or "versioned" (commit records; object stores)
    batch_bytes: int | None = None  # also bounds row groups, record batches and round trips by bytes
    resume: str = "off"  # keep the outputs that the stored run log lists: "unchanged" sources only, or all that are "done"

    def with_defaults(self) -> "GlobalSpec":
        return GlobalSpec(
            workers=self.workers if self.workers and self.workers > 0 else 4,
            batch_size=self.batch_size if self.batch_size and self.batch_size > 0 else 10000,
            default_format=self.default_format or "parquet",
            output_dir=self.output_dir or "./output",
            overwrite=bool(self.overwrite),
            max_rows_per_file=self.max_rows_per_file if self.max_rows_per_file and self.max_rows_per_file > 0 else None,
            narrow=self.narrow or "null",
            batch_bytes=self.batch_bytes if self.batch_bytes and self.batch_bytes > 0 else None,
            publish=self.publish or "swap",
            resume=self.resume or "off",
        )


@dataclass
class DatabaseSpec:
    name: str
    driver: str
    dsn: str
    options: dict = field(default_factory=dict)
    max_open_conns: int | None = None  # JDBC: most key ranges of one scan, each of which holds a connection
    max_idle_conns: int | None = None  # accepted; a task's connection closes with the task


@dataclass
class TaskSpec:
    db: str
    tables: list[str] = field(default_factory=list)
    query: str = ""
    output: str = ""
    format: str = ""
    name: str = ""
    partition_column: dict[str, str] | str | None = None
    skewed: bool = False


def _record(kind: type, given: dict, at: str, wrong: list[str]):
    """A spec record from its table; keys that it doesn't have are noted in ``wrong``."""
    fields = kind.__dataclass_fields__
    wrong += [f"{at} {key}: unknown key" for key in given if key not in fields]
    blank = {k: "" for k in ("name", "driver", "dsn", "db") if k in fields}
    return kind(**blank | {k: v for k, v in given.items() if k in fields})


def _refuse(wrong: list[str]) -> None:
    if wrong:
        raise JobSpecError("E001 " + "; ".join(wrong))


@dataclass
class ExportJob:
    global_: GlobalSpec = field(default_factory=GlobalSpec)
    databases: list[DatabaseSpec] = field(default_factory=list)
    tasks: list[TaskSpec] = field(default_factory=list)

    @classmethod
    def from_dict(cls, d: dict) -> "ExportJob":
        wrong: list[str] = []
        job = cls(_record(GlobalSpec, d.get("global") or {}, "[global]", wrong).with_defaults(),
                  [_record(DatabaseSpec, db, f"[[databases]] {k}", wrong) for k, db in enumerate(d.get("databases", []), 1)],
                  [_record(TaskSpec, t, f"[[tasks]] {k}", wrong) for k, t in enumerate(d.get("tasks", []), 1)])
        wrong += [f"unknown section {key!r}" for key in d if key not in ("global", "databases", "tasks")]
        _refuse(wrong + job.problems())
        return job

    @classmethod
    def from_toml(cls, path: str) -> "ExportJob":
        try:
            with open(path, "rb") as f:
                d = tomllib.load(f)
        except (OSError, tomllib.TOMLDecodeError) as e:
            raise JobSpecError(f"E001 cannot load job spec {path}: {e}") from e
        return cls.from_dict(d)

    def database(self, name: str) -> DatabaseSpec:
        for db in self.databases:
            if db.name == name:
                return db
        raise JobSpecError(f"E001 unknown database {name!r}")

    def validate(self) -> None:
        """Refuse the job, before any data is read, with everything that is wrong in it."""
        self.global_ = self.global_.with_defaults()
        _refuse(self.problems())

    def problems(self) -> list[str]:
        """Every violation of the spec, each with its place and key."""
        g = self.global_
        allowed = [("default_format", tuple(FORMATS)), ("narrow", ("null", "wrap")), ("publish", tuple(PUBLISH_MODES)),
                   ("resume", RESUME_MODES)]
        wrong = [f"[global] {key}: {getattr(g, key)!r} is none of {', '.join(values)}"
                 for key, values in allowed if getattr(g, key) not in values]
        for k, db in enumerate(self.databases, 1):
            at = f"[[databases]] {db.name or k}"
            wrong += [f"{at} {key}: missing" for key in ("name", "driver", "dsn") if not getattr(db, key)]
            if db.driver and db.driver.strip().lower() not in DRIVER_ALIASES:
                wrong.append(f"{at} driver: {db.driver!r} is not known")
        known, writers = {db.name for db in self.databases if db.name}, {}
        for k, t in enumerate(self.tasks):
            at, before = f"[[tasks]] {t.name or k + 1}", len(wrong)
            if t.db not in known:
                wrong.append(f"{at} db: {t.db!r} is not among the databases" if t.db else f"{at} db: missing")
            if len([x for x in (t.tables, t.query) if x]) != 1:
                wrong.append(f"{at} tables, query: exactly one of them is needed")
            if t.query and not t.output:
                wrong.append(f"{at} output: a query needs the name of its output")
            wrong += [f"{at} tables: name {n} is empty" for n, table in enumerate(t.tables, 1) if not str(table).strip()]
            if t.format and t.format not in FORMATS:
                wrong.append(f"{at} format: {t.format!r} is none of {', '.join(FORMATS)}")
            if len(wrong) == before and g.default_format in FORMATS:
                for unit in self._units_of(t, k):
                    writers.setdefault(unit.target, []).append(unit.label)
        return wrong + [f"{target}: written by {' and '.join(labels)}" for target, labels in writers.items() if len(labels) > 1]

    def _units_of(self, t: TaskSpec, i: int) -> list["Unit"]:
        g = self.global_
        fmt = t.format or g.default_format
        out = g.output_dir.rstrip("/")
        label = t.name or f"task{i + 1}"
        if t.query:
            return [Unit(label, t.db, None, t.query, output_path(out, t.output, fmt), fmt, t, label)]
        return [Unit(label, t.db, tb, None, output_path(out, target_name(tb), fmt), fmt, t, f"{label}:{tb}")
                for tb in t.tables]

    def units(self) -> list["Unit"]:
        return [u for i, t in enumerate(self.tasks) for u in self._units_of(t, i)]


@dataclass
class Unit:
    task: str
    db: str
    table: str | None
    query: str | None
    target: str
    format: str
    spec: TaskSpec
    label: str


def output_path(output_dir: str, stem: str, fmt: str) -> str:
    suffix = FORMATS[fmt]
    name = stem if stem.endswith(suffix) else stem + suffix
    if "/" in name and (name.startswith("/") or "://" in name):
        return name
    return f"{output_dir}/{name}"


def make_source(db: DatabaseSpec, batch_size: int = 10000):
    """The source object of a database; ``batch_size`` is also its cursor fetch size."""
    kind = canonical_driver(db.driver)
    fetch = int(batch_options(batch_size)["fetchsize"])
    if kind == "parquet":
        from tablelift.sources.files import ParquetDirSource

        return ParquetDirSource(db.name, db.dsn)
    if kind == "catalog":
        from tablelift.sources.files import CatalogSource

        return CatalogSource(db.name, db.dsn)
    if kind == "sqlite":
        from tablelift.sources.sqlite import SqliteSource

        return SqliteSource(db.name, db.dsn, {"fetchsize": fetch, **db.options})
    if kind in JDBC_KINDS:
        from tablelift.sources.jdbc import JdbcSource

        return JdbcSource(db.name, db.driver, db.dsn, fetchsize=fetch, options=db.options,
                          max_partitions=db.max_open_conns)
    raise JobSpecError(f"E001 driver {db.driver!r} cannot be exported from")


def _classify(e: Exception, stage: str) -> str:
    msg = str(e)
    for code in ("E001", "E002", "E003", "E004", "E005", "E006"):
        if msg.startswith(code):
            return code
    return {"read": "E003", "conform": "E004", "write": "E005"}.get(stage, "E006")


def write_output(df: DataFrame, path: str, fmt: str, batch_size: int, max_rows_per_file: int | None = None,
                 batch_bytes: int | None = None) -> None:
    opts = batch_options(batch_size)
    if fmt == "parquet":
        write_parquet(df, path, batch_size=int(opts["parquet.block.row.count.limit"]),
                      max_records_per_file=max_rows_per_file, batch_bytes=batch_bytes)
    elif fmt == "arrow":
        write_arrow(df, path, batch_size=int(opts["batchSize"]), batch_bytes=batch_bytes)
    else:
        raise ValueError(f"E005 unknown format {fmt!r}")


def scan_unit(spark: SparkSession, source, unit: Unit) -> tuple[DataFrame, dict[str, str] | None]:
    """The scan of one export and its declared column types (``None``: derive from the schema)."""
    pc = unit.spec.partition_column
    if unit.query is not None:
        if isinstance(pc, str) and getattr(source, "kind", None) in JDBC_KINDS:
            return source.read_query(spark, unit.query, partition_column=pc, skewed=unit.spec.skewed), None
        return source.read_query(spark, unit.query), None
    col = pc.get(unit.table) if isinstance(pc, dict) else pc
    df = source.read_table(spark, unit.table, partition_column=col, skewed=unit.spec.skewed) \
        if col else source.read_table(spark, unit.table)
    declared = source.declared_types(spark, unit.table, df.columns, df=df)
    return df, {c: declared.get(c) or sql_type_name(df.schema[c].dataType) for c in df.columns}


def scan_tasks(df: DataFrame) -> int | None:
    """How many tasks read the source (1 for a JDBC table without a partition column: one
    connection reads it all, which the report makes visible).

    Only for plans without a shuffle: asking an adaptive plan for its partitions would run its
    shuffle stages. Query tasks and views with joins or aggregates report None.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan or "AdaptiveSparkPlan" in plan:
        return None
    return int(df._jdf.rdd().getNumPartitions())


def read_output(spark: SparkSession, target: str, fmt: str) -> DataFrame:
    """Read a published output (for versioned targets, the version ``_LATEST`` names)."""
    path = resolve_output(spark, target)
    if fmt == "arrow":
        from tablelift.sources.arrow_ipc import read_arrow

        return read_arrow(spark, path)
    return spark.read.parquet(path)


def export_unit(spark: SparkSession, source, unit: Unit, batch_size: int, overwrite: bool,
                max_rows_per_file: int | None = None, narrow: str = "null", publish: str = "swap",
                keys: tuple[str | None, str | None] = (None, None), batch_bytes: int | None = None) -> tuple:
    """Export one table or query; never raises. Returns one report row, which ends with ``keys``."""
    t0 = time.perf_counter()
    # Each export thread gets its own scheduler pool: under FAIR scheduling a small table is not
    # queued behind a large one; under FIFO the property is ignored.
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"tablelift-{unit.label}")
    stage = "check"
    staging = None
    try:
        pub = publisher(spark, unit.target, publish, overwrite)
        pub.begin()
        if pub.other_mode():
            raise FileExistsError(f"E005 output {unit.target} was published in the other mode")
        if pub.exists() and not overwrite:
            raise FileExistsError(f"E005 output {unit.target} exists and overwrite is off")
        stage = "read"
        df, declared = scan_unit(spark, source, unit)
        if batch_bytes and getattr(source, "kind", None) in JDBC_KINDS:
            source = copy.copy(source)  # other threads read from it with their own widths
            source.fetchsize = fetch_rows(df, batch_size, batch_bytes)
            df, declared = scan_unit(spark, source, unit)
        scan_partitions = scan_tasks(df)
        stage = "conform"
        conformed = conform(df, declared, dialect=getattr(source, "dialect", None), narrow=narrow)
        stage = "write"
        staging = pub.staging()
        spark.sparkContext.setJobDescription(f"export {unit.label} -> {unit.target}")
        write_output(conformed.df, staging, unit.format, batch_size, max_rows_per_file, batch_bytes)
        if not pub.succeeded(staging):
            raise OSError(f"E005 write of {unit.target} did not complete")
        m = conformed.metrics()  # before the publish: from there on nothing may fail
        rejects = {k: int(v) for k, v in conformed.rejects().items()}
        stamp = pub.stamp(staging)
        pub.publish(staging)
        published = pub.published(staging)
        staging = None
        return (unit.task, unit.db, unit.table or unit.query, unit.target, unit.format, "ok",
                int(m.get("rows", 0)), time.perf_counter() - t0, None, None, rejects, _now(), scan_partitions,
                published, *keys, stamp)
    except Exception as e:  # noqa: BLE001 - per-table isolation: report and continue
        if staging is not None:
            try:
                pub.discard(staging)
            except Exception:  # noqa: BLE001
                pass
        return (unit.task, unit.db, unit.table or unit.query, unit.target, unit.format, "failed",
                None, time.perf_counter() - t0, _classify(e, stage), _error_text(e), {}, _now(), None, None, *keys, None)


def publisher(spark: SparkSession, target: str, mode: str, overwrite: bool) -> Publisher:
    return VersionedPublisher(spark, target, overwrite) if mode == "versioned" else Publisher(spark, target)


def unit_key(job: ExportJob, unit: Unit) -> str:
    """Fingerprint of all that decides the values of an output: its source, table or query, format, place
    and conversion. Credentials don't count."""
    db = job.database(unit.db)
    place = re.sub(r"(?i)\b(password|pwd)=[^;&\s]*", "", db.dsn.rsplit("@", 1)[-1])
    parts = [db.name, canonical_driver(db.driver), place, unit.table, unit.query, unit.target, unit.format,
             job.global_.narrow, job.global_.publish]
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def last_states(spark: SparkSession, report_path: str, keys: list[str]) -> dict[str, dict]:
    """The last row of the stored run log for each of ``keys`` that has one (one row a unit comes back)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(report_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return {}
    log = spark.read.schema(REPORT_SCHEMA).parquet(report_path).where(F.col("unit_key").isin(keys))
    last = log.groupBy("unit_key").agg(F.max_by(F.struct(*log.columns), "finished_at").alias("row"))
    return {r["unit_key"]: r["row"].asDict() for r in last.collect()}


def _still_good(spark: SparkSession, unit: Unit, g: GlobalSpec, source_key: str | None, before: dict | None) -> bool:
    """Whether the output of an earlier run stands for this one: its last state is a success, its source is
    the same (or not asked for), and what the target holds is still that run's output."""
    if before is None or before["status"] not in ("ok", "kept"):
        return False
    if g.resume == "unchanged" and (source_key is None or source_key != before["source_key"]):
        return False
    pub = publisher(spark, unit.target, g.publish, g.overwrite)
    live = resolve_output(spark, unit.target)
    return live == before["published"] and before["output_stamp"] is not None and pub.stamp(live) == before["output_stamp"]


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def run(spark: SparkSession, job: ExportJob, report_path: str | None = None) -> DataFrame:
    """Run every export of ``job``; returns the run report (one row per table or query).

    With ``resume`` the rows of a stored run log decide what is left to do: a unit (same source, table or
    query, format, target and conversion) whose last row is a success, whose source has the same
    fingerprint and whose output is still the one written then gets a row ``kept`` with that run's
    figures; all others are exported. Sources without a fingerprint (databases) always count as changed
    unless ``resume = "done"``. Each row is stored when its unit ends. One run at a time writes a log.
    """
    job.validate()
    sources = {}
    for db in job.databases:
        src = make_source(db, job.global_.batch_size)
        src.ping(spark)  # fail fast before any export (E002)
        sources[db.name] = src
    units = job.units()
    g = job.global_
    if g.resume != "off" and not report_path:
        raise JobSpecError("E001 [global] resume: needs the path of a stored run log")
    keys = {id(u): unit_key(job, u) for u in units}
    before = last_states(spark, report_path, list(keys.values())) if g.resume != "off" else {}
    log = threading.Lock()

    def export(u: Unit) -> tuple:
        state = _source_key(spark, sources[u.db], u) if report_path else None
        known = before.get(keys[id(u)])
        try:
            kept = _still_good(spark, u, g, state, known)
        except Exception:  # noqa: BLE001 - an output that can't be looked at is exported again, which reports why
            kept = False
        if kept:
            row = tuple((known | {"status": "kept", "seconds": 0.0, "finished_at": _now()}).values())
        else:
            row = export_unit(spark, sources[u.db], u, g.batch_size, g.overwrite, g.max_rows_per_file, g.narrow,
                              g.publish, (keys[id(u)], state), g.batch_bytes)
        if g.resume != "off":  # at once: a driver that is lost later leaves what is done in the log
            with log:
                spark.createDataFrame([row], REPORT_SCHEMA).coalesce(1).write.mode("append").parquet(report_path)
        return row

    with ThreadPoolExecutor(max_workers=max(1, g.workers)) as pool:
        rows = list(pool.map(export, units))
    report = spark.createDataFrame(rows, REPORT_SCHEMA)
    if report_path and g.resume == "off":
        report.write.mode("append").parquet(report_path)
    return report


def _source_key(spark: SparkSession, source, unit: Unit) -> str | None:
    """The source's fingerprint of what the unit reads, taken before it is read; None where a source has none."""
    if not hasattr(source, "fingerprint"):
        return None
    try:
        return source.fingerprint(spark, table=unit.table, sql=unit.query)
    except Exception:  # noqa: BLE001 - the read itself reports what is wrong with the source
        return None


def report_summary(report: DataFrame) -> DataFrame:
    """Totals of a run report: tables, failed tables, rows written, and the sum of per-table seconds."""
    return report.agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.sum("rows").alias("rows"),
        F.sum("seconds").alias("seconds"),
    )


def _error_text(e: Exception) -> str:
    """The whole text of the error, the Python worker's traceback included when Spark wraps one."""
    return str(e) or type(e).__name__
