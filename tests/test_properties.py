"""Property tests: JVM-side expressions agree with plain-Python statements of the same rules."""

import subprocess
import sys

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions import casts
from tablelift.functions.types import target_type_col, target_type_name

from .conftest import SF_SMALL

INT64 = st.integers(min_value=-(2 ** 63), max_value=2 ** 63 - 1)


def _wrap(v: int, bits: int) -> int:
    m = 1 << bits
    return ((v + (m >> 1)) % m) - (m >> 1)


@settings(max_examples=5, deadline=None)
@given(st.lists(INT64, min_size=1, max_size=200))
def test_wrap_and_unsigned_match_twos_complement(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    c, t = F.col("v"), T.LongType()
    rows = df.select("v", *[casts.to_signed(c, t, b, "wrap").alias(f"s{b}") for b in (8, 16, 32)],
                     *[casts.to_unsigned(c, t, b).alias(f"u{b}") for b in (8, 16, 32, 64)]).collect()
    for r in rows:
        v = r["v"]
        for b in (8, 16, 32):
            assert r[f"s{b}"] == _wrap(v, b)
        for b in (8, 16, 32, 64):
            assert int(r[f"u{b}"]) == v % (1 << b)


@settings(max_examples=5, deadline=None)
@given(st.lists(INT64, min_size=1, max_size=200))
def test_null_on_overflow_matches_range_check(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    rows = df.select("v", *[casts.to_signed(F.col("v"), T.LongType(), b).alias(f"n{b}") for b in (8, 16, 32)]).collect()
    for r in rows:
        for b in (8, 16, 32):
            lo, hi = -(1 << (b - 1)), (1 << (b - 1)) - 1
            assert r[f"n{b}"] == (r["v"] if lo <= r["v"] <= hi else None)


NAMES = st.one_of(
    st.sampled_from(["int", "Integer ", "DECIMAL(10,2)", "numeric", "timestamp(6)", "TIMESTAMPTZ", "varchar(20)",
                     "FLOAT[]", "array<int>", "Bool", "time", "json", "uuid", "", "  text  ", "INT8", "serial"]),
    st.text(alphabet="abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789()[], _", max_size=16),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(NAMES, min_size=1, max_size=100))
def test_type_lookup_expression_matches_python(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select("n", target_type_col(F.col("n")).alias("t")).collect()
    for r in got:
        assert r["t"] == target_type_name(r["n"]), r["n"]


def test_cli_exit_codes(spark, scratch, tmp_path):
    job = tmp_path / "job.toml"
    job.write_text(f'[global]\noutput_dir = "{scratch}"\n[[databases]]\nname = "d"\ndriver = "parquet"\n'
                   f'dsn = "{SF_SMALL}"\n[[tasks]]\ndb = "d"\ntables = ["region", "nation"]\n')
    from tablelift.__main__ import main

    assert main(["--version"]) == 0
    assert main(["--config", str(job), "-verify", "-diff", f"{scratch}/diffs", "--log-level", "warn"]) == 0
    assert main(["-config", str(job)]) == 1  # outputs exist and overwrite is off
    bad = tmp_path / "bad.toml"
    bad.write_text('[[tasks]]\ndb = "nope"\ntables = ["x"]\n')
    assert main(["-config", str(bad)]) == 2
    out = subprocess.run([sys.executable, "-m", "tablelift", "-h"], capture_output=True, text=True, timeout=60)
    assert out.returncode == 0 and "-config" in out.stdout
