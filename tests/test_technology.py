"""Technology from MAC prefix."""

import itertools

import pytest
from pyspark.sql import functions as F

from tessera.functions import mac_prefix
from tessera.operators import resolve_technology
from tessera.operators.technology import DEFAULT_TECHNOLOGY, KNOWN_TECHNOLOGIES, MAC_PREFIX_TECHNOLOGY

REPORTED = [*KNOWN_TECHNOLOGIES, "Unheard", "", None]
SPELLINGS = {
    "plain": lambda mac: mac,
    "lower": str.lower,
    "colons": lambda mac: ":".join(mac[i:i + 2] for i in range(0, 12, 2)),
    "dashes": lambda mac: "-".join(mac[i:i + 2] for i in range(0, 12, 2)).lower(),
}


def cases():
    """Every known prefix and an unknown one, each reported value, each spelling; then no usable id."""
    for (n, prefix), reported, spell in itertools.product(enumerate([*MAC_PREFIX_TECHNOLOGY, "0A0B0C"]), REPORTED, SPELLINGS.values()):
        known = reported if reported in KNOWN_TECHNOLOGIES else DEFAULT_TECHNOLOGY
        yield spell(f"{prefix}{0x51A000 + n:06X}"), reported, MAC_PREFIX_TECHNOLOGY.get(prefix, known)
    for device, reported in itertools.product(("", "3C", None), REPORTED):
        yield device, reported, reported if reported in KNOWN_TECHNOLOGIES else DEFAULT_TECHNOLOGY


def test_resolution(spark):
    rows = [(i, *case) for i, case in enumerate(cases())]
    df = spark.createDataFrame([r[:3] for r in rows], "case_no int, id_controller string, technology string")
    got = {r["case_no"]: (r["technology"], r["reported_technology"]) for r in resolve_technology(df).collect()}
    assert got == {i: (expected, reported) for i, _, reported, expected in rows}


@pytest.mark.parametrize("device,prefix", [("9a:bc:de:f0:12:34", "9ABCDE"), ("9a-bc-de-f0-12-34", "9ABCDE"), ("ab", "AB"), (None, None)])
def test_mac_prefix_strips_separators_and_upper_cases(spark, device, prefix):
    df = spark.createDataFrame([(device,)], "d string")
    assert df.select(mac_prefix(F.col("d"))).first()[0] == prefix


def test_lookup_is_a_projection_not_a_join(spark):
    df = spark.createDataFrame([("0A0B0C000001", "Villa")], "id_controller string, technology string")
    plan = resolve_technology(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
