"""All routes of signature checking against hashlib."""

import hashlib
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from tidewire.functions.digest import hmac_blocks, native_digest
from tidewire.operators.verify import verification_summary, verify_signatures

COLUMNS = ["n", "metric_value", "security_hash"]


def sign(value, key, iterations):
    salt = f"{value:.2f}".encode()
    return hashlib.pbkdf2_hmac("sha256", key.encode(), salt, iterations).hex()


def signed(key="k", iterations=1, n=4000):
    """A third of all rows share one value; some signatures are spoilt in different ways."""
    rnd = random.Random(5)
    rows, good = [], set()
    for i in range(n):
        value = 7.125 if i % 3 == 0 else rnd.choice([2.675, 0.125, 1.005, -0.001, rnd.uniform(-99, 99)])
        mark = sign(value, key, iterations)
        spoilt = {1: mark.upper(), 2: mark[::-1], 3: mark + "0", 4: "", 5: sign(value + 0.01, key, iterations)}
        mark = spoilt.get(i % 23, mark)
        if mark == sign(value, key, iterations):
            good.add(i)
        rows.append((i, value, mark))
    return pd.DataFrame(rows, columns=COLUMNS), good


def kept(df):
    return {r.n for r in df.select("n").collect()}


@pytest.mark.parametrize("route", ["native", "udf", "table", "auto"])
@pytest.mark.parametrize("key", ["k", "k" * 64, "ключ" * 30])
def test_routes_agree(spark, route, key):
    data, good = signed(key)
    df = spark.createDataFrame(data)
    out = verify_signatures(df, key, 1, route=route)
    assert out.columns == COLUMNS and kept(out) == good


@pytest.mark.parametrize("broadcast", [None, "-1"])
def test_wide_join_with_hot_salt(spark, broadcast):
    """More digests than may be broadcast: hot salts are spread, nothing is lost or doubled."""
    data, good = signed(iterations=2)
    extra = pd.DataFrame([(-1, None, "x"), (-2, 1.0, None)], columns=COLUMNS)
    df = spark.createDataFrame(pd.concat([data, extra]), "n long, metric_value double, security_hash string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        if broadcast:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        flagged = verify_signatures(df, "k", 2, keep_flag=True, broadcast_digests=0)
        assert flagged.count() == len(data) + 2
        assert kept(flagged.filter("verified")) == good
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_many_iterations_and_special_values(spark):
    values = [1e20, -1e300, float("inf"), float("-inf"), 12.0, 2.0**60]
    data = pd.DataFrame([(i, v, sign(v, "s", 700)) for i, v in enumerate(values)], columns=COLUMNS)
    for route in ("udf", "table"):
        assert kept(verify_signatures(spark.createDataFrame(data), "s", 700, route=route)) == set(range(6))


def test_native_refuses_what_it_cannot_format(spark):
    df = spark.createDataFrame([(1e20, "x")], "v double, s string")
    with pytest.raises(Exception, match="too large for the native digest"):
        df.select(native_digest(F.col("v"), "k")).collect()


def test_integer_values(spark):
    df = spark.createDataFrame([(1, 12, sign(12, "k", 3))], "n long, metric_value long, security_hash string")
    assert kept(verify_signatures(df, "k", 3)) == {1}


def test_key_stays_out_of_plans(spark, capsys):
    df = spark.createDataFrame(signed()[0])
    verify_signatures(df, "top-secret-key", 2).explain("extended")
    text = capsys.readouterr().out
    assert "top-secret-key" not in text and hmac_blocks("top-secret-key")[0][:20].upper() not in text.upper()


def test_no_rows(spark):
    df = spark.createDataFrame([], "n long, metric_value double, security_hash string")
    assert verify_signatures(df, "k", 5).count() == 0


@pytest.mark.parametrize("bad", [0, -1, True, 1.0])
def test_iterations_checked(spark, bad):
    with pytest.raises(ValueError):
        verify_signatures(spark.range(1), "k", bad)


def test_summary(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "e string, verified boolean")
    assert sorted(map(tuple, verification_summary(df, "e").collect())) == [("a", 1, 1), ("b", 1, 0)]
