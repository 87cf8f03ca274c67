"""Addresses of both families and tables of blocks, against the standard library."""

from __future__ import annotations

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from marlstone.functions import network
from marlstone.operators.addresses import longest_blocks

TEXTS = [
    "10.0.0.1", "255.255.255.255", "0.0.0.0", "1.2.3", "1.2.3.4.5", "256.1.1.1", "", " 10.0.0.1", "n/a", "::", "::1", "1::", "2001:db8::1", "2001:DB8:0:0:0:0:0:ff",
    "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "8000::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4::5:6:7:8", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7", ":::",
    "1::2::3", "::ffff:192.168.1.9", "64:ff9b::10.0.0.300", "1:2:3:4:5:6:1.2.3.4", "12345::", "g::1", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "::1.2.3", "fe80::1%eth0",
]


def number(text):
    try:
        return None if not text or "%" in text else ipaddress.ip_address(text)
    except ValueError:
        return None


def test_parts_of_addresses(spark):
    rows = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string").select("t", network.address_parts(F.col("t")).alias("p")).collect()
    for r in rows:
        want = number(r["t"])
        assert (r["p"] is None) == (want is None), r
        if want is not None:
            assert (r["p"]["family"], (r["p"]["high"] % (1 << 64)) << 64 | r["p"]["low"] % (1 << 64)) == (want.version, int(want)), r


def test_parts_of_blocks(spark):
    rng = random.Random(1)
    texts = ["10.1.2.3/8", "10.1.2.3/33", "10.1.2.3/", "10.1.2.3/0", "10.1.2.3", "::/0", "::1/129", "1.2.3.4/8/8", "x/3", "1.2.3.4/-1", None]
    for _ in range(150):
        six = rng.random() < 0.6
        texts.append(f"{(ipaddress.IPv6Address if six else ipaddress.IPv4Address)(rng.getrandbits(128 if six else 32))}/{rng.randint(0, 128 if six else 32)}")
    for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", network.block_parts(F.col("t")).alias("b")).collect():
        try:
            want = ipaddress.ip_network(r["t"], strict=False) if r["t"] else None
        except ValueError:
            want = None
        assert (r["b"] is None) == (want is None), r
        if want:
            assert (r["b"]["family"], r["b"]["length"]) == (want.version, want.prefixlen)
            assert (r["b"]["high"] % (1 << 64)) << 64 | r["b"]["low"] % (1 << 64) == int(want.network_address), r


def given(spark, n=300):
    rng = random.Random(3)
    some = [str(ipaddress.IPv4Address(0x0A000000 + rng.getrandbits(12))) for _ in range(n // 2)]
    some += [str(ipaddress.IPv6Address(0x20010DB8 << 96 | rng.getrandbits(12))) for _ in range(n // 2)]
    rows = [(i, a) for i, a in enumerate([*some, *some[:40], *["10.0.0.7"] * 50, *[f"192.168.0.{i}" for i in range(30)], None, None, "none", "10.0.0"])]
    blocks = [f"10.0.{rng.randint(0, 15)}.{rng.randint(0, 255)}/{rng.randint(20, 32)}" for _ in range(60)]
    blocks += [f"2001:db8::{rng.getrandbits(12):x}/{rng.randint(112, 128)}" for _ in range(60)] + ["10.0.0.0/22", "10.0.0.0/22", "bad", None]
    table = [(b, f"v{i}") for i, b in enumerate(blocks)]
    return rows, table


def holder(address, table):
    a = number(address) if address else None
    found = {}
    for text, value in sorted(((t, v) for t, v in table if t and t != "bad"), key=lambda x: x):
        net = ipaddress.ip_network(text, strict=False)
        if a is not None and a.version == net.version and a in net:
            found.setdefault((net.prefixlen, net), (text, value))
    return found[max(found, key=lambda k: k[0])] if found else (None, None)


def test_longest_block_wins(spark):
    rows, table = given(spark)
    df, blocks = spark.createDataFrame(rows, "id int, ip string").repartition(4), spark.createDataFrame(table, "block string, name string")
    want = {i: holder(a, table) for i, a in rows}
    got = longest_blocks(df, "ip", blocks, "block").collect()
    assert {r["id"]: (r["block"], r["name"]) for r in got} == want and len(got) == len(rows)
    inside = {i for i, v in want.items() if v[0]}
    assert 100 < len(inside) < len(rows) - 20
    assert {r["id"] for r in longest_blocks(df, "ip", blocks, "block", "inner").collect()} == inside
    assert {r["id"] for r in longest_blocks(df, "ip", blocks, "block", "semi").collect()} == inside
    assert {r["id"] for r in longest_blocks(df, "ip", blocks, "block", "anti").collect()} == {i for i, _ in rows} - inside
    assert longest_blocks(df, "ip", blocks.where("false"), "block").where("name IS NOT NULL").isEmpty()
    with pytest.raises(ValueError, match="unknown way"):
        longest_blocks(df, "ip", blocks, "block", "cross")


def test_blocks_are_joined_by_equality(spark):
    rows, table = given(spark, 20)
    out = longest_blocks(spark.createDataFrame(rows, "id int, ip string"), "ip", spark.createDataFrame(table, "block string, name string"), "block")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("op", ["IN", "NOT IN", ">", ">=", "<", "<="])
def test_literal_filters_over_both_families(spark, op):
    values = ["10.0.0.0/22", "2001:db8::/124"] if "IN" in op else ["2001:db8::ff0/124"]
    rows, _ = given(spark)
    got = {r[0] for r in spark.createDataFrame(rows, "id int, ip string").where(network.text_address_filter(F.col("ip"), op, values)).collect()}
    key = lambda a: (a.version, int(a))
    nets = [ipaddress.ip_network(v) for v in values]
    tests = {
        "IN": lambda a: any(a in n for n in nets), "NOT IN": lambda a: not any(a in n for n in nets),
        ">": lambda a: key(a) > key(nets[0][-1]), ">=": lambda a: key(a) >= key(nets[0][-1]), "<": lambda a: key(a) < key(nets[0][0]), "<=": lambda a: key(a) <= key(nets[0][0]),
    }
    assert got == {i for i, t in rows if number(t or "") is not None and tests[op](number(t))}
    with pytest.raises(ValueError):
        network.text_address_filter(F.col("ip"), ">", ["10.0.0.1", "10.0.0.2"])
