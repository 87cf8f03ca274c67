"""Address and port predicates over integer or dotted-text columns."""

from __future__ import annotations

import ipaddress
import operator
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Service names and their ports.
SERVICE_PORTS = {
    "http": [80],
    "ssh": [22],
    "https": [443],
    "ftp": [20, 21],
    "ftps": [989, 990],
    "telnet": [23],
    "telnets": [992],
    "smtp": [25],
    "submissions": [465],
    "kerberos": [88],
    "kerberos-adm": [749],
    "poperator3": [110],
    "poperator3s": [995],
    "nntp": [119],
    "nntps": [563],
    "ntp": [123],
    "snmp": [161],
    "ldap": [389],
    "ldaps": [636],
    "imap2": [143],
    "imaps": [993],
    "MySQL": [3306],
    "Remote Desktop": [3389],
    "dns": [53],
    "ctf": [84],
    "pdap": [344],
}


def address_number(text: Column) -> Column:
    """Dotted IPv4 text to its number; null when it is not an address."""
    parts = [F.split_part(text, F.lit("."), F.lit(i)).try_cast("long") for i in range(1, 5)]
    valid = text.rlike(r"^(\d{1,3}\.){3}\d{1,3}$") & reduce(lambda a, b: a & b, [p <= 255 for p in parts])
    number = reduce(lambda total, part: total * 256 + part, parts)
    return F.when(valid, number)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` written and computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hextets(text: Column) -> Column:
    """The eight groups of an IPv6 text as hexadecimal digits; null when there are not eight."""

    def spelled(four: Column) -> Column:
        return F.concat(F.lower(F.hex(F.shiftright(four, 16))), F.lit(":"), F.lower(F.hex(four.bitwiseAND(F.lit(0xFFFF)))))

    def groups(part: Column) -> Column:
        return F.when(part == "", F.expr("array()").cast("array<string>")).otherwise(F.split(part, ":"))

    def filled(left: Column, right: Column) -> Column:
        missing = 8 - F.size(left) - F.size(right)
        return F.when(missing >= 1, F.concat(left, F.array_repeat(F.lit("0"), missing), right))

    def made(halves: Column) -> Column:
        short = F.when(F.size(halves) == 2, _let(groups(F.get(halves, 0)), lambda l: _let(groups(F.get(halves, 1)), lambda r: filled(l, r))))  # noqa: E741
        return F.when(F.size(halves) == 1, F.split(F.get(halves, 0), ":")).otherwise(short)

    # An address may end in a dotted one, which stands for its last two groups.
    tail = _let(address_number(F.regexp_extract(text, r"([0-9.]+)$", 1)), spelled)
    whole = F.lower(F.when(text.contains("."), F.concat(F.regexp_replace(text, r"[0-9.]+$", ""), tail)).otherwise(text))
    valid = lambda g: F.when((F.size(g) == 8) & F.forall(g, lambda x: x.rlike("^[0-9a-f]{1,4}$")), g)
    return _let(_let(F.split(whole, "::"), made), valid)


def address_parts(text: Column) -> Column:
    """Struct of ``family`` (4 or 6) and the 128 bits of an address in ``high`` and ``low``; null when it is none.

    IPv4 in dotted form has its number in ``low``.  IPv6 may leave out a
    stretch of zeros and end in a dotted address; zones are not known.
    """

    def half(groups: Column, begin: int) -> Column:
        group = lambda i: F.conv(F.get(groups, begin + i), 16, 10).cast("bigint")
        return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(group(i), 48 - 16 * i) for i in range(4)])

    def made(family: int, high: Column, low: Column) -> Column:
        return F.struct(F.lit(family).alias("family"), high.alias("high"), low.alias("low"))

    as_four = _let(address_number(text), lambda n: F.when(n.isNotNull(), made(4, F.lit(0).cast("bigint"), n)))
    as_six = _let(_hextets(text), lambda g: F.when(g.isNotNull(), made(6, half(g, 0), half(g, 4))))
    return F.when(text.contains(":"), as_six).otherwise(as_four)


def prefix_masks(family: int, length: int) -> tuple[int, int]:
    """Masks of the high and the low 64 bits that keep the first ``length`` bits, as signed numbers."""
    bits = 32 if family == 4 else 128
    mask = ((1 << length) - 1) << (bits - length)
    halves = mask >> 64, mask & (1 << 64) - 1
    return tuple(h - (1 << 64) if h >> 63 else h for h in halves)  # type: ignore[return-value]


def block_parts(text: Column) -> Column:
    """Struct of ``family``, ``length``, ``high`` and ``low`` of a block; null when it is none.

    A block is an address, a slash and the number of bits that count; without
    them all do.  Bits behind those are put to zero.
    """

    def kept(number: Column, size: Column) -> Column:
        """The first ``size`` of 64 bits."""
        rest = F.least(F.greatest(64 - size, F.lit(0)), F.lit(64))
        # A shift by 64 would be one by 0.
        return F.when(rest == 64, F.lit(0).cast("bigint")).otherwise(F.call_function("shiftleft", F.call_function("shiftright", number, rest), rest))

    def block(parts: Column, length: Column) -> Column:
        four = parts["family"] == 4
        high = F.when(four, F.lit(0).cast("bigint")).otherwise(kept(parts["high"], length))
        low = F.when(four, kept(parts["low"], length + 32)).otherwise(kept(parts["low"], length - 64))
        made = F.struct(parts["family"].alias("family"), length.alias("length"), high.alias("high"), low.alias("low"))
        return F.when(length.between(0, F.when(four, 32).otherwise(128)), made)

    def sized(parts: Column) -> Column:
        given = F.get(pieces, 1)
        bits = F.when(given.isNull(), F.when(parts["family"] == 4, 32).otherwise(128)).when(given.rlike("^[0-9]{1,3}$"), given.try_cast("int"))
        return F.when(parts.isNotNull() & (F.size(pieces) <= 2), _let(bits, lambda n: block(parts, n)))

    pieces = F.split(text, "/")
    return _let(address_parts(F.get(pieces, 0)), sized)


def address_range(text: str) -> tuple[int, int]:
    """First and last number of an address or CIDR block; error when invalid."""
    if text.isdigit():
        return int(text), int(text)
    try:
        block = ipaddress.ip_network(text, strict=False)
    except ValueError as error:
        raise ValueError(f"no address or block of addresses: {text!r}") from error
    return int(block[0]), int(block[-1])


#: Comparisons by name, and which end of a block each one looks at.
_COMPARE = {">=": (operator.ge, "end"), ">": (operator.gt, "end"), "<=": (operator.le, "start"), "<": (operator.lt, "start")}


def _inside(column: Column, blocks: Sequence[tuple[int, int]]) -> Column:
    return reduce(operator.or_, [column.between(low, high) if low < high else column == low for low, high in blocks])


def range_filter(column: Column, op: str, blocks: Sequence[tuple[int, int]], what: str) -> Column:
    """Membership in any of the blocks, or a comparison with the only one.

    ``>`` and ``>=`` compare with the end of a block, ``<`` and ``<=`` with its
    start.
    """
    if op in ("IN", "=="):
        return _inside(column, blocks)
    if op in ("NOT IN", "!="):
        return ~_inside(column, blocks)
    if op not in _COMPARE:
        raise ValueError(f"{what} cannot be filtered by {op}")
    if len(blocks) != 1:
        raise ValueError(f"{op} takes one value, not {len(blocks)}")
    compare, end = _COMPARE[op]
    return compare(column, F.lit(blocks[0][end == "end"]))


def address_filter(column: Column, op: str, values: Sequence[str]) -> Column:
    return range_filter(column, op, [address_range(str(v)) for v in values], "addresses")


def address_key(text: Column) -> Column:
    """What addresses of both families sort by: IPv4 first, then by number; null when it is no address."""
    least = F.lit(-(1 << 63)).cast("bigint")
    key = lambda p: F.struct(p["family"].alias("family"), p["high"].bitwiseXOR(least).alias("high"), p["low"].bitwiseXOR(least).alias("low"))
    return _let(address_parts(text), lambda p: F.when(p.isNotNull(), key(p)))


def _literal_key(family: int, number: int) -> Column:
    halves = [h - (1 << 63) for h in (number >> 64, number & (1 << 64) - 1)]
    return F.struct(F.lit(family).alias("family"), *[F.lit(h).cast("bigint").alias(n) for h, n in zip(halves, ("high", "low"))])


def text_address_filter(text: Column, op: str, values: Sequence[str]) -> Column:
    """As ``address_filter``, for texts of IPv4 and IPv6 addresses; families are never equal, IPv4 comes before IPv6."""
    if any(str(v).isdigit() for v in values):
        raise ValueError("addresses are compared with texts of addresses or blocks")
    if op not in ("IN", "==", "NOT IN", "!=", *_COMPARE):
        raise ValueError(f"addresses cannot be filtered by {op}")
    if op in _COMPARE and len(values) != 1:
        raise ValueError(f"{op} takes one value, not {len(values)}")
    blocks = []
    for v in values:
        family = ipaddress.ip_network(v, strict=False).version
        blocks.append(tuple(_literal_key(family, number) for number in address_range(str(v))))

    def test(key: Column) -> Column:
        if op in _COMPARE:
            compare, end = _COMPARE[op]
            return compare(key, blocks[0][end == "end"])
        inside = reduce(operator.or_, [(key >= low) & (key <= high) for low, high in blocks])
        return inside if op in ("IN", "==") else ~inside

    return _let(address_key(text), test)


def ports_of(value: str | int) -> list[int]:
    """The ports that a number or a service name stands for, ascending."""
    text = str(value)
    if text in SERVICE_PORTS:
        return sorted(SERVICE_PORTS[text])
    if not text.isdecimal() or not 0 < int(text) < 1 << 16:
        raise ValueError(f"no port or service: {text!r}")
    return [int(text)]


def port_filter(column: Column, op: str, values: Sequence[str | int]) -> Column:
    """Ports in a list, or a comparison: upwards from the smallest, downwards from the largest of the ports meant."""
    ports = sorted({p for v in values for p in ports_of(v)})
    if op in _COMPARE:
        ports = ports[:1] if op[0] == ">" else ports[-1:]
    return range_filter(column, op, [(p, p) for p in ports], "ports")
