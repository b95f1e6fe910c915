"""IP text to comparable values, CIDR blocks and predicates, all in built-in functions.

IPv4 addresses are BIGINT, IPv6 addresses are BINARY(16): both compare in numeric order.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from nameledger.functions.text import as_column, let, trimmed

# Fixed patterns: dotted quad without leading zeros; colon groups with at most one "::".
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_PATTERN = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
_GROUPS = r"[0-9a-f]{1,4}(?::[0-9a-f]{1,4})*"
IPV6_PATTERN = rf"^(?:{_GROUPS})?(?:::(?:{_GROUPS})?)?$"

IPV4_MAPPED_PREFIX = "00000000000000000000ffff"
MAX_IPV4 = 2**32 - 1


def _quad_number(text: Column) -> Column:
    return F.aggregate(
        F.split(text, r"\."),
        F.lit(0).cast("bigint"),
        lambda total, octet: total * 256 + octet.cast("bigint"),
    )


def ipv4_to_long(value: Column | str) -> Column:
    """Dotted quad as BIGINT; null when the text is not one."""
    text = as_column(value)
    return F.when(text.rlike(IPV4_PATTERN), _quad_number(text))


def _plain_groups(text: Column) -> Column:
    """The address with a dotted tail written as two colon groups instead."""

    def from_tail(tail: Column) -> Column:
        def two_groups(quad: Column) -> Column:
            return F.concat(
                F.left(text, F.length(text) - F.length(tail)),
                F.lower(F.hex(F.shiftright(quad, 16))),
                F.lit(":"),
                F.lower(F.hex(quad.bitwiseAND(0xFFFF))),
            )

        return F.when(tail.contains("."), let(ipv4_to_long(tail), two_groups)).otherwise(text)

    return let(F.substring_index(text, ":", -1), from_tail)


def _ipv6_hex(value: Column | str) -> Column:
    """IPv6 text as 32 lower-case hex digits; null when the text is not an IPv6 address."""
    text = as_column(value)

    def from_groups(groups: Column) -> Column:
        squeezed = groups.contains("::")
        head = F.split(F.substring_index(groups, "::", 1), ":")
        rest = F.when(squeezed, F.split(F.substring_index(groups, "::", -1), ":"))

        def from_sides(sides: Column) -> Column:
            gap = F.lit(8) - F.size(sides["head"]) - F.size(sides["rest"])
            zeros = F.array_repeat(F.lit("0"), gap)
            digits = F.transform(
                F.concat(sides["head"], zeros, sides["rest"]), lambda g: F.lpad(g, 4, "0")
            )
            fits = F.when(sides["squeezed"], gap >= 1).otherwise(gap == 0)
            return F.when(fits, F.array_join(digits, ""))

        sides = F.struct(
            squeezed.alias("squeezed"),
            F.filter(head, lambda g: g != "").alias("head"),
            F.filter(F.coalesce(rest, _no_text()), lambda g: g != "").alias("rest"),
        )
        return F.when(groups.rlike(IPV6_PATTERN), let(sides, from_sides))

    return F.when(
        text.contains(":"), let(F.lower(text), lambda t: let(_plain_groups(t), from_groups))
    )


def _no_text() -> Column:
    return F.array().cast("array<string>")


def ip_version(value: Column | str) -> Column:
    """4, 6, or 0 for text that is not an IP address."""
    text = as_column(value)
    return (
        F.when(text.rlike(IPV4_PATTERN), 4)
        .when(text.contains(":") & _ipv6_hex(text).isNotNull(), 6)
        .otherwise(0)
    )


def ipv6_to_bytes(value: Column | str) -> Column:
    """IPv6 text as BINARY(16); null for anything else."""
    text = as_column(value)
    return F.when(text.contains(":"), F.unhex(_ipv6_hex(text)))


def ip_to_bytes16(value: Column | str) -> Column:
    """Either version as BINARY(16), IPv4 in its IPv4-mapped place."""
    text = as_column(value)
    v4_hex = F.lpad(F.hex(ipv4_to_long(text)), 8, "0")
    return F.when(
        text.rlike(IPV4_PATTERN), F.unhex(F.concat(F.lit(IPV4_MAPPED_PREFIX), v4_hex))
    ).otherwise(ipv6_to_bytes(text))


def lookup_v4(value: Column | str) -> Column:
    """BIGINT of an address that belongs in the IPv4 table, IPv4-mapped IPv6 included."""
    text = as_column(value)
    mapped = let(
        _ipv6_hex(trimmed(text)),
        lambda digits: F.when(
            digits.startswith(IPV4_MAPPED_PREFIX), F.conv(F.right(digits, F.lit(8)), 16, 10)
        ).cast("bigint"),
    )
    return (
        F.when(text.rlike(IPV4_PATTERN), _quad_number(text))
        .when(text.contains(":"), mapped)
        .otherwise(let(trimmed(text), ipv4_to_long))
    )


def lookup_v6(value: Column | str) -> Column:
    """BINARY(16) of an address that belongs in the IPv6 table."""
    text = as_column(value)
    native = let(
        _ipv6_hex(trimmed(text)),
        lambda digits: F.when(~digits.startswith(IPV4_MAPPED_PREFIX), F.unhex(digits)),
    )
    return F.when(text.contains(":"), native)


def cidr_range_v4(value: Column | str) -> Column:
    """Inclusive STRUCT<start, end> of an IPv4 block; host bits are ignored, null when invalid.

    The part after the slash may be a length, a netmask or a host mask; without one it is /32.
    """
    text = trimmed(value)
    address = ipv4_to_long(F.substring_index(text, "/", 1))
    suffix = F.when(text.contains("/"), F.substring_index(text, "/", -1)).otherwise("32")
    bits = F.when(suffix.rlike("^[0-9]{1,3}$"), suffix.cast("int"))
    mask = ipv4_to_long(suffix)
    inverse = F.lit(MAX_IPV4) - mask
    host = (
        F.when(bits.between(0, 32), F.pow(2, 32 - bits).cast("bigint") - 1)
        .when(inverse.bitwiseAND(inverse + 1) == 0, inverse)
        .when(mask.bitwiseAND(mask + 1) == 0, mask)
    )
    start = address - address.bitwiseAND(host)
    single_slash = F.size(F.split(text, "/")) <= 2
    return F.when(
        start.isNotNull() & single_slash, F.struct(start.alias("start"), (start + host).alias("end"))
    )


def cidr_range_v6(value: Column | str) -> Column:
    """Inclusive STRUCT<start, end> of an IPv6 block as BINARY(16); null when invalid."""
    text = trimmed(value)
    return let(_ipv6_hex(F.substring_index(text, "/", 1)), lambda d: _block_v6(text, d))


def _block_v6(text: Column, digits: Column) -> Column:
    suffix = F.when(text.contains("/"), F.substring_index(text, "/", -1)).otherwise("128")
    bits = F.when(suffix.rlike("^[0-9]{1,3}$"), suffix.cast("int"))
    whole = F.floor(bits / 4).cast("int")
    # The hex digit the prefix ends in keeps its first (bits % 4) binary digits.
    low = F.pow(2, 4 - bits % 4).cast("int") - 1
    digit = F.conv(F.substr(digits, whole + 1, F.lit(1)), 16, 10).cast("int")
    partial = (bits % 4) > 0
    low_digit = F.when(partial, F.lower(F.hex(digit - digit.bitwiseAND(low)))).otherwise("")
    high_digit = F.when(partial, F.lower(F.hex(digit.bitwiseOR(low)))).otherwise("")
    prefix = F.left(digits, whole)
    start = F.unhex(F.rpad(F.concat(prefix, low_digit), 32, "0"))
    end = F.unhex(F.rpad(F.concat(prefix, high_digit), 32, "f"))
    single_slash = F.size(F.split(text, "/")) <= 2
    return F.when(
        digits.isNotNull() & bits.between(0, 128) & single_slash,
        F.struct(start.alias("start"), end.alias("end")),
    )


def host_network(value: Column | str) -> Column:
    """The one-address network of an IP: ``/32`` or ``/128``; null for anything else."""
    text = as_column(value)
    version = ip_version(text)
    return F.when(version == 4, F.concat(text, F.lit("/32"))).when(
        version == 6, F.concat(text, F.lit("/128"))
    )


def is_public_ipv4(value: Column | str) -> Column:
    """False for private, loopback, link-local, this-network, multicast and reserved space."""
    ip = ipv4_to_long(value)
    # 0/8, 10/8, 127/8, 169.254/16, 172.16/12, 192.168/16, 224/3.
    reserved = (
        ip.between(0, 16777215)
        | ip.between(167772160, 184549375)
        | ip.between(2130706432, 2147483647)
        | ip.between(2851995648, 2852061183)
        | ip.between(2886729728, 2887778303)
        | ip.between(3232235520, 3232301055)
        | (ip >= 3758096384)
    )
    return ip.isNotNull() & ~reserved
