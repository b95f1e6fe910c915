import ipaddress
import random

from pyspark.sql import functions as F

from nameledger.functions import domains as D
from nameledger.functions import ip as IP
from nameledger.functions import records as R
from nameledger.functions.text import is_blank, trimmed


def values(df, *columns):
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


NAMES = {
    " Example.COM.. ": "example.com",
    " \tApi.Example.com　": "api.example.com",
    "a_b.example": None,
    "-a.example": None,
    "a-.example": None,
    "ab--cd.example": None,
    "a-b.example": "a-b.example",
    "a..b": "a..b",
    "foo. .": None,
    "   ": None,
    "...": None,
    "": None,
    "Bücher.example": "xn--bcher-kva.example",
    "XN--BCHER-KVA.example": "xn--bcher-kva.example",
    "xn--a.example": None,
    "faß.example": "xn--fa-hia.example",
    "日本。jp": "xn--wgv71a.jp",
    "☃.example": "xn--n3h.example",
    "אבג.example": "xn--4dbcd.example",
}


def test_canonical_domains(rows):
    df = rows([(n,) for n in NAMES] + [(None,)], "d string")
    want = [*NAMES.values(), None]
    assert values(df, D.normalize_domain("d")) == want
    assert values(D.with_domain(df, "d", "n"), "n") == want
    listed = D.with_domain_arrays(df, {"n": F.array("d", F.lit("X.Y."))})
    assert values(listed, "n") == [[w, "x.y"] for w in want]


def test_without_idna_only_plain_names_pass(rows):
    df = rows([(n,) for n in NAMES], "d string")
    want = [w if w and "xn--" not in w else None for w in NAMES.values()]
    assert values(df, D.normalize_domain("d", idna=False)) == want
    assert values(D.with_domain(df, "d", "n", idna=False), "n") == want


def test_lite_form_drops_one_dot_only(rows):
    df = rows([(" A.Com.. ",)], "d string")
    assert values(df, D.normalize_domain_lite("d")) == ["a.com."]


def test_trim_and_blank(rows):
    df = rows([(" x y ",), ("　",), (None,), ("z",), ("\n",)], "t string")
    assert values(df, trimmed("t")) == ["x y", "", None, "z", ""]
    assert values(df, is_blank("t")) == [False, True, True, False, True]


# Hash and shard of four for these names.
SHARDS = {
    "example.com": (2742658806, 2),
    "api.example.com": (3502521656, 0),
    "shop.example.com": (2501256098, 2),
    "media.example.net": (451309667, 3),
    "svc.internal": (3842674945, 1),
    "db.internal": (1582922034, 2),
    "api.service.local": (3198017919, 3),
    "gateway.lan": (756478314, 2),
}


def test_shard_ids(rows):
    df = rows([(n,) for n in SHARDS], "d string")
    assert values(df, D.domain_hash("d"), D.shard_id("d")) == list(SHARDS.values())


def test_tags(rows):
    df = rows([("cdn.x.com", "www.google.com"), ("a.com", "instagram.com"), ("b", "whatsapp.net")],
              "d string, base string")
    got = values(df, *D.domain_tags("d", "base").values())
    assert got == [
        (True, True, False, False, False),
        (False, False, True, True, False),
        (False, False, False, False, True),
    ]


ADDRESSES = [
    "1.2.3.4", "0.0.0.0", "255.255.255.255", "01.2.3.4", "256.1.1.1", "1.2.3", "1.2.3.4.5", "",
    "::", "::1", "2001:db8::1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1::2::3", "1:2:3:4:5:6:7::",
    "::2:3:4:5:6:7:8", "::ffff:10.0.0.42", "::ffff:1.2.3.400", "1:2:3:4:5:6:1.2.3.4",
    "1:2:3:4:5:6:7:1.2.3.4", "1:2:3:4::5:6:7:8", "12345::", ":::", ":1", "1:", "x::1", "junk",
    "FE80::ABCD", "1:2:3:4:5:6:7:8:9",
]


def parsed(text):
    try:
        return ipaddress.ip_address(text)
    except ValueError:
        return None


def test_addresses_agree_with_the_standard_library(rows):
    df = rows([(a,) for a in ADDRESSES], "ip string")
    got = values(df, IP.ip_version("ip"), IP.ipv4_to_long("ip"), F.hex(IP.ipv6_to_bytes("ip")),
                 IP.host_network("ip"))
    for text, (version, v4, v6, net) in zip(ADDRESSES, got):
        ip = parsed(text)
        assert version == (ip.version if ip else 0), text
        assert v4 == (int(ip) if ip and version == 4 else None), text
        assert v6 == (f"{int(ip):032X}" if ip and version == 6 else None), text
        assert net == (f"{text}/{32 if version == 4 else 128}" if ip else None), text


def test_random_ipv6_text(rows):
    rng = random.Random(7)
    texts = []
    for _ in range(300):
        number = rng.getrandbits(128) & rng.choice([2**128 - 1, 2**64 - 1, ~(2**80 - 1), 0xFFFF << 64])
        ip = ipaddress.IPv6Address(number % 2**128)
        texts += [ip.compressed, ip.exploded]
    got = values(rows([(t,) for t in texts], "ip string"), F.hex(IP.ip_to_bytes16("ip")))
    assert got == [f"{int(ipaddress.ip_address(t)):032X}" for t in texts]


def test_bytes_order_is_numeric_order(rows):
    texts = ["1.2.3.4", "255.0.0.1", "2001:db8::", "::", "ffff::", "::1:0:0"]
    df = rows([(t,) for t in texts], "ip string")
    ordered = values(df.orderBy(IP.ip_to_bytes16("ip")), "ip")

    def place(text):
        ip = ipaddress.ip_address(text)
        return int(ip) + (0xFFFF << 32 if ip.version == 4 else 0)

    assert ordered == sorted(texts, key=place)


BLOCKS = [
    "1.0.0.0/24", "10.1.2.3/8", "1.2.3.4", "1.2.3.4/33", "1.2.3.4/255.255.0.0", "1.2.3.4/0.0.0.255",
    "0.0.0.0/0", "9.9.9.9/32", "2001:db8::/120", "2001:db8::1/33", "::/0", "::1", "2001:db8::/129",
    "x/8", "2001:db8:ffff::/47", "1.2.3.4/5/6", "1.2.3.4/",
]


def test_cidr_blocks_agree_with_the_standard_library(rows):
    df = rows([(b,) for b in BLOCKS], "b string")
    got = values(df, IP.cidr_range_v4("b"), F.hex(IP.cidr_range_v6("b")["start"]),
                 F.hex(IP.cidr_range_v6("b")["end"]))
    for text, (v4, low, high) in zip(BLOCKS, got):
        try:
            net = ipaddress.ip_network(text, strict=False)
        except ValueError:
            net = None
        ends = (int(net[0]), int(net[-1])) if net else None
        assert (tuple(v4) if v4 else None) == (ends if net and net.version == 4 else None), text
        v6 = (int(low, 16), int(high, 16)) if low else None
        assert v6 == (ends if net and net.version == 6 else None), text


def test_public_ipv4(rows):
    private = ["10.1.1.1", "172.16.0.1", "172.31.255.255", "192.168.3.4", "127.0.0.1", "0.1.2.3",
               "169.254.0.1", "224.0.0.1", "255.1.1.1", "junk"]
    public = ["9.255.255.255", "11.0.0.0", "172.15.0.1", "172.32.0.0", "192.167.1.1", "223.9.9.9"]
    df = rows([(i,) for i in private + public], "ip string")
    assert values(df, IP.is_public_ipv4("ip")) == [False] * len(private) + [True] * len(public)


def test_keys(rows):
    df = rows([("a|A|1",), ("a|TXT|x|y",), ("a|A",)], "k string")
    got = values(df, R.parse_key("k"))
    assert [tuple(g) if g else None for g in got] == [("a", "A", "1"), ("a", "TXT", "x"), None]
    assert values(rows([("a", "A", "1")], "d string, t string, v string"),
                  R.make_key("d", "t", "v")) == ["a|A|1"]


def test_record_defaults(rows):
    df = rows([(["a", "b"], "z", "5"), ([], "z", "x"), (None, None, None), ([""], "z", "1.5")],
              "domains array<string>, domain string, seen string")
    assert values(df, R.first_domain("domains", "domain")) == ["a", "z", None, None]
    assert values(df, R.last_seen_or_zero("seen")) == [5, 0, 0, 0]


def test_times_and_json(rows):
    df = rows([(1705276800000001, None)], "us bigint, country string")
    assert values(df, R.to_micros(R.to_ts("us"))) == [1705276800000001]
    assert values(df, R.to_intel_json(F.struct("us", "country"))) == ['{"us":1705276800000001}']
